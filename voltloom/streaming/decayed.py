"""Time-decayed residual of each series as a mergeable state with event-time timers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY = 86_400
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state_store(spark: SparkSession) -> Iterator[None]:
    """``transformWithState`` needs the RocksDB state store; the session's own setting comes back after the block."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, old) if old else spark.conf.unset(_PROVIDER)


class DecayedResidual(StatefulProcessor):
    """Per key: one sum per open day, anchored at the day's end, and the total of the closed ones.

    A sum is (count, weight, weighted residual). Sums of a day add up, so the order of rows
    and batches does not matter; a closed day is folded into the total after the total has
    decayed to the day's end. A batch of rows is one group-by, never a loop over rows.
    """

    def __init__(self, half_life_hours: float):
        self.half_life = half_life_hours * 3600.0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "day long", "n long, w double, s double")
        self.total = handle.getValueState("total", "day long, n long, w double, s double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            at = pdf["seconds"].to_numpy()
            day = (at // DAY).astype("int64")
            weight = np.exp2(-((day + 1) * DAY - at) / self.half_life)
            g = pd.DataFrame({"n": 1, "w": weight, "s": weight * pdf["Residual_MWH"].to_numpy()}).groupby(day).sum()
            for d, n, w, s in g.itertuples():  # one step per day of the batch
                k = (int(d),)
                old = self.open.getValue(k) if self.open.containsKey(k) else None
                if old is None:
                    self.handle.registerTimer((int(d) + 1) * DAY * 1000)
                    old = (0, 0.0, 0.0)
                self.open.updateValue(k, (int(old[0] + n), float(old[1] + w), float(old[2] + s)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() // 1000
        k = (int(end // DAY) - 1,)
        if not self.open.containsKey(k):
            return
        n, w, s = self.open.getValue(k)
        self.open.removeKey(k)
        if self.total.exists():
            day, tn, tw, ts = self.total.get()
            decay = 2.0 ** (-(k[0] - day) * DAY / self.half_life)
            n, w, s = n + tn, w + tw * decay, s + ts * decay
        self.total.update((k[0], int(n), float(w), float(s)))
        yield pd.DataFrame({"series": [key[0]], "DT": [pd.Timestamp(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(end)))], "n": [int(n)], "weight": [float(w)], "ewma": [float(s / w)]})

    def close(self) -> None:
        pass


def decayed_residuals(residuals: DataFrame, half_life_hours: float = 72.0, watermark: str = "1 day", keys: Sequence[str] = ("series",)) -> DataFrame:
    """Stream of (series, DT, Residual_MWH) to the decayed mean residual at the end of each closed day.

    The residual of a row counts 2^(-age / ``half_life_hours``). A day (UTC) that has rows of
    a series is emitted once, when the watermark has passed its end: rows that come late but
    within the watermark count as in a batch. Rows without a time or residual are left out,
    later rows are dropped by the watermark. Start the stream inside ``keyed_state_store``.
    """
    (key,) = keys
    clean = residuals.where(F.col("DT").isNotNull() & F.col("Residual_MWH").isNotNull()).withWatermark("DT", watermark)
    rows = clean.select(F.col(key).alias("series"), "DT", F.col("Residual_MWH").cast("double").alias("Residual_MWH"), (F.unix_micros("DT") / 1e6).alias("seconds"))
    return rows.groupBy("series").transformWithStateInPandas(DecayedResidual(half_life_hours), "series string, DT timestamp, n long, weight double, ewma double", "append", "EventTime")
