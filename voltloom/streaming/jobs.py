"""Structured Streaming jobs over reading, forecast and daily feeds."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..core import keep_last

c = F.col


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, per_trigger: int | None = None) -> DataFrame:
    """Parquet folder as a stream."""
    r = spark.readStream.schema(schema)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.parquet(path)


def completed_hours(readings: DataFrame, keys: Sequence[str], value: str, watermark: str = "2 hours", min_count: int = 10, last_minute: int = 55) -> DataFrame:
    """An hour is emitted once the watermark has passed it, if it has enough readings and a late enough one."""
    g = readings.withWatermark("DT", watermark).groupBy(*keys, F.window("DT", "1 hour")).agg(
        F.avg(value).alias("MWH"), F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.max("DT").alias("_last"))
    late = F.unix_seconds("_last") - F.unix_seconds("window.start") >= last_minute * 60
    return g.where((c("n") >= min_count) & late).select(*keys, c("window.end").alias("DT"), "MWH", "n", "min", "max")


def first_seen(readings: DataFrame, keys: Sequence[str], watermark: str = "1 hour") -> DataFrame:
    """Copies within the watermark are dropped; the first is kept."""
    return readings.withWatermark("DT", watermark).dropDuplicatesWithinWatermark([*keys, "DT"])


def sliding_stats(readings: DataFrame, keys: Sequence[str], value: str, length: str = "24 hours", slide: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    g = readings.withWatermark("DT", watermark).groupBy(*keys, F.window("DT", length, slide)).agg(F.avg(value).alias("avg"), F.stddev_samp(value).alias("std"), F.count(value).alias("n"))
    return g.select(*keys, c("window.start").alias("start"), c("window.end").alias("end"), "avg", "std", "n")


def live_error(actuals: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream of actuals against a stored forecast."""
    j = actuals.join(forecast, [*keys, "DT"])
    return j.withColumn("Residual_MWH", c("Actual_MWH") - c("Forecast_MWH"))


def hot_sessions(daily: DataFrame, keys: Sequence[str], threshold: float, gap: str = "36 hours", watermark: str = "2 days") -> DataFrame:
    """Runs of hot days as sessions: a gap of a calendar day closes a run."""
    hot = daily.where(c("Temperature_DailyMax") >= threshold).withWatermark("DT", watermark)
    g = hot.groupBy(*keys, F.session_window("DT", gap)).agg(F.count("*").alias("days"), F.max("Temperature_DailyMax").alias("peak"))
    return g.select(*keys, c("session_window.start").alias("start"), "days", "peak")


_TRACK_OUT = "series string, DT timestamp, n long, ewma double"
_TRACK_STATE = "n long, ewma double, last timestamp"


def _track(alpha: float) -> Callable:
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, ew, last = state.get if state.exists else (0, 0.0, None)
        out = []
        pdf = pd.concat(list(batches)).sort_values("DT")
        for dt, r in zip(pdf["DT"], pdf["Residual_MWH"], strict=True):
            if last is not None and dt <= pd.Timestamp(last):
                continue  # a row older than the state was already counted or is too late
            ew = r if n == 0 else alpha * r + (1 - alpha) * ew
            n, last = n + 1, dt
            out.append((key[0], dt, n, float(ew)))
        state.update((n, float(ew), last))
        yield pd.DataFrame(out, columns=["series", "DT", "n", "ewma"])

    return run


def residual_tracker(residuals: DataFrame, alpha: float = 0.2) -> DataFrame:
    """Running, exponentially weighted residual of each series, kept in the state store."""
    return residuals.groupBy("series").applyInPandasWithState(_track(alpha), _TRACK_OUT, _TRACK_STATE, "append", GroupStateTimeout.NoTimeout)


def upsert_latest(path: str, keys: Sequence[str], order: Sequence[str], day: str = "Date") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that keeps the last row per key: the touched days are merged with the batch and replaced.

    A day is rewritten as a whole partition, so a repeated batch gives the same
    table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        exists = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
        merged = batch
        if exists:
            days = batch.select(day).distinct()
            merged = spark.read.parquet(path).join(days, day, "left_semi").unionByName(batch, allowMissingColumns=True)
        one = keep_last(merged, list(keys), list(order)).select(*batch.columns)
        staged = f"{path.rstrip('/')}__stage/{batch_id}"
        one.write.mode("overwrite").parquet(staged)  # the source partitions are read before they are replaced
        spark.read.schema(one.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)

    return write


def run_available(df: DataFrame, name_or_path: str, checkpoint: str, mode: str = "append", fmt: str = "memory") -> None:
    """Process what is there and stop."""
    w = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    q = w.format("memory").queryName(name_or_path).start() if fmt == "memory" else w.format(fmt).option("path", name_or_path).start()
    q.awaitTermination()


def run_batches(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    df.writeStream.foreachBatch(fn).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()
