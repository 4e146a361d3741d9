"""Gap-safe lags, rolling statistics and load-decay shapes of an hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import chunk_window, chunked, epoch_hour, own_rows

# Lag steps and rolling windows, in hours.
LAGS = (1, 2, 3, 24, 48, 72, 168)
ROLLING = (3, 6, 12, 24, 48, 168)
CHUNK_HOURS = 24 * 90


def add_calendar_lags(df: DataFrame, keys: Sequence[str] = ("series",), value: str = "MWH", t: Column | None = None,
                      lags: Sequence[int] = LAGS, rolling: Sequence[int] = ROLLING,
                      chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Lags by clock time, not by row: a missing hour gives null and shifts nothing.

    Every frame reaches back at most 168 hours (or the greatest lag asked for),
    so it is computed per (series, time chunk) with that halo.
    Rows must be unique per (series, hour).
    """
    reach = max([*lags, *rolling, 168])
    hour = t if t is not None else epoch_hour("DT")
    c = chunked(df, hour, chunk_hours, back=reach)
    w = chunk_window(keys)
    v = F.col(value)

    def at(n: int) -> Column:
        return F.max(v).over(w.rangeBetween(-n, -n))

    cols = {f"{value}_Lag{n}": at(n) for n in lags}
    for n in rolling:
        frame = w.rangeBetween(-n, -1)
        need = max(2, min(n, int(n * 0.5)))
        cols[f"{value}_Rolling{n}"] = F.when(F.count(v).over(frame) >= need, F.avg(v).over(frame))
    if 24 in rolling:
        day = w.rangeBetween(-24, -1)
        std = F.when(F.count(v).over(day) >= 12, F.stddev_samp(v).over(day))
        cols[f"{value}_Rolling24Std"] = F.coalesce(std, F.lit(0.0))
    same = [at(24 * i) for i in range(1, 8)]
    for i, s in enumerate(same, 1):
        cols[f"_same{i}"] = s
    out = c.withColumns(cols)
    present = sum(F.when(F.col(f"_same{i}").isNotNull(), 1).otherwise(0) for i in range(1, 8))
    total = sum(F.coalesce(F.col(f"_same{i}"), F.lit(0.0)) for i in range(1, 8))
    out = out.withColumn(f"{value}_SameHour7DayMean", F.when(present > 0, total / present))
    return own_rows(out, chunk_hours).drop(*[f"_same{i}" for i in range(1, 8)])


def add_row_baselines(df: DataFrame, keys: Sequence[str], value: str, order: str, hour: str = "Hour",
                      chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Row-position baselines: 24 and 168 rows back, and the mean of the 7 earlier rows of the same hour (2 at least).

    Positions run over the whole series, so row numbers are built from chunk
    counts; look-backs then become ranges over the row number.
    """
    numbered = with_row_number(df, keys, order, chunk_hours)
    size = 24 * 365
    c = chunked(numbered, F.col("_rn"), size, back=168)
    w = chunk_window(keys)
    out = own_rows(c.withColumns({
        "Baseline_SameHourYesterday_MWH": F.max(value).over(w.rangeBetween(-24, -24)),
        "Baseline_SameHour7DaysAgo_MWH": F.max(value).over(w.rangeBetween(-168, -168)),
    }), size)
    by_hour = with_row_number(out, [*keys, hour], order, chunk_hours, name="_hn")
    c2 = chunked(by_hour, F.col("_hn"), size, back=7)
    frame = chunk_window([*keys, hour]).rangeBetween(-7, -1)
    avg = F.when(F.count(value).over(frame) >= 2, F.avg(value).over(frame))
    return own_rows(c2.withColumn("Baseline_Rolling7DaySameHourAvg_MWH", avg), size).drop("_rn", "_hn")


def with_row_number(df: DataFrame, keys: Sequence[str], order: str, chunk_hours: int = CHUNK_HOURS,
                    name: str = "_rn", tie: Sequence[str] = ()) -> DataFrame:
    """1-based position of each row in its key, without one task per key.

    Rows are counted per (key, time chunk); the running total of those few counts
    is the offset of each chunk.
    """
    c = chunked(df, epoch_hour(order), chunk_hours)
    counts = c.groupBy(*keys, "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = c.join(offs, [*keys, "_chunk"])
    w = Window.partitionBy(*keys, "_chunk").orderBy(order, *tie)
    return joined.withColumn(name, F.row_number().over(w) + F.col("_off")).drop("_off", "_chunk", "_ct")


# Gate column and difference behind every gated feature.
_DIFFS = {
    "Lag1_Minus_SameHourYesterday_MWH": ("MWH_Lag1", "MWH_Lag24"),
    "Lag1_Minus_SameHour7DayMean_MWH": ("MWH_Lag1", "MWH_SameHour7DayMean"),
    "Lag24_Minus_SameHour7DayMean_MWH": ("MWH_Lag24", "MWH_SameHour7DayMean"),
}
_GATED = {
    "PeakWindow": ("IsPeakWindow14to18", ("Lag1_7", "Lag24_7")),
    "PeakWindow16to18": ("IsPeakWindow16to18", ("Lag1_7", "Lag24_7")),
    "HotPeak": ("IsHotPeakWindow16to20", ("Lag1_Y", "Lag1_7", "Lag24_7")),
    "ClearHotPeak": ("ClearHotPeakWindow16to20", ("Lag1_Y", "Lag1_7", "Lag24_7")),
    "ClearPeak16to18": ("ClearPeakWindow16to18", ("Lag24_7",)),
    "OvercastPeak16to18": ("OvercastPeakWindow16to18", ("Lag24_7",)),
    "ClearHotPeak16to18": ("ClearHotPeakWindow16to18", ("Lag24_7",)),
    "OvercastCoolPeak16to18": ("OvercastCoolPeakWindow16to18", ("Lag1_7", "Lag24_7")),
}
_SHORT = dict(zip(("Lag1_Y", "Lag1_7", "Lag24_7"), _DIFFS, strict=True))


def _flag(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col(name).cast("double"), F.lit(0.0))))


def add_load_decay(df: DataFrame) -> DataFrame:
    """Differences of the lag columns and their gated copies, in one projection."""
    lag1, lag2, lag3 = (F.col(f"MWH_Lag{i}") for i in (1, 2, 3))
    lag24, week = F.col("MWH_Lag24"), F.col("MWH_SameHour7DayMean")
    post = _flag(df, "IsPostPeakEvening18to23") if "IsPostPeakEvening18to23" in df.columns else (
        F.hour("DT").between(18, 23).cast("double"))
    cols = {"Load_Decay_1Hr_MWH": lag2 - lag1, "Load_Decay_2Hr_MWH": lag3 - lag1}
    diff = {n: F.col(a) - F.col(b) for n, (a, b) in _DIFFS.items()}
    cols |= diff
    for prefix, (gate, kinds) in _GATED.items():
        for k in kinds:
            cols[f"{prefix}_{_SHORT[k]}"] = _flag(df, gate) * diff[_SHORT[k]]
    vs_week = post * (week - lag1)
    cols |= {
        "PostPeak_LoadDecay_1Hr_MWH": post * (lag2 - lag1),
        "PostPeak_LoadDecay_2Hr_MWH": post * (lag3 - lag1),
        "PostPeak_LoadDecay_VsSameHourYesterday_MWH": post * (lag24 - lag1),
        "PostPeak_LoadDecay_VsSameHour7DayMean_MWH": vs_week,
        "ClearHotEvening_LoadDecay_Vs7Day_MWH": _flag(df, "ClearHotEvening_Flag") * vs_week,
    }
    breeze = F.greatest(*[_flag(df, f"DeltaBreeze_{n}_Flag") for n in ("Cooling", "Westerly_Flow", "EveningWindRamp")])
    up = lambda c: F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
    cols["DeltaBreeze_PostPeak_LoadDecay_Signal"] = breeze * (up(post * (lag2 - lag1)) + up(vs_week))
    return df.withColumns(cols)
