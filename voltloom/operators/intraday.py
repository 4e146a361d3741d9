"""Rollups of sub-hourly readings and their as-of attachment to an hourly frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import (asof_backward, asof_backward_unbounded, epoch_second, keep_last, null_safe_join)
from ..core.frames import keep_first

# Feature columns of the previous-hour rollup.
FEATURES = (
    "FiveMin_Load_Available", "FiveMin_Data_Age_Hours", "FiveMin_PrevHour_Avg_MW", "FiveMin_PrevHour_Max_MW",
    "FiveMin_PrevHour_Min_MW", "FiveMin_PrevHour_Last_MW", "FiveMin_PrevHour_Range_MW", "FiveMin_PrevHour_Ramp_MW",
    "FiveMin_PrevHour_Count", "FiveMin_Ramp_15Min_MW", "FiveMin_Ramp_30Min_MW", "FiveMin_Ramp_60Min_MW",
)
DAY_SECONDS = 86_400
RAMP_MINUTES = (15, 30, 60)


def hour_stats(readings: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str] = ()) -> DataFrame:
    """Count, mean, min, max, first and last reading of every (key, hour).

    One hash aggregate; first and last are ``min_by``/``max_by`` on (time, tie).
    """
    at = F.struct("DT", *tie)
    return readings.where(F.col(value).isNotNull() & F.col("DT").isNotNull()).groupBy(
        *keys, F.date_trunc("hour", "DT").alias("HourDT")
    ).agg(
        F.avg(value).alias("avg"), F.count("*").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"), F.max("DT").alias("last_dt"))


def completed_hours(readings: DataFrame, keys: Sequence[str] = ("series",), value: str = "value", min_count: int = 10,
                    last_minute: int | None = 55, tie: Sequence[str] = ()) -> DataFrame:
    """Hourly load from readings: only hours with enough readings and one late enough; labelled by the hour's end."""
    h = hour_stats(readings, keys, value, tie).where(F.col("n") >= min_count)
    if last_minute is not None:
        h = h.where(F.unix_seconds("last_dt") - F.unix_seconds("HourDT") >= last_minute * 60)
    end = F.col("HourDT") + F.expr("INTERVAL 1 HOUR")
    return h.select(
        *keys, end.alias("DT"), F.col("avg").alias("MWH"), F.lit("five_min_completed_hour").alias("Load_Source"),
        F.col("n").alias("FiveMin_Interval_Count"), F.col("min").alias("FiveMin_Hourly_Min_MW"),
        F.col("max").alias("FiveMin_Hourly_Max_MW"), F.col("last").alias("FiveMin_Hourly_Last_MW"),
        (F.col("max") - F.col("min")).alias("FiveMin_Hourly_Range_MW"),
        F.col("last_dt").alias("FiveMin_Last_Interval_Start"), end.alias("FiveMin_Hour_End"))


def append_recent_hours(official: DataFrame, recent: DataFrame, keys: Sequence[str] = ("series",),
                        overlap_hours: int = 0) -> DataFrame:
    """Official hours plus rolled-up hours newer than the last official one less the overlap.

    On an hour both have, the source that sorts last by name is kept
    (``hourly_history`` after ``five_min_completed_hour``).
    """
    base = official if "Load_Source" in official.columns else official.withColumn("Load_Source", F.lit("hourly_history"))
    base = base.where("DT is not null")
    latest = base.groupBy(*keys).agg(F.max("DT").alias("_latest"))
    new = null_safe_join(recent.where("DT is not null and MWH is not null"), latest, keys, "inner")
    cut = F.unix_seconds("_latest") - max(0, overlap_hours) * 3600
    new = new.where(F.unix_seconds("DT") > cut).drop("_latest")
    both = base.unionByName(new, allowMissingColumns=True)
    return keep_last(both, [*keys, "DT"], ["Load_Source"]).select(*both.columns)


def previous_hour_features(readings: DataFrame, keys: Sequence[str] = ("series",), value: str = "value",
                           tie: Sequence[str] = ()) -> DataFrame:
    """Statistics of the hour before, stamped two hours after its start, with 15/30/60-minute as-of changes."""
    h = hour_stats(readings, keys, value, tie)
    points = readings.where(F.col(value).isNotNull() & F.col("DT").isNotNull()).select(
        *keys, F.col("DT"), F.col(value).alias("_v"), *tie)
    points = keep_last(points, [*keys, "DT"], [*tie, "_v"] if tie else ["_v"])
    # the three times asked for lie in the hour itself, so one pass over the hour's day finds them all
    asked = h.select("*", F.inline(F.array(*[F.struct(F.lit(m).alias("_m"), epoch_us_expr("HourDT", (60 - m) * 60).alias("_at")) for m in RAMP_MINUTES])))
    asof = asof_backward_unbounded(asked, points, keys, F.col("_at"), epoch_us_expr("DT", 0), ["_v"], DAY_SECONDS * 1_000_000)
    ramps = [F.max(F.when(F.col("_m") == m, F.col("last") - F.col("_v"))).alias(f"FiveMin_Ramp_{m}Min_MW") for m in RAMP_MINUTES]
    out = asof.groupBy(*keys, "HourDT").agg(*[F.first(c).alias(c) for c in ("avg", "n", "min", "max", "first", "last")], *ramps)
    return out.select(
        *keys, (F.col("HourDT") + F.expr("INTERVAL 2 HOURS")).alias("DT"),
        F.lit(1.0).alias("FiveMin_Load_Available"), F.lit(0.0).alias("FiveMin_Data_Age_Hours"),
        F.col("avg").alias("FiveMin_PrevHour_Avg_MW"), F.col("max").alias("FiveMin_PrevHour_Max_MW"),
        F.col("min").alias("FiveMin_PrevHour_Min_MW"), F.col("last").alias("FiveMin_PrevHour_Last_MW"),
        (F.col("max") - F.col("min")).alias("FiveMin_PrevHour_Range_MW"),
        (F.col("last") - F.col("first")).alias("FiveMin_PrevHour_Ramp_MW"),
        F.col("n").cast("double").alias("FiveMin_PrevHour_Count"),
        *[f"FiveMin_Ramp_{m}Min_MW" for m in RAMP_MINUTES])


def epoch_us_expr(col: str, plus_seconds: int):
    """Microseconds since the epoch of ``col`` plus whole seconds."""
    return F.unix_micros(F.col(col)) + F.lit(plus_seconds * 1_000_000)


def attach_exact(frame: DataFrame, features: DataFrame, keys: Sequence[str] = ("series",), max_hours: int = 24) -> DataFrame:
    """Left equi join of the features; absent rows get zeros and the 'unavailable' age."""
    cols = [c for c in FEATURES if c in features.columns]
    j = frame.drop(*FEATURES).join(features.select(*keys, "DT", *cols), [*keys, "DT"], "left")
    age = F.lit(float(max_hours) + 1.0)
    fill = {c: F.coalesce(F.col(c), age if c == "FiveMin_Data_Age_Hours" else F.lit(0.0)) for c in cols}
    return j.withColumns(fill)


def attach_carried(frame: DataFrame, features: DataFrame, keys: Sequence[str] = ("series",), max_hours: int = 24) -> DataFrame:
    """Latest feature row at or before each row, at most ``max_hours`` old; else zeros."""
    cols = [c for c in FEATURES if c in features.columns]
    feats = keep_last(features.where("DT is not null").select(*keys, "DT", *cols), [*keys, "DT"], [cols[2]])
    j = asof_backward(frame.drop(*FEATURES), feats, keys, epoch_second("DT"), epoch_second("DT"), cols,
                      max_hours * 3600, DAY_SECONDS * 30)
    hit = F.col("_rt").isNotNull()
    fill = {c: F.when(hit, F.coalesce(F.col(c), F.lit(0.0))).otherwise(0.0) for c in cols}
    fill["FiveMin_Data_Age_Hours"] = F.when(hit, (epoch_second("DT") - F.col("_rt")) / 3600.0).otherwise(float(max_hours) + 1.0)
    fill["FiveMin_Load_Available"] = hit.cast("double")
    return j.withColumns(fill).drop("_rt")


def zeroed(frame: DataFrame, age_hours: float = 999.0) -> DataFrame:
    """Feature columns set to 'operationally unavailable'."""
    return frame.withColumns({c: F.lit(age_hours if c == "FiveMin_Data_Age_Hours" else 0.0) for c in FEATURES})


__all__ = ["FEATURES", "append_recent_hours", "attach_carried", "attach_exact", "completed_hours", "hour_stats",
           "keep_first", "previous_hour_features", "zeroed"]
