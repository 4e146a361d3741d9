"""A table of one row per key goes to the rows; a few hot keys do not gather them in as many tasks."""

import pytest
from pyspark.sql import functions as F

from voltloom.models import rounds as MR
from voltloom.operators import bands as BD
from voltloom.operators import peaks as P
from voltloom.operators import recent as R
from voltloom.operators import solar_gates as SG
from voltloom.operators import training as TR


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    t = F.timestamp_seconds(1_600_000_000 + i % 5000 * 3600)
    df = spark.range(400_000).select(
        F.when(i % 3 > 0, F.concat(F.lit("s"), (i % 3).cast("string"))).alias("series"), i.alias("row_id"), t.alias("DT"), t.alias("IntervalStartDT"), F.hour(t).alias("Hour"),
        (F.lit(1) + i % 16).cast("int").alias("Forecast_Day"), (F.lit(80.0) + i % 30).alias("Temperature_DailyMax"), (i % 97 / 1.0).alias("Raw_Forecast_MWH"), (i % 89 / 1.0).alias("Actual_MWH"), (i % 83 / 1.0).alias("MWH_Lag24"),
        (i % 7).alias("HourGroup"), F.lit("Clear").alias("CloudCoverBucket"), F.lit("Low").alias("SolarLossBucket"), F.lit("hot").alias("DailyMaxTempBin"), F.lit(1).alias("IsLikelySystemPeakHour"))
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 30_000_000
    return df


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_peak_overrides(rows):
    st = rows.groupBy("series").agg(F.lit(30.0).alias("observed_delta_mwh"), F.lit(True).alias("enabled"))
    live = P.live_ramp_override(rows, st, "Raw_Forecast_MWH")
    out = P.heat_anchor_override(live, "Raw_Forecast_MWH")
    assert "SortMergeJoin" not in plan(out) and "BroadcastHashJoin" in plan(out)
    assert out.where("series is null and Day1_Live_Ramp_Observed_Delta_MWH = 30").count() == rows.where("series is null").count()


def test_solar_gates(rows):
    held = SG.hold_out_latest(rows, 0.2, by=("series",))
    months = rows.groupBy("series", F.month("DT").alias("Month")).agg(F.lit(0.9).alias("factor"), F.lit(0.8).alias("aggregate_factor"))
    peaks = rows.groupBy("series").agg(F.lit(0.9).alias("peak_factor"), F.lit(0.5).alias("threshold_cf"))
    out = SG.with_month(held, months, ["series"], F.col("Raw_Forecast_MWH"), "m")
    out = SG.with_peak(out.withColumn("cap", F.lit(100.0)), peaks, "m", "cap", ["series"], "p")
    assert "SortMergeJoin" not in plan(out)


def test_lookups_and_weights(rows):
    lk = BD.band_lookup(rows.withColumn("res", F.col("Actual_MWH") - F.col("Raw_Forecast_MWH")), "res")
    assert "SortMergeJoin" not in plan(BD.first_match(rows, lk, (*BD.BAND_LEVELS, BD.GLOBAL), "band_mwh"))
    out = TR.validation_flag(TR.add_load_weights(rows, "Actual_MWH", TR.Weights(recency_end=1.0)), 30, 10)
    assert "SortMergeJoin" not in plan(out)


def test_rounds_meet_their_encoding_where_they_lie(rows, monkeypatch):
    class Stop(Exception):
        pass

    def stop(df, *a, **kw):
        raise Stop(plan(df))

    monkeypatch.setattr(MR, "fit", stop)
    parts = MR.time_parts(rows, 30, 30, ["series"])
    assert "SortMergeJoin" not in plan(parts)
    with pytest.raises(Stop) as e:
        MR.fit_rounds(parts, ["Hour"], "Actual_MWH")
    assert "SortMergeJoin" not in str(e.value) and "BroadcastHashJoin" in str(e.value)


def test_last_rows_with_full_hours_and_rows_without_a_time(spark):
    df = spark.createDataFrame([(k, t, v) for k, n in (("a", 60), ("b", 2)) for v in range(n) for t in [None if v == 0 else f"2024-01-01 {v // 20:02d}:{v % 20:02d}:00"]], "k string, t string, v int").withColumn("DT", F.col("t").cast("timestamp"))
    got = {}
    for r in R.last_rows(df, ["k"], "DT", 24).collect():
        got.setdefault(r["k"], set()).add(r["v"])
    assert got == {"a": set(range(36, 60)), "b": {0, 1}}
