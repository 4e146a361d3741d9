"""Tables of a bundle come from folded cells and equal a plain aggregate of their rows."""

from pyspark.sql import functions as F

from voltloom.operators import bundle as BU
from voltloom.operators.metrics import metric_aggs


def test_rows_fold_to_cells_before_they_are_dealt_to_tables(spark):
    i = F.col("id")
    df = spark.range(5000).select(F.when(i % 11 > 0, i % 5).alias("origin"), (i % 24).cast("int").alias("Hour"), (F.lit(1) + i % 12).cast("int").alias("Month"), F.lit("Fall").alias("Season"), F.when(i % 24 > 15, "Peak").otherwise("Midday").alias("HourGroup"),
                                  (i % 2).cast("int").alias("IsWeekend"), (i % 18).cast("int").alias("Forecast_Day"), F.when(i % 13 > 0, 80.0 + i % 31).alias("Temperature_DailyMax"), F.lit("Overcast").alias("CloudCoverBucket"),
                                  F.when(i % 17 > 0, (i % 19) * 1.5).alias("Actual_MWH"), F.when(i % 23 > 0, (i % 29) * 1.1).alias("raw"), ((i % 31) * 1.2).alias("lag"))
    h = BU.with_replay_context(df, "origin", F.lit(6))
    out = BU.bundle_rows(h, {"raw": "raw", "lag": "lag"})
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2
    got = {(r["key"], r["Stage"]): r for r in out.where("table = 'hot_peak_metrics_by_stage'").collect()}
    t = BU.TABLES["hot_peak_metrics_by_stage"]
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<missing>")) for k in t.keys])
    for stage in ("raw", "lag"):
        want = h.where(t.where).where(F.col("Actual_MWH").isNotNull() & F.col(stage).isNotNull()).groupBy(key.alias("key")).agg(*[a.alias(n) for n, a in metric_aggs(forecast=stage).items()]).collect()
        assert want and len(want) == sum(s == stage for _, s in got)
        for r in want:
            g = got[r["key"], stage]
            assert all((r[n] is None and g[n] is None) or abs(r[n] - g[n]) < 1e-9 for n in metric_aggs())
