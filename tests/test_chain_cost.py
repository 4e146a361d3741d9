"""Lookups go to the rows as arrays, the same as joins; stages are worked out once and calibration rows are narrow."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltloom.operators import lookups as LK
from voltloom.operators import recent as R
from voltloom.operators import replay as RP

LEVELS = (LK.Level("all", (), 0.1), LK.Level("text", ("t",), 0.4), LK.Level("pair", ("t", "i"), 0.3), LK.Level("date", ("d", "i"), 0.2))


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice(["x", "y|z", "", None]), rng.choice([0, 1, None]), rng.choice([dt.date(2024, 1, 1), None]), rng.choice([True, False, None]), rng.random(), n) for n in range(3000)]
    return spark.createDataFrame(out, "k string, o int, t string, i int, d date, inside boolean, r double, n int").repartition(3).cache()


@pytest.mark.parametrize("by", [[], ["o"], ["o", "k"]])
@pytest.mark.parametrize("count_k", [None, 7.0])
def test_arrays_give_what_joins_give(rows, monkeypatch, by, count_k):
    learned = LK.learn(rows.where("r < 0.9 and n % 11 > 0"), LEVELS, "r", by, 0.7, 2.0, 24.0).where("hash(key) % 3 <> 0 or level = 'text'")

    def run(where):
        out = LK.apply_levels(rows, learned, LEVELS, by, count_k, "v", "names", where)
        return {r["n"]: (r["v"], r["names"]) for r in out.collect()}

    arrays = [run(None), run(F.col("inside"))]
    monkeypatch.setattr(LK, "MOST", 0)
    joins = [run(None), run(F.col("inside"))]
    assert arrays == joins and len(arrays[0]) == 3000 and any(v for v, _ in arrays[0].values())
    inside = {r["n"] for r in rows.where("inside").collect()}
    assert all(v is None and m == "" for n, (v, m) in arrays[1].items() if n not in inside)
    assert all(arrays[1][n] == arrays[0][n] for n in inside)


def test_an_empty_lookup_meets_nothing(rows):
    out = LK.apply_levels(rows, LK.learn(rows.limit(0), LEVELS, "r", ["o"]), LEVELS, ["o"], 7.0, "v", "names")
    assert out.where("v is not null or names <> ''").count() == 0 and out.count() == 3000


def test_lookups_need_no_join(rows):
    plan = LK.apply_levels(rows, LK.learn(rows, LEVELS, "r", ["o"]), LEVELS, ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ArrowEvalPython" in plan


def test_scores_do_not_work_out_the_forecast_twice(rows):
    df = rows.select(F.lit("full").alias("Config"), F.col("i").alias("Origin"), F.col("r").alias(RP.ACTUAL), F.when(F.col("n") % 5 > 0, F.sqrt("r") * F.col("n")).alias(RP.NOW))
    out = RP.origin_scores(df)
    assert "SQRT" not in "".join(x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x)
    assert {r["Origin"]: r["N"] for r in out.collect()} == {r["Origin"]: r["n"] for r in df.where(f"{RP.NOW} is not null").groupBy("Origin").agg(F.count("*").alias("n")).collect()}
    assert RP.origin_scores(df.withColumn(RP.ACTUAL, F.lit(None).cast("double"))).count() == 0


def test_learning_takes_rows_with_a_residual_only(rows):
    df = rows.withColumn("r", F.when(F.col("n") % 3 > 0, F.col("r"))).withColumn("r", F.when(F.coalesce(F.col("i"), F.lit(-1)) != 1, F.col("r")))
    got = {(r["level"], r["key"]): r["count"] for r in LK.learn(df, LEVELS, "r").collect()}
    assert got == {(r["level"], r["key"]): r["count"] for r in LK.learn(df.where("r is not null"), LEVELS, "r").collect()}
    assert ("pair", "x|1") not in got and ("pair", "x|0") in got


def test_calibration_rows_hold_what_targets_need(spark, monkeypatch):
    grid = RP.Origins("2024-06-11", 5, 3, 4, 10)
    data = [("a", dt.datetime(2024, 6, 1) + dt.timedelta(hours=6 * i), 50.0 + i % 7, 51.0 + i % 5, 90.0, 0.5, 5.0, 1.0) for i in range(100)]
    h = RP.with_context(spark.createDataFrame(data, "series string, DT timestamp, Raw_Forecast_MWH double, Actual_MWH double, Temperature_DailyMax double, CloudCover_Norm double, BTM_Solar_Proxy_MW double, BTM_Solar_Loss_From_ClearSky_MW double"))
    h = h.withColumns({"Residual_MWH": F.col("Actual_MWH") - F.col("Raw_Forecast_MWH"), "DailyMaxTempBucket": F.col("DailyMaxTempBin"), "BTMSolarBucket": F.col("BTMSolarProxyBin"), "unused": F.lit("x")}).cache()
    stored, write, last = [], RP.materialise, R.last_rows
    monkeypatch.setattr(RP, "materialise", lambda df, *a: stored.append(df.columns) or write(df, *a))
    asked = []
    monkeypatch.setattr(R, "last_rows", lambda *a, **kw: asked.append(1) or last(*a, **kw))
    steps = [RP.learned_step(), RP.recent_step(weights={"last24_mean": 0.0}), RP.magnitude_step()]
    out = RP.Chain(steps, grid, h).run(RP.with_context(RP.replay_frame(h, grid), grid))
    assert out.count() > 0 and "unused" in out.columns and "Cfg" not in stored[1]
    assert "unused" in stored[0] and "unused" not in stored[1] and "unused" in stored[2] and not asked
