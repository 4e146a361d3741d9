"""Coverage and conformal bands work out the band of a row once, whatever number of passes they make over it."""

import random

import pytest
from pyspark.sql import functions as F

from voltloom.plans import d_corrections as D
from voltloom.plans.base import QUERIES


@pytest.fixture(scope="module")
def cube(spark):
    rng = random.Random(6)
    rows = []
    for i in range(800):
        h, raw = i % 24, 40.0 + rng.random() * 30
        act = None if i % 41 == 0 else raw + rng.gauss(0, 3)
        rows.append((i, rng.choice(["Summer", "Winter", None]), h, ["Overnight", "Morning", "Midday", "Peak"][h // 6], 1 + i % 16, None if i % 13 == 0 else 60.0 + i % 50, rng.choice(["Clear", "Overcast", None]), rng.choice(["Low", "High", "None"]), rng.choice(["<75", ">=100"]), raw, act, None if act is None else act - raw))
    return spark.createDataFrame(rows, "row_id long, Season string, Hour int, HourGroup string, Forecast_Day int, Temperature_DailyMax double, CloudCoverBucket string, SolarLossBucket string, DailyMaxTempBin string, Raw_Forecast_MWH double, Actual_MWH double, Residual_MWH double").cache()


@pytest.mark.parametrize("name", ["agg30_interval_coverage", "agg32_band_coverage_by_stage", "unc06_conformal_bands"])
def test_bands_are_worked_out_once(spark, cube, monkeypatch, name):
    monkeypatch.setattr(D, "banded", lambda *_: cube)
    out = QUERIES[name](spark, "")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan  # the cube is read only for the stored bands
    assert not any(x in plan for x in ("0.0195", "DailyMaxTempBin"))  # 0.03 * 0.65, the band's percent guard
    o = D.bands(spark, "").where("Residual_MWH is not null").toPandas()
    if name == "agg30_interval_coverage":
        got = {r["Slice"]: r for r in out.collect()}
        hit = o.Residual_MWH.abs() <= o.Band
        assert got["Overall"]["n"] == len(o) and got["Overall"]["cov"] == pytest.approx(100 * hit.mean(), abs=1e-5) and got["Overall"]["p90"] == pytest.approx(o.Residual_MWH.abs().quantile(0.9), abs=1e-5)
        assert got["Season:Winter"]["n"] == (o.Season == "Winter").sum()
    elif name == "agg32_band_coverage_by_stage":
        got = {(r["Stage"], r["HourGroup"]): r for r in out.collect()}
        mine = o[o.HourGroup == "Peak"]
        assert got["raw", "Peak"]["n"] == len(mine) and got["raw", "Peak"]["worst"] == pytest.approx((mine.Residual_MWH.abs() - mine.Band).clip(lower=0).max(), abs=1e-5)
    else:
        assert out.count() == 800 and out.where("q is null or band is null").count() == 0
