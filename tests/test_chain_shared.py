"""Leading stages of the chain run once for all configurations and shuffle no frame."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltloom.operators import lookups as LK
from voltloom.operators import recent as R
from voltloom.operators import replay as RP

GRID = RP.Origins("2024-06-11", 5, 4, 4, 10)


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(5)
    rows = []
    for day in range(30):
        for h in range(0, 24, 3):
            a = 60 + h + rng.random() * 8
            rows.append((rng.choice(["a", "b", None]), dt.datetime(2024, 6, 1) + dt.timedelta(days=day, hours=h), a - rng.random() * 3, a, a - 1, a + 1, None if day % 9 == 0 else 80.5 + (day * 7) % 28, (day % 10) / 10, 5.0 + day % 7, float(h % 5) * (8 <= h <= 17)))
    b = spark.createDataFrame(rows, "series string, DT timestamp, Raw_Forecast_MWH double, Actual_MWH double, MWH_SameHour7DayMean double, MWH_Lag24 double, Temperature_DailyMax double, CloudCover_Norm double, BTM_Solar_Proxy_MW double, BTM_Solar_Loss_From_ClearSky_MW double")
    b = RP.with_context(b).withColumns({"Residual_MWH": F.col("Actual_MWH") - F.col("Raw_Forecast_MWH"), "Date": F.to_date("DT"), "IsHoliday": F.lit(0)})
    return b.withColumns({"DailyMaxTempBucket": F.col("DailyMaxTempBin"), "BTMSolarBucket": F.col("BTMSolarProxyBin")}).cache()


def test_configurations_do_not_copy_the_leading_stages(spark, history, monkeypatch):
    stored, write = [], RP.materialise

    def spy(df, *a):
        stored.append(df.count())
        return write(df, *a)

    monkeypatch.setattr(RP, "materialise", spy)
    frame = RP.with_context(RP.replay_frame(history, GRID), GRID)
    steps = [RP.learned_step(), RP.heat_peak_step(), RP.warm_ramp_step(), RP.cloud_solar_step()]
    out = RP.Chain(steps, GRID, history, RP.without_each(steps)).run(frame)
    assert out.count() == 5 * frame.where("Is_Target").count()
    assert stored == [frame.count()]


def test_levels_joined_one_by_one_equal_those_of_the_combinations(spark, history):
    lk = RP.learn_by_origin(history.where("series is not null"), LK.LEARNED, "Residual_MWH", GRID, ["series"], 0.7, 2.0, 24.0).where("level <> 'hour'")
    frame = RP.replay_frame(history, GRID)
    by, on = ["Origin", "series"], ["Origin", "DT", "Raw_Forecast_MWH"]
    a = {tuple(r[x] for x in on): (r["correction"], r["matched"]) for r in LK.apply_weighted(frame, lk, LK.LEARNED, by).collect()}
    b = {tuple(r[x] for x in on): (r["correction"], r["matched"]) for r in LK.apply_levels(frame, lk, LK.LEARNED, by).collect()}
    assert set(a) == set(b) and any(m for _, m in a.values()) and any(not m for _, m in a.values())
    for k, (v, m) in a.items():
        w, n = b[k]
        assert m == n and (v is None) == (w is None) and (v is None or abs(v - w) < 1e-9)


def test_no_lookup_or_profile_shuffles_the_frame(spark, history):
    history = history.withColumn("SolarLossBucket", F.lit("Low"))
    big = spark.range(300_000).crossJoin(history.limit(1))
    profile = R.recent_profile(history)
    out = R.apply_profile(big.withColumn("Forecast_Lead_Hour", F.lit(3)), profile)
    lk = LK.learn(history, LK.LEARNED, "Residual_MWH")
    for x in (out, LK.apply_levels(big, lk, LK.LEARNED)):
        assert "SortMergeJoin" not in x._jdf.queryExecution().executedPlan().toString()
