"""Rounds chosen on later rows, analog statistics, the readiness scorecard and weights by scope against plain versions."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltloom.core.scratch import materialise
from voltloom.models import rounds as MR
from voltloom.operators import analogs as AN
from voltloom.operators import scorecards as SC
from voltloom.operators import training as TR

BASE = dt.datetime(2023, 6, 1)


def labelled(spark, lift=0.0):
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        x, s = rng.random(), "ab"[i % 2]
        test = i >= 1000
        rows.append((s, BASE + dt.timedelta(hours=i), x, rng.random(), 10.0 * x + (5.0 if s == "b" else 0.0) + rng.gauss(0, 4) + (lift if test else 0.0)))
    df = spark.createDataFrame(rows, "series string, DT timestamp, x double, noise double, y double").coalesce(1)
    return materialise(MR.time_parts(df, 300 / 24, 200 / 24), spark)


def test_rounds_come_from_later_rows_only(spark):
    a = labelled(spark)
    assert {r["part"]: r["count"] for r in a.groupBy("part").count().collect()} == {"train": 700, "validation": 300, "test": 200}
    m = MR.fit_rounds(a, ["x", "noise"], "y", rounds=12, depth=5)
    assert len(m.losses) == 12 and m.best == int(np.argmin(m.losses)) + 1 < 12  # noise is learned soon
    assert m.model.model.stages[-1].getNumTrees == m.best
    n = MR.fit_rounds(labelled(spark, 100.0), ["x", "noise"], "y", rounds=12, depth=5)
    assert n.losses == pytest.approx(m.losses)  # labels of the test rows change nothing
    got = m.score(a.where("part = 'test'")).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert got < 4.5


def test_too_few_rows_have_no_model(spark):
    assert MR.fit_rounds(labelled(spark).where("x < 0.1"), ["x"], "y", rounds=3) is None


def hot_rows():
    rng = random.Random(2)
    out = []
    for y in (2021, 2022, 2023):
        for day in range(70):
            for h in (13, 15, 18):
                t = rng.choice([100.0, 104.9, 105.0, 106.5, 108.0, 110.0, 113.0, None])
                when = dt.datetime(y, 6, 20, h) + dt.timedelta(days=day)
                row = [len(out), rng.choice(["a", None]), when, h, when.month, t, rng.uniform(50, 90) if rng.random() > 0.05 else None, rng.uniform(50, 90) if rng.random() > 0.05 else None, when.replace(day=1, hour=0)]
                out += [row] * (2 if rng.random() < 0.1 else 1)
    return [(i, *r[1:]) for i, r in enumerate(out)]


def test_analog_columns_equal_a_plain_loop(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "row_id long, series string, DT timestamp, Hour int, Month int, Temperature_DailyMax double, Base double, Actual_MWH double, origin timestamp")
    got = {r["row_id"]: r for r in AN.heat_analog_detail(df, "Base", "origin", first=["row_id"]).collect()}
    first = {}
    for r in rows:
        first.setdefault((r[1], r[2]), r)
    src = [r for r in first.values() if r[5] is not None and r[5] >= 105 and r[7] is not None]
    want = [r for r in rows if r[5] is not None and r[5] >= 105 and 14 <= r[3] <= 20 and r[4] in (6, 7, 8, 9)]
    assert got.keys() == {r[0] for r in want}
    seen = set()
    for i, s, when, h, m, t, base, act, o in want:
        near = [x for x in src if x[1] == s and x[2] < o and abs(x[5] - t) <= 3]
        same = [x for x in near if x[3] == h]
        tiers = (("same_month_multi_summer", [x for x in same if x[4] == m]), ("summer_months_multi_summer", [x for x in same if x[4] in (6, 7, 8, 9)]), ("all_prior_same_hour_temp", same))
        name, hit = next(((n, x) for n, x in tiers if len(x) >= 3 and base is not None), ("no_pre_origin_match", []))
        g = got[i]
        seen.add(name)
        assert g["Heat_Analog_Source"] == name and g["Heat_Analog_Count_SameHour_PreOrigin"] == len(hit)
        if hit:
            v, pv = [x[7] for x in hit], [x[7] for x in near if 14 <= x[3] <= 20 and x[4] in (6, 7, 8, 9)]
            assert g["Heat_Analog_Actual_Mean_SameHour_PreOrigin_MWH"] == pytest.approx(np.mean(v)) and g["Heat_Analog_Actual_P90_SameHour_PreOrigin_MWH"] == pytest.approx(np.quantile(v, 0.9))
            assert g["Heat_Analog_Count_HE14_20_PreOrigin"] == len(pv) and g["Heat_Analog_Actual_P90_HE14_20_PreOrigin_MWH"] == pytest.approx(np.quantile(pv, 0.9))
            assert g["Heat_Analog_Shadow_Correction_MWH"] == pytest.approx(np.clip((np.mean(v) - base) * 0.5, -12, 12))
        else:
            assert g["Heat_Analog_Shadow_Correction_MWH"] == 0 and g["Heat_Analog_Actual_P90_SameHour_PreOrigin_MWH"] is None
    assert {"same_month_multi_summer", "no_pre_origin_match"} <= seen
    assert AN.heat_analog_detail(df.limit(0), "Base", "origin").count() == 0


def test_readiness_counts_the_last_days_and_fails_without_rows(spark):
    rows = [(BASE + dt.timedelta(days=i), 15, "Summer", 1, 95.0, 0.1, 0.0, 100.0, 100.0 + (2.0 if i >= 55 else 10.0)) for i in range(100)]
    df = spark.createDataFrame(rows, "DT timestamp, Hour int, Season string, Forecast_Day int, Temperature_DailyMax double, CloudCover_Norm double, BTM_Solar_Loss_From_ClearSky_MW double, Actual_MWH double, f double")
    got = {r["Test"]: r for r in SC.readiness_scorecard(SC.last_days(df, 45), df, "f").collect()}
    assert len(got) == 9 and got["Last 45 days"]["N"] == 45 and got["Last 45 days"]["Pass"] and not got["Day 1 only"]["Pass"]
    assert (got["Days 2-3"]["N"], got["Days 2-3"]["Pass"]) == (0, False)
    assert not any(r["Pass"] for r in SC.readiness_scorecard(df.limit(0), df.limit(0), "f").collect())


def test_every_bucket_has_both_scopes(spark):
    df = spark.createDataFrame([(101.0, 17, 3.0), (101.0, 3, 1.0), (None, 17, 4.0)], "Temperature_DailyMax double, Hour int, SampleWeight double")
    got = {(r["Temperature_DailyMax_Bucket"], r["Scope"]): r for r in TR.weight_scopes(df).collect()}
    assert len(got) == 18
    hot = got["100-105", "HotPeakHours16to20"]
    assert (hot["N_Rows"], hot["Pct_Of_Total_Weight"], hot["Weighted_Share_vs_RawShare_Ratio"]) == (1, pytest.approx(37.5), pytest.approx(1.125))
    assert got["<75", "AllHours"]["N_Rows"] == 0 and got["<75", "AllHours"]["Weighted_Share_vs_RawShare_Ratio"] is None
