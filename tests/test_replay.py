"""Replay over origins, the ordered chain, grouped models, recursion and timing against plain versions."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltloom.models import grouped as GM
from voltloom.models import learners as ML
from voltloom.operators import bundle as BU
from voltloom.operators import lookups as LK
from voltloom.operators import peaks as P
from voltloom.operators import replay as RP

BASE = dt.datetime(2024, 6, 1)
GRID = RP.Origins("2024-06-11", 5, 6, 4, 10)
SCHEMA = "series string, DT timestamp, Raw_Forecast_MWH double, Actual_MWH double, MWH_SameHour7DayMean double, MWH_Lag24 double, Temperature_DailyMax double, CloudCover_Norm double, BTM_Solar_Proxy_MW double, BTM_Solar_Loss_From_ClearSky_MW double, Forecast_Day int"


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(1)
    rows = []
    for day in range(40):
        if day in (17, 18):
            continue  # a hole in the record
        for h in range(0, 24, 2):
            t = 80 + (day * 7) % 28 + 0.5
            a = 60 + h + rng.random() * 8
            rows.append((rng.choice("ab"), BASE + dt.timedelta(days=day, hours=h), a - rng.random() * 3, a, a - 1, a + 1, None if day % 9 == 0 else t, (day % 10) / 10, 5.0 + day % 7, float(h % 5) * (8 <= h <= 17), 3))
    b = RP.with_context(spark.createDataFrame(rows, SCHEMA)).withColumns({"Residual_MWH": F.col("Actual_MWH") - F.col("Raw_Forecast_MWH"), "Date": F.to_date("DT"), "IsHoliday": F.lit(0)})
    return b.withColumns({"DailyMaxTempBucket": F.col("DailyMaxTempBin"), "BTMSolarBucket": F.col("BTMSolarProxyBin"), "DailyMaxTemp_Ramp_1Day": F.lit(1.0)}).cache()


def test_frame_holds_every_origin_s_window_and_nothing_else(spark, history):
    got = RP.replay_frame(history, GRID).select("Origin", "DT", "Is_Target", "Forecast_Day", "Forecast_Lead_Hour").collect()
    times = [r["DT"] for r in history.select("DT").collect()]
    want = []
    for k in range(GRID.count):
        o = dt.datetime(2024, 6, 11) + dt.timedelta(days=5 * k)
        for t in times:
            if o - dt.timedelta(days=10) <= t < o:
                want.append((k, t, False, None, None))
            elif o <= t < o + dt.timedelta(days=4):
                want.append((k, t, True, (t - o).days + 1, int((t - o).total_seconds() // 3600) + 1))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_lookups_of_each_origin_are_those_of_its_window(spark, history):
    levels = (LK.Level("global", ()), LK.Level("hour", ("Hour",)), LK.Level("temp", ("DailyMaxTempBin", "Season")))
    got = RP.learn_by_origin(history, levels, "Residual_MWH", GRID, ["series"], 0.7, 2.0, 24.0).collect()
    want = {}
    for k in range(GRID.count):
        o = dt.datetime(2024, 6, 11) + dt.timedelta(days=5 * k)
        part = history.where((F.col("DT") < o) & (F.col("DT") >= o - dt.timedelta(days=10)))
        for r in LK.learn(part, levels, "Residual_MWH", ["series"], 0.7, 2.0, 24.0).collect():
            want[k, r["series"], r["level"], r["key"]] = (r["count"], r["correction"], r["std"])
    assert {(r["Origin"], r["series"], r["level"], r["key"]) for r in got} == set(want)
    for r in got:
        n, corr, std = want[r["Origin"], r["series"], r["level"], r["key"]]
        assert r["count"] == n and abs(r["correction"] - corr) < 1e-9 and (std is None) == (r["std"] is None) and abs((r["std"] or 0) - (std or 0)) < 1e-7


def chain(history, steps, configs=None, **kw):
    return RP.Chain(steps, GRID, history, configs or {"full": {}}, **kw)


def test_no_forecast_depends_on_its_own_horizon(spark, history):
    """Later actuals may be anything: nothing of an origin changes."""
    steps = [RP.learned_step(), RP.warm_ramp_step(), RP.cloud_solar_step(), RP.recent_step(weights={"last24_mean": 0.0}),
             RP.capture_step("hot_ramp", lambda: P.hot_scope(90.0), P.PEAK_HOURS), RP.capture_step("persistence", lambda: P.hot_scope(100.0), P.PEAK_HOURS), RP.magnitude_step()]
    cut = dt.datetime(2024, 6, 21)  # the third origin

    def forecasts(h):
        frame = RP.with_context(RP.replay_frame(h, GRID), GRID).where("Origin = 2")
        return {(r["series"], r["DT"]): r["f"] for r in chain(h, steps).run(frame).select("series", "DT", F.col(RP.NOW).alias("f")).collect()}

    spoiled = history.withColumn("Actual_MWH", F.when(F.col("DT") >= cut, F.lit(999.0)).otherwise(F.col("Actual_MWH"))).withColumn("Residual_MWH", F.col("Actual_MWH") - F.col("Raw_Forecast_MWH"))
    a, b = forecasts(history), forecasts(spoiled)
    assert a and a == b


def test_configurations_switch_scale_and_cap(spark, history):
    frame = RP.with_context(RP.replay_frame(history, GRID), GRID)
    configs = {"full": {}, "off": {"learned": {"on": False}}, "half": {"learned": {"scale": 0.5}}, "capped": {"learned": {"cap": 0.01}}}
    rows = chain(history, [RP.learned_step(), RP.magnitude_step()], configs).run(frame).select("Config", "Origin", "DT", "series", "learned_MWH", "Raw_Forecast_MWH", "learned_Forecast_MWH").collect()
    by = {(r["Config"], r["Origin"], r["DT"], r["series"]): r for r in rows}
    assert len(by) == len(rows) and any(r["learned_MWH"] for r in rows)
    for (name, *rest), r in by.items():
        full = by["full", *rest]["learned_MWH"]
        want = {"full": full, "off": 0.0, "half": full / 2, "capped": max(min(full, 0.01), -0.01)}[name]
        assert abs(r["learned_MWH"] - want) < 1e-9 and abs(r["learned_Forecast_MWH"] - max(r["Raw_Forecast_MWH"] + want, 0)) < 1e-9
    scores = RP.chain_ablation(chain(history, [RP.learned_step()], RP.without_each([RP.learned_step()])).run(frame)).collect()
    assert [r["Config"] for r in scores] == ["no_learned"] and scores[0]["delta"] > 0


def test_chain_checks_order_and_names(spark, history):
    cols = RP.replay_frame(history, GRID).columns
    chain(history, [RP.warm_ramp_step(), RP.selector_step([{"stage": "warm_ramp", "reason": "x"}])]).check([*cols, "SolarLossBucket"])
    with pytest.raises(ValueError, match="needs"):
        chain(history, [RP.selector_step([{"stage": "warm_ramp", "reason": "x"}]), RP.warm_ramp_step()]).check(cols)
    with pytest.raises(ValueError, match="repeated"):
        chain(history, [RP.magnitude_step(), RP.magnitude_step()]).check(cols)
    with pytest.raises(ValueError, match="does not have"):
        chain(history, [RP.magnitude_step()], {"x": {"learned": {"on": False}}}).check(cols)
    with pytest.raises(ValueError):
        RP.Origins("2024-01-01", 4, 3, 5, 10)


# -- grouped models ---------------------------------------------------------------------------------

def loads(spark, n=400, series=3):
    rng = np.random.default_rng(2)
    rows = []
    for s in range(series):
        for h in range(n):
            if s == 1 and h % 97 == 5:
                continue
            rows.append((f"s{s}", BASE + dt.timedelta(hours=h), float(50 + 10 * s + 5 * np.sin(h * 2 * np.pi / 24) + rng.normal())))
    return spark.createDataFrame(rows, "series string, DT timestamp, MWH double"), rows


def test_grouped_least_squares(spark):
    df, rows = loads(spark)
    terms = lambda: [F.sin(F.hour("DT") * (2 * np.pi / 24)), F.hour("DT") / 24.0]
    x = lambda t: [1.0, np.sin(t.hour * 2 * np.pi / 24), t.hour / 24]
    for r in GM.fit_groups(df, terms(), "MWH", ["series"], 0.5).collect():
        mine = [q for q in rows if q[0] == r["series"]]
        a, y = np.array([x(q[1]) for q in mine]), np.array([q[2] for q in mine])
        assert np.allclose(r["coef"], np.linalg.solve(a.T @ a + np.diag([0, .5, .5]), a.T @ y)) and r["n"] == len(mine)
    o = RP.Origins("2024-06-06", 2, 5, 2, 4)
    got = {(r["Origin"], r["series"]): r for r in GM.fit_groups_by_origin(df, terms(), "MWH", ["series"], o, 0.5).collect()}
    assert len(got) == 15
    for (k, s), r in got.items():
        at = dt.datetime(2024, 6, 6) + dt.timedelta(days=2 * k)
        mine = [q for q in rows if q[0] == s and at - dt.timedelta(days=4) <= q[1] < at]
        a, y = np.array([x(q[1]) for q in mine]), np.array([q[2] for q in mine])
        assert r["n"] == len(mine) and np.allclose(r["coef"], np.linalg.solve(a.T @ a + np.diag([0, .5, .5]), a.T @ y), atol=1e-6)


def test_recursion_with_a_fitted_tree_equals_a_plain_loop(spark):
    """A boosted model, three series and 48 steps; the model is called once a step for all series."""
    df, rows = loads(spark, 300)
    train = GM.ring_rows(df, 48).withColumns({"lag_1": F.element_at("_ring", -1), "lag_24": F.element_at("_ring", -24), "Hour": F.hour("DT")})
    model = ML.fit(train, ["lag_1", "lag_24", "Hour"], "MWH", iters=3, depth=3)
    calls = []

    def score(f):
        calls.append(1)
        return model.score(f)

    got = {(r["series"], r["Forecast_Lead_Hour"]): r["Raw_Forecast_MWH"] for r in GM.recursive_steps(df, score, 48, lags=(1, 24), memory=48, cut_every=8).collect()}
    assert len(calls) == 48 and len(got) == 144
    rings, leads = {}, range(1, 49)
    for s in ("s0", "s1", "s2"):
        last = max(t for q, t, _ in rows if q == s)
        near = {int((last - t).total_seconds() // 3600): v for q, t, v in rows if q == s and (last - t) < dt.timedelta(hours=48)}
        mean = sum(near.values()) / len(near)
        rings[s] = (last, [near.get(47 - i, mean) for i in range(48)])
    for h in leads:
        frame = spark.createDataFrame([(s, r[-1], r[-24], (t + dt.timedelta(hours=h)).hour) for s, (t, r) in rings.items()], "series string, lag_1 double, lag_24 double, Hour int")
        if h > 6:
            break  # the ring's first steps; the rest repeats them
        for r in model.score(frame).collect():
            assert abs(got[r["series"], h] - r["prediction"]) < 1e-9
            rings[r["series"]][1].append(r["prediction"])
            del rings[r["series"]][1][0]


def test_two_stage_learner_needs_rows(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 5), 10.0) for i in range(335)], "x double, res double, base double")
    assert ML.fit_two_stage(df, ["x"], "res", F.col("x") > 5) is None
    out = ML.apply_two_stage(df, None, "base", F.col("x") > 5).first()
    assert (out["Targeted_Meta_MWH"], out["Targeted_Meta_MWH_Forecast"]) == (0.0, 10.0)


# -- timing and bundle ------------------------------------------------------------------------------

def test_timing_votes(spark):
    days = {  # per day: base, first and second source by hour 16..20
        1: ([5, 9, 6, 6, 6], [1, 2, 9, 3, 1], [1, 2, 8, 3, 1]),        # both vote 18, base 17
        2: ([5, 9, 6, 6, 6], [1, 9, 2, 3, 1], [1, 9, 2, 3, 1]),        # agree with the base
        3: ([5, 9, 6, 6, 6], [9, 1, 1, 1, 1], [1, 1, 1, 1, 9]),        # far apart
        4: ([5, 9, 6, 6, 6], [5, 5, 5, 5, 5], [5, 5, 5, 5, 5]),        # no margin
        5: ([5, 9, 6, 6, 6], [1, 1, 1, 9, 2], [1, 1, 9, 2, 1]),        # one hour apart: the first source's hour
    }
    rows = [(d, 16 + i, *map(float, v)) for d, cols in days.items() for i, v in enumerate(zip(*cols))]
    df = spark.createDataFrame(rows, "day int, Hour int, b double, s1 double, s2 double")
    t = P.select_timing(df, ["day"], "b", F.lit(True), {"one": "s1", "two": "s2"}, min_margin=1.0, consensus=2, max_spread=1.0)
    got = {r["day"]: (r["Timing_Hour"], r["Timing_Source"], r["Timing_Override"]) for r in t.collect()}
    assert got == {1: (18, "one_consensus", True), 2: (17, "one_aligned", False), 3: (17, "base_no_timing_consensus", False), 4: (17, "base_no_timing_candidate", False), 5: (19, "one_consensus", True)}
    blocked = P.select_timing(df, ["day"], "b", F.lit(True), {"one": "s1", "two": "s2"}, consensus=2, max_spread=1.0, blocked=F.col("day") == 1)
    assert {r["day"]: r["Timing_Hour"] for r in blocked.collect()}[1] == 17


def test_bundle_set_and_manifest(spark, history):
    h = BU.with_replay_context(history.withColumn("origin", F.lit(7)), "origin", F.lit(6))
    folder = BU.write_bundle(h, {"raw": "Raw_Forecast_MWH", "lag": "MWH_Lag24"})
    m = {r["table"]: r for r in BU.manifest(spark, folder).collect()}
    assert set(m) == set(BU.TABLES) and m["stage_metrics"]["rows"] == 2 and m["stage_metrics"]["scored"] == 2 * history.count()
    assert m["weekend_metrics_by_stage"]["scored"] == 2 * history.where("IsWeekend = 1").count() and m["long_horizon_metrics_by_stage"]["rows"] == 0
    t = BU.read_table(spark, folder, "peak_window_metrics_by_stage")
    assert t.columns[:3] == ["Replay_Horizon_Bucket", "Hour", "Stage"] and t.count() == 2 * 3
