"""Nested temporal holdout of the solar calibration against plain versions and planted cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltloom.operators import solar_gates as SG

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "seg string, IntervalStartDT timestamp, Actual_kWh double, Forecast_kWh double, ClearSkyIndex double, CloudCoverPct double, SolarElevationDeg double, ActiveCapacity_kW double"


def planted(flip: bool, peak_grows: bool = False):
    """200 days: a peak hour of its own regime and two others, one steady at 0.9, one that turns from 0.9 to 1.1 in the last 40 days if ``flip``."""
    out = []
    for day in range(200):
        late = day >= 160
        for k in range(6):
            steady = k % 2 == 0
            f = 1000.0 + 10 * k + (4000.0 if k == 5 else 0.0)
            r = 0.9 if steady or not late or not flip else 1.1
            if k == 5:
                r = 0.5 if not (late and peak_grows) else 1.0
            out.append(("a", BASE + dt.timedelta(days=day, hours=8 + k), f * r, f, 1.0 if k == 5 else 0.1 if steady else 0.7, 10.0, 50.0, 10000.0))
    return out


def framed(spark, rows):
    return SG.hold_out_latest(spark.createDataFrame(rows, SCHEMA).coalesce(1), 0.2).cache()


def test_a_factor_that_fails_on_the_holdout_is_pruned(spark):
    g = SG.Gates(month=(1.0, 1.0), peak_floor=1.0)
    _, found, kept = SG.pruned_regimes(framed(spark, planted(True)), g=g)
    assert {r["key"] for r in found.collect()} >= {"csi|csi_000_020", "csi|csi_050_080"}
    keys = {r["key"] for r in kept.collect()}
    assert "csi|csi_000_020" in keys and "csi|csi_050_080" not in keys


def test_factors_do_not_see_the_holdout(spark):
    rows = planted(True)
    cut = BASE + dt.timedelta(days=160)
    other = [r if r[1] < cut else (*r[:2], r[2] * 0.3, *r[3:]) for r in rows]
    a, b = ({(r["key"], r["factor"]) for r in SG.pruned_regimes(framed(spark, x))[1].collect()} for x in (rows, other))
    assert a == b and a


@pytest.mark.parametrize("grows", [False, True])
def test_peak_step_is_switched_off_where_it_hurts(spark, grows):
    g = SG.Gates(month=(1.0, 1.0), regime=(1.0, 1.0), peak_floor=0.4, peak_quantile=0.9)
    df = framed(spark, planted(False, grows))
    r = SG.calibration_gates(df, "ActiveCapacity_kW", g=g)[0].first()
    assert r["peak_factor"] == pytest.approx(0.5) and r["Peak_On"] is (not grows)
    cal = SG.calibrate(df, "ActiveCapacity_kW", g=g)
    assert cal.peaks.count() == (0 if grows else 1)
    top = SG.apply_calibration_tables(df, cal, "ActiveCapacity_kW").where("Forecast_kWh > 5000").agg(F.max("Calibrated_kWh")).first()[0]
    assert top == pytest.approx(5050.0 if grows else 5050.0 * cal.peaks.first()["peak_factor"])


def test_errors_equal_a_plain_loop(spark):
    rows = planted(True)
    g = SG.Gates(month=(0.5, 1.1), regime=(0.6, 1.15), peak_floor=0.5)
    got = SG.calibration_gates(framed(spark, rows), "ActiveCapacity_kW", g=g)[0].first()
    late = [r for r in rows if r[1] >= BASE + dt.timedelta(days=160)]
    fit = [r for r in rows if r[1] < BASE + dt.timedelta(days=160)]
    tot = lambda xs, i: sum(x[i] for x in xs)
    whole = tot(fit, 2) / tot(fit, 3)
    month = {}
    for m in {r[1].month for r in fit}:
        x = [r for r in fit if r[1].month == m]
        month[m] = (tot(x, 2) + 1e5 * whole) / (tot(x, 3) + 1e5)
    pre = [r[3] * month.get(r[1].month, whole) for r in late]
    assert got["Holdout_Rows"] == len(late) == 240
    assert got["WMAPE_Base"] == pytest.approx(sum(abs(r[3] - r[2]) for r in late) / tot(late, 2))
    assert got["WMAPE_Month"] == pytest.approx(sum(abs(p - r[2]) for p, r in zip(pre, late)) / tot(late, 2))


def test_few_rows_have_no_holdout_and_keep_every_step(spark):
    df = framed(spark, planted(False)[:30])
    assert df.where("holdout").count() == 0
    r = SG.calibration_gates(df, "ActiveCapacity_kW")[0].first()
    assert (r["Rows"], r["Holdout_Rows"], r["Regime_On"], r["Peak_On"]) == (30, 0, True, True)


def test_rows_of_one_time_stay_together(spark):
    rows = [("a", BASE + dt.timedelta(days=i // 10), 1.0, 1.0, None, None, None, 1.0) for i in range(100)] + [("a", None, 1.0, 1.0, None, None, None, 1.0)]
    got = SG.hold_out_latest(spark.createDataFrame(rows, SCHEMA), 0.15).groupBy("IntervalStartDT").agg(F.collect_set("holdout").alias("h")).collect()
    assert all(len(r["h"]) == 1 for r in got)
    assert sum(r["h"] == [True] for r in got) == 2


def test_status_of_empty_and_short_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert SG.temporal_holdout_status(empty, 10).first()["Status"] == "skipped"
    one_day = spark.createDataFrame(planted(False)[:6], SCHEMA)
    assert SG.temporal_holdout_status(one_day, 10).first()["Status"] == "skipped"
    r = SG.temporal_holdout_status(spark.createDataFrame(planted(False), SCHEMA), 40).first()
    assert (r["Status"], r["TrainRows"], r["HoldoutRows"]) == ("completed", 960, 240)
