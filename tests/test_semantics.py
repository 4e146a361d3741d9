"""Edge semantics: clocks, runs, bounds, nulls, leakage, archives."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voltloom.functions import buckets as B
from voltloom.functions import calendar as C
from voltloom.functions import clock as K
from voltloom.models import learners as ML
from voltloom.operators import bands as BD
from voltloom.operators import climatology as CL
from voltloom.operators import exclusions as X
from voltloom.operators import history as H
from voltloom.operators import intraday as I
from voltloom.operators import lookups as LK
from voltloom.operators import rules as RU
from voltloom.operators import weather_features as WF
from voltloom.sources import scans as SR
from voltloom.sources import store as ST

T0 = pd.Timestamp("2024-01-01")


def test_localize_drops_skipped_and_repeated_hours(spark):
    rows = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-11-03 03:00:00"]
    df = spark.createDataFrame([(r,) for r in rows], "s string").select(K.localize(F.to_timestamp("s"), "America/Los_Angeles").cast("string").alias("u"))
    assert [r["u"] for r in df.collect()] == ["2024-03-10 09:30:00", None, None, "2024-11-03 11:00:00"]


def test_wall_clock_keeps_and_zone_clock_converts(spark):
    df = spark.createDataFrame([("2024-07-01 18:00:00-07:00",), ("2024-12-01T18:00:00Z",), ("bad",)], "t string")
    r = df.select(K.wall_clock("t").cast("string").alias("w"), K.zone_clock("t", "America/Los_Angeles").cast("string").alias("z")).collect()
    assert [x["w"] for x in r] == ["2024-07-01 18:00:00", "2024-12-01 18:00:00", None]
    assert r[0]["z"] == "2024-07-01 18:00:00" and r[1]["z"] == "2024-12-01 10:00:00" and r[2]["z"] is None


def test_holidays_observed(spark):
    got = {r["h"] for r in spark.range(1).select(F.explode(C.holidays_of_year(F.lit(2021))).alias("h")).collect()}
    assert dt.date(2021, 7, 5) in got and dt.date(2021, 12, 24) in got and dt.date(2021, 5, 31) in got and dt.date(2021, 11, 25) in got and len(got) == 10


def test_row_runs_ignore_gaps_and_streaks_respect_them(spark):
    days = [("2024-06-01", 91.0), ("2024-06-02", 95.0), ("2024-06-04", 96.0), ("2024-06-05", 80.0), ("2024-06-06", None), ("2024-06-07", 90.0)]
    df = spark.createDataFrame([("a", d, t) for d, t in days], "series string, d string, Temperature_DailyMax double").withColumn("Date", F.to_date("d"))
    run = [r["run"] for r in WF.add_run_lengths(df, {"run": F.col("Temperature_DailyMax") >= 90.0}).orderBy("Date").collect()]
    assert run == [1, 2, 3, 0, 0, 1]
    st = sorted((str(r["Start"]), r["Length_Days"], r["Peak_Temp"]) for r in WF.hot_streaks(df, 90.0).collect())
    assert st == [("2024-06-01", 2, 95.0), ("2024-06-04", 1, 96.0), ("2024-06-07", 1, 90.0)]


def test_first_day_ramp_is_zero_for_features_and_null_for_scorecards(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 6, 1), 90.0, 60.0), ("a", dt.date(2024, 6, 2), 95.0, 61.0)], "series string, Date date, Temperature_DailyMax double, Temperature_DailyMin double")
    f = [r["DailyMaxTemp_Ramp_1Day"] for r in WF.daily_heat(df).orderBy("Date").collect()]
    s = [r["DailyMaxTemp_Ramp_1Day"] for r in WF.daily_heat(df, first_ramp=None).orderBy("Date").collect()]
    assert f == [0.0, 5.0] and s == [None, 5.0]


def test_bin_edges(spark):
    df = spark.createDataFrame([(75.0,), (65.0,), (999.5,), (None,)], "t double")
    r = df.select(B.daily_max_bucket("t").alias("r"), B.peak_daily_max_band("t").alias("l"), B.weight_temp_bucket("t").alias("w"), B.cloud_bin("t").alias("c")).collect()
    assert [x["r"] for x in r] == ["65-75", "<65", None, None]
    assert [x["l"] for x in r] == ["75-85", "<75", None, None]
    assert r[3]["w"] == "unknown" and r[2]["w"] == "105+" and r[3]["c"] is None


def test_horizon_schemes_handle_null(spark):
    df = spark.createDataFrame([(None,), (0,), (3,), (17,)], "d int")
    r = df.select(*[B.horizon_bucket("d", s).alias(s) for s in B.HORIZON_SCHEMES]).collect()
    assert [x["scenario"] for x in r] == ["Informational", "Informational", "Days2to3", "Informational"]
    assert [x["capture"] for x in r] == ["Unknown", "Day1", "Days2to7", "Day17Plus"]
    assert [x["diagnostic"] for x in r] == [None, "Day1", "Days2-3", "Day17+"]


def test_interpolation_limit_from_both_sides(spark):
    v = [None, None, None, 1.0, None, None, None, None, None, 7.0, None, None, None]
    pdf = pd.DataFrame({"series": "a", "DT": [T0 + pd.Timedelta(hours=i) for i in range(13)]})
    df = spark.createDataFrame([("a", d.to_pydatetime(), x) for d, x in zip(pdf.DT, v)], "series string, DT timestamp, x double")
    for chunk in (3, 1000):
        got = [r["x"] for r in H.interpolate(df, "x", limit=2, chunk_hours=chunk).orderBy("DT").collect()]
        assert got == [None, 1.0, 1.0, 1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0, 7.0, 7.0, None]


def test_exclusions(spark):
    assert X.hour_bounds({}) == (0, 23) and X.hour_bounds({"he_start": 20, "he_end": 7}) == (7, 20) and X.hour_bounds({"he_start": 18}) == (18, 23)
    df = spark.createDataFrame([(dt.datetime(2024, 6, 1, h),) for h in range(24)], "DT timestamp")
    ev = spark.createDataFrame([("2024-06-01", 18, None), ("2024-06-01", 3, 1)], "date string, he_start int, he_end int")
    left = sorted(r["DT"].hour for r in X.drop_excluded_table(df, ev).collect())
    assert left == [0, *range(4, 18)]
    assert X.drop_excluded(df, [{"date": "2024-06-01"}]).count() == 0


def test_climatology_looks_at_earlier_years_only_and_gives_null(spark):
    rows = [("a", dt.date(y, m, d), t) for y, m, d, t in [(2018, 12, 30, 50.0), (2019, 1, 2, 60.0), (2020, 1, 1, 70.0), (2021, 1, 1, 99.0), (2022, 1, 1, 10.0)]]
    ref = spark.createDataFrame(rows, "series string, Date date, Temperature_DailyMax double").withColumns({"Year": F.year("Date"), "DOY": F.dayofyear("Date")})
    got = {str(r["Date"]): r for r in CL.climatology_lookup(ref, ref.select("series", "Date"), percentile=50.0).collect()}
    assert got["2018-12-30"]["Climatology_Temp_PXX_F"] is None and got["2018-12-30"]["Temp_Climatology_Reference_Years"] == 0
    assert got["2021-01-01"]["Temp_Climatology_Reference_Years"] == 3 and got["2021-01-01"]["Climatology_Temp_PXX_F"] == 60.0
    assert got["2022-01-01"]["Climatology_Temp_PXX_F"] == 65.0


def test_overlap_keeps_official_hour(spark):
    off = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), 10.0 + h) for h in range(3)], "series string, DT timestamp, MWH double")
    rec = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), 99.0, "five_min_completed_hour") for h in range(1, 5)], "series string, DT timestamp, MWH double, Load_Source string")
    got = {r["DT"].hour: r["MWH"] for r in I.append_recent_hours(off, rec, ["series"], 5).collect()}
    assert got == {0: 10.0, 1: 11.0, 2: 12.0, 3: 99.0, 4: 99.0}


def test_rules_bounds_nulls_and_stack(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"Month": rng.integers(1, 13, 300), "Hour": rng.integers(0, 24, 300), "Season": "x", "Forecast_Day": rng.integers(1, 17, 300), "Temperature_DailyMax": np.where(rng.random(300) < 0.1, np.nan, rng.integers(88, 106, 300).astype(float)),
                        "CloudCover_Norm": rng.random(300), "BTM_Solar_Loss_From_ClearSky_MW": rng.random(300) * 5, "Raw_Forecast_MWH": 100.0, "MWH_SameHour7DayMean": 95.0, "MWH_Lag24": 90.0, "IsHoliday": 0, "IsWeekend": 0, "f": 100.0, "id": range(300)})
    rules = [{"name": "a", "min_maxtemp_f": 90.0, "max_maxtemp_f": 100.0, "adjustment_mwh": 2.0}, {"name": "b", "min_prior_guard_mwh": 1.0, "hours": list(range(12, 24)), "adjustment_mwh": 3.0},
             {"name": "c", "max_prior_total_adjustment_mwh": 4.0, "min_forecast_day": 5, "adjustment_mwh": -1.0, "max_total_cap_mwh": 9.0}]
    df = spark.createDataFrame(pdf.to_dict("records")).withColumn("Temperature_DailyMax", F.when(~F.isnan("Temperature_DailyMax"), F.col("Temperature_DailyMax")))
    got = {r["id"]: (r["Focused_Scorecard_Guard_MWH"], r["Focused_Scorecard_Guard_Source"]) for r in RU.apply_guard(df, rules, "f", 4.0).collect()}
    for r in pdf.itertuples():
        t, cap, src = 0.0, 4.0, []
        if 90 <= r.Temperature_DailyMax < 100:
            t += 2
            src.append("a")
        if t >= 1 and r.Hour >= 12:
            t += 3
            src.append("b")
        if t <= 4 and r.Forecast_Day >= 5:
            t -= 1
            cap = 9.0
            src.append("c")
        assert got[r.id] == (max(-cap, min(cap, t)), "+".join(src) or "none")


def test_lookup_null_key_matches_null_and_unseen_is_unmatched(spark):
    lv = (LK.Level("g", (), 0.1), LK.Level("k", ("k",), 1.0))
    work = spark.createDataFrame([(None, 2.0), (None, 4.0), ("x", -1.0)], "k string, r double")
    lk = LK.learn(work, lv, "r", shrink_k=0.0)
    got = {r["k"]: (round(r["c"], 9), r["m"]) for r in LK.apply_weighted(spark.createDataFrame([(None,), ("x",), ("y",)], "k string"), lk, lv, count_k=None, correction="c", matched="m").collect()}
    g = 5.0 / 3
    assert got == {None: (round((0.1 * g + 3.0) / 1.1, 9), "g+k"), "x": (round((0.1 * g - 1.0) / 1.1, 9), "g+k"), "y": (round(g, 9), "g")}
    sd = {(r["level"], r["key"]): r["std"] for r in lk.collect()}
    assert abs(sd[("k", LK.MISSING)] - np.std([2.0, 4.0], ddof=1)) < 1e-9 and sd[("k", "x")] is None


def test_prior_origin_quantiles_against_loop(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"o": rng.integers(0, 6, 600), "Weather_Input_Risk_Class": rng.choice(["r1", "r2"], 600), "Replay_Horizon_Bucket": rng.choice(["h1", "h2"], 600), "e": np.round(np.abs(rng.normal(0, 3, 600)), 2)})
    got = {(r["level"], r["key"], r["o"]): (r["q"], r["count"]) for r in BD.prior_origin_quantiles(spark.createDataFrame(pdf), "o", "e").collect()}
    for o in range(1, 6):
        p = pdf[pdf.o < o]
        assert abs(got[("global", "all", o)][0] - np.quantile(p.e, 0.8)) < 1e-9 and got[("global", "all", o)][1] == len(p)
        q = p[(p.Weather_Input_Risk_Class == "r1") & (p.Replay_Horizon_Bucket == "h2")]
        assert abs(got[("risk_horizon", "r1|h2", o)][0] - np.quantile(q.e, 0.8)) < 1e-9
    assert ("global", "all", 0) not in got


def test_replay_does_not_leak(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"series": "a", "DT": [T0 + pd.Timedelta(hours=i) for i in range(24 * 30)], "MWH": rng.random(24 * 30)})
    later = pdf.copy()
    later.loc[later.DT >= T0 + pd.Timedelta(days=12), "MWH"] += 50
    run = lambda x: H.rolling_origin_replay(spark.createDataFrame(x), "2024-01-08", 2, 5, 3).where("origin_dt <= DATE'2024-01-12'").select("origin_dt", "DT", "Raw_Forecast_MWH").toPandas().sort_values(["origin_dt", "DT"]).Raw_Forecast_MWH.to_numpy()
    np.testing.assert_array_equal(run(pdf), run(later))


def test_recursive_forecast_equals_loop(spark):
    rng = np.random.default_rng(4)
    y = list(rng.random(200))
    df = spark.createDataFrame(pd.DataFrame({"series": "a", "DT": [T0 + pd.Timedelta(hours=i) for i in range(200)], "MWH": y}))
    got = [r["Raw_Forecast_MWH"] for r in ML.recursive_forecast(df, {1: 0.6, 24: 0.3}, 0.1, 40).orderBy("Forecast_Lead_Hour").collect()]
    h = list(y)
    for _ in range(40):
        h.append(0.1 + 0.6 * h[-1] + 0.3 * h[-24])
    np.testing.assert_allclose(got, h[200:])


def test_archive_reuses_equal_content(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), float(h)) for h in range(5)], "DT timestamp, x double")
    root = str(tmp_path / "arch")
    assert ST.archive(df, root, "s1", ["DT", "x"]) == "s1"
    assert ST.archive(df.orderBy(F.desc("DT")), root, "s2", ["DT", "x"]) == "s1"
    assert ST.archive(df.withColumn("x", F.col("x") + 1), root, "s3", ["DT", "x"]) == "s3"
    assert spark.read.parquet(f"{root}/manifest").count() == 2


def test_lake_path_metadata(spark):
    df = spark.createDataFrame([("file:/d/RES/NEM/DEL/MONTHLY_202401/a.parquet",), ("file:/d/COM/GS3/REC/MONTHLY_202312/b.parquet",), ("file:/d/x.parquet",)], "p string")
    r = df.select(*[c.alias(n) for n, c in SR.lake_metadata(F.col("p")).items()]).collect()
    assert (r[0]["segment"], r[0]["channel"], r[0]["month"], r[0]["rate_group"], r[0]["nem_status"]) == ("RES", "DEL", "202401", "RES", "NEM")
    assert (r[1]["segment"], r[1]["channel"], r[1]["rate_group"], r[1]["nem_status"]) == ("COM", "REC", "GS3", "Non-NEM")
    assert r[2]["segment"] is None


def test_missing_solar_csv_is_empty(spark, tmp_path):
    assert SR.solar_csv(spark, str(tmp_path / "none*.csv")).count() == 0


def test_interval_labels_follow_last_rule(spark):
    from voltloom.operators import scorecards as SC

    df = spark.createDataFrame([("Peak", "Spring", 17, 9, 91.0, 0.9, 0.0, 0, 0)], "HourGroup string, Season string, Hour int, Forecast_Day int, Temperature_DailyMax double, CloudCover_Norm double, BTM_Solar_Loss_From_ClearSky_MW double, IsHoliday int, IsWeekend int")
    r = df.select(SC.weather_event_label().alias("a"), SC.interval_event_slice().alias("b")).first()
    assert r["a"] == "long_horizon_days8to16" and r["b"] == "shoulder_heat_transition"
