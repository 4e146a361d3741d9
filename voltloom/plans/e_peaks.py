"""Queries: peak corrections and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core.scratch import materialise
from ..operators import peaks as P
from ..operators import scorecards as SC
from .base import ctes, load, query, replay
from .c_scorecards import ACT, FIN, RAW

COLS = ("series", "row_id", "origin_id", "Date", "DT", "Hour", "Month", "Forecast_Day", "Temperature", "Temperature_DailyMax", "CloudCover_Norm", RAW, FIN, ACT, "MWH_Lag1", "MWH_Lag24", "MWH_SameHour7DayMean")
S2 = "Raw_Forecast_MWH*1.05 + row_id % 4 AS hotsc, Raw_Forecast_MWH*1.02 + row_id % 3 AS bm1, Raw_Forecast_MWH*1.01 + row_id % 5 AS bm2"


def base(spark, d):
    r, k = F.col(RAW), F.col("row_id")
    return replay(spark, d, *COLS).withColumns({"hotsc": r * 1.05 + k % 4, "bm1": r * 1.02 + k % 3, "bm2": r * 1.01 + k % 5})


def heated(spark, d):
    return SC.add_origin_heat(base(spark, d), ["origin_id", "series"])


HEAT_SQL = f"""v_pk AS (SELECT *, {S2} FROM v_bt),
hd AS (SELECT origin_id, series, "Date", max(Temperature_DailyMax) AS t FROM v_bt GROUP BY 1, 2, 3),
hr AS (SELECT *, t - lag(t) OVER w AS ramp, lag(t) OVER w AS prior, sum(CASE WHEN t >= 100 THEN 0 ELSE 1 END) OVER w AS i100 FROM hd WINDOW w AS (PARTITION BY origin_id, series ORDER BY "Date")),
hc AS (SELECT *, CASE WHEN t >= 100 THEN count(*) FILTER (t >= 100) OVER (PARTITION BY origin_id, series, i100 ORDER BY "Date") ELSE 0 END AS run100 FROM hr),
v_ht AS (SELECT v_pk.*, ramp, run100 FROM v_pk JOIN hc USING (origin_id, series, "Date"))"""


@query("cor10_peak_risk_uplift", ctes("bt") + f""", x AS (SELECT *, {S2} FROM v_bt)
SELECT row_id, CASE WHEN Hour BETWEEN 14 AND 18 AND Temperature_DailyMax >= 85 THEN least(greatest(0, greatest(bm1-Raw_Forecast_MWH-1,0), greatest(bm2-Raw_Forecast_MWH-0.5,0)*0.65)*0.5, CASE WHEN Hour BETWEEN 16 AND 18 AND Temperature_DailyMax >= 105 AND Forecast_Day BETWEEN 1 AND 7 THEN 2.0 ELSE 1.0 END) ELSE 0 END AS cal,
 CASE WHEN Hour BETWEEN 14 AND 18 AND Temperature_DailyMax >= 85 AND (bm1-Raw_Forecast_MWH > 1 OR bm2-Raw_Forecast_MWH > 0.5) THEN concat_ws('+', CASE WHEN bm1-Raw_Forecast_MWH > 1 THEN 'prophet_peak_gap' END, CASE WHEN bm2-Raw_Forecast_MWH > 0.5 THEN 'catboost_peak_gap' END) ELSE 'none' END AS src FROM x""", r6=["cal"])
def _(spark, d):
    o = P.peak_risk(base(spark, d), RAW, {"prophet_peak_gap": ("bm1", 1.0, 1.0), "catboost_peak_gap": ("bm2", 0.5, 0.65)}, cap=1.0, extreme={"hours": [16, 17, 18], "min_temp": 105.0, "min_day": 1, "max_day": 7, "cap": 2.0})
    return o.select("row_id", F.col("Peak_Risk_Cal_MWH").alias("cal"), F.col("Peak_Risk_Source").alias("src"))


@query("cor11_hot_scenario_override", ctes("bt") + "," + HEAT_SQL + """
SELECT row_id, CASE WHEN Hour BETWEEN 17 AND 20 AND Temperature_DailyMax BETWEEN 100 AND 109.9 AND (run100 >= 2 OR ramp >= 5) AND Forecast_Day BETWEEN 1 AND 16 THEN least(greatest(hotsc-Raw_Forecast_MWH,0)*0.4, 1.5, greatest(2-greatest(bm1-Raw_Forecast_MWH,0),0)) ELSE 0 END AS lift FROM v_ht""", r6=["lift"])
def _(spark, d):
    h = heated(spark, d).withColumns({"prior_lift": F.col("bm1") - F.col(RAW), "PriorDay_DailyMaxTemp": F.lit(100.0)})
    o = P.scenario_override(h, RAW, "hotsc", P.hot_ramp_gate(consec95=None, consec100=2.0, min_ramp=5.0), 0.40, 1.5, 2.0, "prior_lift")
    return o.select("row_id", F.col("Hot_Ramp_Scenario_Lift_MWH").alias("lift"))


LIVE_SQL = """ld AS (SELECT series, max(CAST(DT AS DATE)) AS d FROM v_load GROUP BY 1),
pr AS (SELECT a.series, hour(a.DT) AS h, a.MWH - b.MWH AS dl, max(hour(a.DT)) OVER (PARTITION BY a.series) AS lh FROM v_load a JOIN ld ON a.series = ld.series AND CAST(a.DT AS DATE) = ld.d JOIN v_load b ON b.series = a.series AND b.eh = a.eh - 24),
tl AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY h DESC) AS rn FROM pr), lh AS (SELECT v_load.series, max(hour(DT)) AS lh FROM v_load JOIN ld ON v_load.series = ld.series AND CAST(DT AS DATE) = ld.d GROUP BY 1),
st AS (SELECT tl.series, arg_max(dl, h) AS obs, count(*) AS n, max(lh.lh) AS lh FROM tl JOIN lh ON tl.series = lh.series WHERE rn <= 3 GROUP BY 1)"""


@query("cor12_live_ramp_state", ctes("load") + "," + LIVE_SQL + """
SELECT series, obs, CAST(n AS BIGINT) AS pairs, CAST(lh AS INT) AS latest_hour, CAST(lh >= 6 AND n >= 3 AND obs >= 1 AS INT) AS enabled FROM st""", r6=["obs"])
def _(spark, d):
    s = P.live_ramp_state(load(spark, d), min_delta=1.0)
    return s.select("series", F.col("observed_delta_mwh").alias("obs"), F.col("pair_count").alias("pairs"), "latest_hour", F.col("enabled").cast("int").alias("enabled"))


def liveramped(spark, d):
    b = base(spark, d)
    st = b.groupBy("series").agg(F.lit(30.0).alias("observed_delta_mwh"), F.lit(True).alias("enabled"))
    return P.live_ramp_override(b, st, RAW, carry=0.1, cap=5.0)


LR_SQL = f"""v_lr AS (SELECT *, {S2}, CASE WHEN Forecast_Day = 1 AND Hour BETWEEN 16 AND 20 AND Temperature_DailyMax BETWEEN 100 AND 115 THEN least(greatest(MWH_Lag24 + 3.0 - Raw_Forecast_MWH, 0), 5) ELSE 0 END AS lift FROM v_bt)"""


@query("cor12_day1_live_ramp", ctes("bt") + "," + LR_SQL + "\nSELECT row_id, lift FROM v_lr", r6=["lift"])
def _(spark, d):
    return liveramped(spark, d).select("row_id", F.col("Day1_Live_Ramp_Cal_MWH").alias("lift"))


@query("cor13_multiday_heat_anchor", ctes("bt") + "," + LR_SQL + """,
an AS (SELECT series, max(CASE WHEN Forecast_Day = 1 AND Hour BETWEEN 16 AND 19 AND Temperature_DailyMax >= 102 AND lift >= 3 THEN Raw_Forecast_MWH END) AS pk, max(CASE WHEN Forecast_Day = 1 THEN Temperature_DailyMax END) AS tp FROM v_lr GROUP BY 1)
SELECT row_id, CASE WHEN pk IS NOT NULL AND Forecast_Day BETWEEN 2 AND 7 AND Hour BETWEEN 16 AND 20 AND Temperature_DailyMax BETWEEN 102 AND 115 THEN least(greatest(least(pk - 5 - (Forecast_Day-1)*0.75 - greatest(tp-Temperature_DailyMax,0)*1.75 + greatest(Temperature_DailyMax-tp,0)
 - CASE WHEN isodow(DT) >= 6 THEN 8 ELSE 0 END - CASE WHEN isodow(DT) = 7 THEN 6 ELSE 0 END + CASE WHEN Hour = 17 THEN 2 ELSE 0 END, 365) - Raw_Forecast_MWH, 0), 14) ELSE 0 END AS lift FROM v_lr JOIN an USING (series)""", r6=["lift"])
def _(spark, d):
    o = P.heat_anchor_override(liveramped(spark, d), RAW, min_live_lift=3.0, offsets={17: 2.0})
    return o.select("row_id", F.col("MultiDay_Heat_Anchor_Cal_MWH").alias("lift"))


@query("agg21_daily_peak_pairs", ctes("bt") + """
SELECT series, CAST("Date" AS VARCHAR) AS Date, max(Raw_Forecast_MWH) AS bp, CAST(arg_max(Hour, (Raw_Forecast_MWH, -epoch(DT))) AS INT) AS bh, max(Actual_MWH) AS ap, CAST(arg_max(Hour, (Actual_MWH, -epoch(DT))) AS INT) AS ah, max(Temperature_DailyMax) AS mx
FROM v_bt GROUP BY 1, 2""", r6=["bp", "ap", "mx"])
def _(spark, d):
    o = P.daily_peak_rows(base(spark, d), ["series", "Date"], RAW, max_cols=["Temperature_DailyMax"])
    return o.select("series", F.col("Date").cast("string").alias("Date"), F.col("Base_DailyPeak_MWH").alias("bp"), F.col("Base_PeakHour").alias("bh"), F.col("Actual_DailyPeak_MWH").alias("ap"),
                    F.col("Actual_PeakHour").alias("ah"), F.col("Max_Temperature_DailyMax").alias("mx"))


_SCOPE = "Hour BETWEEN 16 AND 20 AND coalesce(Temperature_DailyMax,0) >= 95"
CAP_SQL = HEAT_SQL + f""",
dk AS (SELECT series, "Date", arg_max(Month, (Raw_Forecast_MWH, -epoch(DT))) AS mo, arg_max(Forecast_Day, (Raw_Forecast_MWH, -epoch(DT))) AS fd, arg_max(Hour, (Raw_Forecast_MWH, -epoch(DT))) AS ph, arg_max(MWH_SameHour7DayMean, (Raw_Forecast_MWH, -epoch(DT))) AS s7, arg_max(MWH_Lag24, (Raw_Forecast_MWH, -epoch(DT))) AS l24,
  max(Raw_Forecast_MWH) AS bp, max(Actual_MWH) AS ap, max(Temperature_DailyMax) AS tp, max(CloudCover_Norm) AS cl, max(ramp) AS rp FROM v_ht WHERE {_SCOPE} GROUP BY 1, 2),
d2 AS (SELECT *, CASE WHEN fd<=1 THEN 'Day1' WHEN fd<=7 THEN 'Days2to7' ELSE 'Days8to16' END AS hb, CASE WHEN tp < 95 THEN '90-95' WHEN tp < 100 THEN '95-100' WHEN tp < 105 THEN '100-105' ELSE '105+' END AS tb,
  CASE WHEN cl IS NULL THEN 'Unknown' WHEN cl <= 0.2 THEN 'Clear/Low' WHEN cl <= 0.4 THEN 'Some Clouds' WHEN cl <= 0.6 THEN 'Partly Cloudy' WHEN cl <= 0.8 THEN 'Mostly Cloudy' ELSE 'Overcast' END AS cb, ap-bp AS r, ap-s7 AS r7, ap-l24 AS r24, CASE WHEN rp > 0 THEN (ap-l24)/rp END AS sl FROM dk),
k1 AS (SELECT hb, mo, tb, cb, count(*) n, avg(r) r, avg(r7) r7, avg(r24) r24, avg(sl) sl FROM d2 GROUP BY 1,2,3,4 HAVING count(*) >= 3), k2 AS (SELECT hb, tb, cb, avg(r) r, avg(r7) r7, avg(r24) r24, avg(sl) sl FROM d2 GROUP BY 1,2,3 HAVING count(*) >= 3),
k3 AS (SELECT hb, tb, avg(r) r, avg(r7) r7, avg(r24) r24, avg(sl) sl FROM d2 GROUP BY 1,2 HAVING count(*) >= 3)"""


def captured(spark, d):
    h = heated(spark, d)
    scope = P.hot_scope(95.0)
    lk = P.capture_lookup(P.capture_days(h, ["series", "Date"], RAW, scope))
    return h, scope, lk


CAPTURE_KEYS = {"HorizonBucket+Month+DailyMaxTempBucket+CloudCoverBucket": ("hb", "mo", "tb", "cb"), "HorizonBucket+DailyMaxTempBucket+CloudCoverBucket": ("hb", "tb", "cb"), "HorizonBucket+DailyMaxTempBucket": ("hb", "tb"),
                "DailyMaxTempBucket+CloudCoverBucket": ("tb", "cb"), "DailyMaxTempBucket": ("tb",), "HorizonBucket": ("hb",), "global": ()}
ALL_LEVELS = " UNION ALL ".join(
    f"SELECT '{name}' AS level, {' || chr(124) || '.join(f'CAST({k} AS VARCHAR)' for k in ks) if ks else chr(39) + 'all' + chr(39)} AS key, CAST(count(*) AS BIGINT) AS n, avg(r) AS r, avg(r7) AS r7, avg(r24) AS r24, avg(sl) AS sl FROM d2 "
    + (f"GROUP BY {', '.join(ks)} HAVING count(*) >= 3" if ks else "HAVING count(*) > 0") for name, ks in CAPTURE_KEYS.items())


def lookup_rows(lk):
    return lk.select("level", "key", F.col("count").alias("n"), F.col("PeakResidual").alias("r"), F.col("SameHour7Residual").alias("r7"), F.col("Lag24Residual").alias("r24"), F.col("Lag24RampSlope").alias("sl"))


@query("cor14_peak_capture_lookup", ctes("bt") + "," + CAP_SQL + "\n" + ALL_LEVELS, r6=["r", "r7", "r24", "sl"])
def _(spark, d):
    return lookup_rows(captured(spark, d)[2])


CAPTURE_SQL = CAP_SQL + """,
jd AS (SELECT d2.series, d2."Date", d2.ph, d2.bp, d2.tp, coalesce(k1.r,k2.r,k3.r) AS lr, d2.s7 + coalesce(k1.r7,k2.r7,k3.r7) AS t7, d2.l24 + coalesce(k1.r24,k2.r24,k3.r24) AS t24,
  d2.l24 + least(greatest(coalesce(CASE WHEN k1.r IS NOT NULL THEN k1.sl WHEN k2.r IS NOT NULL THEN k2.sl ELSE k3.sl END, 0),-4),4)*greatest(coalesce(d2.rp,0),0) AS ts
 FROM d2 LEFT JOIN k1 ON k1.hb=d2.hb AND k1.mo=d2.mo AND k1.tb=d2.tb AND k1.cb=d2.cb LEFT JOIN k2 ON k2.hb=d2.hb AND k2.tb=d2.tb AND k2.cb=d2.cb LEFT JOIN k3 ON k3.hb=d2.hb AND k3.tb=d2.tb),
ja AS (SELECT *, least(greatest(greatest(bp + greatest(lr,0), CASE WHEN lr >= 4 OR tp >= 105 THEN greatest(t7,t24,ts) ELSE bp END) - bp, 0), 9) AS amt FROM jd),
jb AS (SELECT *, CASE WHEN lr < 0 THEN 'negative_learned_residual' WHEN amt < 0.25 THEN 'below_min_correction' ELSE 'applied' END AS why FROM ja),
jc AS (SELECT v_ht.*, why, amt, exp(-0.5*pow(v_ht.Hour-ph,2)) AS w FROM v_ht JOIN jb USING (series, "Date") WHERE """ + _SCOPE.replace("Hour", "v_ht.Hour") + """),
v_cp AS (SELECT *, CASE WHEN why = 'applied' THEN amt*w/max(w) OVER (PARTITION BY series, "Date") ELSE 0 END AS lift FROM jc)"""


def capture(spark, d):
    h, scope, lk = captured(spark, d)
    return P.apply_capture(h, ["series", "Date"], lk, RAW, scope, strong_floor=0.0), scope


@query("cor14_peak_capture", ctes("bt") + "," + CAPTURE_SQL + "\nSELECT row_id, lift, why FROM v_cp", r6=["lift"])
def _(spark, d):
    o, scope = capture(spark, d)
    return o.where(scope).select("row_id", F.col("Peak_Capture_MWH").alias("lift"), F.col("Peak_Capture_Source").alias("why"))


@query("agg41_capture_summary", ctes("bt") + "," + CAPTURE_SQL + """
SELECT CAST(count(*) AS BIGINT) AS scope_rows, CAST(count(*) FILTER (lift <> 0) AS BIGINT) AS applied_rows, avg(CASE WHEN lift <> 0 THEN lift END) AS mean_lift, avg(abs(Actual_MWH-Raw_Forecast_MWH)) AS mae_before, avg(abs(Actual_MWH-Raw_Forecast_MWH-lift)) AS mae_after FROM v_cp""", r6=["mean_lift", "mae_before", "mae_after"])
def _(spark, d):
    o, scope = capture(spark, d)
    return P.capture_summary(o, RAW, "Peak_Capture_MWH", scope)


_PS = "Hour BETWEEN 16 AND 20 AND coalesce(Temperature_DailyMax,0) >= 100 AND coalesce(run100,0) >= 1"


PERSIST_SQL = CAP_SQL.replace(_SCOPE, _PS)


def persisting():
    return P.hot_scope(100.0) & P.yes(F.col("ConsecutiveExtremeHotDays100") >= 1)


def persisted(spark, d):
    h = materialise(heated(spark, d), spark)  # learned from, timed and applied to
    return h, P.capture_lookup(P.capture_days(h, ["series", "Date"], RAW, persisting()))


@query("cor16_heat_persistence_lookup", ctes("bt") + "," + PERSIST_SQL + "\n" + ALL_LEVELS, r6=["r", "r7", "r24", "sl"])
def _(spark, d):
    return lookup_rows(persisted(spark, d)[1])


TIMING = {"scenario": "hotsc", "first_benchmark": "bm1", "second_benchmark": "bm2"}
_VOTES = " UNION ALL ".join(f"""SELECT series, "Date", {i} AS p, '{n}' AS s, l[1].h AS h, coalesce(l[2].v - l[1].v, 1e18) AS m FROM (SELECT series, "Date", list_sort(list({{'v': -v, 'h': Hour}})) AS l FROM (SELECT series, "Date", Hour, max({c}) AS v FROM v_ht WHERE {_PS} GROUP BY ALL) GROUP BY ALL)"""
                            for i, (n, c) in enumerate(TIMING.items()))
TIMING_SQL = PERSIST_SQL + f""",
vo AS (SELECT * FROM ({_VOTES}) WHERE m >= 0.5),
cl AS (SELECT a.series, a."Date", a.p, count(*) AS n, min(b.m) AS cf, min(b.p) AS bp, arg_min(b.h, b.p) AS h, arg_min(b.s, b.p) AS s FROM vo a JOIN vo b ON a.series = b.series AND a."Date" = b."Date" AND abs(a.h - b.h) <= 1 GROUP BY ALL HAVING count(*) >= 2),
tp AS (SELECT *, row_number() OVER (PARTITION BY series, "Date" ORDER BY n DESC, cf DESC, bp, p) AS rn FROM cl),
tm AS (SELECT d2.series, d2."Date", ph, coalesce(tp.h, ph) AS th, CASE WHEN tp.h IS NOT NULL THEN tp.s || CASE WHEN tp.h <> ph THEN '_consensus' ELSE '_aligned' END
  WHEN EXISTS (SELECT 1 FROM vo WHERE vo.series = d2.series AND vo."Date" = d2."Date") THEN 'base_no_timing_consensus' ELSE 'base_no_timing_candidate' END AS src, tp.cf FROM d2 LEFT JOIN tp ON tp.series = d2.series AND tp."Date" = d2."Date" AND rn = 1)"""


def timed(h):
    return P.select_timing(h, ["series", "Date"], RAW, persisting(), TIMING, min_margin=0.5, consensus=2, max_spread=1.0)


@query("cor16_peak_timing", ctes("bt") + "," + TIMING_SQL + """
SELECT series, CAST("Date" AS VARCHAR) AS Date, CAST(ph AS INT) AS base_hour, CAST(th AS INT) AS hour, src, cf FROM tm""", r6=["cf"])
def _(spark, d):
    o = timed(materialise(heated(spark, d), spark))
    return o.select("series", F.col("Date").cast("string").alias("Date"), F.col("Base_PeakHour").alias("base_hour"), F.col("Timing_Hour").alias("hour"), F.col("Timing_Source").alias("src"), F.col("Timing_Confidence").alias("cf"))


def _first(x):
    return "CASE " + " ".join(f"WHEN k{i}.n IS NOT NULL THEN k{i}.{x}" for i in range(1, 7)) + f" ELSE k7.{x} END"


_KS = list(CAPTURE_KEYS.values())
PERSIST_CAPTURE_SQL = TIMING_SQL.replace("k1 AS (", "o1 AS (").replace("k2 AS (", "o2 AS (").replace("k3 AS (", "o3 AS (") + ",\n" + ",\n".join(
    f"k{i} AS (SELECT {''.join(k + ', ' for k in ks)}count(*) n, avg(r) r, avg(r7) r7, avg(r24) r24, avg(sl) sl FROM d2 {('GROUP BY ' + ', '.join(ks) + ' HAVING count(*) >= 3') if ks else ''})" for i, ks in enumerate(_KS, 1)) + f""",
ld AS (SELECT d2.*, coalesce({_first('r')}, 0) AS lr, s7 + coalesce({_first('r7')}, {_first('r')}, 0) AS t7, l24 + coalesce({_first('r24')}, {_first('r')}, 0) AS t24, l24 + least(greatest(coalesce({_first('sl')}, 0), -4), 4) * greatest(coalesce(rp, 0), 0) AS ts
  FROM d2 {' '.join('LEFT JOIN k%d ON %s' % (i, ' AND '.join(f'k{i}.{k} = d2.{k}' for k in ks) or 'TRUE') for i, ks in enumerate(_KS, 1))}),
la AS (SELECT *, least(greatest(greatest(bp + greatest(lr, 0), CASE WHEN lr >= 4 OR tp >= 105 THEN greatest(t7, t24, ts) ELSE bp END) - bp, 0), 9) AS amt FROM ld),
lb AS (SELECT la.*, th, th <> la.ph AS mv, CASE WHEN lr < 0 THEN 'negative_learned_residual' WHEN amt < 0.25 THEN 'below_min_correction' ELSE 'applied' END AS why FROM la JOIN tm ON tm.series = la.series AND tm."Date" = la."Date"),
lc AS (SELECT v_ht.*, why, amt, bp, lb.ph, lb.th, mv, exp(-0.5*pow(v_ht.Hour - lb.th, 2)) AS w FROM v_ht JOIN lb ON lb.series = v_ht.series AND lb."Date" = v_ht."Date" WHERE {_PS.replace('Hour', 'v_ht.Hour')}),
le AS (SELECT *, w / max(w) OVER (PARTITION BY series, "Date") AS g, max(CASE WHEN Hour = th THEN Raw_Forecast_MWH END) OVER (PARTITION BY series, "Date") AS sb FROM lc),
lf AS (SELECT *, least(greatest(amt, bp + amt - sb), amt + 5) AS up FROM le),
v_pc AS (SELECT *, CASE WHEN why <> 'applied' THEN 0 WHEN mv AND sb IS NOT NULL AND up > amt + 1e-9 THEN CASE WHEN Hour <> th THEN least(up * g, greatest(bp + amt - Raw_Forecast_MWH, 0)) ELSE up * g END ELSE amt * g END AS lift FROM lf)"""


@query("cor16_heat_persistence_capture", ctes("bt") + "," + PERSIST_CAPTURE_SQL + "\nSELECT row_id, th AS hour, why, lift, greatest(Raw_Forecast_MWH + lift, 0) AS fc FROM v_pc", r6=["lift", "fc"])
def _(spark, d):
    h, lk = persisted(spark, d)
    t = timed(h)
    o = P.apply_capture(h, ["series", "Date"], lk, RAW, persisting(), strong_floor=0.0, timing=t, max_extra=5.0).where(persisting())
    o = o.join(t.select("series", "Date", "Timing_Hour"), ["series", "Date"])
    return o.select("row_id", F.col("Timing_Hour").alias("hour"), F.col("Peak_Capture_Source").alias("why"), F.col("Peak_Capture_MWH").alias("lift"), F.col("Peak_Capture_Forecast_MWH").alias("fc"))


@query("cor15_targeted_missing_rules", ctes("bt") + """
SELECT row_id, CASE WHEN f <> 0 THEN f WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 105 AND Month IN (6,7,8) THEN 3.0 WHEN Hour IN (17,18) AND Temperature_DailyMax >= 98 AND Temperature_DailyMax <= 110 AND Forecast_Day BETWEEN 2 AND 9 AND CloudCover_Norm <= 0.3 THEN 1.5 ELSE 0 END AS lift
FROM (SELECT *, CASE WHEN row_id % 5 = 0 THEN 0.5 ELSE 0 END AS f FROM v_bt)""", r6=["lift"])
def _(spark, d):
    rules = [{"name": "summer_105", "min_maxtemp_f": 105.0, "months": [6, 7, 8], "lift_mwh": 3.0},
             {"name": "core", "hours": [17, 18], "min_maxtemp_f": 98.0, "max_maxtemp_f": 110.0, "min_forecast_day": 2, "max_forecast_day": 9, "max_cloud_cover_norm": 0.3, "lift_mwh": 1.5}]
    b = base(spark, d).withColumn("lift", F.when(F.col("row_id") % 5 == 0, 0.5).otherwise(0.0))
    return P.targeted_rules(b, rules, "lift").select("row_id", "lift")


@query("cor17_cooling_guard", ctes("bt") + """
SELECT CAST(coalesce(Temperature_DailyMax-Temperature >= 12, FALSE) AND Hour >= 15 AND coalesce(CloudCover_Norm <= 0.5, FALSE) AS INT) AS guard, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1""")
def _(spark, d):
    g = P.cooling_underway({"min_drop_from_dailymax_f": 12.0, "min_hour": 15, "max_cloud_cover_norm": 0.5})
    return base(spark, d).groupBy(g.cast("int").alias("guard")).agg(F.count("*").alias("n"))


@query("cor18_escalating_streak", ctes("bt") + "," + HEAT_SQL + """
SELECT row_id, CASE WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 AND run100 > 1 THEN least((run100-1)*1.5, 4) ELSE 0 END AS lift FROM v_ht""", r6=["lift"])
def _(spark, d):
    h = heated(spark, d).withColumn("ConsecutiveVeryHotDays95", F.col("ConsecutiveExtremeHotDays100"))
    return P.streak_lift(h, RAW, 1.0, 1.5, 4.0).select("row_id", F.col("Escalating_Heat_Persistence_Correction_MWH").alias("lift"))


@query("cor19_extreme_magnitude", ctes("bt") + "," + HEAT_SQL + """
SELECT row_id, CASE WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 98 AND run100 <= 2 THEN least((Temperature_DailyMax-98)*0.5, 6) ELSE 0 END AS lift FROM v_ht""", r6=["lift"])
def _(spark, d):
    h = heated(spark, d).withColumn("ConsecutiveVeryHotDays95", F.col("ConsecutiveExtremeHotDays100"))
    return P.magnitude_lift(h, RAW, 98.0, 0.5, 6.0, 2.0).select("row_id", F.col("Extreme_Heat_Magnitude_Correction_MWH").alias("lift"))


@query("cor24_evidence_gates", ctes("bt") + """
SELECT CAST(coalesce(Raw_Forecast_MWH >= 20 AND coalesce(MWH_Lag1, MWH_Lag24 - 1) <= 80 AND Temperature_DailyMax >= 85 AND CloudCover_Norm <= 0.7 AND Forecast_Day <= 10, FALSE) AS INT) AS gate, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1""")
def _(spark, d):
    b = base(spark, d).withColumn("Lag1_Minus_SameHourYesterday_MWH", F.lit(-1.0))
    g = P.evidence_gate({"raw": (20.0, None), "lag1x": (None, 80.0), "maxtemp": (85.0, None), "cloud": (None, 0.7), "forecast_day": (None, 10.0)}, {"lag1x": P.lag1_or_rebuilt()})
    return b.groupBy(g.cast("int").alias("gate")).agg(F.count("*").alias("n"))
