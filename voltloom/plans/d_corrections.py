"""Queries: lookups, event classes, rules, recent residuals, bands, scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core.scratch import materialise
from ..functions import buckets as B
from ..operators import bands as BD
from ..operators import event_class as E
from ..operators import lookups as LK
from ..operators import metrics as M
from ..operators import recent as R
from ..operators import rules as RU
from ..operators import scenarios as S
from .a_features import CLOUD_BIN_SQL, CLOUD_BUCKET_SQL, LOSS, PROXY_BIN_SQL, QUART_CASE, QUART_SQL, TEMP_BIN_SQL
from .base import HOUR_GROUP, ctes, load, query, reading, replay
from .c_scorecards import ACT, FIN, RAW, bucketed

CTX = ("series", "row_id", "Hour", "Month", "Season", "HourGroup", "IsWeekend", "Forecast_Day", "Forecast_Lead_Hour", "Temperature_DailyMax", "CloudCover_Norm", "BTM_Solar_Proxy_MW", LOSS, RAW, ACT, "Residual_MWH")
CX_SQL = f"""{QUART_SQL.format(c=LOSS)},
v_cx AS (SELECT v_bt.*, {TEMP_BIN_SQL} AS tb, {CLOUD_BIN_SQL} AS cb, {PROXY_BIN_SQL} AS pb, {CLOUD_BUCKET_SQL} AS ck, {QUART_CASE.format(c=LOSS)} AS lk FROM v_bt, quart)"""
_NAME = {"DailyMaxTempBin": "tb", "CloudCoverBin": "cb", "BTMSolarProxyBin": "pb", "CloudCoverBucket": "ck", "SolarLossBucket": "lk", "CloudSolarEventClass": "cls", "CloudSolarBaseBucket": "bb"}


def _sqlk(keys):
    return [_NAME.get(k, k) for k in keys]


def lookup_sql(levels, src, where, blend, cap, k):
    """One CTE per level with correction and count, as DuckDB text."""
    out = []
    for lv in levels:
        ks = _sqlk(lv.keys)
        sel = "".join(f"{x}, " for x in ks)
        grp = f"GROUP BY {', '.join(ks)}" if ks else ""
        out.append(f"lk_{lv.name} AS (SELECT {sel}least(greatest(avg(Residual_MWH)*count(*)/(count(*)+{k})*{blend}, -{cap}), {cap}) AS c, avg(Residual_MWH) AS m, count(*) AS n, stddev_samp(Residual_MWH) AS sd FROM {src} WHERE {where} {grp})")
    return ",\n".join(out)


def apply_sql(levels, src, count_k):
    """(numerator, denominator, joins) of the weighted fallback."""
    num, den, joins, names = [], [], [], []
    for lv in levels:
        a = f"j_{lv.name}"
        on = " AND ".join(f"{a}.{x} IS NOT DISTINCT FROM x.{x}" for x in _sqlk(lv.keys)) or "TRUE"
        joins.append(f"LEFT JOIN lk_{lv.name} {a} ON {on}")
        w = f"{lv.weight}*sqrt({a}.n/({a}.n+{count_k}.0))"
        num.append(f"coalesce({a}.c*{w}, 0)")
        den.append(f"CASE WHEN {a}.c IS NULL THEN 0 ELSE {w} END")
        names.append(f"CASE WHEN {a}.c IS NOT NULL THEN '{lv.name}' END")
    return "+".join(num), "+".join(den), " ".join(joins), f"concat_ws('+', {', '.join(names)})"


LEARN_SQL = lookup_sql(LK.LEARNED, "v_cx", "TRUE", 0.7, 4, 24)
_N, _D, _J, _M = apply_sql(LK.LEARNED, "v_cx", 24)


def learned(spark, d):
    work = LK.add_context(replay(spark, d, *CTX))
    return work, LK.learn(work, LK.LEARNED, "Residual_MWH", blend=0.7, cap=4.0, shrink_k=24.0)


_LONG = " UNION ALL ".join("SELECT '%s' AS level, %s AS key, c, m, n, sd FROM lk_%s" % (
    lv.name, "concat_ws('|', %s)" % ", ".join(f"coalesce(CAST({x} AS VARCHAR), '<missing>')" for x in _sqlk(lv.keys)) if lv.keys else "'all'", lv.name) for lv in LK.LEARNED)


@query("cor01_learned_lookups", ctes("bt") + "," + CX_SQL + "," + LEARN_SQL + "\nSELECT level, key, c AS correction, m AS mean, CAST(n AS BIGINT) AS count, sd AS std FROM (" + _LONG + ")", r6=["correction", "mean", "std"])
def _(spark, d):
    return learned(spark, d)[1].select("level", "key", "correction", "mean", "count", "std")


@query("agg09_shrunk_group_lookup", ctes("bt") + """
SELECT series, Hour, avg(Residual_MWH) AS mean, CAST(count(*) AS BIGINT) AS n, stddev_samp(Residual_MWH) AS sd, least(greatest(avg(Residual_MWH)*count(*)/(count(*)+15.0)*0.8, -2), 2) AS corr FROM v_bt GROUP BY 1, 2""", r6=["mean", "sd", "corr"])
def _(spark, d):
    lv = (LK.Level("hour", ("Hour",)),)
    o = LK.learn(replay(spark, d, "series", "Hour", "Residual_MWH"), lv, "Residual_MWH", ["series"], 0.8, 2.0, 15.0)
    return o.select("series", F.col("key").cast("int").alias("Hour"), "mean", F.col("count").alias("n"), F.col("std").alias("sd"), F.col("correction").alias("corr"))


@query("cor02_weighted_fallback", ctes("bt") + "," + CX_SQL + "," + LEARN_SQL + f"""
SELECT row_id, ({_N})/nullif({_D},0) * CASE WHEN x.Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 AND x.Season = 'Summer' THEN 0.6 ELSE 1 END AS cal, {_M} AS levels,
 greatest(Raw_Forecast_MWH + ({_N})/nullif({_D},0) * CASE WHEN x.Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 AND x.Season = 'Summer' THEN 0.6 ELSE 1 END, 0) AS fc FROM v_cx x {_J}""", r6=["cal", "fc"])
def _(spark, d):
    work, lk = learned(spark, d)
    o = LK.apply_learned(work, lk, hot_peak={"season_scales": {"Summer": 0.6}})
    return o.select("row_id", F.col("Residual_Cal_MWH").alias("cal"), F.col("Calibration_Matched_Levels").alias("levels"), F.col("Residual_Calibrated_Forecast_MWH").alias("fc"))


@query("joi06_null_matching_lookup_join", ctes("bt") + "," + CX_SQL + """,
g AS (SELECT Season, tb, cb, HourGroup, avg(Residual_MWH) AS m FROM v_cx GROUP BY ALL)
SELECT x.series, CAST(count(*) AS BIGINT) AS n, sum(g.m) AS s, CAST(count(*) FILTER (x.tb IS NULL) AS BIGINT) AS null_temp FROM v_cx x LEFT JOIN g ON x.Season = g.Season AND x.HourGroup = g.HourGroup AND x.tb IS NOT DISTINCT FROM g.tb AND x.cb IS NOT DISTINCT FROM g.cb GROUP BY 1""", r4=["s"])
def _(spark, d):
    from ..core import null_safe_join
    w = LK.add_context(replay(spark, d, *CTX))
    k = ["Season", "DailyMaxTempBin", "CloudCoverBin", "HourGroup"]
    g = w.groupBy(*k).agg(F.avg("Residual_MWH").alias("m"))
    return null_safe_join(w, g, k).groupBy("series").agg(F.count("*").alias("n"), F.sum("m").alias("s"), F.count(F.when(F.col("DailyMaxTempBin").isNull(), 1)).alias("null_temp"))


@query("cor03_heat_peak_lookup", ctes("bt") + "," + CX_SQL + """,
g AS (SELECT Hour, tb, least(greatest(avg(Residual_MWH)*count(*)/(count(*)+10.0)*0.9, -3), 3) AS c FROM v_cx WHERE Temperature_DailyMax >= 95 AND Hour BETWEEN 15 AND 20 GROUP BY 1, 2)
SELECT row_id, CASE WHEN Temperature_DailyMax >= 95 AND x.Hour BETWEEN 15 AND 20 THEN coalesce(g.c, 0) ELSE 0 END AS cal FROM v_cx x LEFT JOIN g ON x.Hour = g.Hour AND x.tb IS NOT DISTINCT FROM g.tb""", r6=["cal"])
def _(spark, d):
    w = LK.add_context(replay(spark, d, *CTX))
    lv = (LK.Level("heat_peak", ("Hour", "DailyMaxTempBin")),)
    scope = LK.heat_peak_scope(95.0, range(15, 21))
    lk = LK.learn(w.where(scope), lv, "Residual_MWH", blend=0.9, cap=3.0, shrink_k=10.0)
    return LK.apply_scoped(w, lk, lv, scope, count_k=None, base=RAW, out_col="cal").select("row_id", "cal")


_WS = "Season IN ('Spring','Fall') AND Temperature_DailyMax >= 75 AND Temperature_DailyMax <= 93 AND Hour BETWEEN 12 AND 22"
_WN, _WD, _WJ, _WM = apply_sql(LK.WARM_RAMP, "v_cx", 10)


@query("cor04_warm_ramp", ctes("bt") + "," + CX_SQL + "," + lookup_sql(LK.WARM_RAMP, "v_cx", _WS, 0.7, 12, 15) + f"""
SELECT row_id, CASE WHEN {_WS.replace('Hour', 'x.Hour').replace('Season', 'x.Season')} AND ({_WD}) > 0 THEN least(greatest(({_WN})/nullif({_WD},0),-12),12) ELSE 0 END AS cal,
 CASE WHEN {_WS.replace('Hour', 'x.Hour').replace('Season', 'x.Season')} THEN {_WM} ELSE 'none' END AS src FROM v_cx x {_WJ}""", r6=["cal"])
def _(spark, d):
    w = LK.add_context(replay(spark, d, *CTX))
    lk = LK.learn(w.where(LK.warm_ramp_scope()), LK.WARM_RAMP, "Residual_MWH", blend=0.7, cap=12.0, shrink_k=15.0)
    return LK.apply_scoped(w, lk, LK.WARM_RAMP, LK.warm_ramp_scope(), cap=12.0, base=RAW, out_col="cal", source_col="src").select("row_id", "cal", "src")


@query("cor05_seasonal_lookup", ctes("bt") + """,
g AS (SELECT Season, Hour, least(greatest(avg(Residual_MWH)*count(*)/(count(*)+24.0)*0.7, -4), 4) AS c FROM v_bt GROUP BY 1, 2)
SELECT row_id, greatest(Raw_Forecast_MWH + coalesce(c, 0), 0) AS fc FROM v_bt LEFT JOIN g USING (Season, Hour)""", r6=["fc"])
def _(spark, d):
    w = replay(spark, d, "row_id", "Season", "Hour", RAW, "Residual_MWH")
    lv = (LK.Level("season_hour", ("Season", "Hour")),)
    lk = LK.learn(w, lv, "Residual_MWH", blend=0.7, cap=4.0, shrink_k=24.0)
    return LK.apply_scoped(w, lk, lv, F.lit(True), count_k=None, base=RAW, forecast_col="fc").select("row_id", "fc")


BASE_B = "CASE WHEN v <= 105 THEN 0 WHEN v <= 115 THEN 1 WHEN v <= 125 THEN 2 WHEN v <= 135 THEN 3 WHEN v <= 150 THEN 4 WHEN v <= 170 THEN 5 ELSE 6 END"
CLS_SQL = f"""v_c1 AS (SELECT *, Raw_Forecast_MWH + 40 AS v, coalesce(ck IN ('Mostly Cloudy','Overcast'), FALSE) AS cloudy, lk IN ('High','Extreme') AS big, {LOSS} AS ls, coalesce(Temperature_DailyMax, 999999) AS th, coalesce(Temperature_DailyMax, -999999) AS tl FROM v_cx),
v_c2 AS (SELECT *, {BASE_B} AS rk, ['<=105','105-115','115-125','125-135','135-150','150-170','170+'][{BASE_B}+1] AS bb, cloudy OR big OR ls >= 1.25 AS ev, IsWeekend = 1 AS we FROM v_c1),
v_c3 AS (SELECT *, we AND (rk <= 2 OR th < 68) AS low, we AND rk >= 3 AND tl >= 68 AS high, ev AND NOT we AND Hour BETWEEN 12 AND 13 AND (big OR ls >= 8) AS core FROM v_c2),
v_cl AS (SELECT *, CASE WHEN NOT ev THEN 'other' WHEN tl >= 75 AND Hour BETWEEN 16 AND 20 THEN 'warm_cloud_peak_transition' WHEN NOT we AND Hour BETWEEN 15 AND 16 THEN 'weekday_late_midday_solar_loss'
  WHEN NOT we AND Hour BETWEEN 10 AND 11 THEN 'weekday_morning_solar_loss' WHEN NOT we AND Hour = 14 AND (big OR ls >= 6) THEN 'weekday_core_hour14_solar_loss'
  WHEN core AND ls >= 10 AND coalesce(ck = 'Overcast', FALSE) AND rk BETWEEN 2 AND 3 THEN 'weekday_core_highimpact_solar_loss' WHEN core THEN 'weekday_core_solar_loss'
  WHEN Hour BETWEEN 12 AND 14 AND we AND NOT (low OR high) THEN 'weekend_core_solar_loss_dampen' WHEN Hour BETWEEN 12 AND 14 AND high THEN 'weekend_core_highload_solar_loss'
  WHEN Hour BETWEEN 12 AND 14 AND low THEN 'weekend_core_lowload_solar_loss_dampen' WHEN high THEN 'weekend_highload_solar_loss' WHEN low THEN 'weekend_lowload_solar_loss_dampen'
  WHEN we THEN 'weekend_solar_loss_dampen' ELSE 'solar_loss_general' END AS cls FROM v_c3),
v_cm AS (SELECT *, greatest(0.08, least(1.65, CASE cls """ + " ".join(f"WHEN '{k}' THEN {v}" for k, v in E.MULTIPLIERS.items()) + """ ELSE 1 END * CASE WHEN cls LIKE '%weekend_core_lowload%' AND th < 65 AND rk <= 2 THEN 0.75 ELSE 1 END)) AS mult FROM v_cl)"""


def classed(spark, d):
    b = bucketed(replay(spark, d, *CTX)).withColumn("cal0", F.col(RAW) + 40)
    return E.add_event_columns(LK.add_context(b), "cal0")


@query("prj20_event_class_multiplier", ctes("bt") + "," + CX_SQL + "," + CLS_SQL + """
SELECT cls, CAST(round(mult, 6) AS DOUBLE) AS mult, CAST(count(*) AS BIGINT) AS n, sum(ls) AS loss FROM v_cm GROUP BY 1, 2""", r4=["loss"])
def _(spark, d):
    return classed(spark, d).groupBy(F.col("CloudSolarEventClass").alias("cls"), F.round("CloudSolarEventMultiplier", 6).alias("mult")).agg(F.count("*").alias("n"), F.sum(LOSS).alias("loss"))


_CS = f"Hour BETWEEN 10 AND 16 AND (cloudy OR big OR ls >= 1.25)"
_CN, _CD, _CJ, _CMx = apply_sql(LK.CLOUD_SOLAR, "v_cm", 14)


@query("cor06_cloud_solar_shape", ctes("bt") + "," + CX_SQL + "," + CLS_SQL + "," + lookup_sql(LK.CLOUD_SOLAR, "v_cm", _CS, 0.8, 16, 10) + f""",
a AS (SELECT row_id, mult, CASE WHEN {_CS.replace('Hour', 'x.Hour')} THEN least(greatest(({_CN})/nullif({_CD},0),-16),16) ELSE NULL END AS r, x.cls, x.Hour AS hh, ls FROM v_cm x {_CJ}),
b AS (SELECT *, CASE WHEN r IS NULL THEN 0 WHEN cls = 'weekday_core_highimpact_solar_loss' AND hh BETWEEN 12 AND 13 AND ls >= 10 THEN greatest(r, least(greatest(1.35+0.2*ls, 3), 4.75)) ELSE r END AS raw FROM a)
SELECT row_id, raw, least(greatest(CASE WHEN raw > 0 THEN raw*mult ELSE raw END,-16),16) AS cal FROM b""", r6=["raw", "cal"])
def _(spark, d):
    w = classed(spark, d)
    lk = LK.learn(w.where(E.cloud_solar_scope()), LK.CLOUD_SOLAR, "Residual_MWH", blend=0.8, cap=16.0, shrink_k=10.0)
    o = E.apply_cloud_solar(w, lk, base="cal0")
    return o.select("row_id", F.col("Cloud_Solar_Shape_Raw_Cal_MWH").alias("raw"), F.col("Cloud_Solar_Shape_Cal_MWH").alias("cal"))


@query("unc09_lookup_debug_table", ctes("bt") + """
SELECT 'season_hour' AS level, Season, CAST(Hour AS VARCHAR) AS Hour, avg(Residual_MWH) AS mean, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 2, 3""", r6=["mean"])
def _(spark, d):
    lv = (LK.Level("season_hour", ("Season", "Hour")),)
    t = LK.lookup_table(LK.learn(replay(spark, d, "Season", "Hour", "Residual_MWH"), lv, "Residual_MWH"), lv)
    return t.select("level", F.col("keys")["Season"].alias("Season"), F.col("keys")["Hour"].alias("Hour"), "mean", F.col("count").alias("n"))


# ---- rules --------------------------------------------------------------------------------------

RULES = [
    {"name": "hot_afternoon", "hours": [15, 16, 17, 18], "min_maxtemp_f": 95.0, "max_maxtemp_f": 105.0, "adjustment_mwh": 1.5},
    {"name": "summer_far", "seasons": ["Summer"], "min_forecast_day": 5, "max_forecast_day": 12, "adjustment_mwh": -0.75},
    {"name": "high_level", "min_forecast_mwh": 60.0, "max_forecast_mwh": 90.0, "min_raw_minus_samehour_7day_mean_mwh": 0.5, "adjustment_mwh": 1.0, "max_total_cap_mwh": 3.0},
    {"name": "stacked", "min_prior_total_adjustment_mwh": 1.0, "max_cloud_cover_norm": 0.4, "adjustment_mwh": 2.0},
    {"name": "weekend_loss", "weekend": True, "min_solar_loss_mw": 5.0, "max_raw_minus_lag24_mwh": -1.0, "adjustment_mwh": -2.5},
    {"name": "off", "enabled": False, "adjustment_mwh": 9.0},
]
RULE_WHERE = {
    "hot_afternoon": "Hour IN (15,16,17,18) AND Temperature_DailyMax >= 95 AND Temperature_DailyMax < 105", "summer_far": "Season='Summer' AND Forecast_Day BETWEEN 5 AND 12",
    "high_level": "Final_Forecast_MWH >= 60 AND Final_Forecast_MWH < 90 AND Raw_Forecast_MWH-MWH_SameHour7DayMean >= 0.5", "stacked": "CloudCover_Norm <= 0.4",
    "weekend_loss": "IsWeekend=1 AND BTM_Solar_Loss_From_ClearSky_MW >= 5 AND Raw_Forecast_MWH-MWH_Lag24 <= -1",
}
RULE_SQL = """v_r1 AS (SELECT *, """ + ", ".join(f"coalesce({w}, FALSE) AS m_{n}" for n, w in RULE_WHERE.items()) + """ FROM v_bt),
v_r2 AS (SELECT *, CASE WHEN m_hot_afternoon THEN 1.5 ELSE 0 END + CASE WHEN m_summer_far THEN -0.75 ELSE 0 END + CASE WHEN m_high_level THEN 1.0 ELSE 0 END AS t3 FROM v_r1),
v_r3 AS (SELECT *, m_stacked AND t3 >= 1 AS f_stacked, t3 + CASE WHEN m_stacked AND t3 >= 1 THEN 2 ELSE 0 END + CASE WHEN m_weekend_loss THEN -2.5 ELSE 0 END AS tot, CASE WHEN m_high_level THEN 3.0 ELSE 2.0 END AS cap FROM v_r2),
v_rg AS (SELECT *, least(greatest(tot, -cap), cap) AS g, CASE WHEN concat_ws('+', CASE WHEN m_hot_afternoon THEN 'hot_afternoon' END, CASE WHEN m_summer_far THEN 'summer_far' END, CASE WHEN m_high_level THEN 'high_level' END, CASE WHEN f_stacked THEN 'stacked' END,
  CASE WHEN m_weekend_loss THEN 'weekend_loss' END) = '' THEN 'none' ELSE concat_ws('+', CASE WHEN m_hot_afternoon THEN 'hot_afternoon' END, CASE WHEN m_summer_far THEN 'summer_far' END, CASE WHEN m_high_level THEN 'high_level' END, CASE WHEN f_stacked THEN 'stacked' END,
  CASE WHEN m_weekend_loss THEN 'weekend_loss' END) END AS src FROM v_r3)"""
RULE_COLS = ("row_id", "Hour", "Month", "Season", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", LOSS, "IsWeekend", RAW, FIN, ACT, "MWH_SameHour7DayMean", "MWH_Lag24")


def ruled(spark, d):
    return replay(spark, d, *RULE_COLS).withColumn("IsHoliday", F.lit(0))


@query("prj09_rule_table_predicate", ctes("bt") + "," + RULE_SQL + "\n" + " UNION ALL ".join(f"SELECT '{n}' AS rule, CAST(count(*) AS BIGINT) AS n, sum(row_id) AS s FROM v_r1 WHERE m_{n}" for n in RULE_WHERE), r4=["s"])
def _(spark, d):
    b = RU.add_rule_context(ruled(spark, d), FIN)
    names = RU.matched_names([r for r in RULES if r["name"] != "off"])
    return b.select("row_id", F.explode(names).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"), F.sum("row_id").alias("s"))


@query("udf01_rules_as_input_data", ctes("bt") + "," + RULE_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n FROM v_r1 WHERE m_hot_afternoon OR m_summer_far OR m_high_level OR m_stacked OR m_weekend_loss""")
def _(spark, d):
    b = RU.add_rule_context(ruled(spark, d), FIN)
    return b.where(RU.union_mask(RULES)).agg(F.count("*").alias("n"))


@query("prj34_rule_context", ctes("bt") + """
SELECT Month, avg(Raw_Forecast_MWH-MWH_SameHour7DayMean) AS d7, avg(Raw_Forecast_MWH-MWH_Lag24) AS d24, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1""", r6=["d7", "d24"])
def _(spark, d):
    b = RU.add_rule_context(ruled(spark, d), FIN)
    return b.groupBy("Month").agg(F.avg("Raw_Minus_SameHour7DayMean_MWH").alias("d7"), F.avg("Raw_Minus_SameHourYesterday_MWH").alias("d24"), F.count("*").alias("n"))


@query("cor21_stacked_rule_guard", ctes("bt") + "," + RULE_SQL + """
SELECT row_id, g, src, greatest(Final_Forecast_MWH + g, 0) AS fc FROM v_rg""", r6=["g", "fc"])
def _(spark, d):
    o = RU.apply_guard(ruled(spark, d), RULES, FIN, total_cap=2.0)
    return o.select("row_id", F.col("Focused_Scorecard_Guard_MWH").alias("g"), F.col("Focused_Scorecard_Guard_Source").alias("src"), F.col(FIN).alias("fc"))


@query("cor22_rule_audit", ctes("bt") + "," + RULE_SQL + "\nSELECT *, CASE WHEN after - before > 0 THEN 'fail' ELSE 'pass' END AS status FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS before, avg(abs(Actual_MWH-greatest(Final_Forecast_MWH+({a}),0))) AS after FROM v_r1 WHERE m_{n}"
    for n, a in (("hot_afternoon", 1.5), ("summer_far", -0.75), ("high_level", 1.0), ("stacked", 2.0), ("weekend_loss", -2.5))) + ")", r6=["before", "after"])
def _(spark, d):
    o = RU.rule_audit(ruled(spark, d), RU.active(RULES), FIN)
    return o.select(F.col("RuleName").alias("rule"), F.col("ScoredRows").alias("n"), F.col("Baseline_MAE_MWH").alias("before"), F.col("RuleOnly_MAE_MWH").alias("after"), F.col("RuleHealth_Status").alias("status"))


@query("rep15_correction_audit_by_source", ctes("bt") + "," + RULE_SQL + """
SELECT src, CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae0, avg(abs(Actual_MWH-greatest(Final_Forecast_MWH+g,0))) AS mae1, avg(Actual_MWH-greatest(Final_Forecast_MWH+g,0)) AS bias1,
 quantile_cont(abs(Actual_MWH-greatest(Final_Forecast_MWH+g,0)), 0.9) AS p90, quantile_cont(abs(Actual_MWH-greatest(Final_Forecast_MWH+g,0)), 0.99) AS p99 FROM v_rg GROUP BY 1""", r6=["mae0", "mae1", "bias1", "p90", "p99"])
def _(spark, d):
    from ..core import group_quantiles
    o = RU.apply_guard(ruled(spark, d), RULES, FIN, total_cap=2.0).withColumnRenamed("Focused_Scorecard_Guard_Source", "src")
    a, b = F.abs(F.col(ACT) - F.col("Pre_Focused_Guard_Forecast_MWH")), F.abs(F.col(ACT) - F.col(FIN))
    o = o.withColumn("ae", b)
    g = o.groupBy("src").agg(F.count("*").alias("n"), F.avg(a).alias("mae0"), F.avg(b).alias("mae1"), F.avg(F.col(ACT) - F.col(FIN)).alias("bias1"))
    return g.join(group_quantiles(o, ["src"], "ae", {"p90": 0.9, "p99": 0.99}), "src")


@query("rep15_rule_tokens_audit", ctes("bt") + "," + RULE_SQL + """
SELECT rule, Season, CAST(count(*) AS BIGINT) AS n, avg(g) AS g FROM (SELECT unnest(string_split(src, '+')) AS rule, Season, g FROM v_rg WHERE src <> 'none') GROUP BY 1, 2""", r6=["g"])
def _(spark, d):
    from ..functions.clock import tokens
    o = RU.apply_guard(ruled(spark, d), RULES, FIN, total_cap=2.0)
    return o.select(F.explode(tokens("Focused_Scorecard_Guard_Source")).alias("rule"), "Season", F.col("Focused_Scorecard_Guard_MWH").alias("g")).groupBy("rule", "Season").agg(F.count("*").alias("n"), F.avg("g").alias("g"))


# ---- recent residuals ---------------------------------------------------------------------------
# residuals of an hourly series: reading mean against a fixed daily shape

RES_SQL = """v_rs AS (SELECT series, DT, eh, hour(DT) AS "Hour", MWH - (50 + hour(DT)) AS r, """ + HOUR_GROUP.format(h="hour(DT)") + """ AS hg, CAST(CAST(floor(eh/24) AS BIGINT) % 4 AS VARCHAR) AS tk, CAST(eh % 3 AS VARCHAR) AS ck,
  CASE WHEN eh % 17 = 0 THEN NULL ELSE CAST(eh % 5 AS VARCHAR) END AS sk, CAST(eh % 2 AS VARCHAR) AS lk FROM v_load)"""


def residuals(spark, d):
    e, h = F.col("eh"), F.hour("DT")
    from ..functions.calendar import hour_group
    return load(spark, d).select("series", "DT", "eh", h.alias("Hour"), (F.col("MWH") - (50 + h)).alias("Residual_MWH"), hour_group(h).alias("HourGroup"),
                                 (F.floor(e / 24) % 4).cast("string").alias("DailyMaxTempBucket"), (e % 3).cast("string").alias("CloudCoverBucket"),
                                 F.when(e % 17 != 0, (e % 5).cast("string")).alias("BTMSolarBucket"), (e % 2).cast("string").alias("SolarLossBucket"))


_CATS = {"same_hour": '"Hour"', "hourgroup": "hg", "temp_hourgroup": "tk, hg", "cloud_hourgroup": "ck, hg", "solar_hourgroup": "sk, hg", "solar_loss_hourgroup": "lk, hg", "temp_cloud_hourgroup": "tk, ck, hg"}


def _clip10(x):
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE least(greatest({x}, -10), 10) END"


CAUSAL_SQL = "v_cz AS (SELECT *, " + ", ".join([
    _clip10("avg(r) OVER (PARTITION BY series ORDER BY eh ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING)") + " AS recent_mean",
    _clip10("avg(r) OVER (PARTITION BY series ORDER BY eh ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)") + " AS last24_mean",
    _clip10("avg(r) OVER (PARTITION BY series ORDER BY eh ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)") + " AS global",
    *[f"CASE WHEN {'sk IS NULL' if 'sk' in k else 'FALSE'} THEN NULL ELSE " + _clip10(f"avg(r) OVER (PARTITION BY series, {k} ORDER BY eh RANGE BETWEEN 168 PRECEDING AND 1 PRECEDING)") + f" END AS {n}" for n, k in _CATS.items()]]) + " FROM v_rs)"


@query("win18_causal_category_means", ctes("load") + "," + RES_SQL + "," + CAUSAL_SQL + f"""
SELECT series, CAST(DT AS VARCHAR) AS DT, {', '.join(f"{n} AS src_{n}" for n in R.WEIGHTS)} FROM v_cz""", r6=[f"src_{n}" for n in R.WEIGHTS])
def _(spark, d):
    return R.causal_means(residuals(spark, d)).select("series", F.col("DT").cast("string").alias("DT"), *[f"src_{n}" for n in R.WEIGHTS])


_num = " + ".join(f"coalesce({n}*{w},0)" for n, w in R.WEIGHTS.items())
_den = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE {w} END" for n, w in R.WEIGHTS.items())


@query("cor07_causal_correction", ctes("load") + "," + RES_SQL + "," + CAUSAL_SQL + f"""
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE WHEN ({_den}) > 0 THEN least(greatest(({_num})/nullif({_den},0)*0.85, -10), 10) ELSE 0 END AS corr FROM v_cz""", r6=["corr"])
def _(spark, d):
    o = R.causal_correction(R.causal_means(residuals(spark, d)))
    return o.select("series", F.col("DT").cast("string").alias("DT"), F.col("Recent_Level_Correction_MWH").alias("corr"))


PROF_SQL = """e0 AS (SELECT series, max(eh) AS m FROM v_rs GROUP BY 1), rr AS (SELECT v_rs.*, m - eh AS age, row_number() OVER (PARTITION BY series ORDER BY eh DESC) AS rn FROM v_rs JOIN e0 USING (series)),
pl AS (SELECT series, 'global' AS source, 'all' AS category, avg(r) AS v, count(*) AS n FROM rr GROUP BY 1 UNION ALL SELECT series, 'recent_mean', 'all', avg(r), count(*) FROM rr WHERE age <= 48 GROUP BY 1
 UNION ALL SELECT series, 'last24_mean', 'all', avg(r), count(*) FROM rr WHERE rn <= 24 GROUP BY 1 """ + " ".join(
    f"UNION ALL SELECT series, '{n}', {k.replace(', ', ' || chr(124) || ') if ',' in k else f'CAST({k} AS VARCHAR)'}, avg(r), count(*) FROM rr WHERE age <= 168 {'AND sk IS NOT NULL' if 'sk' in k else ''} GROUP BY 1, 3 {'HAVING count(*) >= 6' if ',' in k else ''}" for n, k in _CATS.items()) + ")"


@query("cor07_recent_profile", ctes("load") + "," + RES_SQL + "," + PROF_SQL + """
SELECT series, source, category, least(greatest(v,-10),10) AS value, CAST(n AS BIGINT) AS n FROM pl""", r6=["value"])
def _(spark, d):
    return R.recent_profile(residuals(spark, d))


_PJ = " ".join(f"LEFT JOIN pl p{i} ON p{i}.series = x.series AND p{i}.source = '{n}' AND p{i}.category = " + (
    "'all'" if n not in _CATS else (_CATS[n].replace(", ", " || chr(124) || ") if "," in _CATS[n] else f"CAST({_CATS[n]} AS VARCHAR)")) for i, n in enumerate(R.WEIGHTS))
_PN = " + ".join(f"CASE WHEN p{i}.v IS NULL THEN 0 ELSE least(greatest(p{i}.v,-10),10)*{w} END" for i, w in enumerate(R.WEIGHTS.values()))
_PD = " + ".join(f"CASE WHEN p{i}.v IS NULL THEN 0 ELSE {w} END" for i, w in enumerate(R.WEIGHTS.values()))


@query("cor07_recent_correction", ctes("load") + "," + RES_SQL + "," + PROF_SQL + f"""
SELECT x.series, CAST(x.DT AS VARCHAR) AS DT, coalesce(least(greatest(({_PN})/nullif({_PD},0)*0.85*greatest(0.25, exp(-(eh%300)/96.0)), -10), 10), 0) AS corr FROM v_rs x {_PJ}""", r6=["corr"])
def _(spark, d):
    r = residuals(spark, d)
    f = r.withColumns({"Forecast_Lead_Hour": (F.col("eh") % 300 + 1).cast("int"), RAW: 50 + F.col("Hour")})
    o = R.apply_profile(f, R.recent_profile(r))
    return o.select("series", F.col("DT").cast("string").alias("DT"), F.col("Recent_Level_Correction_MWH").alias("corr"))


@query("cor08_regime_scale", ctes("bt") + """
SELECT Season, Forecast_Day, CAST(count(*) AS BIGINT) AS n, sum(CASE WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 THEN CASE Season WHEN 'Summer' THEN 1.2 WHEN 'Fall' THEN 0.8 ELSE 1 END ELSE 1 END
 * CASE WHEN Forecast_Day >= 8 THEN 0.4 WHEN Forecast_Day >= 4 THEN 0.6 WHEN Forecast_Day >= 2 THEN 0.8 ELSE 1 END * CASE WHEN Forecast_Day BETWEEN 2 AND 7 AND Season='Summer' AND Temperature_DailyMax >= 90 AND CloudCover_Norm <= 0.2 THEN 0.5 ELSE 1 END) AS s FROM v_bt GROUP BY 1, 2""", r4=["s"])
def _(spark, d):
    s = R.regime_scale({"Summer": 1.2, "Fall": 0.8}, {"days2to3": 0.8, "days4to7": 0.6, "days8plus": 0.4}, {"scale": 0.5})
    return replay(spark, d, "Season", "Forecast_Day", "Hour", "Temperature_DailyMax", "CloudCover_Norm").groupBy("Season", "Forecast_Day").agg(F.count("*").alias("n"), F.sum(s).alias("s"))


AR_SQL = """ar0 AS (SELECT series, max(eh) AS m, arg_max(r, eh) AS latest FROM v_rs GROUP BY 1), ar1 AS (SELECT v_rs.series, latest, r, lag(r) OVER w AS p, eh - lag(eh) OVER w AS gap FROM v_rs JOIN ar0 USING (series) WHERE eh >= m - 168 WINDOW w AS (PARTITION BY v_rs.series ORDER BY eh)),
ar2 AS (SELECT series, latest, count(*) FILTER (gap <= 1) AS np, coalesce(sum(p*r) FILTER (gap <= 1) / nullif(sum(p*p) FILTER (gap <= 1), 0), 0) AS raw FROM ar1 GROUP BY 1, 2),
ars AS (SELECT series, np, latest, least(greatest(greatest(CASE WHEN np >= 24 THEN raw ELSE 0 END, 0) * np/(np+72.0), -0.4), 0.4) AS phi, greatest(CASE WHEN np >= 24 THEN raw ELSE 0 END, 0) AS phi_raw FROM ar2)"""
DAY_SQL = """d0 AS (SELECT series, max(eh) AS m FROM v_rs GROUP BY 1), d1 AS (SELECT series, CAST(DT AS DATE) AS d, avg(r) AS mean, count(*) AS n FROM v_rs JOIN d0 USING (series) WHERE eh >= m - 168 GROUP BY 1, 2),
d1b AS (SELECT *, bool_or(n >= 12) OVER (PARTITION BY series) AS any_ok FROM d1), d2 AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY d DESC) AS rk FROM d1b WHERE n >= 12 OR NOT any_ok), d3 AS (SELECT series, count(*) AS nd, sum(n) AS nh, arg_max(mean, d) AS lm, sum(mean*sqrt(n))/sum(sqrt(n)) AS rm FROM d2 WHERE rk <= 7 GROUP BY 1),
ds AS (SELECT series, nd, nh, lm, rm, CASE WHEN lm*rm < 0 THEN 0 ELSE 0.65*lm+0.35*rm END AS sr, least(greatest(CASE WHEN lm*rm < 0 THEN 0 ELSE 0.65*lm+0.35*rm END * nd/(nd+6.0) * nh/(nh+96.0), -4), 4) AS st FROM d3 WHERE nd >= 2 AND nh >= 36)"""


@query("win16_ar1_coefficient", ctes("load") + "," + RES_SQL + "," + AR_SQL + """
SELECT series, CAST(np AS BIGINT) AS n_pairs, phi_raw, phi, latest FROM ars""", r6=["phi_raw", "phi", "latest"])
def _(spark, d):
    return R.ar_state(residuals(spark, d)).select("series", "n_pairs", "phi_raw", "phi", F.col("latest_residual").alias("latest"))


@query("win17_day_state", ctes("load") + "," + RES_SQL + "," + DAY_SQL + """
SELECT series, CAST(nd AS BIGINT) AS n_days, CAST(nh AS BIGINT) AS n_hours, lm AS latest, rm AS recent, st AS state FROM ds""", r6=["latest", "recent", "state"])
def _(spark, d):
    o = R.day_state(residuals(spark, d))
    return o.select("series", "n_days", "n_hours", F.col("latest_day_mean").alias("latest"), F.col("recent_day_mean").alias("recent"), F.col("state_mwh").alias("state"))


@query("win15_same_sign_run", ctes("load") + "," + RES_SQL + """,
tg AS (SELECT series, arg_max(r, eh) AS t FROM v_rs GROUP BY 1), st AS (SELECT v_rs.series, eh, abs(r) < 0.25 OR sign(r) <> sign(t) AS brk FROM v_rs JOIN tg USING (series)), lb AS (SELECT series, max(eh) FILTER (brk) AS b FROM st GROUP BY 1)
SELECT st.series, CAST(count(*) FILTER (b IS NULL OR eh > b) AS BIGINT) AS run FROM st JOIN lb USING (series) GROUP BY 1""")
def _(spark, d):
    r = residuals(spark, d)
    t = r.groupBy("series").agg(F.max_by("Residual_MWH", "DT").alias("state_raw"))
    return R.same_sign_run(r, t).select("series", F.col("same_sign_run_hours").cast("long").alias("run"))


@query("cor09_ar_and_day_state_carryover", ctes("load") + "," + RES_SQL + "," + AR_SQL + "," + DAY_SQL + """,
x AS (SELECT v_rs.series, DT, eh % 300 + 1 AS ld, CAST(floor((eh % 300)/24) + 1 AS INT) AS fd, phi, latest, st, sr FROM v_rs JOIN ars USING (series) LEFT JOIN ds USING (series)),
y AS (SELECT *, CASE WHEN abs(phi) > 1e-12 AND abs(latest) > 1e-12 THEN least(greatest(phi*latest*0.35*exp(-(ld-1)/36.0)*CASE WHEN fd<=1 THEN 1 WHEN fd<=3 THEN 0.45 WHEN fd<=7 THEN 0.15 ELSE 0 END,-2),2) ELSE 0 END AS ar,
 CASE WHEN abs(st) >= 0.5 THEN least(greatest(st*0.45*exp(-(fd-1)/5.0)*CASE WHEN fd<=1 THEN 0.35 WHEN fd<=3 THEN 0.45 WHEN fd<=7 THEN 0.25 ELSE 0.08 END,-2),2) ELSE 0 END AS ds FROM x)
SELECT series, CAST(DT AS VARCHAR) AS DT, ar, coalesce(ds,0) AS ds, least(greatest(least(greatest(1+ar,-10),10)+coalesce(ds,0),-10),10) AS total FROM y""", r6=["ar", "ds", "total"])
def _(spark, d):
    r = residuals(spark, d)
    f = r.select("series", "DT", (F.col("eh") % 300 + 1).cast("int").alias("Forecast_Lead_Hour"), (F.floor((F.col("eh") % 300) / 24) + 1).cast("int").alias("Forecast_Day"))
    f = f.join(R.ar_state(r), "series").join(R.day_state(r), "series", "left").withColumns({"hourgroup_mean": F.lit(None).cast("double"), "same_hour_mean": F.lit(None).cast("double"), "same_sign_run_hours": F.lit(10)})
    o = f.withColumns({"ar": R.ar_correction(), "ds": R.day_state_correction()})
    return o.select("series", F.col("DT").cast("string").alias("DT"), "ar", "ds", R.add_in_order(F.lit(1.0), F.col("ar"), F.col("ds")).alias("total"))


@query("top02_tail_rows_mean", ctes("load") + """
SELECT series, avg(MWH) AS m, CAST(count(*) AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY eh DESC) AS rn FROM v_load) WHERE rn <= 24 GROUP BY 1""", r6=["m"])
def _(spark, d):
    return R.last_rows(load(spark, d), ["series"], "DT", 24).groupBy("series").agg(F.avg("MWH").alias("m"), F.count("*").alias("n"))


# ---- bands --------------------------------------------------------------------------------------

BAND_TB = "CASE WHEN Temperature_DailyMax <= 70 THEN 0e0 WHEN Temperature_DailyMax <= 80 THEN 1e0 WHEN Temperature_DailyMax <= 88 THEN 2e0 WHEN Temperature_DailyMax <= 94 THEN 3e0 WHEN Temperature_DailyMax <= 98 THEN 4e0 WHEN Temperature_DailyMax IS NOT NULL THEN 5e0 END"
BX_SQL = f"{QUART_SQL.format(c=LOSS)}, v_bx AS (SELECT v_bt.*, {BAND_TB} AS tb, {CLOUD_BUCKET_SQL} AS ck, {QUART_CASE.format(c=LOSS)} AS lk FROM v_bt, quart)"
_BL = [("Hour+CloudCoverBucket+SolarLossBucket", ["Hour", "ck", "lk"]), ("Hour+SolarLossBucket", ["Hour", "lk"]), ("HourGroup+SolarLossBucket", ["HourGroup", "lk"]), ("HourGroup+DailyMaxTempBin", ["HourGroup", "tb"]), ("HourGroup", ["HourGroup"]), ("Hour", ["Hour"])]


def banded(spark, d):
    b = B.with_quartile_bucket(replay(spark, d, *CTX), LOSS, "SolarLossBucket")
    return b.withColumns({"CloudCoverBucket": B.cloud_bucket("CloudCover_Norm"), "DailyMaxTempBin": B.daily_max_bin("Temperature_DailyMax", "band")})


@query("agg10_residual_band_quantiles", ctes("bt") + "," + BX_SQL + "\n" + " UNION ALL ".join(
    "SELECT '%s' AS level, concat_ws('|', %s) AS key, quantile_cont(abs(Residual_MWH),0.5) AS p50, quantile_cont(abs(Residual_MWH),0.8) AS p80, quantile_cont(abs(Residual_MWH),0.9) AS p90, avg(abs(Residual_MWH)) AS mean, CAST(count(*) AS BIGINT) AS count FROM v_bx GROUP BY 1, 2" % (
        n, ", ".join(f"coalesce(CAST({x} AS VARCHAR),'<missing>')" for x in k)) for n, k in _BL), r6=["p50", "p80", "p90", "mean"])
def _(spark, d):
    o = BD.band_lookup(banded(spark, d), "Residual_MWH", 1.0, levels=BD.BAND_LEVELS)
    return o.select("level", "key", "p50", "p80", "p90", "mean", "count")


RISK_SQL = """v_rk AS (SELECT *, Forecast_Day <= 7 AS sc, coalesce(ck IN ('Mostly Cloudy','Overcast'),FALSE) OR lk IN ('High','Extreme') AS cz FROM v_bx),
v_rk2 AS (SELECT *, sc AND cz AND Hour BETWEEN 10 AND 16 AS cloudy, sc AND Hour BETWEEN 16 AND 20 AND coalesce(Temperature_DailyMax,0) >= 90 AS hot, sc AND Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND coalesce(Temperature_DailyMax BETWEEN 75 AND 93, FALSE) AS sho, sc AND coalesce(Temperature_DailyMax,0) >= 95 AS hi FROM v_rk),
v_rm AS (SELECT *, least(2.25, CASE WHEN Forecast_Day = 1 THEN 1.2 WHEN Forecast_Day <= 3 THEN 1.4 WHEN Forecast_Day <= 7 THEN 1.6 ELSE 1 END * CASE WHEN cloudy THEN 1.15 ELSE 1 END * CASE WHEN hot THEN 1.1 ELSE 1 END) AS wm,
 CASE WHEN NOT sc THEN 'none' ELSE concat_ws('+', CASE WHEN Forecast_Day = 1 THEN 'weather_day1' WHEN Forecast_Day <= 3 THEN 'weather_days2to3' ELSE 'weather_days4to7' END, CASE WHEN cloudy THEN 'cloud_solar' END, CASE WHEN hot THEN 'hot_peak' END, CASE WHEN sho THEN 'shoulder_heat' END, CASE WHEN hi THEN 'high_temp' END) END AS reason,
 CASE WHEN sc AND Forecast_Day BETWEEN 4 AND 7 AND (cloudy OR hot OR sho OR hi) THEN 'days4to7_' ELSE '' END || CASE WHEN hi AND NOT hot THEN 'high_temp_weather_error' WHEN hot THEN 'hot_peak_weather_error' WHEN sho THEN 'shoulder_heat_weather_error' WHEN cloudy THEN 'cloudy_solar_loss_weather_error'
   WHEN Forecast_Day = 1 THEN 'day1_weather_error' WHEN Forecast_Day <= 3 THEN 'days2to3_weather_error' WHEN Forecast_Day <= 7 THEN 'days4to7_weather_error' ELSE 'none' END AS cls FROM v_rk2)"""


@query("unc03_weather_input_risk", ctes("bt") + "," + BX_SQL + "," + RISK_SQL + """
SELECT cls, reason, CAST(round(wm, 6) AS DOUBLE) AS mult, CAST(count(*) AS BIGINT) AS n FROM v_rm GROUP BY 1, 2, 3""")
def _(spark, d):
    o = BD.add_weather_risk(banded(spark, d))
    return o.groupBy(F.col("Weather_Input_Risk_Class").alias("cls"), F.col("Weather_Input_Risk_Reason").alias("reason"), F.round("Weather_Input_Risk_Multiplier", 6).alias("mult")).agg(F.count("*").alias("n"))


@query("prj22_caution_labels", ctes("bt") + "," + BX_SQL + "," + RISK_SQL + """,
q AS (SELECT *, wm > 1 OR cls <> 'none' AS risky, Hour BETWEEN 16 AND 20 AND coalesce(Temperature_DailyMax,0) >= 90 AS h2, Hour BETWEEN 14 AND 18 AS pw, Hour BETWEEN 10 AND 16 AND cz AS c2, Forecast_Day BETWEEN 8 AND 16 AS far FROM v_rm)
SELECT CASE WHEN far AND (pw OR h2 OR c2 OR risky) THEN 'Low confidence caution' WHEN far THEN 'Low confidence' WHEN h2 THEN 'Caution: hot peak' WHEN pw THEN 'Caution: peak window' WHEN c2 THEN 'Caution: solar/cloud' WHEN risky THEN 'Weather risk' ELSE 'Normal' END AS label,
 CASE WHEN h2 THEN 'HOT_PEAK_RISK' WHEN c2 THEN 'SOLAR_CLOUD_RISK' WHEN pw THEN 'PEAK_WINDOW_RISK' WHEN risky THEN 'WEATHER_INPUT_RISK' WHEN far THEN 'LONG_HORIZON_RISK' ELSE 'NORMAL' END || CASE WHEN far AND (pw OR h2 OR c2 OR risky) THEN '+LONG_HORIZON_RISK' ELSE '' END AS code,
 CASE WHEN concat_ws('+', CASE WHEN pw THEN 'peak_window_data_limited' END, CASE WHEN h2 THEN 'hot_peak_data_limited' END, CASE WHEN c2 THEN 'cloudy_solar_midday_risk' END, CASE WHEN risky THEN 'weather_input_risk' END, CASE WHEN far THEN 'days8to16_low_confidence' END) = '' THEN 'none'
  ELSE concat_ws('+', CASE WHEN pw THEN 'peak_window_data_limited' END, CASE WHEN h2 THEN 'hot_peak_data_limited' END, CASE WHEN c2 THEN 'cloudy_solar_midday_risk' END, CASE WHEN risky THEN 'weather_input_risk' END, CASE WHEN far THEN 'days8to16_low_confidence' END) END AS reason, CAST(count(*) AS BIGINT) AS n FROM q GROUP BY 1, 2, 3""")
def _(spark, d):
    o = BD.add_caution_labels(BD.add_weather_risk(banded(spark, d)))
    return o.groupBy(F.col("Production_Confidence_Label").alias("label"), F.col("Production_Risk_Code").alias("code"), F.col("Production_Caution_Reason").alias("reason")).agg(F.count("*").alias("n"))


_BLK = ",".join(f"b{i} AS (SELECT {', '.join(k)}, greatest(1.0, quantile_cont(abs(Residual_MWH),0.8)) AS w FROM v_bx GROUP BY ALL)" for i, (n, k) in enumerate(_BL))
_BJ = " ".join(f"LEFT JOIN b{i} ON " + " AND ".join(f"b{i}.{x} IS NOT DISTINCT FROM x.{x}" for x in k) for i, (n, k) in enumerate(_BL))
_RM = """greatest(0.65, least(5, CASE WHEN x.HourGroup IN ('Overnight','Morning') THEN 0.78 ELSE 1 END * CASE x.Hour WHEN 14 THEN 1.35 WHEN 15 THEN 1.45 WHEN 16 THEN 1.55 WHEN 17 THEN 1.45 WHEN 18 THEN 1.25 ELSE 1 END * CASE WHEN x.HourGroup='Peak' THEN 1.12 ELSE 1 END
 * CASE WHEN coalesce(x.ck IN ('Mostly Cloudy','Overcast'),FALSE) AND x.lk IN ('High','Extreme') THEN 1.35 ELSE 1 END * CASE WHEN x.Hour BETWEEN 16 AND 18 AND coalesce(x.ck IN ('Mostly Cloudy','Overcast'),FALSE) THEN 1.15 ELSE 1 END
 * CASE WHEN Temperature_DailyMax >= 95 THEN CASE x.HourGroup WHEN 'Overnight' THEN 1.55 WHEN 'Morning' THEN 3.25 WHEN 'Midday' THEN 2.05 WHEN 'Peak' THEN 1.25 ELSE 1 END ELSE 1 END
 * CASE WHEN Temperature_DailyMax >= 105 THEN CASE x.HourGroup WHEN 'Morning' THEN 1.25 WHEN 'Midday' THEN 1.2 ELSE 1 END ELSE 1 END * CASE WHEN Temperature_DailyMax >= 112 AND x.HourGroup IN ('Morning','Midday','Peak') THEN 1.1 ELSE 1 END))"""
_BW = "coalesce(" + ", ".join(f"b{i}.w" for i in range(6)) + ")"
_BM = "CASE " + " ".join(f"WHEN b{i}.w IS NOT NULL THEN '{n}'" for i, (n, _) in enumerate(_BL)) + " END"
BANDS_SQL = BX_SQL + "," + RISK_SQL + "," + _BLK + f""", v_bn AS (SELECT x.*, {_BM} AS method0, greatest(greatest(1.0,{_BW})*{_RM}, 1.0, abs(Raw_Forecast_MWH)*0.03*0.65)*wm AS band0 FROM v_rm x {_BJ}),
v_bd AS (SELECT *, CASE WHEN Temperature_DailyMax >= 100 AND HourGroup IN ('Midday','Peak') AND band0 < 6 THEN 6 ELSE band0 END AS band, method0 || CASE WHEN Temperature_DailyMax >= 100 AND HourGroup IN ('Midday','Peak') AND band0 < 6 THEN '+hot_bucket_floor' ELSE '' END AS method FROM v_bn)"""
HOT_RULES = [{"min_daily_max_temp_f": 100.0, "hour_groups": ["Midday", "Peak"], "min_band_mwh": 6.0}]


def bands(spark, d):
    b = banded(spark, d)
    return BD.apply_bands(b, RAW, 0.03, 1.0, BD.band_lookup(b, "Residual_MWH", 1.0), weather_risk={}, hot_rules=HOT_RULES)


def stored_bands(spark, d, *cols):
    """Columns of the banded cube, written once: the passes after it (and their filters) would each work out the whole band anew."""
    return materialise(bands(spark, d).select(*cols), spark)


@query("unc02_interval_bands", ctes("bt") + "," + BANDS_SQL + """
SELECT row_id, band, method, greatest(Raw_Forecast_MWH - band, 0) AS p10, Raw_Forecast_MWH + band AS p90 FROM v_bd""", r6=["band", "p10", "p90"])
def _(spark, d):
    return bands(spark, d).select("row_id", F.col("Band").alias("band"), F.col("Band_Method").alias("method"), F.col("P10_Forecast_MWH").alias("p10"), F.col("P90_Forecast_MWH").alias("p90"))


@query("agg30_interval_coverage", ctes("bt") + "," + BANDS_SQL + """,
s AS (SELECT 'Overall' AS "Slice", * FROM v_bd UNION ALL SELECT 'Season:' || Season, * FROM v_bd UNION ALL SELECT 'RiskClass:' || cls, * FROM v_bd)
SELECT "Slice", CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN abs(Residual_MWH) <= band THEN 100.0 ELSE 0 END) AS cov, avg(band) AS w, avg(greatest(abs(Residual_MWH)-band,0)) AS miss, quantile_cont(abs(Residual_MWH),0.9) AS p90 FROM s GROUP BY 1""", r6=["cov", "w", "miss", "p90"])
def _(spark, d):
    from ..operators import scorecards as SC
    o = stored_bands(spark, d, "Residual_MWH", "Band", "Season", "Weather_Input_Risk_Class")
    n = F.array(F.lit("Overall"), F.concat(F.lit("Season:"), "Season"), F.concat(F.lit("RiskClass:"), "Weather_Input_Risk_Class"))
    c = SC.coverage(o.select("Residual_MWH", "Band", F.explode(n).alias("Slice")), ["Slice"], "Residual_MWH", "Band")
    return c.select("Slice", F.col("N").alias("n"), F.col("Coverage_PCT").alias("cov"), F.col("Avg_Band_MWH").alias("w"), F.col("Avg_Band_Miss_MWH").alias("miss"), F.col("P90_AbsError_MWH").alias("p90"))


@query("agg32_band_coverage_by_stage", ctes("bt") + "," + BANDS_SQL + """,
s AS (SELECT 'raw' AS "Stage", *, Actual_MWH-Raw_Forecast_MWH AS e FROM v_bd UNION ALL SELECT 'actual_plus_one', *, -1.0 FROM v_bd)
SELECT "Stage", HourGroup, CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN abs(e) <= band THEN 100.0 ELSE 0 END) AS cov, max(greatest(abs(e)-band,0)) AS worst FROM s GROUP BY 1, 2""", r6=["cov", "worst"])
def _(spark, d):
    from ..operators import scorecards as SC
    o = stored_bands(spark, d, RAW, ACT, "HourGroup", "Band").withColumn("p1", F.col(ACT) + 1.0)
    long = M.by_stage(o, {"raw": RAW, "actual_plus_one": "p1"}, ["HourGroup", ACT, "Band"]).withColumn("e", F.col(ACT) - F.col("Forecast_MWH"))
    c = SC.coverage(long, ["Stage", "HourGroup"], "e", "Band")
    return c.select("Stage", "HourGroup", F.col("N").alias("n"), F.col("Coverage_PCT").alias("cov"), F.col("Max_Band_Miss_MWH").alias("worst"))


HB = "CASE WHEN Forecast_Day=1 THEN 'Day1' WHEN Forecast_Day<=7 THEN 'Days2to7' ELSE 'Days8to16' END"
SCEN = {"warmer": "sc_warm", "cooler": "sc_cool"}


def scen(df):
    return df.withColumns({"sc_warm": F.col(RAW) * 1.04 + F.col("row_id") % 3, "sc_cool": F.col(RAW) * 0.97 - F.col("row_id") % 2})


SCEN_SQL = "Raw_Forecast_MWH*1.04 + row_id%3 AS sc_warm, Raw_Forecast_MWH*0.97 - row_id%2 AS sc_cool"


@query("unc06_conformal_bands", ctes("bt") + "," + BANDS_SQL + f""",
z AS (SELECT *, {HB} AS hb, abs(Residual_MWH) AS ae, {SCEN_SQL} FROM v_bd), q1 AS (SELECT cls, hb, quantile_cont(ae,0.8) AS q FROM z GROUP BY 1,2)
SELECT row_id, q, CASE WHEN wm > 1 OR z.cls <> 'none' THEN greatest(band/wm, q, (greatest(sc_warm,sc_cool)-least(sc_warm,sc_cool))/2) ELSE band END AS band FROM z JOIN q1 USING (cls, hb)""", r6=["q", "band"])
def _(spark, d):
    o = scen(stored_bands(spark, d, "row_id", RAW, "Residual_MWH", "Forecast_Day", "Band", "Weather_Input_Risk_Multiplier", "Weather_Input_Risk_Class")).withColumns({"Replay_Horizon_Bucket": B.horizon_bucket("Forecast_Day", "replay"), "AbsError_MWH": F.abs("Residual_MWH")})
    c = BD.conformal_bands(o, BD.conformal_lookup(o), RAW, S.half_spread(list(SCEN.values())))
    return c.select("row_id", F.col("Conformal_Weather_Band_MWH").alias("q"), F.col("Band").alias("band"))


@query("win20_prior_origin_conformal", ctes("bt") + "," + BX_SQL + "," + RISK_SQL + f""",
z AS (SELECT *, {HB} AS hb, abs(Residual_MWH) AS ae, CAST(year("Date") AS BIGINT) AS o FROM v_rm), os AS (SELECT DISTINCT o FROM z),
l1 AS (SELECT os.o, z.cls, z.hb, count(*) AS n, quantile_cont(ae,0.8) AS q FROM os JOIN z ON z.o < os.o GROUP BY 1,2,3), l2 AS (SELECT os.o, z.cls, count(*) AS n, quantile_cont(ae,0.8) AS q FROM os JOIN z ON z.o < os.o GROUP BY 1,2),
l3 AS (SELECT os.o, z.hb, count(*) AS n, quantile_cont(ae,0.8) AS q FROM os JOIN z ON z.o < os.o GROUP BY 1,2), l4 AS (SELECT os.o, count(*) AS n, quantile_cont(ae,0.8) AS q FROM os JOIN z ON z.o < os.o GROUP BY 1)
SELECT z.o, z.cls, z.hb, CAST(count(*) AS BIGINT) AS n, max(CASE WHEN l1.n >= 20 THEN l1.q WHEN l2.n >= 20 THEN l2.q WHEN l3.n >= 20 THEN l3.q WHEN l4.n >= 50 THEN l4.q END) AS q,
 max(CASE WHEN l1.n >= 20 THEN 'risk_horizon' WHEN l2.n >= 20 THEN 'risk_class' WHEN l3.n >= 20 THEN 'horizon' WHEN l4.n >= 50 THEN 'global' ELSE 'insufficient_prior' END) AS src
FROM z LEFT JOIN l1 ON l1.o=z.o AND l1.cls=z.cls AND l1.hb=z.hb LEFT JOIN l2 ON l2.o=z.o AND l2.cls=z.cls LEFT JOIN l3 ON l3.o=z.o AND l3.hb=z.hb LEFT JOIN l4 ON l4.o=z.o GROUP BY 1,2,3""", r6=["q"])
def _(spark, d):
    cols = [*CTX, "Date"]
    b = B.with_quartile_bucket(replay(spark, d, *cols), LOSS, "SolarLossBucket").withColumns({"CloudCoverBucket": B.cloud_bucket("CloudCover_Norm")})
    b = BD.add_weather_risk(b).withColumns({"Replay_Horizon_Bucket": B.horizon_bucket("Forecast_Day", "replay"), "ae": F.abs("Residual_MWH"), "o": F.year("Date").cast("long")})
    cells = b.groupBy("o", "Weather_Input_Risk_Class", "Replay_Horizon_Bucket").agg(F.count("*").alias("n"))
    lk = BD.prior_origin_quantiles(b, "o", "ae")
    r = BD.first_match(cells, lk, BD.CONFORMAL_LEVELS, "q", ["o"], "qq", "src", {"risk_horizon": 20, "risk_class": 20, "horizon": 20, "global": 50})
    return r.select("o", F.col("Weather_Input_Risk_Class").alias("cls"), F.col("Replay_Horizon_Bucket").alias("hb"), "n", F.col("qq").alias("q"), F.coalesce("src", F.lit("insufficient_prior")).alias("src"))


@query("unc08_half_spread", ctes("bt") + f"""
SELECT row_id, (greatest(sc_warm,sc_cool)-least(sc_warm,sc_cool))/2 AS hs FROM (SELECT row_id, {SCEN_SQL} FROM v_bt)""", r6=["hs"])
def _(spark, d):
    return scen(replay(spark, d, "row_id", RAW)).select("row_id", S.half_spread(list(SCEN.values())).alias("hs"))


@query("unc07_policy_compare", ctes("bt") + "," + BX_SQL + "," + RISK_SQL + """
SELECT policy, CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN abs(Residual_MWH) <= b THEN 100.0 ELSE 0 END) AS cov, avg(b) AS w FROM (SELECT 'no_weather_risk' AS policy, Residual_MWH, greatest(1, abs(Raw_Forecast_MWH)*0.03) AS b FROM v_rm UNION ALL SELECT 'current', Residual_MWH, greatest(1, abs(Raw_Forecast_MWH)*0.03)*wm FROM v_rm) GROUP BY 1""", r6=["cov", "w"])
def _(spark, d):
    o = BD.add_weather_risk(banded(spark, d))
    base = F.greatest(F.lit(1.0), F.abs(RAW) * 0.03)
    pol = F.array(F.struct(F.lit("no_weather_risk").alias("policy"), base.alias("b")), F.struct(F.lit("current").alias("policy"), (base * F.col("Weather_Input_Risk_Multiplier")).alias("b")))
    g = o.select(F.abs("Residual_MWH").alias("e"), F.inline(pol))
    return g.groupBy("policy").agg(F.count("*").alias("n"), F.avg(F.when(F.col("e") <= F.col("b"), 100.0).otherwise(0.0)).alias("cov"), F.avg("b").alias("w"))


# ---- scenarios ----------------------------------------------------------------------------------

_CAP = "CASE WHEN Forecast_Day BETWEEN 8 AND 16 THEN least(CASE WHEN Hour BETWEEN 10 AND 16 AND (CloudCover_Norm >= 0.6 OR BTM_Solar_Loss_From_ClearSky_MW >= 1.25) THEN 2.0 WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 THEN 3.0 ELSE 2.5 END, 1.0) WHEN Hour BETWEEN 10 AND 16 AND (CloudCover_Norm >= 0.6 OR BTM_Solar_Loss_From_ClearSky_MW >= 1.25) THEN 2.0 WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 THEN 3.0 ELSE 2.5 END"
CAPPED_SQL = f"v_s1 AS (SELECT *, {SCEN_SQL}, {_CAP} AS cap FROM v_bt), v_s2 AS (SELECT *, greatest(Raw_Forecast_MWH + least(greatest(sc_warm-Raw_Forecast_MWH,-cap),cap),0) AS w2, greatest(Raw_Forecast_MWH + least(greatest(sc_cool-Raw_Forecast_MWH,-cap),cap),0) AS c2, CASE WHEN abs(sc_warm-Raw_Forecast_MWH) > cap + 1e-9 OR abs(sc_cool-Raw_Forecast_MWH) > cap + 1e-9 THEN 1 ELSE 0 END AS hit FROM v_s1)"
SC_COLS = ("row_id", "Hour", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", LOSS, RAW)


def capped(spark, d):
    return S.cap_deltas(scen(replay(spark, d, *SC_COLS)), list(SCEN.values()), RAW, S.delta_cap(2.5, 3.0, 2.0, 1.0))


@query("unc04_scenario_delta_caps", ctes("bt") + "," + CAPPED_SQL + """
SELECT row_id, w2 AS sc_warm, c2 AS sc_cool, hit, greatest(w2,c2)-least(w2,c2) AS spread, greatest(abs(w2-Raw_Forecast_MWH),abs(c2-Raw_Forecast_MWH)) AS mx FROM v_s2""", r6=["sc_warm", "sc_cool", "spread", "mx"])
def _(spark, d):
    o = S.add_scenario_summary(capped(spark, d), list(SCEN.values()), RAW)
    return o.select("row_id", "sc_warm", "sc_cool", F.col("WeatherScenario_Cap_Applied").alias("hit"), F.col("WeatherScenario_Spread_MWH").alias("spread"), F.col("WeatherScenario_MaxAbsDelta_MWH").alias("mx"))


_SS = {"Overall": "TRUE", "PeakWindow_HE14to18": "Hour BETWEEN 14 AND 18", "HotPeak_HE16to20_90FPlus": "Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90", "CloudSolarMidday": "Hour BETWEEN 10 AND 16 AND (CloudCover_Norm >= 0.6 OR BTM_Solar_Loss_From_ClearSky_MW >= 1.25)",
       "LongHorizon_Days8to16": "Forecast_Day BETWEEN 8 AND 16", "Horizon_Day1": "Forecast_Day=1", "Horizon_Days2to3": "Forecast_Day BETWEEN 2 AND 3", "Horizon_Days4to7": "Forecast_Day BETWEEN 4 AND 7", "Horizon_Days8to16": "Forecast_Day BETWEEN 8 AND 16"}


@query("unc05_stress_summary", ctes("bt") + "," + CAPPED_SQL + ", u AS (" + " UNION ALL ".join(f"SELECT '{n}' AS \"Slice\", '{s}' AS \"Scenario\", {c} - Raw_Forecast_MWH AS dl, hit FROM v_s2 WHERE {w}" for n, w in _SS.items() for s, c in (("warmer", "w2"), ("cooler", "c2"))) + """)
SELECT "Scenario", "Slice", CAST(count(*) AS BIGINT) AS n, avg(dl) AS m, avg(abs(dl)) AS ma, quantile_cont(abs(dl),0.9) AS p90, max(abs(dl)) AS mx, CAST(sum(hit) AS BIGINT) AS hits FROM u GROUP BY 1, 2""", r6=["m", "ma", "p90", "mx"])
def _(spark, d):
    o = S.stress_summary(capped(spark, d), SCEN, RAW)
    return o.select("Scenario", "Slice", F.col("N").alias("n"), F.col("MeanDelta_MWH").alias("m"), F.col("MeanAbsDelta_MWH").alias("ma"), F.col("P90AbsDelta_MWH").alias("p90"), F.col("MaxAbsDelta_MWH").alias("mx"), F.col("CapHitRows").alias("hits"))


_SG = "(CASE least(Forecast_Day,7) WHEN 1 THEN 1.6 WHEN 2 THEN 2.0 WHEN 3 THEN 2.4 WHEN 4 THEN 2.9 WHEN 5 THEN 3.4 WHEN 6 THEN 3.9 ELSE 4.4 END*1.2533)"


@query("cor20_robustness_hedge", ctes("bt") + "," + f"""h AS (SELECT row_id, Hour, Forecast_Day, Temperature_DailyMax, sc_warm-Raw_Forecast_MWH AS wd, sc_cool-Raw_Forecast_MWH AS cd, {_SG} AS sg, Raw_Forecast_MWH AS b FROM (SELECT *, {SCEN_SQL} FROM v_bt))
SELECT row_id, CASE WHEN Hour BETWEEN 13 AND 21 AND Temperature_DailyMax >= 88 THEN least(greatest(0.5*sg*sg*(wd+cd)/9*2 + 0.3*(sg/(4.4*1.2533))*greatest(wd,0), 0), 16, greatest(wd,0)*1.25) ELSE 0 END AS hedge FROM h""", r6=["hedge"])
def _(spark, d):
    t = {1: 1.6, 2: 2.0, 3: 2.4, 4: 2.9, 5: 3.4, 6: 3.9, 7: 4.4}
    o = S.robustness_hedge(scen(replay(spark, d, *SC_COLS)), RAW, "sc_warm", "sc_cool", mae_by_lead=t)
    return o.select("row_id", F.col("Weather_Robustness_Hedge_MWH").alias("hedge"))
