"""Queries: end-to-end flows, replay, chain, models and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core.scratch import materialise, shared_dir
from ..functions import calendar as C
from ..models import learners as ML
from ..operators import chain as CH
from ..operators import history as H
from ..operators import lags as L
from ..operators import lookups as LK
from ..operators import metrics as M
from ..operators import peaks as P
from ..operators import rules as RU
from ..operators import scenarios as S
from ..operators import scorecards as SC
from ..operators import solar as SO
from ..operators import weather_features as WF
from ..streaming import jobs as J
from .a_features import LOSS
from .base import STAGES, ctes, daily, load, query, reading, replay, site, weather
from .c_scorecards import ACT, FIN, RAW, m_sql
from .f_solar import intervals


def s(col, name=None):
    return F.col(col).cast("string").alias(name or col)


# ---- flagship -----------------------------------------------------------------------------------

FLOW_SQL = """,
lg AS (SELECT a.series, a.DT, a.eh, a.MWH, avg(b.MWH) AS f FROM v_load a JOIN v_load b ON b.series = a.series AND a.eh - b.eh IN (24,48,72,96,120,144,168) GROUP BY 1, 2, 3, 4),
lk AS (SELECT series, hour(DT) AS h, least(greatest(avg(MWH-f)*count(*)/(count(*)+24.0)*0.7, -12), 12) AS c FROM lg WHERE DT < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
z AS (SELECT lg.*, greatest(f + coalesce(c, 0), 0) AS g FROM lg LEFT JOIN lk ON lk.series = lg.series AND lk.h = hour(lg.DT) WHERE lg.DT >= TIMESTAMP '2024-01-20'), u AS (SELECT series, 'corrected' AS "Stage", MWH AS a, g AS f FROM z UNION ALL SELECT series, 'seasonal_naive', MWH, f FROM z)"""


FLOW_CUT = "2024-01-20"


def flow(spark, d):
    """Readings to hours, gap-safe lags, seasonal-naive forecast, shrunk (series, hour) correction.

    The correction is learned before ``FLOW_CUT`` and applied from there on, so no row is scored on itself.
    """
    lagged = L.add_calendar_lags(load(spark, d), lags=[], rolling=[])
    base = lagged.where("MWH_SameHour7DayMean is not null").select("series", "DT", F.col("MWH").alias(ACT), F.col("MWH_SameHour7DayMean").alias(RAW), F.hour("DT").alias("Hour"))
    base = base.withColumn("Residual_MWH", F.col(ACT) - F.col(RAW))
    lv = (LK.Level("hour", ("Hour",)),)
    base = materialise(base, spark)  # learned from and applied to
    cut = F.lit(FLOW_CUT).cast("timestamp")
    lk = LK.learn(base.where(F.col("DT") < cut), lv, "Residual_MWH", ["series"], 0.7, 12.0, 24.0)
    return LK.apply_scoped(base.where(F.col("DT") >= cut), lk, lv, F.lit(True), ["series"], count_k=None, base=RAW, forecast_col="Corrected_MWH")


@query("flow_rollup_to_scorecard", ctes("load") + FLOW_SQL + f"""
SELECT series, "Stage", {m_sql('f', 'a')} FROM u GROUP BY 1, 2""", r6=["Actual_Mean_MWH", "Forecast_Mean_MWH", "Bias_MWH", "MAE_MWH", "RMSE_MWH", "MAPE_PCT", "Underforecast_Rate_PCT", "Max_Underforecast_MWH", "Max_Overforecast_MWH", "P90_AbsError_MWH"])
def _(spark, d):
    return M.stage_metrics(flow(spark, d), {"seasonal_naive": RAW, "corrected": "Corrected_MWH"}, ["series"])


# ---- replay -------------------------------------------------------------------------------------

REPLAY_SQL = """,
og AS (SELECT DATE '2024-01-08' + CAST(3*k AS INTEGER) AS o FROM range(0, 6) t(k)),
tg AS (SELECT o, series, DT, eh, MWH FROM og JOIN v_load ON DT >= o AND DT < o + INTERVAL 5 DAY), hp AS (SELECT o, series, hour(DT) AS h, avg(MWH) AS f FROM og JOIN v_load ON DT < o AND DT >= o - INTERVAL 7 DAY GROUP BY 1, 2, 3),
rp AS (SELECT tg.o, tg.series, tg.DT, tg.MWH AS a, f, row_number() OVER (PARTITION BY tg.o, tg.series ORDER BY tg.DT) AS lead FROM tg LEFT JOIN hp ON hp.o = tg.o AND hp.series = tg.series AND hp.h = hour(tg.DT))"""


def rp(spark, d):
    return H.rolling_origin_replay(load(spark, d).select("series", "DT", "MWH"), "2024-01-08", 3, 6, 5)


@query("rep02_rolling_origin_replay", ctes("load") + REPLAY_SQL + """
SELECT CAST(o AS VARCHAR) AS origin, series, CAST(DT AS VARCHAR) AS DT, a, f, CAST(lead AS INT) AS lead, CAST(floor((lead-1)/24)+1 AS INT) AS day FROM rp""", r6=["a", "f"])
def _(spark, d):
    o = rp(spark, d)
    return o.select(s("origin_dt", "origin"), "series", s("DT"), F.col(ACT).alias("a"), F.col(RAW).alias("f"), F.col("Forecast_Lead_Hour").alias("lead"), F.col("Forecast_Day").alias("day"))


@query("rep21_one_origin_bundle", ctes("load") + REPLAY_SQL + """
SELECT series, CAST(count(*) AS BIGINT) AS n, avg(abs(a-f)) AS mae FROM rp WHERE o = DATE '2024-01-14' GROUP BY 1""", r6=["mae"])
def _(spark, d):
    o = H.rolling_origin_replay(load(spark, d).select("series", "DT", "MWH"), "2024-01-14", 3, 1, 5)
    return o.groupBy("series").agg(F.count("*").alias("n"), F.avg(F.abs(F.col(ACT) - F.col(RAW))).alias("mae"))


@query("rep01_holdout_backtest", ctes("load") + """,
e AS (SELECT series, max(DT) AS m FROM v_load GROUP BY 1), p AS (SELECT l.series, hour(DT) AS h, avg(MWH) AS f FROM v_load l JOIN e ON e.series = l.series WHERE DT < m - INTERVAL 5 DAY GROUP BY 1, 2)
SELECT l.series, CAST(count(*) AS BIGINT) AS n, avg(MWH - f) AS bias, avg(abs(MWH - f)) AS mae FROM v_load l JOIN e ON e.series = l.series JOIN p ON p.series = l.series AND p.h = hour(DT) WHERE DT >= m - INTERVAL 5 DAY GROUP BY 1""", r6=["bias", "mae"])
def _(spark, d):
    o = CH.holdout_backtest(load(spark, d), 5)
    r = F.col("MWH") - F.col(RAW)
    return o.groupBy("series").agg(F.count("*").alias("n"), F.avg(r).alias("bias"), F.avg(F.abs(r)).alias("mae"))


@query("win19_expanding_walk_forward", ctes("bt") + """,
y AS (SELECT CAST(year("Date") AS INT) AS y, Hour, sum(Residual_MWH) AS s, count(*) AS n FROM v_bt GROUP BY 1, 2), t AS (SELECT DISTINCT y FROM y), p AS (SELECT t.y, Hour, sum(s)/sum(n) AS m FROM t JOIN y ON y.y < t.y GROUP BY 1, 2)
SELECT p.y, CAST(count(*) AS BIGINT) AS n, avg(abs(Residual_MWH - m)) AS mae FROM v_bt JOIN p ON p.y = year("Date") AND p.Hour = v_bt.Hour GROUP BY 1""", r6=["mae"])
def _(spark, d):
    b = replay(spark, d, "Date", "Hour", "Residual_MWH").withColumn("y", F.year("Date"))
    m = CH.prior_block_means(b, "y", ["Hour"], "Residual_MWH")
    return b.join(m, ["y", "Hour"]).groupBy("y").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("Residual_MWH") - F.col("prior_mean"))).alias("mae"))


CHAIN_COLS = ("series", "row_id", "origin_id", "Date", "DT", "Hour", "Month", "Season", "HourGroup", "IsWeekend", "Forecast_Day", "Temperature", "Temperature_DailyMax", "CloudCover_Norm", "BTM_Solar_Proxy_MW", LOSS, RAW, ACT, "Residual_MWH",
              "MWH_SameHour7DayMean", "MWH_Lag24")


def cube(spark, d):
    return replay(spark, d, *CHAIN_COLS).withColumn("IsHoliday", F.lit(0))


GUARD = {"name": "hot", "min_maxtemp_f": 100.0, "hours": [16, 17, 18], "adjustment_mwh": 1.0}


@query("cor23_correction_chain", ctes("bt") + """,
g AS (SELECT Season, Hour, least(greatest(avg(Residual_MWH)*count(*)/(count(*)+24.0)*0.7, -4), 4) AS c FROM v_bt GROUP BY 1, 2), a AS (SELECT b.*, greatest(Raw_Forecast_MWH + coalesce(c,0),0) AS f1 FROM v_bt b LEFT JOIN g ON g.Season = b.Season AND g.Hour = b.Hour),
e AS (SELECT *, f1 + CASE WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 98 THEN least((Temperature_DailyMax-98)*0.1, 1) ELSE 0 END AS f2 FROM a)
SELECT row_id, greatest(f2 + CASE WHEN Hour IN (16,17,18) AND Temperature_DailyMax >= 100 THEN 1 ELSE 0 END, 0) AS fc FROM e""", r6=["fc"])
def _(spark, d):
    b = cube(spark, d)
    lv = (LK.Level("season_hour", ("Season", "Hour")),)
    lk = LK.learn(b, lv, "Residual_MWH", blend=0.7, cap=4.0, shrink_k=24.0)
    steps = [lambda x: LK.apply_scoped(x, lk, lv, F.lit(True), count_k=None, base=RAW, forecast_col="f1"), lambda x: P.magnitude_lift(x, "f1", 98.0, 0.1, 1.0), lambda x: RU.apply_guard(x, [GUARD], "Magnitude_Forecast_MWH", 5.0)]
    return CH.run_chain(b, steps).select("row_id", F.col("Magnitude_Forecast_MWH").alias("fc"))


@query("udf03_user_stage_in_chain", ctes("bt") + """
SELECT Season, avg(abs(Actual_MWH - (Raw_Forecast_MWH * 0.97 + 0.5))) AS mae FROM v_bt GROUP BY 1""", r6=["mae"])
def _(spark, d):
    user = lambda x: x.withColumn("u", F.col(RAW) * 0.97)
    o = CH.run_chain(replay(spark, d, "Season", RAW, ACT), [user, lambda x: x.withColumn("u", F.col("u") + 0.5)])
    return o.groupBy("Season").agg(F.avg(F.abs(F.col(ACT) - F.col("u"))).alias("mae"))


@query("udf02_user_metrics", ctes("bt") + """
SELECT Season, CAST(count(*) AS BIGINT) AS "N", avg(abs(Actual_MWH-Final_Forecast_MWH)) AS "MAE_MWH", max(Actual_MWH)/avg(Actual_MWH) AS peak_ratio FROM v_bt GROUP BY 1""", r6=["MAE_MWH", "peak_ratio"])
def _(spark, d):
    o = M.grouped_metrics(replay(spark, d, "Season", ACT, FIN), ["Season"], FIN, p90=False, extra={"peak_ratio": F.max(ACT) / F.avg(ACT)})
    return o.select("Season", "N", "MAE_MWH", "peak_ratio")


@query("udf04_per_series_routine", ctes("load") + """,
hm AS (SELECT series, hour(DT) AS h, avg(MWH) AS hm FROM v_load GROUP BY 1, 2), dm AS (SELECT series, avg(MWH) AS dm FROM v_load GROUP BY 1),
e AS (SELECT l.series, k, sqrt(avg(power(MWH - (k*hm + (1-k)*dm), 2))) AS r FROM v_load l JOIN hm ON hm.series = l.series AND hm.h = hour(l.DT) JOIN dm ON dm.series = l.series, (VALUES (0.0), (0.25), (0.5), (0.75), (1.0)) t(k) GROUP BY 1, 2)
SELECT series, CAST(arg_min(k, r) AS DOUBLE) AS share, min(r) AS rmse FROM e GROUP BY 1""", r6=["rmse"])
def _(spark, d):
    return CH.per_key_search(load(spark, d).select("series", "DT", "MWH", F.hour("DT").alias("Hour")), [0.0, 0.25, 0.5, 0.75, 1.0])


@query("rep04_cached_rescoring", ctes("bt") + """,
cf AS (SELECT * FROM (VALUES ('off', 0.0), ('half', 0.5), ('full', 1.0)) t(config, k))
SELECT config, origin_id, avg(abs(Actual_MWH - (Raw_Forecast_MWH + k*(Learned_Forecast_MWH-Raw_Forecast_MWH)))) AS mae FROM cf, v_bt GROUP BY 1, 2""", r6=["mae"])
def _(spark, d):
    b = materialise(replay(spark, d, "origin_id", ACT, RAW, STAGES["residual_calibrated"]), spark)
    return CH.score_configs(b, {"off": 0.0, "half": 0.5, "full": 1.0}, RAW, STAGES["residual_calibrated"], ["origin_id"])


@query("rep14_stage_ablation", ctes("bt") + """,
m AS (SELECT origin_id, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS b, avg(abs(Actual_MWH-Recent_Forecast_MWH)) AS r, avg(abs(Actual_MWH-Learned_Forecast_MWH)) AS l FROM v_bt WHERE Hour BETWEEN 14 AND 18 GROUP BY 1), u AS (SELECT 'no_level' AS variant, r - b AS d FROM m UNION ALL SELECT 'no_recent', l - b FROM m)
SELECT variant, CAST(count(*) AS BIGINT) AS origins, avg(d) AS delta, CAST(count(*) FILTER (d < -0.05) AS BIGINT) AS better, CAST(count(*) FILTER (d > 0.05) AS BIGINT) AS worse FROM u GROUP BY 1""", r6=["delta"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "Hour", ACT, *STAGES.values()).where("Hour between 14 and 18")
    return CH.ablation(b, FIN, {"no_level": STAGES["recent_corrected"], "no_recent": STAGES["residual_calibrated"]}, "origin_id")


@query("rep03_scenario_replay_hedge", ctes("bt") + """,
x AS (SELECT *, Raw_Forecast_MWH*1.04 AS w, Raw_Forecast_MWH*0.97 AS c FROM v_bt), y AS (SELECT origin_id, Raw_Forecast_MWH AS b, Actual_MWH AS a, w - Raw_Forecast_MWH AS wd, c - Raw_Forecast_MWH AS cd, CASE least(Forecast_Day,7) WHEN 1 THEN 1.94 WHEN 2 THEN 1.0 WHEN 3 THEN 1.92 WHEN 4 THEN 2.36 WHEN 5 THEN 4.11 WHEN 6 THEN 4.69 ELSE 6.3 END*1.2533 AS sg, Hour BETWEEN 13 AND 21 AND coalesce(Temperature_DailyMax,0) >= 88 AS g FROM x),
z AS (SELECT *, CASE WHEN g THEN least(greatest(sg*sg*(wd+cd)/9 + 0.3*(sg/(6.3*1.2533))*greatest(wd,0),0),16,greatest(wd,0)*1.25) ELSE 0 END AS h FROM y)
SELECT origin_id, avg(h) AS hedge, avg(abs(a-b)) AS mae0, avg(abs(a-b-h)) AS mae1 FROM z GROUP BY 1""", r6=["hedge", "mae0", "mae1"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "Hour", "Forecast_Day", "Temperature_DailyMax", RAW, ACT).withColumns({"w": F.col(RAW) * 1.04, "c": F.col(RAW) * 0.97})
    o = S.robustness_hedge(b, RAW, "w", "c")
    return o.groupBy("origin_id").agg(F.avg("Weather_Robustness_Hedge_MWH").alias("hedge"), F.avg(F.abs(F.col(ACT) - F.col(RAW))).alias("mae0"), F.avg(F.abs(F.col(ACT) - F.col("Hedged_Forecast_MWH"))).alias("mae1"))


@query("rep05_replay_readiness_summary", ctes("bt") + """
SELECT Season, CAST(count(DISTINCT origin_id) AS BIGINT) AS origins, CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae, CAST(count(DISTINCT origin_id) >= 3 AS INT) AS ready FROM v_bt GROUP BY 1""", r6=["mae"])
def _(spark, d):
    g = replay(spark, d, "Season", "origin_id", ACT, FIN).groupBy("Season").agg(F.count_distinct("origin_id").alias("origins"), F.count("*").alias("n"), F.avg(F.abs(F.col(ACT) - F.col(FIN))).alias("mae"))
    return g.withColumn("ready", (F.col("origins") >= 3).cast("int"))


@query("rep07_june_hot_origin_audit", ctes("bt") + """
SELECT origin_id, row_id, Actual_MWH - Final_Forecast_MWH AS miss, Temperature_DailyMax AS t FROM v_bt WHERE Month = 6 AND Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 100 AND Actual_MWH - Final_Forecast_MWH > 0.25""", r6=["miss", "t"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "row_id", "Month", "Hour", "Temperature_DailyMax", ACT, FIN).where("Month = 6 AND Hour between 16 and 20 AND Temperature_DailyMax >= 100")
    r = F.col(ACT) - F.col(FIN)
    return b.where(r > 0.25).select("origin_id", "row_id", r.alias("miss"), F.col("Temperature_DailyMax").alias("t"))


@query("rep13_diagnostics_bundle", ctes("bt") + """
SELECT 'by_hour' AS t, CAST(count(DISTINCT Hour) AS BIGINT) AS n FROM v_bt UNION ALL SELECT 'by_season', CAST(count(DISTINCT Season) AS BIGINT) FROM v_bt UNION ALL SELECT 'by_day', CAST(count(DISTINCT Forecast_Day) AS BIGINT) FROM v_bt UNION ALL SELECT 'stages', 4""")
def _(spark, d):
    b = materialise(replay(spark, d, "Hour", "Season", "Forecast_Day", ACT, *STAGES.values()), spark)
    tabs = CH.diagnostics_bundle(b, STAGES, {"by_hour": ["Hour"], "by_season": ["Season"], "by_day": ["Forecast_Day"]}, FIN)
    parts = [v.agg(F.count("*").alias("n")).select(F.lit(k).alias("t"), "n") for k, v in tabs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("rep18_origin_split_stability")
def _(spark, d):
    b = replay(spark, d, "origin_id", ACT, FIN)
    return CH.split_stability(b, "origin_id", FIN, seeds=(1, 2, 3), holdout=0.3)


# ---- scenario frame -----------------------------------------------------------------------------

@query("unc01_scenario_fan_out", ctes("weather") + """,
sc AS (SELECT * FROM (VALUES ('warmer', 3.0, 0.0, 1.0), ('cooler', -3.0, 0.0, 1.0), ('cloudier_solar_loss', 0.0, 0.3, 0.65), ('clearer_high_solar', 0.0, -0.3, 1.15)) t(n, dtf, dc, gm)),
w AS (SELECT series, DT, n, TempF + dtf AS t, CASE WHEN dc <> 0 OR gm <> 1 THEN least(greatest(coalesce(least(greatest(CloudCoverPct/100,0),1),0)+dc,0),1) ELSE coalesce(least(greatest(CloudCoverPct/100,0),1),0) END AS c, coalesce(GHI_Wm2,0)*gm AS g FROM v_weather, sc)
SELECT series, CAST(DT AS VARCHAR) AS DT, n AS scenario, t, c, g, CASE WHEN t IS NULL THEN NULL ELSE greatest(t-65,0) END AS cdd, max(t) OVER (PARTITION BY series, n, CAST(DT AS DATE)) AS tmax FROM w""", r6=["t", "c", "g", "cdd", "tmax"])
def _(spark, d):
    f = WF.add_weather_features(C.add_time_features(weather(spark, d)))
    o = S.scenario_frame(f)
    return o.select("series", s("DT"), F.col("Weather_Scenario_Name").alias("scenario"), F.col("Temperature").alias("t"), F.col("CloudCover_Norm").alias("c"), F.col("GHI_Wm2").alias("g"), F.col("CDD").alias("cdd"), F.col("Temperature_DailyMax").alias("tmax"))


# ---- models -------------------------------------------------------------------------------------

LOAD_ROUNDS = 1400  # the most rounds of the load model; the loss of later rows ends it before
FEATS = ["Hour", "Temperature", "Temperature_DailyMax", "CloudCover_Norm", "MWH_Lag24", "MWH_SameHour7DayMean"]


def model_rows(spark, d):
    return materialise(replay(spark, d, "series", "row_id", "Date", "Month", "DT", *FEATS, RAW, ACT, "Residual_MWH", "IsWeekend", "Forecast_Day"), spark)


@query("mod01_boosted_load_model")
def _(spark, d):
    from ..operators import training as TR
    b = model_rows(spark, d)
    w = TR.add_load_weights(b.withColumn("IsLikelySystemPeakHour", F.lit(1)), ACT, TR.Weights(recency_end=1.0))
    w = TR.validation_flag(w, 180, 100)
    f = ML.fit(w, FEATS, ACT, weight="SampleWeight", validation="is_validation", iters=LOAD_ROUNDS, depth=4, tol=0.0)
    return f.score(w.where("is_validation")).groupBy("Hour").agg(F.count("*").alias("n"), F.avg(F.abs(F.col(ACT) - F.col("prediction"))).alias("mae"))


@query("mod02_component_blend", ctes("bt") + """
SELECT row_id, CASE WHEN MWH_Lag1 IS NULL THEN (0.5*Raw_Forecast_MWH + 0.2*Recent_Forecast_MWH)/0.7 ELSE 0.5*Raw_Forecast_MWH + 0.3*MWH_Lag1 + 0.2*Recent_Forecast_MWH END AS f FROM v_bt""", r6=["f"])
def _(spark, d):
    return replay(spark, d, "row_id", RAW, "MWH_Lag1", STAGES["recent_corrected"]).select("row_id", ML.blend({RAW: 0.5, "MWH_Lag1": 0.3, STAGES["recent_corrected"]: 0.2}).alias("f"))


@query("mod03_recursive_forecast", ctes("load") + """,
e AS (SELECT series, max(eh) AS m FROM v_load GROUP BY 1), g AS (SELECT e.series, m, avg(MWH) AS av FROM v_load JOIN e USING (series) WHERE m - eh < 168 GROUP BY 1, 2),
h AS (SELECT g.series, k, 2 + 0.5*coalesce(a.MWH, av) + 0.45*coalesce(b.MWH, av) AS y FROM g, range(1, 25) t(k) LEFT JOIN v_load a ON a.series = g.series AND a.eh = m + k - 24 LEFT JOIN v_load b ON b.series = g.series AND b.eh = m + k - 168)
SELECT series, CAST(k AS INT) AS lead, y FROM h""", r6=["y"])
def _(spark, d):
    o = ML.recursive_forecast(load(spark, d), {24: 0.5, 168: 0.45}, 2.0, 24)
    return o.select("series", F.col("Forecast_Lead_Hour").alias("lead"), F.col("Raw_Forecast_MWH").alias("y"))


@query("mod04_trend_seasonality")
def _(spark, d):
    cols = ML.trend_seasonality_columns((F.col("eh") - 473352) / 720.0, F.dayofyear("DT"), F.hour("DT"), 2)
    x = load(spark, d).withColumns(cols)
    keep = [k for k in cols if not k.startswith("y")]
    m = ML.fit_linear(x, keep, "MWH", 0.01)
    return m.transform(x).groupBy("series").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("MWH") - F.col("prediction"))).alias("mae"))


@query("mod05_targeted_residual_meta")
def _(spark, d):
    b, ev = model_rows(spark, d), SC.hot_peak()
    lr = ML.fit_two_stage(b, FEATS, "Residual_MWH", ev, iters=3, depth=3)
    o = ML.apply_two_stage(b, lr, RAW, ev)
    return o.groupBy("Hour").agg(F.count("*").alias("n"), F.avg("Targeted_Meta_MWH").alias("correction"), F.avg(F.abs(F.col(ACT) - F.col("Targeted_Meta_MWH_Forecast"))).alias("mae"))


@query("mod06_operational_residual_learner")
def _(spark, d):
    b = model_rows(spark, d)
    f = ML.fit(b.where("Date < DATE'2000-01-01'"), FEATS, "Residual_MWH", loss="absolute", iters=3, depth=3, prediction="corr")
    gate = P.evidence_gate({"raw": (5.0, None), "maxtemp": (80.0, None), "cloud": (None, 0.8)})
    o = f.score(b.where("Date >= DATE'2000-01-01'")).withColumn("applied", ML.gated_correction(F.col("corr"), gate, 5.0))
    return o.groupBy("Hour").agg(F.count("*").alias("n"), F.count(F.when(F.col("applied") != 0, 1)).alias("applied_rows"), F.avg("applied").alias("mean_correction"))


@query("mod14_scoped_shadow_columns")
def _(spark, d):
    b = model_rows(spark, d)
    f = ML.fit(b, FEATS, "Residual_MWH", iters=3, depth=3, prediction="corr")
    o = ML.shadow_columns(f.score(b), "corr", RAW, {"structural": (SC.hot_peak(), 3.0), "broad": (F.col("Temperature_DailyMax") >= 85, 5.0)})
    return o.groupBy("Hour").agg(F.avg("structural_Correction_MWH").alias("structural"), F.avg("broad_Correction_MWH").alias("broad"), F.avg(RAW).alias("base"))


@query("mod07_focused_shape_learner")
def _(spark, d):
    b = model_rows(spark, d)
    scope = F.col("Hour").between(12, 20)
    f = ML.fit(b.where(scope & (F.col("Date") < F.lit("2000-01-01").cast("date"))), FEATS, "Residual_MWH", loss="absolute", iters=3, depth=3, prediction="corr")
    o = f.score(b.where(F.col("Date") >= F.lit("2000-01-01").cast("date"))).withColumn("shape", F.col(RAW) + ML.gated_correction(F.col("corr"), scope, 4.0))
    g = CH.promotion_guard(o, "shape", RAW, SC.hot_peak())
    return g


@query("mod15_promotion_reference_and_risk_mask", ctes("bt") + """
SELECT CAST(coalesce(Hour BETWEEN 14 AND 18 OR (Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90), FALSE) AS INT) AS risk, CAST(count(*) AS BIGINT) AS n, avg(coalesce(MWH_Lag1, Recent_Forecast_MWH, Raw_Forecast_MWH)) AS ref FROM v_bt GROUP BY 1""", r6=["ref"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Temperature_DailyMax", "MWH_Lag1", STAGES["recent_corrected"], RAW)
    risk = P.yes(F.col("Hour").between(14, 18)) | P.yes(SC.hot_peak())
    return b.groupBy(risk.cast("int").alias("risk")).agg(F.count("*").alias("n"), F.avg(F.coalesce("MWH_Lag1", STAGES["recent_corrected"], RAW)).alias("ref"))


@query("mod08_daily_peak_residual_timing")
def _(spark, d):
    b = replay(spark, d, "series", "Date", "DT", "Hour", "Month", "Temperature_DailyMax", "CloudCover_Norm", RAW, ACT)
    days = materialise(P.daily_peak_rows(b, ["series", "Date"], RAW, max_cols=["Temperature_DailyMax", "CloudCover_Norm"]), spark)
    days = days.withColumns({"m": F.month("Date"), "res": F.col("Actual_DailyPeak_MWH") - F.col("Base_DailyPeak_MWH"), "shift": (F.col("Actual_PeakHour") - F.col("Base_PeakHour")).cast("double")})
    fs = ["m", "Base_DailyPeak_MWH", "Base_PeakHour", "Max_Temperature_DailyMax", "Max_CloudCover_Norm"]
    a, t = ML.fit(days, fs, "res", iters=3, depth=3, prediction="pr"), ML.fit(days, fs, "shift", iters=3, depth=3, prediction="ps")
    o = t.score(a.score(days))
    return o.groupBy("series").agg(F.count("*").alias("days"), F.avg(F.abs(F.col("res") - F.col("pr"))).alias("residual_mae"), F.avg(F.abs(F.col("shift") - F.col("ps"))).alias("timing_mae"))


SOLF = ["GHI_kWh_per_m2", "ClearSkyIndex", "CloudCoverPct", "SolarElevationDeg", "q"]


@query("mod09_solar_performance_ratio")
def _(spark, d):
    i = materialise(intervals(spark, d), spark)
    o = ML.performance_ratio(i, SOLF, "Forecast_kWh")
    return o.groupBy("seg").agg(F.count("*").alias("n"), F.avg("PerformanceRatio").alias("ratio"))


@query("mod10_solar_residual_calibration")
def _(spark, d):
    i = ML.latest_rows_hold_out(materialise(intervals(spark, d), spark).where("Forecast_kWh > 0"), 0.2)
    o = ML.performance_ratio(i.where("not holdout"), SOLF, "Forecast_kWh", lo=0.6, hi=1.2)
    months = SO.month_factors(o.withColumn("r", F.col("Forecast_kWh") * F.col("PerformanceRatio")), "r", lo=0.5)
    h = SO.lookup_month(i.where("holdout"), months)
    e0, e1 = F.sum(F.abs(F.col("Forecast_kWh") - F.col("Actual_kWh"))), F.sum(F.abs(F.col("Forecast_kWh") * F.col("SeasonalCalibrationFactor") - F.col("Actual_kWh")))
    return h.groupBy("seg").agg(F.count("*").alias("n"), (e0 / F.sum("Actual_kWh")).alias("wmape_base"), (e1 / F.sum("Actual_kWh")).alias("wmape_calibrated"))


@query("sol07_temporal_holdout")
def _(spark, d):
    i = ML.latest_rows_hold_out(materialise(intervals(spark, d), spark).where("Forecast_kWh > 0"), 0.1)
    f = SO.regime_factors(i.where("not holdout"), "Forecast_kWh", lo=0.6)
    o = SO.lookup_regime(i.where("holdout"), f).withColumn("Forecast_kWh", F.col("Forecast_kWh") * F.col("RegimeCalibrationFactor")).withColumn("Forecast_MW", F.col("Forecast_kWh") / 1000)
    return SO.solar_slices(o)


@query("mod11_geographic_clusters")
def _(spark, d):
    return ML.cluster_sites(site(spark, d), 4).select("site", "WeatherCluster")


@query("top04_cluster_representatives", ctes("site") + """,
w AS (SELECT cluster, coalesce(sum(capacity_kw*"Latitude")/nullif(sum(capacity_kw),0), avg("Latitude")) AS la, coalesce(sum(capacity_kw*"Longitude")/nullif(sum(capacity_kw),0), avg("Longitude")) AS lo FROM v_site GROUP BY 1)
SELECT v.cluster, arg_min(site, ((("Latitude"-la)*("Latitude"-la) + ("Longitude"-lo)*("Longitude"-lo)), site)) AS site, sum(capacity_kw) AS capacity_kw, CAST(count(*) AS BIGINT) AS sites FROM v_site v JOIN w USING (cluster) GROUP BY 1""", r4=["capacity_kw"])
def _(spark, d):
    return ML.representatives(site(spark, d), "cluster")


@query("mod12_feature_importance")
def _(spark, d):
    return ML.importance(ML.fit(model_rows(spark, d), FEATS, ACT, iters=3, depth=3), spark)


# ---- streams ------------------------------------------------------------------------------------

def staged(spark, df, parts=None):
    """The given rows as a folder of files for a stream to read, in ``parts`` steps of time if asked for."""
    path = shared_dir(spark)
    (df.repartitionByRange(parts, "DT") if parts else df).write.parquet(path)
    return path, df.schema


def drained(spark, stream, mode="append", schema=None):
    out, ck = shared_dir(spark), shared_dir(spark)
    J.run_available(stream, out, ck, mode, "parquet")
    return spark.read.schema(stream.schema).parquet(out)


@query("str01_stream_completed_hours", ctes("reading") + """,
h AS (SELECT series, date_trunc('hour', DT) AS hh, avg(value) AS m, count(*) AS n, max(DT) AS ld FROM v_reading GROUP BY 1, 2), mx AS (SELECT max(DT) AS m FROM v_reading)
SELECT series, CAST(hh + INTERVAL 1 HOUR AS VARCHAR) AS DT, h.m AS MWH, CAST(n AS BIGINT) AS n FROM h, mx WHERE n >= 2 AND epoch(ld)-epoch(hh) >= 1800 AND hh + INTERVAL 1 HOUR <= mx.m - INTERVAL 2 HOUR""", r6=["MWH"])
def _(spark, d):
    path, schema = staged(spark, reading(spark, d).select("series", "DT", "value"))
    st = J.completed_hours(J.file_stream(spark, path, schema), ["series"], "value", "2 hours", 2, 30)
    return drained(spark, st).select("series", s("DT"), "MWH", "n")


@query("str03_stream_sliding_stats", ctes("reading") + """,
mx AS (SELECT max(DT) AS m FROM v_reading), w AS (SELECT series, value, DT, date_trunc('hour', DT) - to_hours(CAST(k AS INTEGER)) AS st FROM v_reading, range(0, 24) t(k))
SELECT series, CAST(st AS VARCHAR) AS start, avg(value) AS avg, stddev_samp(value) AS std, CAST(count(*) AS BIGINT) AS n FROM w, mx WHERE st + INTERVAL 24 HOUR <= mx.m - INTERVAL 2 HOUR GROUP BY 1, 2""", r6=["avg", "std"])
def _(spark, d):
    path, schema = staged(spark, reading(spark, d).select("series", "DT", "value"))
    st = J.sliding_stats(J.file_stream(spark, path, schema), ["series"], "value")
    return drained(spark, st).select("series", s("start"), "avg", "std", "n")


@query("str02_stream_keep_last", ctes("reading") + """
SELECT series, CAST(date_trunc('hour', DT) AS VARCHAR) AS DT, arg_max(value, event_id) AS value FROM v_reading GROUP BY 1, 2""", r6=["value"])
def _(spark, d):
    r = reading(spark, d).select("series", F.date_trunc("hour", "DT").alias("DT"), "event_id", "value", F.to_date("DT").alias("Date"))
    path, schema = staged(spark, r, 3)
    out, ck = shared_dir(spark), shared_dir(spark)
    J.run_batches(J.file_stream(spark, path, schema, 1), J.upsert_latest(out, ["series", "DT"], ["event_id"]), ck)
    return spark.read.parquet(out).select("series", s("DT"), "value")


@query("str02_stream_first_seen", ctes("reading") + """
SELECT series, CAST(count(DISTINCT DT) AS BIGINT) AS n FROM v_reading GROUP BY 1""")
def _(spark, d):
    r = reading(spark, d).select("series", "DT", "value")
    path, schema = staged(spark, r.unionByName(r))
    return drained(spark, J.first_seen(J.file_stream(spark, path, schema), ["series"], "60 days")).groupBy("series").agg(F.count("*").alias("n"))


@query("str04_stream_live_error", ctes("load") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, avg(MWH - (50 + hour(DT))) AS bias FROM v_load GROUP BY 1""", r6=["bias"])
def _(spark, d):
    l = load(spark, d).select("series", "DT", F.col("MWH").alias(ACT))
    path, schema = staged(spark, l)
    fc = l.select("series", "DT", (50 + F.hour("DT")).cast("double").alias("Forecast_MWH"))
    return drained(spark, J.live_error(J.file_stream(spark, path, schema), fc, ["series"])).groupBy("series").agg(F.count("*").alias("n"), F.avg("Residual_MWH").alias("bias"))


@query("str05_stream_residual_tracker")
def _(spark, d):
    l = load(spark, d).select("series", "DT", (F.col("MWH") - (50 + F.hour("DT"))).alias("Residual_MWH"))
    path, schema = staged(spark, l, 2)
    o = drained(spark, J.residual_tracker(J.file_stream(spark, path, schema)))
    return o.groupBy("series").agg(F.max("n").alias("n"), F.max_by("ewma", "n").alias("ewma"))


@query("str06_stream_revisable_tail", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, TempF + CASE WHEN DT >= TIMESTAMP '2024-01-22' THEN 1 ELSE 0 END AS t FROM v_weather""")
def _(spark, d):
    w = weather(spark, d).select("series", "DT", F.col("TempF").alias("t"), F.to_date("DT").alias("Date"), F.lit(0).alias("rev"))
    tail = w.where("DT >= TIMESTAMP'2024-01-22'").withColumns({"t": F.col("t") + 1, "rev": F.lit(1)})
    out, ck, path = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    for part in (w, tail):
        part.write.mode("append").parquet(path)
        J.run_batches(J.file_stream(spark, path, w.schema), J.upsert_latest(out, ["series", "DT"], ["rev"]), ck)
    return spark.read.parquet(out).select("series", s("DT"), "t")


@query("str07_stream_heat_sessions", ctes("daily") + """,
f AS (SELECT *, "Date" - CAST(row_number() OVER (ORDER BY "Date") AS INTEGER) AS isl FROM v_daily WHERE Temperature_DailyMax >= 90), r AS (SELECT min("Date") AS a, max("Date") AS b, count(*) AS days, max(Temperature_DailyMax) AS peak FROM f GROUP BY isl), mx AS (SELECT max("Date") AS m FROM v_daily WHERE Temperature_DailyMax >= 90)
SELECT CAST(CAST(a AS TIMESTAMP) AS VARCHAR) AS start, CAST(days AS BIGINT) AS days, peak FROM r, mx WHERE CAST(b AS TIMESTAMP) + INTERVAL 36 HOUR <= CAST(m AS TIMESTAMP) - INTERVAL 2 DAY""", r6=["peak"])
def _(spark, d):
    x = daily(spark, d).select(F.lit("all").alias("series"), F.col("Date").cast("timestamp").alias("DT"), "Temperature_DailyMax")
    path, schema = staged(spark, x)
    return drained(spark, J.hot_sessions(J.file_stream(spark, path, schema), ["series"], 90.0)).select(s("start"), "days", "peak")

