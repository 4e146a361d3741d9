"""Queries: metrics, slices, gates, coverage, audits of the replay cube."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import buckets as B
from ..operators import metrics as M
from ..operators import scorecards as SC
from .a_features import CLOUD_BUCKET_SQL, LOSS, PEAK_BAND_SQL, QUART_CASE, QUART_SQL, TEMP_BUCKET_SQL
from .base import STAGES, ctes, query, replay

ACT, FIN, RAW = "Actual_MWH", "Final_Forecast_MWH", "Raw_Forecast_MWH"
METRICS = ("Actual_Mean_MWH", "Forecast_Mean_MWH", "Bias_MWH", "MAE_MWH", "RMSE_MWH", "MAPE_PCT", "Underforecast_Rate_PCT",
           "Max_Underforecast_MWH", "Max_Overforecast_MWH")


def m_sql(f, a='"Actual_MWH"', p90=True):
    """DuckDB text of the metric columns for forecast expression ``f``."""
    out = f"""CAST(count(*) AS BIGINT) AS "N", avg({a}) AS "Actual_Mean_MWH", avg({f}) AS "Forecast_Mean_MWH", avg({a}-{f}) AS "Bias_MWH", avg(abs({a}-{f})) AS "MAE_MWH",
 sqrt(avg(({a}-{f})*({a}-{f}))) AS "RMSE_MWH", avg(CASE WHEN abs({a}) > 1e-9 THEN abs({a}-{f})/abs({a})*100 END) AS "MAPE_PCT",
 avg(CASE WHEN {a}-{f} > 0 THEN 100.0 ELSE 0.0 END) AS "Underforecast_Rate_PCT", max({a}-{f}) AS "Max_Underforecast_MWH", greatest(max({f}-{a}),0) AS "Max_Overforecast_MWH\""""
    return out + (f', quantile_cont(abs({a}-{f}), 0.9) AS "P90_AbsError_MWH"' if p90 else "")


STAGE_SQL = "v_st AS (" + " UNION ALL ".join(f"SELECT *, '{s}' AS \"Stage\", \"{c}\" AS f FROM v_bt" for s, c in STAGES.items()) + ")"
BUCKET_SQL = f"""{QUART_SQL.format(c=LOSS)},
v_bb AS (SELECT v_bt.*, {TEMP_BUCKET_SQL} AS "DailyMaxTempBucket", {CLOUD_BUCKET_SQL} AS "CloudCoverBucket", {QUART_CASE.format(c=LOSS)} AS "SolarLossBucket",
  CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=7 THEN 'Days2to7' ELSE 'Days8to16' END AS "Replay_Horizon_Bucket" FROM v_bt, quart)"""
R6 = [*METRICS, "P90_AbsError_MWH"]


def bucketed(df):
    df = B.with_quartile_bucket(df, LOSS, "SolarLossBucket")
    return df.withColumns({"DailyMaxTempBucket": B.daily_max_bucket("Temperature_DailyMax"), "CloudCoverBucket": B.cloud_bucket("CloudCover_Norm"),
                           "Replay_Horizon_Bucket": B.horizon_bucket("Forecast_Day", "replay"), "IsHoliday": F.lit(0)})


@query("agg03_grouped_accuracy", ctes("bt") + f"""
SELECT series, Hour, {m_sql(FIN)} FROM v_bt GROUP BY 1, 2 HAVING count(*) >= 5""", r6=R6)
def _(spark, d):
    return M.grouped_metrics(replay(spark, d, "series", "Hour", ACT, FIN), ["series", "Hour"], FIN, min_count=5)


@query("agg04_overall_metrics", ctes("bt") + f"""
SELECT {m_sql(FIN)}, max(Actual_MWH) AS peak, arg_max({FIN}, (Actual_MWH, -epoch(DT))) AS at_peak FROM v_bt""", r6=[*R6, "peak", "at_peak"])
def _(spark, d):
    o = M.grouped_metrics(replay(spark, d, "DT", ACT, FIN), [], FIN, peak_at="DT")
    return o.withColumnsRenamed({"Actual_Peak_MWH": "peak", "Forecast_At_Actual_Peak_MWH": "at_peak"}).drop("Underforecast_At_Actual_Peak_MWH")


@query("agg06_metrics_per_stage", ctes("bt") + "," + STAGE_SQL + f"""
SELECT "Stage", Season, {m_sql('f')} FROM v_st GROUP BY 1, 2""", r6=R6)
def _(spark, d):
    return M.stage_metrics(replay(spark, d, "Season", ACT, *STAGES.values()), STAGES, ["Season"])


@query("agg06_stage_skill", ctes("bt") + "," + STAGE_SQL + """,
m AS (SELECT "Stage", avg(abs(Actual_MWH-f)) AS mae, avg(Actual_MWH-f) AS b FROM v_st GROUP BY 1)
SELECT "Stage", (SELECT mae FROM m WHERE "Stage"='raw') - mae AS gain, ((SELECT mae FROM m WHERE "Stage"='raw') - mae)/(SELECT mae FROM m WHERE "Stage"='raw')*100 AS skill,
 abs((SELECT b FROM m WHERE "Stage"='raw')) - abs(b) AS bias_gain, mae - (SELECT mae FROM m WHERE "Stage"='final_corrected') AS vs_final FROM m""", r6=["gain", "skill", "bias_gain", "vs_final"])
def _(spark, d):
    m = M.versus(M.stage_metrics(replay(spark, d, ACT, *STAGES.values()), STAGES, p90=False))
    return m.select("Stage", F.col("MAE_Improvement_vs_Raw_MWH").alias("gain"), F.col("Skill_vs_Raw_PCT").alias("skill"),
                    F.col("Bias_Abs_Improvement_vs_Raw_MWH").alias("bias_gain"), F.col("MAE_Delta_vs_Final_MWH").alias("vs_final"))


SEGMENTS = {
    "Season_Hour": ["Season", "Hour"], "Season_HourGroup": ["Season", "HourGroup"], "Month_Hour": ["Month", "Hour"],
    "DailyMaxTempBucket_HourGroup": ["DailyMaxTempBucket", "HourGroup"], "CloudCoverBucket_HourGroup": ["CloudCoverBucket", "HourGroup"],
    "SolarLossBucket_HourGroup": ["SolarLossBucket", "HourGroup"], "Temp_Cloud_HourGroup": ["DailyMaxTempBucket", "CloudCoverBucket", "HourGroup"],
    "Forecast_Day_HourGroup": ["Forecast_Day", "HourGroup"], "Weekend_Hour": ["IsWeekend", "Hour"],
}
_SEG = " UNION ALL ".join(
    "SELECT '%s' AS \"Segment\", '%s' AS \"SegmentKeys\", concat_ws('|', %s) AS \"SegmentValue\", %s FROM v_bb GROUP BY 1, 2, 3 HAVING count(*) >= 6" % (
        n, "+".join(k), ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '<missing>')" for c in k), m_sql(FIN)) for n, k in SEGMENTS.items())
BB_COLS = ("Season", "Hour", "HourGroup", "Month", "Temperature_DailyMax", "CloudCover_Norm", LOSS, "Forecast_Day", "IsWeekend", ACT, FIN)


@query("agg07_segment_grid", ctes("bt") + "," + BUCKET_SQL + "\nSELECT 'final_corrected' AS \"Stage\", * FROM (" + _SEG + ")", r6=R6)
def _(spark, d):
    return M.segment_metrics(bucketed(replay(spark, d, *BB_COLS)), SEGMENTS, {"final_corrected": FIN}, 6)


EV_SQL = """
hd AS (SELECT origin_id, series, "Date", max(Temperature_DailyMax) AS t FROM v_bt GROUP BY 1, 2, 3),
hr AS (SELECT *, t - lag(t) OVER w AS ramp, sum(CASE WHEN t >= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY origin_id, series ORDER BY "Date") AS isl FROM hd WINDOW w AS (PARTITION BY origin_id, series ORDER BY "Date")),
hc AS (SELECT *, CASE WHEN t >= 100 THEN sum(CASE WHEN t >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY origin_id, series, isl ORDER BY "Date") ELSE 0 END AS run FROM hr),
v_ev AS (SELECT v_bb.*, ramp, run FROM v_bb JOIN hc USING (origin_id, series, "Date")),
slices AS (""" + " UNION ALL ".join(f"SELECT '{n}' AS \"Slice\", * FROM v_ev WHERE {w}" for n, w in {
    "Overall": "TRUE", "PeakWindowHours14to18": "Hour BETWEEN 14 AND 18", "PeakWindowHours14to20": "Hour BETWEEN 14 AND 20", "LatePeakHours19to20": "Hour BETWEEN 19 AND 20",
    "HE18to20CodeHours17to19": "Hour BETWEEN 17 AND 19", "HotPeakDailyMax90Plus": "HourGroup='Peak' AND Temperature_DailyMax >= 90",
    "HotRampPeak100PlusRamp2HE16to20": "Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 100 AND ramp >= 2",
    "HeatPersistencePeak100PlusConsec3HE16to20": "Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 100 AND run >= 3",
    "ExtremeHeat105PlusPeakWindowHours14to20": "Hour BETWEEN 14 AND 20 AND Temperature_DailyMax >= 105",
    "ShoulderSeasonHeatTransition": "Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND Temperature_DailyMax BETWEEN 75 AND 93",
    "CloudSolarMidday": "HourGroup='Midday' AND (coalesce(\"CloudCoverBucket\",'') IN ('Mostly Cloudy','Overcast') OR \"SolarLossBucket\" IN ('High','Extreme'))",
    "WeekendHours": "IsWeekend = 1", "LongHorizonDays8to16": "Forecast_Day BETWEEN 8 AND 16"}.items()) + """
 UNION ALL SELECT 'ScoredSeason:' || Season, * FROM v_ev UNION ALL SELECT 'Horizon:' || "Replay_Horizon_Bucket", * FROM v_ev)"""
EV_COLS = ("origin_id", "series", "Date", *BB_COLS)


def eventful(spark, d, *more):
    return SC.add_origin_heat(bucketed(replay(spark, d, *EV_COLS, *more)), ["origin_id", "series"])


@query("prj10_event_slices", ctes("bt") + "," + BUCKET_SQL + "," + EV_SQL + """
SELECT "Slice", CAST(count(*) AS BIGINT) AS n, sum(Actual_MWH) AS s FROM slices WHERE "Slice" NOT LIKE '%:%' AND "Slice" <> 'Overall' GROUP BY 1""", r4=["s"])
def _(spark, d):
    return M.explode_slices(eventful(spark, d), SC.event_slices()).groupBy("Slice").agg(F.count("*").alias("n"), F.sum(ACT).alias("s"))


@query("agg08_seasonal_scorecard", ctes("bt") + "," + BUCKET_SQL + "," + EV_SQL + f"""
SELECT "Slice", 'final_corrected' AS "Stage", {m_sql(FIN)} FROM slices GROUP BY 1""", r6=R6)
def _(spark, d):
    return SC.seasonal_scorecard(eventful(spark, d), {"final_corrected": FIN}, {"ScoredSeason": "Season", "Horizon": "Replay_Horizon_Bucket"})


@query("win14_stage_marginal", ctes("bt") + "," + STAGE_SQL + """,
m AS (SELECT Season AS "Slice", "Stage", avg(abs(Actual_MWH-f)) AS mae, CASE "Stage" WHEN 'raw' THEN 1 WHEN 'residual_calibrated' THEN 2 WHEN 'recent_corrected' THEN 3 ELSE 4 END AS p FROM v_st GROUP BY 1, 2)
SELECT "Slice", "Stage", mae, mae - lag(mae) OVER w AS d, CAST(coalesce(mae - lag(mae) OVER w > 0, FALSE) AS INT) AS worse FROM m WINDOW w AS (PARTITION BY "Slice" ORDER BY p)""", r6=["mae", "d"])
def _(spark, d):
    m = M.stage_metrics(replay(spark, d, "Season", ACT, *STAGES.values()), STAGES, ["Season"], p90=False).withColumnRenamed("Season", "Slice")
    o = M.marginal(m, list(STAGES))
    return o.select("Slice", "Stage", F.col("MAE_MWH").alias("mae"), F.col("Marginal_dMAE_MWH").alias("d"), F.col("Worsens_Slice").cast("int").alias("worse"))


@query("top03_best_stage", ctes("bt") + "," + STAGE_SQL + """,
m AS (SELECT Season, "Stage", avg(abs(Actual_MWH-f)) AS mae FROM v_st GROUP BY 1, 2)
SELECT Season, arg_min("Stage", (mae, "Stage")) AS best, min(mae) AS best_mae, max(CASE WHEN "Stage"='final_corrected' THEN mae END) - min(mae) AS gain FROM m GROUP BY 1""", r6=["best_mae", "gain"])
def _(spark, d):
    m = M.stage_metrics(replay(spark, d, "Season", ACT, *STAGES.values()), STAGES, ["Season"], p90=False)
    o = M.stage_leader(m, keys=["Season"])
    return o.select("Season", F.col("Best_Stage").alias("best"), F.col("Best_MAE_MWH").alias("best_mae"), F.col("Best_Stage_MAE_Improvement_vs_Final_MWH").alias("gain"))


@query("top01_top_errors", ctes("bt") + """,
e AS (SELECT row_id, Actual_MWH - Final_Forecast_MWH AS r FROM v_bt),
k AS (SELECT 'under' AS side, row_id, r, row_number() OVER (ORDER BY abs(r) DESC, row_id) AS rk FROM e WHERE r > 0 UNION ALL SELECT 'over', row_id, r, row_number() OVER (ORDER BY abs(r) DESC, row_id) FROM e WHERE r < 0)
SELECT side, row_id, r, CAST(rk AS INT) AS rk FROM k WHERE rk <= 50""", r6=["r"])
def _(spark, d):
    o = M.top_errors(replay(spark, d, "row_id", ACT, FIN), 50, FIN)
    return o.select(F.col("Side").alias("side"), "row_id", F.col("Residual").alias("r"), F.col("Rank").alias("rk"))


@query("agg20_daily_peak_miss", ctes("bt") + """,
g AS (SELECT series, "Date", arg_max(Hour, (Actual_MWH, -epoch(DT), -row_id)) AS ah, max(Actual_MWH) AS ap, arg_max(Final_Forecast_MWH, (Actual_MWH, -epoch(DT))) AS fa,
  arg_max(DT, (Final_Forecast_MWH, -epoch(DT))) AS fdt, arg_max(DT, (Actual_MWH, -epoch(DT))) AS adt, max(Final_Forecast_MWH) AS fp, sum(Final_Forecast_MWH)-sum(Actual_MWH) AS err, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae
  FROM v_bt WHERE Hour BETWEEN 14 AND 20 GROUP BY 1, 2)
SELECT series, CAST("Date" AS VARCHAR) AS Date, CAST(ah AS INT) AS ah, ap, ap - fa AS under, fp, (epoch(fdt)-epoch(adt))/3600 AS timing, err, mae FROM g""", r6=["ap", "under", "fp", "timing", "err", "mae"])
def _(spark, d):
    o = M.daily_peaks(replay(spark, d, "series", "Date", "DT", "Hour", ACT, FIN), ["series", "Date"], FIN, hours=range(14, 21))
    return o.select("series", F.col("Date").cast("string").alias("Date"), F.col("Actual_Peak_Hour").alias("ah"), F.col("Actual_Peak_MWH").alias("ap"),
                    F.col("Underforecast_At_Actual_Peak_MWH").alias("under"), F.col("Forecast_Peak_MWH").alias("fp"), F.col("Daily_Peak_Timing_Error_Hours").alias("timing"),
                    F.col("Daily_Energy_Error_MWH").alias("err"), F.col("Daily_MAE_MWH").alias("mae"))


@query("agg24_origin_coverage", ctes("bt") + """
SELECT origin_id, CAST(min(DT) AS VARCHAR) AS mn, CAST(max(DT) AS VARCHAR) AS mx, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT "Date") AS BIGINT) AS days,
 array_to_string(list_sort(list(DISTINCT CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=7 THEN 'Days2to7' ELSE 'Days8to16' END)), '|') AS buckets FROM v_bt GROUP BY 1""")
def _(spark, d):
    b = replay(spark, d, "origin_id", "DT", "Date", "Forecast_Day").withColumn("b", B.horizon_bucket("Forecast_Day", "replay"))
    return b.groupBy("origin_id").agg(F.min("DT").cast("string").alias("mn"), F.max("DT").cast("string").alias("mx"), F.count("*").alias("n"), F.count_distinct("Date").alias("days"),
                                      F.array_join(F.array_sort(F.collect_set("b")), "|").alias("buckets"))


@query("agg25_bias_pivot", ctes("bt") + """
SELECT origin_id, """ + ", ".join(f"avg(CASE WHEN Forecast_Day={k} THEN Actual_MWH-Raw_Forecast_MWH END) AS d{k}" for k in range(1, 17)) + " FROM v_bt GROUP BY 1", r6=[f"d{k}" for k in range(1, 17)])
def _(spark, d):
    b = replay(spark, d, "origin_id", "Forecast_Day", ACT, RAW).withColumn("e", F.col(ACT) - F.col(RAW))
    o = b.groupBy("origin_id").pivot("Forecast_Day", list(range(1, 17))).agg(F.avg("e"))
    return o.withColumnsRenamed({str(k): f"d{k}" for k in range(1, 17)})


@query("agg26_origin_bias_in_gate", ctes("bt") + """
SELECT origin_id, CAST(count(*) AS BIGINT) AS n, avg(Actual_MWH-Final_Forecast_MWH) AS bias, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae FROM v_bt WHERE Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 GROUP BY 1""", r6=["bias", "mae"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "Hour", "Temperature_DailyMax", ACT, FIN).where(SC.hot_peak())
    r = F.col(ACT) - F.col(FIN)
    return b.groupBy("origin_id").agg(F.count("*").alias("n"), F.avg(r).alias("bias"), F.avg(F.abs(r)).alias("mae"))


@query("agg27_monthly_totals_nearest_horizon", ctes("bt") + """,
o AS (SELECT series, DT, arg_min(Actual_MWH, (Forecast_Day, row_id)) AS a, arg_min(Final_Forecast_MWH, (Forecast_Day, row_id)) AS f FROM v_bt GROUP BY 1, 2)
SELECT series, CAST(year(DT)*100+month(DT) AS BIGINT) AS ym, CAST(count(*) AS BIGINT) AS n, sum(a) AS a, sum(f) AS f, sum(f)-sum(a) AS diff, (sum(f)-sum(a))/sum(a)*100 AS pct FROM o GROUP BY 1, 2""", r4=["a", "f", "diff", "pct"])
def _(spark, d):
    from ..core import keep_first, safe_div
    one = keep_first(replay(spark, d, "series", "DT", "row_id", "Forecast_Day", ACT, FIN), ["series", "DT"], ["Forecast_Day", "row_id"])
    ym = (F.year("DT") * 100 + F.month("DT")).cast("long").alias("ym")
    g = one.groupBy("series", ym).agg(F.count("*").alias("n"), F.sum(ACT).alias("a"), F.sum(FIN).alias("f"))
    return g.withColumns({"diff": F.col("f") - F.col("a"), "pct": safe_div(F.col("f") - F.col("a"), F.col("a")) * 100})


# as-forecast weather of the replay: small deterministic shifts of the realised columns
def realism(df):
    k = F.col("row_id")
    return df.withColumns({
        "prev_tmax": F.col("Temperature_DailyMax") + (k % 13 - 6), "prev_cloud": F.col("CloudCover_Norm") + (k % 9 - 4) / 10.0,
        "prev_loss": F.col(LOSS) + (k % 7 - 3), "prev_final": F.col(FIN) + (k % 11 - 5) * 0.3, "lead": (k % 8 + 1).cast("int"),
    })


REAL_SQL = """v_re AS (SELECT *, Temperature_DailyMax + (row_id % 13 - 6) AS prev_tmax, CloudCover_Norm + (row_id % 9 - 4)/10e0 AS prev_cloud, BTM_Solar_Loss_From_ClearSky_MW + (row_id % 7 - 3) AS prev_loss,
  Final_Forecast_MWH + (row_id % 11 - 5)*0.3 AS prev_final, CAST(row_id % 8 + 1 AS INT) AS lead,
  CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=7 THEN 'Days2to7' ELSE 'Days8to16' END AS hb FROM v_bt)"""
RE_COLS = ("row_id", "Temperature_DailyMax", "CloudCover_Norm", LOSS, FIN, ACT, "Forecast_Day", "Hour", "HourGroup", "Season", "IsWeekend")


@query("agg28_weather_error_by_lead", ctes("bt") + "," + REAL_SQL + """,
u AS (SELECT 'temp' AS v, lead, hb, Temperature_DailyMax AS r, prev_tmax AS p FROM v_re UNION ALL SELECT 'cloud', lead, hb, CloudCover_Norm, prev_cloud FROM v_re UNION ALL SELECT 'loss', lead, hb, BTM_Solar_Loss_From_ClearSky_MW, prev_loss FROM v_re)
SELECT v AS "Weather_Variable", lead, hb, CAST(count(*) AS BIGINT) AS "N", avg(r) AS "Realized_Mean", avg(p) AS "Previous_Run_Mean", avg(p-r) AS "Bias_PreviousMinusRealized", avg(abs(p-r)) AS "MAE_PreviousVsRealized", quantile_cont(abs(p-r), 0.9) AS "P90_AbsError"
FROM u WHERE r IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2, 3""", r6=["Realized_Mean", "Previous_Run_Mean", "Bias_PreviousMinusRealized", "MAE_PreviousVsRealized", "P90_AbsError"])
def _(spark, d):
    r = realism(replay(spark, d, *RE_COLS)).withColumn("hb", B.horizon_bucket("Forecast_Day", "replay"))
    return SC.weather_error_by_lead(r, {"temp": ("Temperature_DailyMax", "prev_tmax"), "cloud": ("CloudCover_Norm", "prev_cloud"), "loss": (LOSS, "prev_loss")}, "lead", "hb")


DRIVER_SQL = """v_dr AS (SELECT *, abs(prev_tmax-Temperature_DailyMax) AS te, abs(prev_cloud-CloudCover_Norm) AS ce, abs(prev_loss-BTM_Solar_Loss_From_ClearSky_MW) AS le FROM v_re),
v_d2 AS (SELECT *, CASE WHEN te >= 5 THEN 1 ELSE 0 END AS st, CASE WHEN ce >= 0.35 THEN 1 ELSE 0 END AS sc, CASE WHEN le >= 3 THEN 1 ELSE 0 END AS sl,
  CASE WHEN te >= 2 THEN te/2 ELSE 0 END AS mt, CASE WHEN ce >= 0.2 THEN ce/0.2 ELSE 0 END AS mc, CASE WHEN le >= 1.25 THEN le/1.25 ELSE 0 END AS ml FROM v_dr),
v_lb AS (SELECT *, CASE WHEN st+sc+sl >= 2 THEN 'multi_weather_error' WHEN st=1 THEN 'temp' WHEN sc=1 THEN 'cloud' WHEN sl=1 THEN 'solar_loss' WHEN greatest(mt,mc,ml)=0 THEN 'low_weather_error'
   WHEN mt >= mc AND mt >= ml THEN 'temp_moderate' WHEN mc >= ml THEN 'cloud_moderate' ELSE 'solar_loss_moderate' END AS driver,
  CASE WHEN Forecast_Day >= 8 THEN 'long_horizon_days8to16' WHEN HourGroup='Peak' AND Temperature_DailyMax >= 90 THEN 'hot_peak' WHEN HourGroup='Midday' AND (BTM_Solar_Loss_From_ClearSky_MW >= 1.25 OR CloudCover_Norm >= 0.6) THEN 'cloudy_solar_loss_midday'
   WHEN Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND Temperature_DailyMax BETWEEN 75 AND 93 THEN 'shoulder_heat_transition' WHEN IsWeekend=1 THEN 'weekend' ELSE 'normal' END AS event,
  CASE WHEN Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND Temperature_DailyMax BETWEEN 75 AND 93 THEN 'shoulder_heat_transition' WHEN HourGroup='Midday' AND (BTM_Solar_Loss_From_ClearSky_MW >= 1.25 OR CloudCover_Norm >= 0.6) THEN 'cloudy_solar_loss_midday'
   WHEN HourGroup='Peak' AND Temperature_DailyMax >= 90 THEN 'hot_peak' WHEN Forecast_Day >= 8 THEN 'long_horizon_days8to16' ELSE 'normal' END AS islice FROM v_d2)"""


def labelled(spark, d):
    r = realism(replay(spark, d, *RE_COLS)).withColumn("IsHoliday", F.lit(0))
    te, ce, le = F.col("prev_tmax") - F.col("Temperature_DailyMax"), F.col("prev_cloud") - F.col("CloudCover_Norm"), F.col("prev_loss") - F.col(LOSS)
    return r.withColumns({"driver": SC.weather_error_driver(te, ce, le), "event": SC.weather_event_label(), "islice": SC.interval_event_slice(), "te": F.abs(te), "ce": F.abs(ce), "le": F.abs(le)})


@query("prj21_event_label_and_driver", ctes("bt") + "," + REAL_SQL + "," + DRIVER_SQL + """
SELECT driver, event, CAST(count(*) AS BIGINT) AS n FROM v_lb GROUP BY 1, 2""")
def _(spark, d):
    return labelled(spark, d).groupBy("driver", "event").agg(F.count("*").alias("n"))


@query("prj33_interval_event_last_wins", ctes("bt") + "," + REAL_SQL + "," + DRIVER_SQL + """
SELECT islice, CAST(count(*) AS BIGINT) AS n FROM v_lb GROUP BY 1""")
def _(spark, d):
    return labelled(spark, d).groupBy("islice").agg(F.count("*").alias("n"))


@query("agg29_weather_sensitivity", ctes("bt") + "," + REAL_SQL + "," + DRIVER_SQL + """,
s AS (SELECT 'Overall' AS "Slice", * FROM v_lb UNION ALL SELECT 'Driver:' || driver, * FROM v_lb UNION ALL SELECT 'Event:' || event, * FROM v_lb UNION ALL SELECT 'Lead:' || lead, * FROM v_lb UNION ALL SELECT 'Driver_Event:' || driver || '|' || event, * FROM v_lb)
SELECT "Slice", CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS real_mae, avg(abs(Actual_MWH-prev_final)) AS prev_mae, avg(abs(Actual_MWH-prev_final) - abs(Actual_MWH-Final_Forecast_MWH)) AS delta,
 avg(CASE WHEN abs(Actual_MWH-prev_final) > abs(Actual_MWH-Final_Forecast_MWH) THEN 100.0 ELSE 0.0 END) AS harm, quantile_cont(abs(Actual_MWH-prev_final), 0.9) AS p90 FROM s GROUP BY 1""", r6=["real_mae", "prev_mae", "delta", "harm", "p90"])
def _(spark, d):
    return SC.weather_sensitivity(labelled(spark, d), FIN, "prev_final", {"Driver": ["driver"], "Event": ["event"], "Lead": ["lead"], "Driver_Event": ["driver", "event"]})


@query("agg33_peak_window_bias", ctes("bt") + f""",
w AS (SELECT *, CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=3 THEN 'Days2-3' WHEN Forecast_Day<=7 THEN 'Days4-7' ELSE 'Days8-16' END AS fb, CASE WHEN Hour IN (14,15) THEN 'HE14-15' ELSE 'HE16-18' END AS hb, {PEAK_BAND_SQL} AS tb,
 CASE WHEN CloudCover_Norm <= 0.1 THEN 'Clear/Low' WHEN CloudCover_Norm <= 0.35 THEN 'Some/Partly' WHEN CloudCover_Norm <= 0.6 THEN 'Cloudy' WHEN CloudCover_Norm <= 1.001 THEN 'Overcast' END AS cb,
 CASE WHEN Raw_Forecast_MWH-MWH_SameHour7DayMean <= -10 THEN '<-10' WHEN Raw_Forecast_MWH-MWH_SameHour7DayMean <= 10 THEN '-10..10' WHEN Raw_Forecast_MWH-MWH_SameHour7DayMean <= 25 THEN '10..25' ELSE '25..50' END AS ab FROM v_bt WHERE Hour BETWEEN 14 AND 18)
SELECT Month, fb, hb, tb, cb, ab, CAST(count(*) AS BIGINT) AS n, sum(Actual_MWH-Final_Forecast_MWH) AS net, sum(greatest(Actual_MWH-Final_Forecast_MWH,0)) AS pos, avg(Actual_MWH-Final_Forecast_MWH) - avg(Actual_MWH-Raw_Forecast_MWH) AS vs_raw,
 quantile_cont(abs(Actual_MWH-Final_Forecast_MWH), 0.9) AS p90 FROM w GROUP BY 1,2,3,4,5,6 HAVING count(*) >= 5""", r6=["net", "pos", "vs_raw", "p90"])
def _(spark, d):
    b = replay(spark, d, "Month", "Hour", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", RAW, "MWH_SameHour7DayMean", ACT, FIN)
    o = SC.peak_bias_scorecard(b, FIN, 5)
    return o.select("Month", F.col("Forecast_Day_Bucket").alias("fb"), F.col("Peak_Hour_Band").alias("hb"), F.col("DailyMaxTempBiasBand").alias("tb"), F.col("CloudCoverBiasBand").alias("cb"),
                    F.col("LagAnchorState").alias("ab"), F.col("N").alias("n"), F.col("Residual_Sum_MWH").alias("net"), F.col("Positive_Residual_Sum_MWH").alias("pos"),
                    F.col("Bias_Delta_vs_Raw_MWH").alias("vs_raw"), F.col("P90_AbsError_MWH").alias("p90"))


_HOT = {"14to20": "Hour BETWEEN 14 AND 20", "16to20": "Hour BETWEEN 16 AND 20", "17to19": "Hour BETWEEN 17 AND 19"}


@query("agg34_extreme_heat_scorecard", ctes("bt") + "," + STAGE_SQL + ", s AS (" + " UNION ALL ".join(f"SELECT '{n}' AS \"Slice\", * FROM v_st WHERE Temperature_DailyMax >= 105 AND {w}" for n, w in _HOT.items()) + f""")
SELECT "Slice", "Stage", {m_sql('f')} FROM s GROUP BY 1, 2""", r6=R6)
def _(spark, d):
    b = replay(spark, d, "Hour", "Temperature_DailyMax", ACT, *STAGES.values()).where("Temperature_DailyMax >= 105")
    s = M.explode_slices(b, {n: F.expr(w) for n, w in _HOT.items()})
    return M.stage_metrics(s, STAGES, ["Slice"])


@query("agg36_training_weight_by_bucket", ctes("bt") + f""",
q AS (SELECT quantile_cont(Actual_MWH, 0.9) AS q90, quantile_cont(Actual_MWH, 0.95) AS q95 FROM v_bt),
w AS (SELECT coalesce({PEAK_BAND_SQL}, 'unknown') AS b, coalesce(Temperature_DailyMax >= 90 AND Hour BETWEEN 16 AND 20, FALSE) AS hot,
  least(greatest(CASE WHEN Actual_MWH >= q90 THEN 1.8 ELSE 1 END * CASE WHEN Actual_MWH >= q95 THEN 3.0 ELSE 1 END * CASE WHEN Temperature_DailyMax >= 90 AND Hour BETWEEN 16 AND 20 AND IsWeekend = 0 THEN 1.7 ELSE 1 END, 0.25), 8) AS w FROM v_bt, q),
t AS (SELECT count(*) AS n, sum(w) AS w FROM w)
SELECT b AS bucket, CAST(count(*) AS BIGINT) AS n, sum(w.w) AS total, 100*sum(w.w)/max(t.w) AS share, CAST(count(*) FILTER (hot) AS BIGINT) AS hot_n, (100*sum(w.w)/max(t.w))/(100.0*count(*)/max(t.n)) AS ratio FROM w, t WHERE b <> 'unknown' GROUP BY 1""", r4=["total", "share", "ratio"])
def _(spark, d):
    from ..operators import training as TR
    b = replay(spark, d, "Hour", "Temperature_DailyMax", "IsWeekend", ACT).withColumn("IsLikelySystemPeakHour", F.when((F.col("IsWeekend") == 0) & F.col("Hour").between(16, 20), 1).otherwise(0))
    o = TR.weight_diagnostic(TR.add_load_weights(b, ACT, TR.Weights(recency_end=1.0)), 90.0)
    return o.where("bucket <> 'unknown'")


@query("agg42_qualifying_row_profile", ctes("bt") + """
SELECT Season, CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN CloudCover_Norm IS NULL THEN 100.0 ELSE 0.0 END) AS null_pct, quantile_cont(BTM_Solar_Loss_From_ClearSky_MW, 0.25) AS q25, quantile_cont(BTM_Solar_Loss_From_ClearSky_MW, 0.75) AS q75,
 CAST(count(*) FILTER (BTM_Solar_Loss_From_ClearSky_MW BETWEEN 1 AND 1.5) AS BIGINT) AS marginal FROM v_bt WHERE HourGroup='Midday' AND (CloudCover_Norm >= 0.6 OR BTM_Solar_Loss_From_ClearSky_MW >= 1.25) GROUP BY 1""", r6=["null_pct", "q25", "q75"])
def _(spark, d):
    from ..core import group_quantiles
    b = replay(spark, d, "Season", "HourGroup", "CloudCover_Norm", LOSS).where((F.col("HourGroup") == "Midday") & ((F.col("CloudCover_Norm") >= 0.6) | (F.col(LOSS) >= 1.25)))
    g = b.groupBy("Season").agg(F.count("*").alias("n"), F.avg(F.when(F.col("CloudCover_Norm").isNull(), 100.0).otherwise(0.0)).alias("null_pct"), F.count(F.when(F.col(LOSS).between(1, 1.5), 1)).alias("marginal"))
    return g.join(group_quantiles(b, ["Season"], LOSS, {"q25": 0.25, "q75": 0.75}), "Season")


@query("rep08_readiness_gates", ctes("bt") + """,
s AS (""" + " UNION ALL ".join(f"SELECT '{n}' AS \"Test\", {lim} AS lim, * FROM v_bt WHERE {w}" for n, lim, w in (
    ("Seasonal rolling origins", 4.5, "TRUE"), ("Day 1 only", 3.5, "Forecast_Day=1"), ("Days 2-3", 5.0, "Forecast_Day BETWEEN 2 AND 3"), ("Days 4-7", 5.0, "Forecast_Day BETWEEN 4 AND 7"),
    ("Hot peak days", 6.0, "Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90"), ("Cloud/solar midday", 7.0, "Hour BETWEEN 10 AND 16 AND (CloudCover_Norm >= 0.6 OR BTM_Solar_Loss_From_ClearSky_MW >= 1.25)"),
    ("Shoulder heat transition", 7.0, "Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND Temperature_DailyMax BETWEEN 75 AND 93"), ("Peak window hours 14-18", 5.5, "Hour BETWEEN 14 AND 18"))) + """)
SELECT "Test", CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae, CAST(avg(abs(Actual_MWH-Final_Forecast_MWH)) <= max(lim) AND ("Test" <> 'Seasonal rolling origins' OR (
  avg(abs(Actual_MWH-Final_Forecast_MWH)/abs(Actual_MWH)*100) <= 3.5 AND abs(avg(Actual_MWH-Final_Forecast_MWH)) <= 0.75)) AS INT) AS pass FROM s GROUP BY 1""", r6=["mae"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Season", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", LOSS, ACT, FIN)
    o = SC.gated(b, SC.readiness_gates(), FIN)
    return o.select("Test", F.col("N").alias("n"), F.col("MAE_MWH").alias("mae"), F.col("Pass").cast("int").alias("pass"))


_PROMO = {"HotPeak": "Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90", "Peak14to18": "Hour BETWEEN 14 AND 18", "Day1": "Forecast_Day=1", "Days2to7": "Forecast_Day BETWEEN 2 AND 7",
          "CloudSolar": "Hour BETWEEN 10 AND 16 AND CloudCover_Norm >= 0.6 AND BTM_Solar_Loss_From_ClearSky_MW >= 1.25"}
CAND = {"residual_calibrated": STAGES["residual_calibrated"], "recent_corrected": STAGES["recent_corrected"]}


@query("rep09_shadow_promotion_audit", ctes("bt") + "," + STAGE_SQL + """,
m AS (SELECT "Stage", avg(abs(Actual_MWH-f)) AS mae, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS fm, avg(Actual_MWH-f) AS b, """ + ", ".join(
    f"avg(CASE WHEN {w} THEN abs(Actual_MWH-f) END) - avg(CASE WHEN {w} THEN abs(Actual_MWH-Final_Forecast_MWH) END) AS \"d_{n}\"" for n, w in _PROMO.items()) + """
 FROM v_st WHERE "Stage" IN ('residual_calibrated','recent_corrected') GROUP BY 1)
SELECT "Stage", mae, fm - mae AS gain, CASE WHEN x = '' THEN 'none' ELSE x END AS failures, CAST(x = '' AND fm - mae > 1e-9 AS INT) AS meets FROM (SELECT *, concat_ws(';', CASE WHEN abs(b) > 0.75 THEN 'Seasonal_Abs_Bias' END, """ + ", ".join(
    f"CASE WHEN NOT (\"d_{n}\" {'< -1e-9' if n == 'Peak14to18' else '<= 1e-9'}) THEN '{n}' END" for n in _PROMO) + ") AS x FROM m)", r6=["mae", "gain"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", LOSS, ACT, FIN, *CAND.values())
    o = SC.promotion_audit(b, CAND, FIN)
    return o.select("Stage", F.col("Candidate_MAE_MWH").alias("mae"), F.col("Candidate_MAE_Improvement_vs_Final_MWH").alias("gain"), F.col("Promotion_Gate_Failures").alias("failures"),
                    F.col("Meets_Promotion_Rule").cast("int").alias("meets"))


@query("rep10_hot_peak_candidates", ctes("bt") + "," + BUCKET_SQL + """,
s AS (SELECT *, 'residual_calibrated' AS "Stage", Learned_Forecast_MWH AS f FROM v_bb UNION ALL SELECT *, 'recent_corrected', Recent_Forecast_MWH FROM v_bb)
SELECT "Replay_Horizon_Bucket" AS hb, Month, "DailyMaxTempBucket" AS tb, "CloudCoverBucket" AS cb, "Stage", CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-f)) AS mae, avg(abs(Actual_MWH-Final_Forecast_MWH)) - avg(abs(Actual_MWH-f)) AS gain,
 abs(avg(Actual_MWH-Final_Forecast_MWH)) - abs(avg(Actual_MWH-f)) AS bias_gain FROM s WHERE Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 GROUP BY 1,2,3,4,5""", r6=["mae", "gain", "bias_gain"])
def _(spark, d):
    b = replay(spark, d, "Month", "Hour", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", ACT, FIN, *CAND.values()).where(SC.hot_peak())
    b = b.withColumns({"hb": B.horizon_bucket("Forecast_Day", "replay"), "tb": B.daily_max_bucket("Temperature_DailyMax"), "cb": B.cloud_bucket("CloudCover_Norm")})
    o = SC.candidate_scorecard(b, CAND, FIN, ["hb", "Month", "tb", "cb"])
    return o.select("hb", "Month", "tb", "cb", "Stage", F.col("N").alias("n"), F.col("MAE_MWH").alias("mae"), F.col("Candidate_MAE_Improvement_vs_Final_MWH").alias("gain"),
                    F.col("Candidate_Bias_Abs_Improvement_vs_Final_MWH").alias("bias_gain"))


@query("rep12_daily_peak_window_scorecard", ctes("bt") + """,
g AS (SELECT origin_id, series, "Date", min(Forecast_Day) AS fd, max(Actual_MWH) AS ap, arg_max(Recent_Forecast_MWH, (Actual_MWH, -epoch(DT))) AS ba, arg_max(Final_Forecast_MWH, (Actual_MWH, -epoch(DT))) AS sa,
  max(Recent_Forecast_MWH) AS bp, max(Final_Forecast_MWH) AS sp, avg(abs(Actual_MWH-Recent_Forecast_MWH)) AS bm, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS sm FROM v_bt WHERE Hour BETWEEN 14 AND 20 GROUP BY 1, 2, 3)
SELECT CASE WHEN fd < 2 THEN 'below' WHEN fd <= 7 THEN 'inside' ELSE 'above' END AS win, CAST(count(*) AS BIGINT) AS days, avg(abs(ap-ba)) AS base_at, avg(abs(ap-sa)) AS shadow_at, avg(abs(ap-bp)) AS base_pk, avg(abs(ap-sp)) AS shadow_pk,
 avg(sm-bm) AS d_mae, CAST(count(*) FILTER (abs(ap-sa) < abs(ap-ba)) AS BIGINT) AS better, CAST(count(*) FILTER (abs(ap-sa) > abs(ap-ba)) AS BIGINT) AS worse FROM g GROUP BY 1""", r6=["base_at", "shadow_at", "base_pk", "shadow_pk", "d_mae"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "series", "Date", "DT", "Hour", "Forecast_Day", ACT, STAGES["recent_corrected"], FIN)
    p = SC.daily_peak_pairs(b, ["origin_id", "series", "Date"], STAGES["recent_corrected"], FIN, range(14, 21))
    w = F.when(F.col("Forecast_Day") < 2, "below").when(F.col("Forecast_Day") <= 7, "inside").otherwise("above")
    return SC.daily_peak_window_summary(p.withColumn("win", w), ["win"])


@query("rep16_stage_bias_in_gate", ctes("bt") + "," + STAGE_SQL + f"""
SELECT "Stage", {m_sql('f', p90=False)} FROM v_st WHERE Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND Temperature_DailyMax BETWEEN 75 AND 93 GROUP BY 1""", r6=METRICS)
def _(spark, d):
    b = replay(spark, d, "Season", "Hour", "Temperature_DailyMax", ACT, *STAGES.values()).where(SC.shoulder_heat())
    return M.stage_metrics(b, STAGES, p90=False)


@query("joi15_full_outer_compare", ctes("bt") + """,
a AS (SELECT Hour, avg(abs(Actual_MWH-Raw_Forecast_MWH)) AS raw FROM v_bt WHERE Forecast_Day=1 AND Hour <= 18 GROUP BY 1), b AS (SELECT Hour, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS fin FROM v_bt WHERE Forecast_Day=1 AND Hour >= 6 GROUP BY 1)
SELECT Hour, raw, fin, fin - raw AS delta FROM a FULL OUTER JOIN b USING (Hour)""", r6=["raw", "fin", "delta"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Forecast_Day", ACT, RAW, FIN).where("Forecast_Day = 1")
    a = b.where("Hour <= 18").groupBy("Hour").agg(F.avg(F.abs(F.col(ACT) - F.col(RAW))).alias("mae"))
    z = b.where("Hour >= 6").groupBy("Hour").agg(F.avg(F.abs(F.col(ACT) - F.col(FIN))).alias("mae"))
    return SC.compare_grouped(a, z, "Hour", "mae", "raw", "fin")


@query("rep06_weather_realism_scorecard", ctes("bt") + "," + REAL_SQL + """,
u AS (SELECT 'realized' AS basis, hb, Actual_MWH, Final_Forecast_MWH AS f FROM v_re UNION ALL SELECT 'as_forecast', hb, Actual_MWH, prev_final FROM v_re)
SELECT basis, hb, """ + m_sql("f") + " FROM u GROUP BY 1, 2", r6=R6)
def _(spark, d):
    r = realism(replay(spark, d, *RE_COLS)).withColumn("hb", B.horizon_bucket("Forecast_Day", "replay"))
    return M.stage_metrics(r, {"realized": FIN, "as_forecast": "prev_final"}, ["hb"]).withColumnRenamed("Stage", "basis")


@query("rep17_search_objective", ctes("bt") + """,
m AS (SELECT avg(abs(Actual_MWH-Final_Forecast_MWH)) AS overall, avg(CASE WHEN Hour BETWEEN 14 AND 18 THEN abs(Actual_MWH-Final_Forecast_MWH) END) AS peak, avg(CASE WHEN Season='Summer' THEN Actual_MWH-Final_Forecast_MWH END) AS warm_bias,
 avg(CASE WHEN Hour BETWEEN 10 AND 16 AND CloudCover_Norm >= 0.6 THEN abs(Actual_MWH-Final_Forecast_MWH) END) AS cloud, avg(CASE WHEN Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90 THEN greatest(Actual_MWH-Final_Forecast_MWH,0) END) AS miss FROM v_bt)
SELECT 0.40*overall + 0.25*peak + 0.20*miss + 0.10*abs(warm_bias) + 0.05*cloud AS objective FROM m""", r6=["objective"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Season", "Temperature_DailyMax", "CloudCover_Norm", ACT, FIN)
    return SC.search_objective(b, FIN)


@query("rep20_scorecard_compare", ctes("bt") + """,
a AS (SELECT Season AS s, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae FROM v_bt WHERE origin_id >= 199801 GROUP BY 1), b AS (SELECT Season AS s, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae FROM v_bt WHERE origin_id < 199801 GROUP BY 1)
SELECT s, a.mae AS now, b.mae AS before, a.mae - b.mae AS change FROM a JOIN b USING (s)""", r6=["now", "before", "change"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "Season", ACT, FIN)
    m = b.groupBy("Season").agg(*[F.avg(F.when(c, F.abs(F.col(ACT) - F.col(FIN)))).alias(n) for n, c in (("now", F.col("origin_id") >= 199801), ("before", F.col("origin_id") < 199801))])
    return m.select(F.col("Season").alias("s"), "now", "before", (F.col("now") - F.col("before")).alias("change")).where("now is not null and before is not null")
