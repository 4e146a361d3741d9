"""Queries: analogs with their statistics, the whole readiness scorecard, weights by scope and a scan of interval files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core.scratch import shared_dir
from ..operators import analogs as AN
from ..operators import metrics as M
from ..operators import scorecards as SC
from ..operators import training as TR
from ..sources import scans as SR
from .a_features import LOSS, PEAK_BAND_SQL
from .base import ctes, query, replay, table
from .c_scorecards import ACT, FIN, RAW, m_sql

METRICS = ["Actual_Mean_MWH", "Forecast_Mean_MWH", "Bias_MWH", "MAE_MWH", "RMSE_MWH", "MAPE_PCT", "Underforecast_Rate_PCT", "Max_Underforecast_MWH", "Max_Overforecast_MWH"]
_O = "make_date(CAST(origin_id // 100 AS INT), CAST(origin_id % 100 AS INT), 1)"
DETAIL_SQL = ctes("bt") + f""",
sc AS MATERIALIZED (SELECT *, {_O} AS o FROM v_bt WHERE Temperature_DailyMax >= 105 AND Hour BETWEEN 14 AND 20 AND Month IN (6,7,8,9)),
src AS MATERIALIZED (SELECT * FROM (SELECT series, DT, arg_min(Hour, row_id) AS h, arg_min(Month, row_id) AS m, min_by(struct_pack(t := Temperature_DailyMax), row_id).t AS t, arg_min(Actual_MWH, row_id) AS a FROM v_bt GROUP BY 1, 2) WHERE t >= 105),
th AS (SELECT sc.series, sc.o, sc.Hour, sc.Month, sc.Temperature_DailyMax AS t,
  count(*) FILTER (src.m = sc.Month) AS n1, avg(a) FILTER (src.m = sc.Month) AS v1, quantile_cont(a, 0.9) FILTER (src.m = sc.Month) AS p1,
  count(*) FILTER (src.m IN (6,7,8,9)) AS n2, avg(a) FILTER (src.m IN (6,7,8,9)) AS v2, quantile_cont(a, 0.9) FILTER (src.m IN (6,7,8,9)) AS p2, count(*) AS n3, avg(a) AS v3, quantile_cont(a, 0.9) AS p3
  FROM (SELECT DISTINCT series, o, Hour, Month, Temperature_DailyMax FROM sc) sc JOIN src ON src.series = sc.series AND src.h = sc.Hour AND src.DT < sc.o AND abs(src.t - sc.Temperature_DailyMax) <= 3 GROUP BY ALL),
tp AS (SELECT sc.series, sc.o, sc.Temperature_DailyMax AS t, count(*) AS pn, avg(a) AS pm, quantile_cont(a, 0.9) AS pp
  FROM (SELECT DISTINCT series, o, Temperature_DailyMax FROM sc) sc JOIN src ON src.series = sc.series AND src.h BETWEEN 14 AND 20 AND src.m IN (6,7,8,9) AND src.DT < sc.o AND abs(src.t - sc.Temperature_DailyMax) <= 3 GROUP BY ALL),
de AS (SELECT sc.*, CASE WHEN n1 >= 3 THEN 1 WHEN n2 >= 3 THEN 2 WHEN n3 >= 3 THEN 3 END AS tier, CASE tier WHEN 1 THEN n1 WHEN 2 THEN n2 WHEN 3 THEN n3 ELSE 0 END AS n,
  CASE tier WHEN 1 THEN v1 WHEN 2 THEN v2 WHEN 3 THEN v3 END AS v, CASE tier WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 END AS p, pn, pm, pp,
  CASE WHEN tier IS NULL THEN 0 ELSE least(greatest((CASE tier WHEN 1 THEN v1 WHEN 2 THEN v2 ELSE v3 END - Raw_Forecast_MWH) * 0.5, -12), 12) END AS corr,
  coalesce(CASE tier WHEN 1 THEN 'same_month_multi_summer' WHEN 2 THEN 'summer_months_multi_summer' WHEN 3 THEN 'all_prior_same_hour_temp' END, 'no_pre_origin_match') AS src
  FROM sc LEFT JOIN th ON th.series = sc.series AND th.o = sc.o AND th.Hour = sc.Hour AND th.Month = sc.Month AND th.t = sc.Temperature_DailyMax
  LEFT JOIN tp ON tp.series = sc.series AND tp.o = sc.o AND tp.t = sc.Temperature_DailyMax)"""


def detail(spark, d):
    b = replay(spark, d, "series", "row_id", "origin_id", "DT", "Hour", "Month", "Forecast_Day", "Temperature_DailyMax", RAW, ACT)
    o = F.make_date(F.floor(F.col("origin_id") / 100).cast("int"), (F.col("origin_id") % 100).cast("int"), F.lit(1))
    return AN.heat_analog_detail(b.withColumn("origin_dt", o), RAW, "origin_dt", first=["row_id"])


@query("joi10_heat_analog_columns", DETAIL_SQL + """
SELECT row_id, src, corr, CAST(abs(corr) > 1e-9 AS INT) AS applied, CAST(n AS BIGINT) AS n_hour, v AS mean_hour, p AS p90_hour, CAST(CASE WHEN tier IS NULL THEN 0 ELSE coalesce(pn, 0) END AS BIGINT) AS n_peak,
 CASE WHEN tier IS NOT NULL THEN pm END AS mean_peak, CASE WHEN tier IS NOT NULL THEN pp END AS p90_peak, Actual_MWH - v AS above_mean, abs(Actual_MWH - Raw_Forecast_MWH - corr) - abs(Actual_MWH - Raw_Forecast_MWH) AS delta FROM de""",
       r6=["corr", "mean_hour", "p90_hour", "mean_peak", "p90_peak", "above_mean", "delta"])
def _(spark, d):
    h = "Heat_Analog_"
    return detail(spark, d).select("row_id", F.col(f"{h}Source").alias("src"), F.col(f"{h}Shadow_Correction_MWH").alias("corr"), F.col(f"{h}Shadow_Applied_Flag").alias("applied"),
                                   F.col(f"{h}Count_SameHour_PreOrigin").alias("n_hour"), F.col(f"{h}Actual_Mean_SameHour_PreOrigin_MWH").alias("mean_hour"), F.col(f"{h}Actual_P90_SameHour_PreOrigin_MWH").alias("p90_hour"),
                                   F.col(f"{h}Count_HE14_20_PreOrigin").alias("n_peak"), F.col(f"{h}Actual_Mean_HE14_20_PreOrigin_MWH").alias("mean_peak"), F.col(f"{h}Actual_P90_HE14_20_PreOrigin_MWH").alias("p90_peak"),
                                   F.col("Actual_Minus_Heat_Analog_SameHour_Mean_MWH").alias("above_mean"), F.col(f"{h}Delta_AbsError_MWH").alias("delta"))


@query("rep11_analog_metrics_by_day", DETAIL_SQL + """,
u AS (SELECT 'raw' AS "Stage", src, Forecast_Day, Hour, Actual_MWH, Raw_Forecast_MWH AS f FROM de UNION ALL SELECT 'analog', src, Forecast_Day, Hour, Actual_MWH, Raw_Forecast_MWH + corr FROM de)
SELECT "Stage", src AS "Heat_Analog_Source", Forecast_Day, Hour, """ + m_sql("f", p90=False) + " FROM u GROUP BY 1, 2, 3, 4", r6=METRICS)
def _(spark, d):
    return M.stage_metrics(detail(spark, d), {"raw": RAW, "analog": "Heat_Analog_Shadow_Forecast_MWH"}, ["Heat_Analog_Source", "Forecast_Day", "Hour"], p90=False)


_GATES = (
    ("Last 45 days", "Recent behavior", 3.0, "DT > (SELECT max(DT) FROM v_bt) - INTERVAL 45 DAY"), ("Seasonal rolling origins", "General robustness", 4.5, "TRUE"),
    ("Day 1 only", "Near-term operational forecast", 3.5, "Forecast_Day = 1"), ("Days 2-3", "Short weather forecast horizon", 5.0, "Forecast_Day BETWEEN 2 AND 3"),
    ("Days 4-7", "Weather uncertainty horizon", 5.0, "Forecast_Day BETWEEN 4 AND 7"), ("Hot peak days", "Operational risk", 6.0, "Hour BETWEEN 16 AND 20 AND Temperature_DailyMax >= 90"),
    ("Cloud/solar midday", "BTM solar/cloud risk", 7.0, "Hour BETWEEN 10 AND 16 AND (CloudCover_Norm >= 0.6 OR BTM_Solar_Loss_From_ClearSky_MW >= 1.25)"),
    ("Shoulder heat transition", "Spring/fall load-response risk", 7.0, "Season IN ('Spring','Fall') AND Hour BETWEEN 12 AND 22 AND Temperature_DailyMax BETWEEN 75 AND 93"),
    ("Peak window hours 14-18", "Peak planning risk", 5.5, "Hour BETWEEN 14 AND 18"))


@query("rep08_readiness_scorecard", ctes("bt") + ", s AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS \"Test\", '{p}' AS \"Purpose\", {lim} AS lim, Actual_MWH AS a, Final_Forecast_MWH AS f FROM v_bt WHERE {w}" for n, p, lim, w in _GATES) + """)
SELECT "Test", "Purpose", CASE WHEN "Test" = 'Last 45 days' THEN 'recent_45_day_backtest' ELSE 'seasonal_rolling_origin_replay' END AS "Basis",
 CASE WHEN "Test" = 'Seasonal rolling origins' THEN 'mae<=4.5;mape<=3.5;abs_bias<=0.75' ELSE 'mae<=' || printf('%.1f', max(lim)) END AS "Gate", CAST(count(*) AS BIGINT) AS "N", avg(abs(a-f)) AS "MAE_MWH", avg(a-f) AS "Bias_MWH",
 CAST(avg(abs(a-f)) <= max(lim) AND ("Test" <> 'Seasonal rolling origins' OR (avg(abs(a-f)/abs(a)*100) <= 3.5 AND abs(avg(a-f)) <= 0.75)) AS INT) AS "Pass" FROM s GROUP BY 1, 2""", r6=["MAE_MWH", "Bias_MWH"])
def _(spark, d):
    b = replay(spark, d, "DT", "Hour", "Season", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", LOSS, ACT, FIN)
    o = SC.readiness_scorecard(SC.last_days(b, 45), b, FIN)
    return o.select("Test", "Purpose", "Basis", "Gate", "N", "MAE_MWH", "Bias_MWH", F.col("Pass").cast("int").alias("Pass"))


@query("agg36_training_weight_by_scope", ctes("bt") + f""",
q AS (SELECT quantile_cont(Actual_MWH, 0.9) AS q90, quantile_cont(Actual_MWH, 0.95) AS q95 FROM v_bt),
w AS (SELECT coalesce({PEAK_BAND_SQL}, 'unknown') AS b, coalesce(Temperature_DailyMax >= 90 AND Hour BETWEEN 16 AND 20, FALSE) AS hot,
  least(greatest(CASE WHEN Actual_MWH >= q90 THEN 1.8 ELSE 1 END * CASE WHEN Actual_MWH >= q95 THEN 3.0 ELSE 1 END * CASE WHEN Temperature_DailyMax >= 90 AND Hour BETWEEN 16 AND 20 AND IsWeekend = 0 THEN 1.7 ELSE 1 END, 0.25), 8) AS w FROM v_bt, q),
t AS (SELECT count(*) AS n, sum(w) AS w FROM w),
k AS (SELECT * FROM (VALUES ('<75'), ('75-85'), ('85-90'), ('90-92.5'), ('92.5-95'), ('95-98'), ('98-100'), ('100-105'), ('105+')) v(b), (VALUES ('AllHours'), ('HotPeakHours16to20')) u(sc)),
m AS (SELECT k.b, sc, count(w.b) AS n, coalesce(sum(w.w), 0) AS s FROM k LEFT JOIN w ON w.b = k.b AND (sc = 'AllHours' OR hot) GROUP BY 1, 2)
SELECT m.b AS bucket, sc AS scope, CAST(m.n AS BIGINT) AS n, 100.0*m.n/t.n AS row_pct, CASE WHEN m.n > 0 THEN s/m.n ELSE 0 END AS mean_weight, s AS total, 100*s/t.w AS weight_pct, CASE WHEN m.n > 0 THEN (100*s/t.w)/(100.0*m.n/t.n) END AS ratio FROM m, t""",
       r4=["row_pct", "mean_weight", "total", "weight_pct", "ratio"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Temperature_DailyMax", "IsWeekend", ACT).withColumn("IsLikelySystemPeakHour", F.when((F.col("IsWeekend") == 0) & F.col("Hour").between(16, 20), 1).otherwise(0))
    o = TR.weight_scopes(TR.add_load_weights(b, ACT, TR.Weights(recency_end=1.0)), 90.0)
    return o.select(F.col("Temperature_DailyMax_Bucket").alias("bucket"), F.col("Scope").alias("scope"), F.col("N_Rows").alias("n"), F.col("Pct_Of_Total_Rows").alias("row_pct"), F.col("Mean_Sample_Weight").alias("mean_weight"),
                    F.col("Total_Sample_Weight").alias("total"), F.col("Pct_Of_Total_Weight").alias("weight_pct"), F.col("Weighted_Share_vs_RawShare_Ratio").alias("ratio"))


# channel folder by return flag; the rows of a channel are one monthly folder named after their last month
_CHANNELS = {"A": "COM/GS2/NEM/REC", "N": "RES/DEL", "R": "COM/GS1/NET"}


@query("src10_interval_file_scan", """
SELECT CASE l_returnflag WHEN 'N' THEN 'RES' ELSE 'COM' END AS segment, CASE l_returnflag WHEN 'A' THEN 'REC' WHEN 'N' THEN 'DEL' ELSE 'NET' END AS channel, CASE l_returnflag WHEN 'A' THEN 'GS2' WHEN 'N' THEN 'RES' ELSE 'GS1' END AS rate_group,
 CASE l_returnflag WHEN 'A' THEN 'NEM' ELSE 'Non-NEM' END AS nem_status, strftime(max(l_shipdate), '%Y%m') AS month, CAST(count(*) AS BIGINT) AS rows, sum(l_quantity) AS kwh, 1 AS sized FROM lineitem GROUP BY l_returnflag""", r4=["kwh"])
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", "l_quantity")
    root, schema = shared_dir(spark), "l_shipdate timestamp, l_quantity double"
    last = {r[0]: r[1] for r in li.groupBy("l_returnflag").agg(F.date_format(F.max("l_shipdate"), "yyyyMM")).collect()}  # one row a flag
    for flag, folder in _CHANNELS.items():
        if flag in last:
            li.where(F.col("l_returnflag") == flag).select(F.col("l_shipdate").cast("timestamp"), F.col("l_quantity").cast("double")).write.parquet(f"{root}/{folder}/MONTHLY_{last[flag]}")
    lake = SR.interval_lake(spark, root, schema)
    keys = ["segment", "channel", "rate_group", "nem_status", "month"]
    files = SR.file_catalog(lake).groupBy(*keys).agg(F.sum("rows").alias("rows"), F.min(((F.col("file_size") > 0) & F.col("modified").isNotNull()).cast("int")).alias("sized"))
    return files.join(lake.groupBy(*keys).agg(F.sum("l_quantity").alias("kwh")), keys)
