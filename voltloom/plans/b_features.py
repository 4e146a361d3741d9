"""Queries: weather and solar features, daily heat windows, climatology, exclusions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import calendar as C
from ..operators import climatology as CL
from ..operators import exclusions as X
from ..operators import lags as L
from ..operators import solar_features as S
from ..operators import weather_features as WF
from .base import ctes, daily, load, query, replay, table, weather


def ts(c="DT"):
    return F.col(c).cast("string").alias(c)


def wx(spark, d):
    return WF.add_weather_features(C.add_time_features(weather(spark, d)))


# weather features in SQL: only what the checked columns need
WX_SQL = """
w1 AS (SELECT *, hour(DT) AS hh, CAST(DT AS DATE) AS dd, coalesce(least(greatest(CloudCoverPct/100,0),1),0) AS cl, coalesce(least(greatest(HumidityPct/100,0),1),0) AS hu,
  isodow(DT) < 6 AND CAST(DT AS DATE) NOT IN (DATE '2024-01-01', DATE '2024-01-15') AND hour(DT) BETWEEN 16 AND 20 AS likely FROM v_weather),
w2 AS (SELECT *, max(TempF) OVER d AS tmax, min(TempF) OVER d AS tmin, avg(TempF) OVER d AS tmean FROM w1 WINDOW d AS (PARTITION BY series, dd)),
w3 AS (SELECT *, CASE WHEN hh BETWEEN 16 AND 20 AND tmax >= 90 THEN 1e0 ELSE 0e0 END AS hot, CASE WHEN cl <= 0.1 THEN 1e0 ELSE 0e0 END AS clr,
  CASE WHEN cl >= 0.6 THEN 1e0 ELSE 0e0 END AS ovr, greatest(TempF - 65, 0) AS cdd_raw FROM w2),
wf AS (SELECT *, CASE WHEN TempF IS NULL THEN NULL ELSE cdd_raw END AS cdd FROM w3)"""


@query("prj03_weather_features", ctes("weather") + "," + WX_SQL + """
SELECT series, CAST(DT AS VARCHAR) AS DT, cdd AS CDD, CASE WHEN TempF IS NULL THEN NULL ELSE greatest(65-TempF,0) END AS HDD,
 CASE WHEN tmax <= 65 THEN 0e0 WHEN tmax <= 75 THEN 1e0 WHEN tmax <= 85 THEN 2e0 WHEN tmax <= 90 THEN 3e0 WHEN tmax <= 95 THEN 4e0 WHEN tmax <= 100 THEN 5e0 WHEN tmax <= 105 THEN 6e0 WHEN tmax <= 999 THEN 7e0 END AS DailyMaxTempBin,
 greatest(tmean-65,0) AS Daily_CDD, hot AS IsHotPeakWindow16to20, hot*clr AS ClearHotPeakWindow16to20, hot*ovr*greatest(tmax-95,0) AS OvercastHotPeak_x_DailyMaxExcess95,
 CASE WHEN hh BETWEEN 14 AND 18 THEN clr ELSE 0 END * CASE WHEN tmax >= 75 AND tmax < 85 THEN 1 ELSE 0 END AS ClearPeakDailyMax75to85,
 hot * CASE WHEN tmax >= 98 AND tmax < 100 THEN 1 ELSE 0 END AS HotPeakDailyMax98to100, hot*clr*sin(2*pi()*month(DT)/12) AS MonthSin_x_ClearHotPeak,
 month(DT)*CASE WHEN hh BETWEEN 16 AND 18 THEN clr ELSE 0 END*CASE WHEN tmax >= 105 THEN 1 ELSE 0 END AS Month_x_ClearPeakHE16to18DailyMax105Plus,
 greatest(tmax-90,0)*CASE WHEN hh=17 THEN 1 ELSE 0 END AS DailyMaxExcess90_x_HE17, hot*CASE WHEN likely THEN 0 ELSE 1 END AS NonBusinessHotPeakWindow16to20,
 hu*TempF AS Humidity_x_Temp, cl*coalesce(GHI_Wm2,0) AS Cloud_x_GHI, cdd*CASE WHEN likely THEN 1 ELSE 0 END AS Cooling_Stress,
 CAST(coalesce(TempF >= 95, FALSE) AS INT) AS Extreme_Heat_95
FROM wf""", r6=["CDD", "HDD", "Daily_CDD", "OvercastHotPeak_x_DailyMaxExcess95", "MonthSin_x_ClearHotPeak", "Humidity_x_Temp", "Cloud_x_GHI", "Cooling_Stress",
                "ClearPeakDailyMax75to85", "HotPeakDailyMax98to100", "Month_x_ClearPeakHE16to18DailyMax105Plus", "DailyMaxExcess90_x_HE17", "NonBusinessHotPeakWindow16to20"])
def _(spark, d):
    return wx(spark, d).select("series", ts(), "CDD", "HDD", "DailyMaxTempBin", "Daily_CDD", "IsHotPeakWindow16to20", "ClearHotPeakWindow16to20",
                               "OvercastHotPeak_x_DailyMaxExcess95", "ClearPeakDailyMax75to85", "HotPeakDailyMax98to100", "MonthSin_x_ClearHotPeak",
                               "Month_x_ClearPeakHE16to18DailyMax105Plus", "DailyMaxExcess90_x_HE17", "NonBusinessHotPeakWindow16to20", "Humidity_x_Temp",
                               "Cloud_x_GHI", "Cooling_Stress", "Extreme_Heat_95")


@query("agg05_daily_stats_on_rows", ctes("weather") + "," + WX_SQL + """
SELECT series, CAST(DT AS VARCHAR) AS DT, tmax, tmin, tmean FROM wf""", r6=["tmean"])
def _(spark, d):
    w = weather(spark, d).withColumns({"Temperature": F.col("TempF"), "Date": F.to_date("DT")})
    o = WF.add_daily_temperature(w)
    return o.select("series", ts(), F.col("Temperature_DailyMax").alias("tmax"), F.col("Temperature_DailyMin").alias("tmin"), F.col("Temperature_DailyMean").alias("tmean"))


BREEZE_SQL = """
b1 AS (SELECT *, coalesce(WindSpeedMph,0) AS ws, WindDirectionDeg % 360 AS dir FROM wf),
b2 AS (SELECT *, ((dir - 270 + 180 + 360) % 360) - 180 AS dl FROM b1),
b3 AS (SELECT *, CASE WHEN dir IS NULL THEN 0 ELSE greatest(ws*cos(radians(dl)), 0) END AS fl FROM b2),
b4 AS (SELECT *, CASE WHEN abs(dl) <= 45 AND fl >= 3 THEN 1e0 ELSE 0e0 END AS ff, tmax - TempF AS drop0, TempF - lead(TempF,3) OVER o AS d3, TempF - lead(TempF,1) OVER o AS d1,
  lag(TempF,2) OVER o - TempF AS p2, coalesce(fl - lag(fl,1) OVER o, 0) AS r1, coalesce(fl - lag(fl,3) OVER o, 0) AS r3, coalesce(lead(fl,1) OVER o - fl, 0) AS n1,
  coalesce(lead(fl,3) OVER o - fl, 0) AS n3, hh BETWEEN 18 AND 23 AND tmax >= 95 AND cl <= 0.2 AS ch FROM b3 WINDOW o AS (PARTITION BY series, dd ORDER BY DT))"""


@query("prj04_evening_cooling", ctes("weather") + "," + WX_SQL + "," + BREEZE_SQL + """
SELECT series, CAST(DT AS VARCHAR) AS DT, fl AS flow, ff AS flow_flag, CASE WHEN p2 IS NULL THEN NULL ELSE greatest(p2, 0) END AS drop2, n3 AS next3,
 CASE WHEN ch THEN 1e0 ELSE 0e0 END AS clear_hot, CASE WHEN ch AND ff = 1 AND (r1 >= 2 OR r3 >= 3 OR n1 >= 2 OR n3 >= 3) THEN 1e0 ELSE 0e0 END AS ramp_flag,
 CASE WHEN ch AND (coalesce(drop0,0) >= 5 OR coalesce(d3,0) >= 6) THEN 1e0 ELSE 0e0 END AS cooling,
 CASE WHEN ch THEN greatest(coalesce(drop0,0),0) + greatest(coalesce(d1,0),0) + greatest(coalesce(d3,0),0) ELSE 0 END AS signal
FROM b4""", r6=["flow", "drop2", "next3", "signal"])
def _(spark, d):
    o = WF.add_evening_cooling(wx(spark, d))
    return o.select("series", ts(), F.col("Westerly_Flow_Mph").alias("flow"), F.col("Westerly_Flow_Flag").alias("flow_flag"), F.col("TempDrop_2Hr_F").alias("drop2"),
                    F.col("WesterlyFlow_Next3Hr_Ramp_Mph").alias("next3"), F.col("ClearHotEvening_Flag").alias("clear_hot"), F.col("DeltaBreeze_EveningWindRamp_Flag").alias("ramp_flag"),
                    F.col("DeltaBreeze_Cooling_Flag").alias("cooling"), F.col("DeltaBreeze_ClearHotEvening_Signal").alias("signal"))


@query("win09_in_day_shift", ctes("weather") + "," + WX_SQL + """
SELECT series, CAST(DT AS VARCHAR) AS DT, lag(TempF,1) OVER o AS p1, lag(TempF,3) OVER o AS p3, lead(TempF,2) OVER o AS n2 FROM wf WINDOW o AS (PARTITION BY series, dd ORDER BY DT)""")
def _(spark, d):
    w = weather(spark, d).withColumn("Date", F.to_date("DT"))
    return w.select("series", ts(), WF.shift_in_day("TempF", 1).alias("p1"), WF.shift_in_day("TempF", 3).alias("p3"), WF.shift_in_day("TempF", -2).alias("n2"))


@query("prj05_load_decay", ctes("load", "weather") + "," + WX_SQL + "," + BREEZE_SQL + """,
l AS (SELECT a.series, a.DT, a.eh, (SELECT MWH FROM v_load b WHERE b.series=a.series AND b.eh=a.eh-1) AS l1, (SELECT MWH FROM v_load b WHERE b.series=a.series AND b.eh=a.eh-2) AS l2,
  (SELECT MWH FROM v_load b WHERE b.series=a.series AND b.eh=a.eh-24) AS l24, (SELECT avg(MWH) FROM v_load b WHERE b.series=a.series AND a.eh-b.eh IN (24,48,72,96,120,144,168)) AS wk FROM v_load a)
SELECT l.series, CAST(l.DT AS VARCHAR) AS DT, l2-l1 AS d1, b4.hot*(l1-l24) AS hot_y, CASE WHEN hh BETWEEN 16 AND 18 THEN 1 ELSE 0 END*(l24-wk) AS pw, 
 CASE WHEN hh BETWEEN 18 AND 23 THEN 1 ELSE 0 END*(wk-l1) AS post_w,
 CASE WHEN ch AND (coalesce(drop0,0) >= 5 OR coalesce(d3,0) >= 6) OR (ch AND ff = 1) THEN 1 ELSE 0 END
   * (CASE WHEN hh BETWEEN 18 AND 23 THEN greatest(coalesce(l2-l1,0),0) + greatest(coalesce(wk-l1,0),0) ELSE 0 END) AS signal
FROM l JOIN b4 ON l.series=b4.series AND l.eh=b4.eh""", r6=["d1", "hot_y", "pw", "post_w", "signal"])
def _(spark, d):
    lg = L.add_calendar_lags(load(spark, d)).drop("DT", "n")
    f = WF.add_evening_cooling(wx(spark, d)).join(lg, ["series", "eh"])
    o = L.add_load_decay(f)
    return o.select("series", ts(), F.col("Load_Decay_1Hr_MWH").alias("d1"), F.col("HotPeak_Lag1_Minus_SameHourYesterday_MWH").alias("hot_y"),
                    F.col("PeakWindow16to18_Lag24_Minus_SameHour7DayMean_MWH").alias("pw"), F.col("PostPeak_LoadDecay_VsSameHour7DayMean_MWH").alias("post_w"),
                    F.col("DeltaBreeze_PostPeak_LoadDecay_Signal").alias("signal"))


@query("win06_daily_rolling_heat", ctes("daily") + """
SELECT CAST("Date" AS VARCHAR) AS Date, coalesce(lag(Temperature_DailyMax) OVER w, Temperature_DailyMax) AS prior, coalesce(Temperature_DailyMax - lag(Temperature_DailyMax) OVER w, 0) AS ramp,
 avg(Temperature_DailyMax) OVER (ORDER BY "Date" ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS m2, avg(Temperature_DailyMax) OVER (ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS m3,
 avg(Temperature_DailyMin) OVER (ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3
FROM v_daily WINDOW w AS (ORDER BY "Date")""", r6=["prior", "ramp", "m2", "m3", "n3"])
def _(spark, d):
    o = WF.daily_heat(daily(spark, d).withColumn("series", F.lit("all")))
    return o.select(F.col("Date").cast("string").alias("Date"), F.col("PriorDay_DailyMaxTemp").alias("prior"), F.col("DailyMaxTemp_Ramp_1Day").alias("ramp"),
                    F.col("DailyMaxTemp_2DayMean").alias("m2"), F.col("DailyMaxTemp_3DayMean").alias("m3"), F.col("DailyMinTemp_3DayMean").alias("n3"))


@query("win07_run_length_rows", ctes("daily") + """,
f AS (SELECT *, CASE WHEN Temperature_DailyMax >= 90 THEN 1 ELSE 0 END AS hot, sum(CASE WHEN Temperature_DailyMax >= 90 THEN 0 ELSE 1 END) OVER (ORDER BY "Date") AS isl FROM v_daily)
SELECT CAST("Date" AS VARCHAR) AS Date, CAST(CASE WHEN hot = 1 THEN sum(hot) OVER (PARTITION BY isl ORDER BY "Date") ELSE 0 END AS DOUBLE) AS run FROM f""")
def _(spark, d):
    o = WF.add_run_lengths(daily(spark, d).withColumn("series", F.lit("all")), {"run": F.col("Temperature_DailyMax") >= 90.0})
    return o.select(F.col("Date").cast("string").alias("Date"), "run")


@query("win08_calendar_streaks", ctes("daily") + """,
f AS (SELECT *, "Date" - CAST(row_number() OVER (ORDER BY "Date") AS INTEGER) AS isl FROM v_daily WHERE Temperature_DailyMax >= 90)
SELECT CAST(min("Date") AS VARCHAR) AS s, CAST(max("Date") AS VARCHAR) AS e, CAST(count(*) AS BIGINT) AS len, max(Temperature_DailyMax) AS peak FROM f GROUP BY isl""", r6=["peak"])
def _(spark, d):
    o = WF.hot_streaks(daily(spark, d).withColumn("series", F.lit("all")), 90.0)
    return o.select(F.col("Start").cast("string").alias("s"), F.col("End").cast("string").alias("e"), F.col("Length_Days").alias("len"), F.col("Peak_Temp").alias("peak"))


@query("agg40_depth_histograms", ctes("daily") + """,
f AS (SELECT *, CASE WHEN Temperature_DailyMax >= 90 THEN 1 ELSE 0 END AS hot, sum(CASE WHEN Temperature_DailyMax >= 90 THEN 0 ELSE 1 END) OVER (ORDER BY "Date") AS isl FROM v_daily),
r AS (SELECT CASE WHEN hot = 1 THEN sum(hot) OVER (PARTITION BY isl ORDER BY "Date") ELSE 0 END AS run FROM f),
g AS (SELECT "Date" - CAST(row_number() OVER (ORDER BY "Date") AS INTEGER) AS isl FROM v_daily WHERE Temperature_DailyMax >= 90),
s AS (SELECT count(*) AS len FROM g GROUP BY isl), dp AS (SELECT * FROM (VALUES ('0', 0, 0), ('1-3', 1, 3), ('4-7', 4, 7), ('8-12', 8, 12), ('13-18', 13, 18), ('19+', 19, 100000)) t(depth, lo, hi))
SELECT depth, CAST((SELECT count(*) FROM r WHERE run BETWEEN lo AND hi) AS BIGINT) AS days, CAST((SELECT count(*) FROM s WHERE len BETWEEN lo AND hi) AS BIGINT) AS episodes FROM dp""")
def _(spark, d):
    day = daily(spark, d).withColumn("series", F.lit("all"))
    runs = WF.add_run_lengths(day, {"run": F.col("Temperature_DailyMax") >= 90.0}).select(WF.depth_bucket(F.col("run")).alias("depth"))
    ep = WF.hot_streaks(day, 90.0).select(WF.depth_bucket(F.col("Length_Days")).alias("depth"))
    one, none = F.lit(1), F.lit(0)
    both = runs.select("depth", one.alias("d"), none.alias("e")).unionByName(ep.select("depth", none.alias("d"), one.alias("e")))
    empty = day.select(F.explode(F.array(*[F.lit(x) for x in WF.DEPTH_BUCKETS])).alias("depth")).distinct().select("depth", none.alias("d"), none.alias("e"))
    return both.unionByName(empty).groupBy("depth").agg(F.sum("d").alias("days"), F.sum("e").alias("episodes"))


CAP_SQL = """
cm AS (SELECT s_nationkey AS series, date_trunc('month', DATE '1995-01-01' + CAST(s_suppkey * 37 % 2200 AS INTEGER)) AS m, sum(greatest(s_acctbal,0)) AS kw FROM supplier GROUP BY 1, 2),
cc AS (SELECT series, m, sum(kw) OVER (PARTITION BY series ORDER BY m) AS kw FROM cm),
ce AS (SELECT series, max(m) AS e, arg_max(kw, m) AS cur FROM cc GROUP BY 1),
cx AS (SELECT series, m, kw/1000 AS mw FROM cc UNION ALL SELECT series, e + to_months(CAST(i AS INTEGER)), cur/1000 FROM ce, range(1, 7) t(i)),
cap AS (SELECT cx.series, cx.m, mw, CASE WHEN cur = 0 THEN 0 ELSE mw/(cur/1000) END AS ratio, mw*0.6 AS impact FROM cx JOIN ce USING (series))"""


def capacity(spark, d):
    s = table(spark, d, "supplier")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") * 37 % 2200).cast("int"))
    m = s.groupBy(F.col("s_nationkey").alias("series"), F.trunc(day, "month").alias("DT")).agg(F.sum(F.greatest("s_acctbal", F.lit(0.0))).alias("kw"))
    w = Window.partitionBy("series").orderBy("DT").rowsBetween(Window.unboundedPreceding, 0)
    return S.extend_capacity(m.withColumn("Nameplate_kW", F.sum("kw").over(w)), ["series"], 6, 0.6)


@query("src05_capacity_extension", "WITH " + CAP_SQL.strip() + """
SELECT series, CAST(CAST(m AS DATE) AS VARCHAR) AS month, mw, ratio, impact FROM cap""", r6=["mw", "ratio", "impact"])
def _(spark, d):
    return capacity(spark, d).select("series", F.col("PeriodStart").cast("string").alias("month"), F.col("Nameplate_MW").alias("mw"),
                                     F.col("Capacity_Ratio_To_Current").alias("ratio"), F.col("Impact_Cap_MW").alias("impact"))


@query("joi07_month_join_fill", "WITH " + CAP_SQL.strip() + """,
o AS (SELECT DISTINCT CAST(c_nationkey AS INT) AS series, date_trunc('month', o_orderdate) AS m FROM orders JOIN customer ON o_custkey = c_custkey),
j AS (SELECT o.series, o.m, cap.impact FROM o LEFT JOIN cap ON o.series = cap.series AND o.m = cap.m)
SELECT series, CAST(CAST(m AS DATE) AS VARCHAR) AS month, coalesce(last_value(impact IGNORE NULLS) OVER (PARTITION BY series ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(impact IGNORE NULLS) OVER (PARTITION BY series ORDER BY m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS impact FROM j""", r6=["impact"])
def _(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select(F.col("c_nationkey").alias("series"), F.trunc("o_orderdate", "month").alias("DT")).distinct()
    f = S.attach_capacity(o, capacity(spark, d), ["series"])
    return f.select("series", F.col("DT").cast("string").alias("month"), F.col("Impact_Cap_MW").alias("impact"))


@query("win10_forward_backward_fill", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, coalesce(last_value(TempF IGNORE NULLS) OVER (PARTITION BY series, CAST(DT AS DATE) ORDER BY DT ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 first_value(TempF IGNORE NULLS) OVER (PARTITION BY series, CAST(DT AS DATE) ORDER BY DT ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS t FROM v_weather""", r6=["t"])
def _(spark, d):
    w = weather(spark, d).select("series", F.to_date("DT").alias("day"), "DT", F.col("TempF").alias("t"))
    return S.fill_forward_back(w, ["series", "day"], "DT", ["t"]).select("series", ts(), "t")


SOLAR_SQL = """
s1 AS (SELECT series, DT, eh, hour(DT) AS hh, dayofyear(DT) AS doy, coalesce(GHI_Wm2,0) AS ghi, coalesce(least(greatest(CloudCoverPct/100,0),1),0) AS cl, CASE WHEN eh % 7 = 0 THEN (eh % 50)/10e0 END AS ex FROM v_weather),
s2 AS (SELECT *, least(greatest(sin(pi()*(hh-6)/12),0),1) AS sh, least(greatest(0.825+0.175*cos(2*pi()*(doy-172)/365.25),0.6),1.05) AS sf FROM s1),
s3 AS (SELECT *, greatest(1000*sh*sf,0) AS sky FROM s2),
s4 AS (SELECT *, greatest(coalesce(ex, 40*(ghi/950)*sh),0) AS px, 40*(sky/950)*sh AS cs FROM s3),
s5 AS (SELECT *, greatest(cs-px,0) AS loss FROM s4)"""


@query("prj06_solar_features", ctes("weather") + "," + SOLAR_SQL + """
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE WHEN sky = 0 THEN 0 ELSE least(ghi/sky,1.35) END AS csi, px, cs, loss, CASE WHEN hh BETWEEN 10 AND 15 AND cl >= 0.6 THEN loss ELSE 0 END AS midday_loss,
 sum(px) OVER d AS day_mwh, max(loss) OVER d AS day_loss_max, greatest(coalesce(lag(px,2) OVER o - px,0),0) AS down2, greatest(coalesce(px - lag(px,1) OVER o,0),0) AS up1
FROM s5 WINDOW d AS (PARTITION BY series, CAST(DT AS DATE)), o AS (PARTITION BY series ORDER BY DT)""", r6=["csi", "px", "cs", "loss", "midday_loss", "day_mwh", "day_loss_max", "down2", "up1"])
def _(spark, d):
    w = weather(spark, d).withColumn("CloudCover_Norm", F.col("CloudCoverPct") / 100.0)
    cap = w.select("series", F.trunc("DT", "month").alias("PeriodStart")).distinct().select(
        "series", "PeriodStart", F.lit(50.0).alias("Nameplate_MW"), F.lit(1.0).alias("Capacity_Ratio_To_Current"), F.lit(40.0).alias("Impact_Cap_MW"))
    ex = w.where("eh % 7 = 0").select("series", "DT", ((F.col("eh") % 50) / 10.0).alias("Solar_Forecast_MW"))
    o = S.add_solar_features(w, cap, ex)
    return o.select("series", ts(), F.col("ClearSky_Index").alias("csi"), F.col("BTM_Solar_Proxy_MW").alias("px"), F.col("BTM_ClearSky_Proxy_MW").alias("cs"),
                    F.col("BTM_Solar_Loss_From_ClearSky_MW").alias("loss"), F.col("Midday_Overcast_Solar_Loss_MW").alias("midday_loss"), F.col("Daily_BTM_Solar_Proxy_Total_MWh").alias("day_mwh"),
                    F.col("Daily_BTM_Solar_Loss_Max_MW").alias("day_loss_max"), F.col("Solar_Ramp_Down_2hr").alias("down2"), F.col("Solar_Ramp_Up_1hr").alias("up1"))


CLIM_SQL = """
ref AS (SELECT "Date", year("Date") AS y, dayofyear("Date") AS doy, Temperature_DailyMax AS t FROM v_daily),
m AS (SELECT a."Date" AS d, b.y AS ry, b.t FROM ref a LEFT JOIN ref b ON b.y < a.y AND least(abs(a.doy-b.doy), 366-abs(a.doy-b.doy)) <= 10),
clim AS (SELECT d, count(DISTINCT ry) AS ny, CASE WHEN count(DISTINCT ry) >= 3 THEN quantile_cont(t, 0.95) END AS p FROM m GROUP BY d)"""


@query("joi09_circular_climatology", ctes("daily") + "," + CLIM_SQL + """
SELECT CAST(d AS VARCHAR) AS Date, CAST(ny AS BIGINT) AS ny, p FROM clim""", r6=["p"])
def _(spark, d):
    ref = daily(spark, d).select(F.lit("all").alias("series"), "Date", "Temperature_DailyMax", F.year("Date").alias("Year"), F.dayofyear("Date").alias("DOY"))
    o = CL.climatology_lookup(ref, ref.select("series", "Date"))
    return o.select(F.col("Date").cast("string").alias("Date"), F.col("Temp_Climatology_Reference_Years").alias("ny"), F.col("Climatology_Temp_PXX_F").alias("p"))


@query("joi08_record_heat_excess", ctes("daily") + "," + CLIM_SQL + """
SELECT CAST(d AS VARCHAR) AS Date, CASE WHEN month(d) IN (6,7,8,9) THEN t - p END AS excess FROM clim JOIN ref ON ref."Date" = d""", r6=["excess"])
def _(spark, d):
    ref = daily(spark, d).select(F.lit("all").alias("series"), "Date", "Temperature_DailyMax", F.year("Date").alias("Year"), F.dayofyear("Date").alias("DOY"))
    rows = ref.select("series", F.col("Date").cast("timestamp").alias("DT"), "Temperature_DailyMax")
    o = CL.add_record_heat(rows, CL.climatology_lookup(ref, ref.select("series", "Date")))
    return o.select(F.to_date("DT").cast("string").alias("Date"), F.col("Temp_Excess_Over_Climatology_F").alias("excess"))


@query("agg22_daily_max_reference", ctes("weather") + """
SELECT series, CAST(CAST(DT AS DATE) AS VARCHAR) AS Date, max(TempF) AS mx, CAST(dayofyear(min(DT)) AS INT) AS doy FROM v_weather GROUP BY series, CAST(DT AS DATE) HAVING max(TempF) IS NOT NULL""", r6=["mx"])
def _(spark, d):
    o = CL.daily_max_reference(weather(spark, d))
    return o.select("series", F.col("Date").cast("string").alias("Date"), F.col("Temperature_DailyMax").alias("mx"), F.col("DOY").alias("doy"))


@query("agg23_distinct_years", ctes("daily") + "," + CLIM_SQL + """
SELECT CAST(ny AS BIGINT) AS years, CAST(count(*) AS BIGINT) AS days FROM clim GROUP BY 1""")
def _(spark, d):
    ref = daily(spark, d).select(F.lit("all").alias("series"), "Date", "Temperature_DailyMax", F.year("Date").alias("Year"), F.dayofyear("Date").alias("DOY"))
    o = CL.climatology_lookup(ref, ref.select("series", "Date"))
    return o.groupBy(F.col("Temp_Climatology_Reference_Years").alias("years")).agg(F.count("*").alias("days"))


EVENTS = [{"date": "1998-07-04"}, {"date": "1999-06-01", "he_start": 15, "he_end": 18}, {"date": "1997-03-03", "he_start": 20, "he_end": 7}, {"date": "2000-01-05", "he_start": 12}]


@query("prj08_exclusion_list", ctes("bt") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, sum(row_id) AS s FROM v_bt WHERE NOT ("Date" = DATE '1998-07-04' OR ("Date" = DATE '1999-06-01' AND Hour BETWEEN 15 AND 18)
 OR ("Date" = DATE '1997-03-03' AND Hour BETWEEN 7 AND 20) OR ("Date" = DATE '2000-01-05' AND Hour BETWEEN 12 AND 23)) GROUP BY 1""", r4=["s"])
def _(spark, d):
    return X.drop_excluded(replay(spark, d, "series", "DT", "row_id"), EVENTS).groupBy("series").agg(F.count("*").alias("n"), F.sum("row_id").alias("s"))


@query("prj08_exclusion_table", ctes("bt") + """,
ev AS (SELECT CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 24 AS INT) END AS a, CASE WHEN o_orderkey % 3 <= 1 THEN NULL ELSE CAST(o_orderkey * 5 % 24 AS INT) END AS b FROM orders WHERE o_totalprice > 300000),
e2 AS (SELECT d, least(coalesce(a,0),coalesce(b,23)) AS lo, greatest(coalesce(a,0),coalesce(b,23)) AS hi FROM ev)
SELECT series, CAST(count(*) AS BIGINT) AS n, sum(row_id) AS s FROM v_bt WHERE NOT EXISTS (SELECT 1 FROM e2 WHERE e2.d = "Date" AND Hour BETWEEN lo AND hi) GROUP BY 1""", r4=["s"])
def _(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 300000")
    k = F.col("o_orderkey")
    ev = o.select(F.to_date("o_orderdate").alias("date"), F.when(k % 3 != 0, (k % 24).cast("int")).alias("he_start"), F.when(k % 3 > 1, (k * 5 % 24).cast("int")).alias("he_end"))
    return X.drop_excluded_table(replay(spark, d, "series", "DT", "row_id"), ev).groupBy("series").agg(F.count("*").alias("n"), F.sum("row_id").alias("s"))

