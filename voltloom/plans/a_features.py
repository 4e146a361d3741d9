"""Queries: scalar functions, calendar, rollups, lags, as-of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions import calendar as C
from ..functions import clock as K
from ..functions import weather as W
from ..operators import intraday as I
from ..operators import lags as L
from .base import ctes, load, query, reading, replay, table, weather


def ts(c="DT"):
    return F.col(c).cast("string").alias(c)


# ---- scalar functions ---------------------------------------------------------------------------

@query("scl01_season_hourgroup", ctes("bt") + f"""
SELECT Season, HourGroup, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1, 2""")
def _(spark, d):
    b = replay(spark, d, "Month", "Hour")
    return b.groupBy(C.season("Month").alias("Season"), C.hour_group("Hour").alias("HourGroup")).agg(F.count("*").alias("n"))


_HOL_SQL = """
ys AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders),
fixed AS (SELECT y, make_date(y, m, dd) AS d FROM ys, (VALUES (1,1),(7,4),(11,11),(12,25)) t(m, dd)),
obs AS (SELECT CASE WHEN isodow(d)=6 THEN d - 1 WHEN isodow(d)=7 THEN d + 1 ELSE d END AS h FROM fixed),
nth AS (SELECT CAST(f + CAST((wd - isodow(f) + 7) % 7 AS INTEGER) + 7*(n-1) AS DATE) AS h
        FROM (SELECT make_date(y, m, 1) AS f, wd, n FROM ys, (VALUES (1,1,3),(2,1,3),(9,1,1),(10,1,2),(11,4,4)) t(m, wd, n))),
lst AS (SELECT CAST(e - CAST((isodow(e) - 1) % 7 AS INTEGER) AS DATE) AS h FROM (SELECT last_day(make_date(y, 5, 1)) AS e FROM ys)),
hol AS (SELECT h FROM obs UNION SELECT h FROM nth UNION SELECT h FROM lst)"""


@query("scl02_weekday_holiday_dates", "WITH " + _HOL_SQL.strip() + """
SELECT CAST(h AS VARCHAR) AS Holiday FROM hol""")
def _(spark, d):
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    return years.select(F.explode(C.holidays_of_year(F.col("y"))).alias("h")).distinct().select(F.col("h").cast("string").alias("Holiday"))


@query("scl03_heat_index", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT,
  CASE WHEN TempF >= 80 AND HumidityPct >= 40 THEN -42.379 + 2.04901523*TempF + 10.14333127*HumidityPct - 0.22475541*TempF*HumidityPct
    - 0.00683783*TempF*TempF - 0.05481717*HumidityPct*HumidityPct + 0.00122874*TempF*TempF*HumidityPct
    + 0.00085282*TempF*HumidityPct*HumidityPct - 0.00000199*TempF*TempF*HumidityPct*HumidityPct ELSE TempF END AS HeatIndexF
FROM v_weather""", r6=["HeatIndexF"])
def _(spark, d):
    return weather(spark, d).select("series", ts(), W.heat_index_f("TempF", "HumidityPct").alias("HeatIndexF"))


@query("scl04_angle_delta", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, ((WindDirectionDeg - 270 + 180) - floor((WindDirectionDeg - 270 + 180) / 360) * 360) - 180 AS delta
FROM v_weather""", r6=["delta"])
def _(spark, d):
    return weather(spark, d).select("series", ts(), W.angle_delta("WindDirectionDeg", 270.0).alias("delta"))


_TB = """CASE WHEN {c} < -999 THEN NULL WHEN {c} <= 65 THEN {l}[1] WHEN {c} <= 75 THEN {l}[2] WHEN {c} <= 85 THEN {l}[3] WHEN {c} <= 90 THEN {l}[4]
  WHEN {c} <= 95 THEN {l}[5] WHEN {c} <= 100 THEN {l}[6] WHEN {c} <= 105 THEN {l}[7] WHEN {c} <= 999 THEN {l}[8] END"""
TEMP_BUCKET_SQL = _TB.format(c="Temperature_DailyMax", l="['<65','65-75','75-85','85-90','90-95','95-100','100-105','105+']")
TEMP_BIN_SQL = _TB.format(c="Temperature_DailyMax", l="[0e0,1e0,2e0,3e0,4e0,5e0,6e0,7e0]")
CLOUD_BUCKET_SQL = """CASE WHEN CloudCover_Norm < -0.001 THEN NULL WHEN CloudCover_Norm <= 0.2 THEN 'Clear/Low' WHEN CloudCover_Norm <= 0.4 THEN 'Some Clouds'
  WHEN CloudCover_Norm <= 0.6 THEN 'Partly Cloudy' WHEN CloudCover_Norm <= 0.8 THEN 'Mostly Cloudy' WHEN CloudCover_Norm <= 1.001 THEN 'Overcast' END"""
CLOUD_BIN_SQL = """CASE WHEN CloudCover_Norm <= 0.2 THEN 0e0 WHEN CloudCover_Norm <= 0.4 THEN 1e0 WHEN CloudCover_Norm <= 0.6 THEN 2e0
  WHEN CloudCover_Norm <= 0.8 THEN 3e0 WHEN CloudCover_Norm <= 1.001 THEN 4e0 END"""
PROXY_BIN_SQL = """CASE WHEN BTM_Solar_Proxy_MW <= 1 THEN 0e0 WHEN BTM_Solar_Proxy_MW <= 5 THEN 1e0 WHEN BTM_Solar_Proxy_MW <= 10 THEN 2e0
  WHEN BTM_Solar_Proxy_MW <= 15 THEN 3e0 WHEN BTM_Solar_Proxy_MW <= 20 THEN 4e0 WHEN BTM_Solar_Proxy_MW <= 30 THEN 5e0 WHEN BTM_Solar_Proxy_MW <= 9999 THEN 6e0 END"""


@query("scl05_right_closed_bins", ctes("bt") + f"""
SELECT {TEMP_BUCKET_SQL} AS temp_bucket, {CLOUD_BUCKET_SQL} AS cloud_bucket, {PROXY_BIN_SQL} AS proxy_bin,
  CASE WHEN Raw_Forecast_MWH <= 70 THEN 0 ELSE 1 END AS hi, CAST(count(*) AS BIGINT) AS n
FROM v_bt GROUP BY ALL""")
def _(spark, d):
    b = replay(spark, d, "Temperature_DailyMax", "CloudCover_Norm", "BTM_Solar_Proxy_MW", "Raw_Forecast_MWH")
    return b.groupBy(B.daily_max_bucket("Temperature_DailyMax").alias("temp_bucket"), B.cloud_bucket("CloudCover_Norm").alias("cloud_bucket"),
                     B.solar_proxy_bin("BTM_Solar_Proxy_MW").alias("proxy_bin"),
                     F.when(F.col("Raw_Forecast_MWH") <= 70, 0).otherwise(1).alias("hi")).agg(F.count("*").alias("n"))


PEAK_BAND_SQL = """CASE WHEN Temperature_DailyMax < 75 THEN '<75' WHEN Temperature_DailyMax < 85 THEN '75-85' WHEN Temperature_DailyMax < 90 THEN '85-90'
  WHEN Temperature_DailyMax < 92.5 THEN '90-92.5' WHEN Temperature_DailyMax < 95 THEN '92.5-95' WHEN Temperature_DailyMax < 98 THEN '95-98'
  WHEN Temperature_DailyMax < 100 THEN '98-100' WHEN Temperature_DailyMax < 105 THEN '100-105' WHEN Temperature_DailyMax < 999 THEN '105+' END"""


@query("scl06_left_closed_bins", ctes("bt") + f"""
SELECT {PEAK_BAND_SQL} AS band, coalesce({PEAK_BAND_SQL}, 'unknown') AS weight_bucket,
  CASE WHEN Temperature_DailyMax IS NULL THEN 'Unknown' WHEN Temperature_DailyMax < 95 THEN '90-95' WHEN Temperature_DailyMax < 100 THEN '95-100'
       WHEN Temperature_DailyMax < 105 THEN '100-105' ELSE '105+' END AS capture_bucket, CAST(count(*) AS BIGINT) AS n
FROM v_bt GROUP BY ALL""")
def _(spark, d):
    t = "Temperature_DailyMax"
    return replay(spark, d, t).groupBy(B.peak_daily_max_band(t).alias("band"), B.weight_temp_bucket(t).alias("weight_bucket"),
                                       B.capture_temp_bucket(t).alias("capture_bucket")).agg(F.count("*").alias("n"))


LOSS = "BTM_Solar_Loss_From_ClearSky_MW"
QUART_SQL = """quart AS (SELECT count(*) AS qn, count(DISTINCT {c}) AS qd, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
  quantile_cont({c}, 0.75) AS q3 FROM v_bt WHERE {c} > 0)"""
QUART_CASE = """CASE WHEN coalesce({c},0) <= 0 THEN 'None' WHEN qn >= 10 AND qd >= 4 THEN
  CASE WHEN {c} <= q1 THEN 'Low' WHEN {c} <= q2 THEN 'Medium' WHEN {c} <= q3 THEN 'High' ELSE 'Extreme' END
  ELSE CASE WHEN {c} <= q2 THEN 'Low/Medium' ELSE 'High' END END"""


@query("scl07_quartile_bucket", ctes("bt") + f""",
q AS (SELECT series, count(*) AS qn, count(DISTINCT {LOSS}) AS qd, quantile_cont({LOSS}, 0.25) AS q1, quantile_cont({LOSS}, 0.5) AS q2,
  quantile_cont({LOSS}, 0.75) AS q3 FROM v_bt WHERE {LOSS} > 0 GROUP BY 1)
SELECT series, {QUART_CASE.format(c=LOSS)} AS bucket, CAST(count(*) AS BIGINT) AS n FROM v_bt JOIN q USING (series) GROUP BY ALL""")
def _(spark, d):
    b = B.with_quartile_bucket(replay(spark, d, "series", LOSS), LOSS, "bucket", ["series"])
    return b.groupBy("series", "bucket").agg(F.count("*").alias("n"))


@query("scl08_percent_or_fraction", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE WHEN (SELECT max(CloudCoverPct) FROM v_weather w WHERE w.series = v.series) > 1.5 THEN CloudCoverPct/100 ELSE CloudCoverPct END AS cloud
FROM v_weather v""", r6=["cloud"])
def _(spark, d):
    return B.with_cloud_fraction(weather(spark, d), "CloudCoverPct", "cloud", ["series"]).select("series", ts(), "cloud")


@query("scl09_unit_conversion", ctes("weather") + """,
u AS (SELECT *, CASE eh % 4 WHEN 0 THEN 'W/m²' WHEN 1 THEN 'kWh/m^2' WHEN 2 THEN 'MJ/m2' ELSE 'Wh/m2' END AS ru,
  CASE eh % 3 WHEN 0 THEN '°F' WHEN 1 THEN 'K' ELSE 'C' END AS tu, CASE eh % 4 WHEN 0 THEN 'mph' WHEN 1 THEN 'km/h' WHEN 2 THEN 'kn' ELSE 'm/s' END AS wu FROM v_weather)
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE ru WHEN 'kWh/m^2' THEN GHI_Wm2 WHEN 'MJ/m2' THEN GHI_Wm2/3.6 ELSE GHI_Wm2/1000 END AS kwh,
  CASE tu WHEN '°F' THEN (TempF-32)*5/9 WHEN 'K' THEN TempF-273.15 ELSE TempF END AS c,
  CASE wu WHEN 'mph' THEN WindSpeedMph*0.44704 WHEN 'km/h' THEN WindSpeedMph/3.6 WHEN 'kn' THEN WindSpeedMph*0.514444 ELSE WindSpeedMph END AS ms,
  (WindDirectionDeg % 360) - 180 - CASE WHEN (WindDirectionDeg % 360) - 180 >= 180 THEN 360 ELSE 0 END AS az
FROM u""", r6=["kwh", "c", "ms", "az"])
def _(spark, d):
    e = F.col("eh")
    ru = F.when(e % 4 == 0, "W/m²").when(e % 4 == 1, "kWh/m^2").when(e % 4 == 2, "MJ/m2").otherwise("Wh/m2")
    tu = F.when(e % 3 == 0, "°F").when(e % 3 == 1, "K").otherwise("C")
    wu = F.when(e % 4 == 0, "mph").when(e % 4 == 1, "km/h").when(e % 4 == 2, "kn").otherwise("m/s")
    return weather(spark, d).select("series", ts(), W.irradiance_kwh_m2("GHI_Wm2", ru).alias("kwh"), W.celsius("TempF", tu).alias("c"),
                                    W.metres_per_second("WindSpeedMph", wu).alias("ms"), W.panel_azimuth("WindDirectionDeg").alias("az"))


@query("scl10_wall_clock_vs_zone_clock", """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS wall,
  CAST(date_trunc('second', ts) + CASE WHEN event_id % 2 = 0 THEN INTERVAL 7 HOUR ELSE INTERVAL 8 HOUR END - INTERVAL 8 HOUR AS VARCHAR) AS zone
FROM events""")
def _(spark, d):
    e = table(spark, d, "events")
    text = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "-07:00").otherwise("-08:00"))
    return e.select("event_id", K.wall_clock(text).cast("string").alias("wall"), K.zone_clock(text, "America/Los_Angeles").cast("string").alias("zone"))


@query("scl14_solar_shape_season", ctes("load") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, least(greatest(sin(pi()*(hour(DT)-6)/12), 0), 1) AS shape,
  least(greatest(0.825 + 0.175*cos(2*pi()*(dayofyear(DT)-172)/365.25), 0.6), 1.05) AS factor FROM v_load""", r6=["shape", "factor"])
def _(spark, d):
    return load(spark, d).select("series", ts(), W.solar_hour_shape(F.hour("DT")).alias("shape"), W.solar_season_factor(F.dayofyear("DT")).alias("factor"))


@query("scl15_decay", ctes("bt") + """
SELECT Forecast_Lead_Hour AS lead, CAST(count(*) AS BIGINT) AS n, greatest(exp(-(Forecast_Lead_Hour-1)/48.0), 0.15) AS e, pow(0.5, Forecast_Lead_Hour/6.0) AS h
FROM v_bt GROUP BY 1""", r6=["e", "h"])
def _(spark, d):
    lead = F.col("lead")
    g = replay(spark, d, "Forecast_Lead_Hour").groupBy(F.col("Forecast_Lead_Hour").alias("lead")).agg(F.count("*").alias("n"))
    return g.select("lead", "n", W.exp_decay(lead, 48.0, 0.15).alias("e"), W.half_life_decay(lead, 6.0).alias("h"))


@query("scl16_horizon_schemes", ctes("bt") + """
SELECT Forecast_Day AS day, CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=7 THEN 'Days2to7' WHEN Forecast_Day<=16 THEN 'Days8to16' ELSE 'Days17Plus' END AS replay,
 CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=7 THEN 'Days2to7' WHEN Forecast_Day<=16 THEN 'Days8to16' ELSE 'Day17Plus' END AS capture,
 CASE WHEN Forecast_Day<=1 THEN 'Day1' WHEN Forecast_Day<=3 THEN 'Days2-3' WHEN Forecast_Day<=7 THEN 'Days4-7' WHEN Forecast_Day<=16 THEN 'Days8-16' ELSE 'Day17+' END AS diagnostic,
 CASE WHEN Forecast_Day=1 THEN 'Day1' WHEN Forecast_Day<=3 THEN 'Days2to3' WHEN Forecast_Day<=7 THEN 'Days4to7' WHEN Forecast_Day<=16 THEN 'Days8to16' ELSE 'Informational' END AS scenario,
 CASE WHEN Forecast_Day<=1 THEN 'day1' WHEN Forecast_Day<=3 THEN 'days2to3' WHEN Forecast_Day<=7 THEN 'days4to7' ELSE 'days8plus' END AS day_state,
 CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1""")
def _(spark, d):
    g = replay(spark, d, "Forecast_Day").groupBy(F.col("Forecast_Day").alias("day")).agg(F.count("*").alias("n"))
    return g.select("day", "n", *[B.horizon_bucket("day", s).alias(s) for s in B.HORIZON_SCHEMES])


@query("scl17_slug", """
SELECT regexp_replace(regexp_replace(lower(p_name || ' / ' || p_type), '[^0-9a-z]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1""")
def _(spark, d):
    p = table(spark, d, "part")
    return p.groupBy(K.slug(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug")).agg(F.count("*").alias("n"))


@query("scl18_token_lists", ctes("bt") + """,
t AS (SELECT row_id, CASE WHEN concat_ws('+', CASE WHEN Hour BETWEEN 14 AND 18 THEN 'peak_window' END, CASE WHEN Temperature_DailyMax >= 90 THEN 'hot' END,
   CASE WHEN CloudCover_Norm >= 0.6 THEN 'cloud' END) = '' THEN 'none' ELSE concat_ws('+', CASE WHEN Hour BETWEEN 14 AND 18 THEN 'peak_window' END,
   CASE WHEN Temperature_DailyMax >= 90 THEN 'hot' END, CASE WHEN CloudCover_Norm >= 0.6 THEN 'cloud' END) END AS reason FROM v_bt)
SELECT token, reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT reason, unnest(string_split(reason, '+')) AS token FROM t WHERE reason <> 'none') GROUP BY 1, 2""")
def _(spark, d):
    b = replay(spark, d, "row_id", "Hour", "Temperature_DailyMax", "CloudCover_Norm")
    r = K.token_list((F.col("Hour").between(14, 18), "peak_window"), (F.col("Temperature_DailyMax") >= 90, "hot"), (F.col("CloudCover_Norm") >= 0.6, "cloud"))
    b = b.select(r.alias("reason"))
    return b.select("reason", F.explode(K.tokens("reason")).alias("token")).groupBy("token", "reason").agg(F.count("*").alias("n"))


@query("scl19_json_flatten", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS n, sum(value) AS total FROM events GROUP BY 1""", r4=["total"])
def _(spark, d):
    e = table(spark, d, "events").select(F.from_json("props", "k BIGINT").alias("p"), "value")
    return e.groupBy("p.k").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("scl20_localize_dst", """
WITH l AS (SELECT DISTINCT date_trunc('hour', o_orderdate) + to_hours(CAST(o_orderkey % 4 AS INTEGER)) AS local FROM orders),
r AS (SELECT local, local AT TIME ZONE 'America/Los_Angeles' AS u FROM l)
SELECT CAST(local AS VARCHAR) AS local, CASE WHEN (u AT TIME ZONE 'America/Los_Angeles') <> local
   OR ((u + INTERVAL 1 HOUR) AT TIME ZONE 'America/Los_Angeles') = local OR ((u - INTERVAL 1 HOUR) AT TIME ZONE 'America/Los_Angeles') = local
   THEN NULL ELSE CAST(u AT TIME ZONE 'UTC' AS VARCHAR) END AS instant FROM r""")
def _(spark, d):
    o = table(spark, d, "orders")
    local = F.timestamp_add("HOUR", (F.col("o_orderkey") % 4).cast("int"), F.date_trunc("hour", F.col("o_orderdate").cast("timestamp")))
    o = o.select(local.alias("local")).distinct()
    return o.select(F.col("local").cast("string").alias("local"), K.localize("local", "America/Los_Angeles").cast("string").alias("instant"))


@query("scl21_numeric_coercion", """
SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(count(TRY_CAST(trim(substr(text, 1, 4)) AS DOUBLE)) AS BIGINT) AS numeric_starts,
  CAST(count(TRY_CAST(CAST(n_chars AS VARCHAR) AS DOUBLE)) AS BIGINT) AS ok FROM documents GROUP BY 1""")
def _(spark, d):
    t = table(spark, d, "documents")
    return t.groupBy("lang").agg(F.count("*").alias("n"), F.count(K.to_number(F.trim(F.substring("text", 1, 4)))).alias("numeric_starts"),
                                 F.count(K.to_number(F.col("n_chars").cast("string"))).alias("ok"))


@query("scl22_hour_ending", """
SELECT CAST(hour(ts) + 1 AS INT) AS he, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def _(spark, d):
    return table(spark, d, "events").groupBy(K.hour_ending("ts").alias("he")).agg(F.count("*").alias("n"))


@query("scl23_weather_frame_normalise", """
SELECT CAST(CAST(user_id AS BIGINT) AS VARCHAR) AS site_key, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS n, max(CAST(value AS DOUBLE)) AS mx FROM events GROUP BY 1, 2""", r6=["mx"])
def _(spark, d):
    e = table(spark, d, "events").select(F.trim(F.col("user_id").cast("string")).alias("site_key"), F.to_date("ts").cast("string").alias("day"), F.col("value").cast("double").alias("v"))
    return e.groupBy("site_key", "day").agg(F.count("*").alias("n"), F.max("v").alias("mx"))


@query("scl24_history_window", """
SELECT o_orderstatus AS status, CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 11 MONTH AS DATE)::VARCHAR AS first_day, CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_day
FROM orders GROUP BY 1""")
def _(spark, d):
    g = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.max(F.to_date("o_orderdate")).alias("m"))
    return g.select("status", F.add_months(F.trunc("m", "month"), -11).cast("string").alias("first_day"), F.col("m").cast("string").alias("last_day"))


@query("scl25_add_months", """
SELECT CAST(CAST(o_orderdate AS DATE) + to_months(CAST(o_orderkey % 5 AS INTEGER)) AS DATE)::VARCHAR AS due, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1""")
def _(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy(F.add_months(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")).cast("string").alias("due")).agg(F.count("*").alias("n"))


# ---- calendar projection ------------------------------------------------------------------------

@query("prj01_calendar_features", "WITH " + _HOL_SQL.strip() + """,
h AS (SELECT DISTINCT date_trunc('day', o_orderdate) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS DT FROM orders),
f AS (SELECT DT, CAST(DT AS DATE) AS dd, hour(DT) AS hh, isodow(DT) AS wd, CAST(DT AS DATE) IN (SELECT h FROM hol) AS hol FROM h)
SELECT CAST(DT AS VARCHAR) AS DT, CAST(week(DT) AS INT) AS WeekOfYear, CAST(wd - 1 AS INT) AS DOW, CAST(hol AS INT) AS IsHoliday,
  CAST(wd < 6 AND NOT hol AS INT) AS IsBusinessDay, sin(2*pi()*hh/24) AS HourSin, cos(2*pi()*dayofyear(DT)/366) AS DayOfYearCos,
  CAST(wd >= 6 OR hol OR hh < 7 OR hh >= 22 AS INT) AS IsOffPeak, CAST(wd < 6 AND NOT hol AND hh BETWEEN 16 AND 18 AS INT) AS IsSuperPeak,
  CAST(wd < 6 AND NOT hol AND hh BETWEEN 7 AND 21 AND hh NOT BETWEEN 16 AND 18 AS INT) AS IsOnPeak,
  CAST(wd < 6 AND NOT hol AND hh BETWEEN 16 AND 20 AS INT) AS IsLikelySystemPeakHour
FROM f""", r6=["HourSin", "DayOfYearCos"])
def _(spark, d):
    o = table(spark, d, "orders")
    dt = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp")))
    out = C.add_time_features(o.select(dt.alias("DT")).distinct())
    return out.select(ts(), "WeekOfYear", "DOW", "IsHoliday", "IsBusinessDay", "HourSin", "DayOfYearCos", "IsOffPeak", "IsSuperPeak", "IsOnPeak", "IsLikelySystemPeakHour")


@query("prj02_holiday_flags", "WITH " + _HOL_SQL.strip() + """,
hol2 AS (SELECT h FROM hol UNION ALL SELECT CAST(make_date(CAST(y AS INT)+1, 1, 1) - CASE WHEN isodow(make_date(CAST(y AS INT)+1,1,1))=6 THEN 1 ELSE 0 END + CASE WHEN isodow(make_date(CAST(y AS INT)+1,1,1))=7 THEN 1 ELSE 0 END AS DATE) FROM ys),
dd AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(d AS VARCHAR) AS d, CAST(d IN (SELECT h FROM hol2) AS INT) AS IsHoliday, CAST(d + 1 IN (SELECT h FROM hol2) AS INT) AS IsPreHoliday,
 CAST(d - 1 IN (SELECT h FROM hol2) AS INT) AS IsPostHoliday, CAST(d IN (SELECT h FROM hol2) OR d + 1 IN (SELECT h FROM hol2) OR d - 1 IN (SELECT h FROM hol2) AS INT) AS IsHolidayAdjacent
FROM dd""")
def _(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("Date")).distinct()
    return C.add_holiday_flags(o).withColumn("d", F.col("Date").cast("string")).drop("Date")


# ---- rollups ------------------------------------------------------------------------------------

@query("agg01_completed_hour_rollup", ctes("reading") + """,
h AS (SELECT series, date_trunc('hour', DT) AS hh, avg(value) AS MWH, count(*) AS n, min(value) AS mn, max(value) AS mx,
  arg_max(value, (DT, event_id)) AS last, max(DT) AS ld FROM v_reading GROUP BY 1, 2)
SELECT series, CAST(hh + INTERVAL 1 HOUR AS VARCHAR) AS DT, MWH, CAST(n AS BIGINT) AS n, mn, mx, mx - mn AS rng, last
FROM h WHERE n >= 2 AND epoch(ld) - epoch(hh) >= 30*60""", r6=["MWH", "mn", "mx", "rng", "last"])
def _(spark, d):
    h = I.completed_hours(reading(spark, d), ["series"], "value", min_count=2, last_minute=30, tie=["event_id"])
    return h.select("series", ts(), "MWH", F.col("FiveMin_Interval_Count").alias("n"), F.col("FiveMin_Hourly_Min_MW").alias("mn"),
                    F.col("FiveMin_Hourly_Max_MW").alias("mx"), F.col("FiveMin_Hourly_Range_MW").alias("rng"), F.col("FiveMin_Hourly_Last_MW").alias("last"))


_PREV_SQL = """
h AS (SELECT series, date_trunc('hour', DT) AS hh, avg(value) AS a, count(*) AS n, min(value) AS mn, max(value) AS mx,
  arg_max(value, (DT, event_id)) AS l, arg_min(value, (DT, event_id)) AS f FROM v_reading GROUP BY 1, 2),
p AS (SELECT series, DT, arg_max(value, event_id) AS v FROM v_reading GROUP BY 1, 2),
prev AS (SELECT h.*, h.hh + INTERVAL 2 HOUR AS fdt, l - p15.v AS r15, l - p30.v AS r30, l - p60.v AS r60 FROM h
 ASOF LEFT JOIN p p15 ON h.series = p15.series AND h.hh + INTERVAL 45 MINUTE >= p15.DT
 ASOF LEFT JOIN p p30 ON h.series = p30.series AND h.hh + INTERVAL 30 MINUTE >= p30.DT
 ASOF LEFT JOIN p p60 ON h.series = p60.series AND h.hh >= p60.DT)"""


@query("agg02_previous_hour_features", ctes("reading") + "," + _PREV_SQL + """
SELECT series, CAST(fdt AS VARCHAR) AS DT, a AS avg, mx - mn AS rng, l - f AS ramp, CAST(n AS DOUBLE) AS n, r15, r30, r60 FROM prev""",
       r6=["avg", "rng", "ramp", "r15", "r30", "r60"])
def _(spark, d):
    h = I.previous_hour_features(reading(spark, d), ["series"], "value", tie=["event_id"])
    return h.select("series", ts(), F.col("FiveMin_PrevHour_Avg_MW").alias("avg"), F.col("FiveMin_PrevHour_Range_MW").alias("rng"),
                    F.col("FiveMin_PrevHour_Ramp_MW").alias("ramp"), F.col("FiveMin_PrevHour_Count").alias("n"),
                    *[F.col(f"FiveMin_Ramp_{m}Min_MW").alias(f"r{m}") for m in (15, 30, 60)])


@query("win11_asof_delta", ctes("reading") + "," + _PREV_SQL + """
SELECT series, CAST(CAST(hh AS DATE) AS VARCHAR) AS day, avg(r15) AS r15, avg(r30) AS r30, avg(r60) AS r60, CAST(count(r60) AS BIGINT) AS n60 FROM prev GROUP BY 1, 2""", r6=["r15", "r30", "r60"])
def _(spark, d):
    h = I.previous_hour_features(reading(spark, d), ["series"], "value", tie=["event_id"])
    day = F.to_date(F.col("DT") - F.expr("INTERVAL 2 HOURS")).cast("string").alias("day")
    return h.groupBy("series", day).agg(*[F.avg(f"FiveMin_Ramp_{m}Min_MW").alias(f"r{m}") for m in (15, 30, 60)], F.count("FiveMin_Ramp_60Min_MW").alias("n60"))


# ---- windows ------------------------------------------------------------------------------------

_LAG_SQL = ",\n".join(f"(SELECT MWH FROM v_load b WHERE b.series = a.series AND b.eh = a.eh - {n}) AS Lag{n}" for n in L.LAGS)


@query("win02_calendar_lags", ctes("load") + f"""
SELECT series, CAST(DT AS VARCHAR) AS DT, {_LAG_SQL} FROM v_load a""", r6=[f"Lag{n}" for n in L.LAGS])
def _(spark, d):
    out = L.add_calendar_lags(load(spark, d))
    return out.select("series", ts(), *[F.col(f"MWH_Lag{n}").alias(f"Lag{n}") for n in L.LAGS])


_ROLL_SQL = ",\n".join(
    f"CASE WHEN count(MWH) OVER (PARTITION BY series ORDER BY eh RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING) >= {max(2, n // 2)} "
    f"THEN avg(MWH) OVER (PARTITION BY series ORDER BY eh RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS r{n}" for n in L.ROLLING)


@query("win03_shifted_rolling", ctes("load") + f"""
SELECT series, CAST(DT AS VARCHAR) AS DT, {_ROLL_SQL},
 coalesce(CASE WHEN count(MWH) OVER (PARTITION BY series ORDER BY eh RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING) >= 12
   THEN stddev_samp(MWH) OVER (PARTITION BY series ORDER BY eh RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING) END, 0) AS sd
FROM v_load""", r6=[*[f"r{n}" for n in L.ROLLING], "sd"])
def _(spark, d):
    out = L.add_calendar_lags(load(spark, d))
    return out.select("series", ts(), *[F.col(f"MWH_Rolling{n}").alias(f"r{n}") for n in L.ROLLING], F.col("MWH_Rolling24Std").alias("sd"))


@query("win04_same_hour_week_mean", ctes("load") + """
SELECT a.series, CAST(a.DT AS VARCHAR) AS DT, avg(b.MWH) AS m, CAST(count(b.MWH) AS BIGINT) AS n FROM v_load a
LEFT JOIN v_load b ON a.series = b.series AND a.eh - b.eh IN (24,48,72,96,120,144,168) GROUP BY 1, 2""", r6=["m"])
def _(spark, d):
    out = L.add_calendar_lags(load(spark, d), lags=[24 * i for i in range(1, 8)], rolling=[])
    n = sum(F.col(f"MWH_Lag{24 * i}").isNotNull().cast("long") for i in range(1, 8))
    return out.select("series", ts(), F.col("MWH_SameHour7DayMean").alias("m"), n.alias("n"))


@query("win05_row_baselines", ctes("load") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, lag(MWH, 24) OVER w AS b24, lag(MWH, 168) OVER w AS b168,
  CASE WHEN count(MWH) OVER (PARTITION BY series, hour(DT) ORDER BY eh ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 2
   THEN avg(MWH) OVER (PARTITION BY series, hour(DT) ORDER BY eh ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS b7
FROM v_load WINDOW w AS (PARTITION BY series ORDER BY eh)""", r6=["b24", "b168", "b7"])
def _(spark, d):
    out = L.add_row_baselines(load(spark, d).withColumn("Hour", F.hour("DT")), ["series"], "MWH", "DT")
    return out.select("series", ts(), F.col("Baseline_SameHourYesterday_MWH").alias("b24"), F.col("Baseline_SameHour7DaysAgo_MWH").alias("b168"),
                      F.col("Baseline_Rolling7DaySameHourAvg_MWH").alias("b7"))


@query("win01_keep_last", ctes("bt") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, arg_min(row_id, (Forecast_Day, row_id)) AS row_id, CAST(min(Forecast_Day) AS INT) AS Forecast_Day, CAST(count(*) AS BIGINT) AS copies
FROM v_bt GROUP BY 1, 2""")
def _(spark, d):
    b = replay(spark, d, "series", "DT", "row_id", "Forecast_Day")
    from ..core import keep_first
    one = keep_first(b, ["series", "DT"], ["Forecast_Day", "row_id"])
    n = b.groupBy("series", "DT").agg(F.count("*").alias("copies"))
    return one.join(n, ["series", "DT"]).select("series", ts(), "row_id", "Forecast_Day", "copies")


# ---- as-of and feature frames -------------------------------------------------------------------

@query("joi03_asof_backward_tolerance", ctes("reading") + "," + _PREV_SQL + """,
fr AS (SELECT DISTINCT series, date_trunc('hour', DT) + INTERVAL 3 HOUR AS DT FROM v_reading),
j AS (SELECT fr.series, fr.DT, prev.fdt, prev.a, prev.r60, (epoch(fr.DT) - epoch(prev.fdt))/3600 AS age FROM fr ASOF LEFT JOIN prev ON fr.series = prev.series AND fr.DT >= prev.fdt)
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE WHEN age <= 1 THEN a ELSE 0 END AS avg, CASE WHEN age <= 1 THEN coalesce(r60, 0) ELSE 0 END AS r60,
  CASE WHEN age <= 1 THEN age ELSE 2 END AS age, CASE WHEN age <= 1 THEN 1.0 ELSE 0.0 END AS ok FROM j""", r6=["avg", "r60", "age", "ok"])
def _(spark, d):
    r = reading(spark, d)
    f = I.previous_hour_features(r, ["series"], "value", tie=["event_id"])
    frame = r.select("series", (F.date_trunc("hour", "DT") + F.expr("INTERVAL 3 HOURS")).alias("DT")).distinct()
    j = I.attach_carried(frame, f, ["series"], 1)
    return j.select("series", ts(), F.col("FiveMin_PrevHour_Avg_MW").alias("avg"), F.col("FiveMin_Ramp_60Min_MW").alias("r60"),
                    F.col("FiveMin_Data_Age_Hours").alias("age"), F.col("FiveMin_Load_Available").alias("ok"))


@query("joi03_exact_feature_join", ctes("reading") + "," + _PREV_SQL + """,
fr AS (SELECT DISTINCT series, date_trunc('hour', DT) AS DT FROM v_reading)
SELECT fr.series, CAST(fr.DT AS VARCHAR) AS DT, coalesce(a, 0) AS avg, CASE WHEN fdt IS NULL THEN 25.0 ELSE 0.0 END AS age
FROM fr LEFT JOIN prev ON fr.series = prev.series AND fr.DT = prev.fdt""", r6=["avg", "age"])
def _(spark, d):
    r = reading(spark, d)
    f = I.previous_hour_features(r, ["series"], "value", tie=["event_id"])
    j = I.attach_exact(r.select("series", F.date_trunc("hour", "DT").alias("DT")).distinct(), f)
    return j.select("series", ts(), F.col("FiveMin_PrevHour_Avg_MW").alias("avg"), F.col("FiveMin_Data_Age_Hours").alias("age"))


@query("prj07_zeroed_features", ctes("load") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, 0.0 AS avail, sum(999.0) AS age FROM v_load GROUP BY 1""", r6=["avail", "age"])
def _(spark, d):
    z = I.zeroed(load(spark, d))
    return z.groupBy("series").agg(F.count("*").alias("n"), F.sum("FiveMin_Load_Available").alias("avail"), F.sum("FiveMin_Data_Age_Hours").alias("age"))


@query("set02_union_replace_overlap", ctes("load") + """,
off AS (SELECT series, DT, MWH, 'hourly_history' AS src FROM v_load WHERE DT < TIMESTAMP '2024-01-20'),
lim AS (SELECT series, max(DT) AS m FROM off GROUP BY 1),
rec AS (SELECT l.series, l.DT + INTERVAL 1 HOUR AS DT, l.MWH, 'five_min_completed_hour' AS src FROM v_load l JOIN lim USING (series) WHERE l.DT + INTERVAL 1 HOUR > lim.m - INTERVAL 48 HOUR),
a AS (SELECT * FROM off UNION ALL SELECT * FROM rec)
SELECT series, CAST(DT AS VARCHAR) AS DT, arg_max(MWH, src) AS MWH, max(src) AS src FROM a GROUP BY 1, 2""", r6=["MWH"])
def _(spark, d):
    off = load(spark, d).where("DT < TIMESTAMP'2024-01-20'").select("series", "DT", "MWH")
    rec = I.completed_hours(reading(spark, d), ["series"], "value", min_count=1, last_minute=None).select("series", "DT", "MWH", "Load_Source")
    return I.append_recent_hours(off, rec, ["series"], 48).select("series", ts(), "MWH", F.col("Load_Source").alias("src"))
