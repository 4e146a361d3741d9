"""Queries: the solar export chain."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import solar as S
from .base import Entry, _duck_cols, _spark_cols, ctes, query, site, table, weather

_Q = "((l_orderkey * 7 + l_linenumber) % 96)"
INT: list[Entry] = [
    ("site", "l_suppkey"), ("seg", "l_returnflag"), ("row_id", "l_orderkey * 10 + l_linenumber"),
    ("IntervalStartDT", f"timestampadd(MINUTE, CAST({_Q} * 15 AS INT), CAST(l_shipdate AS TIMESTAMP))", f"CAST(l_shipdate AS TIMESTAMP) + to_minutes(CAST({_Q} * 15 AS INTEGER))"),
    ("Date", "CAST(l_shipdate AS DATE)"), ("q", f"CAST({_Q} AS INT)"),
    ("Actual_kWh", f"CASE WHEN {_Q} BETWEEN 24 AND 72 THEN l_quantity * 100 * (1 - l_discount * 8 * (l_orderkey % 7) / 6e0) ELSE 0e0 END"),
    ("Forecast_kWh", f"CASE WHEN {_Q} BETWEEN 22 AND 74 THEN l_quantity * 100 * (1 + l_tax) ELSE 0e0 END"),
    ("GHI_kWh_per_m2", "(l_partkey % 10) / 10e0"), ("ClearSkyIndex", "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE (l_partkey % 13) / 10e0 END"),
    ("CloudCoverPct", "CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE (l_partkey * 3 % 101) * 1e0 END"), ("SolarElevationDeg", "(l_suppkey * 7 % 100) - 20e0"),
    ("reads", "CAST(l_linenumber AS BIGINT)"), ("ExportSource", "CASE WHEN l_linestatus = 'O' THEN 'REC' ELSE 'NET_NEGATIVE' END"),
]
SQL_INT = f"v_int AS (SELECT {_duck_cols(INT)}, 0 AS one FROM lineitem), v_mw AS (SELECT *, Actual_kWh/1000 AS Actual_MW, Forecast_kWh/1000 AS Forecast_MW FROM v_int)"


def intervals(spark, d):
    return table(spark, d, "lineitem").select(*_spark_cols(INT)).withColumns({"Actual_MW": F.col("Actual_kWh") / 1000, "Forecast_MW": F.col("Forecast_kWh") / 1000, "Forecast_kW": F.col("Forecast_kWh") * 4})


def W(sql):
    return "WITH " + SQL_INT + sql


def dstr(c):
    return F.col(c).cast("string").alias(c)


@query("prj19_customer_segments", ctes("site") + """
SELECT site, CASE WHEN m IN ('AMI_NET','AMI_NET_D') THEN 'NEM' WHEN m LIKE '%SLR2%' OR m LIKE '%TSL2%' OR r LIKE 'E2%' OR r LIKE '%SL%' THEN 'SOLAR_2_0' ELSE 'OTHER' END AS seg
FROM (SELECT site, CASE site % 5 WHEN 0 THEN 'AMI_NET' WHEN 1 THEN 'XSLR2' WHEN 2 THEN ' ami_net_d ' WHEN 3 THEN NULL ELSE 'AMI' END AS m0, upper(trim(CASE site % 5 WHEN 0 THEN 'AMI_NET' WHEN 1 THEN 'XSLR2' WHEN 2 THEN ' ami_net_d ' WHEN 3 THEN '' ELSE 'AMI' END)) AS m, CASE site % 3 WHEN 0 THEN 'E20' WHEN 1 THEN 'RSL1' ELSE 'GS1' END AS r FROM v_site)""")
def _(spark, d):
    s, k = site(spark, d), F.col("site")
    m = F.when(k % 5 == 0, "AMI_NET").when(k % 5 == 1, "XSLR2").when(k % 5 == 2, " ami_net_d ").when(k % 5 == 4, "AMI")
    r = F.when(k % 3 == 0, "E20").when(k % 3 == 1, "RSL1").otherwise("GS1")
    return s.select("site", S.segment_of(m, r).alias("seg"))


@query("src13_eligible_sites", ctes("site") + """
SELECT MeterType, CAST(count(*) AS BIGINT) AS n, sum(capacity_kw) AS kw FROM v_site WHERE capacity_kw > 0 GROUP BY 1""", r4=["kw"])
def _(spark, d):
    return site(spark, d).where("capacity_kw > 0").groupBy("MeterType").agg(F.count("*").alias("n"), F.sum("capacity_kw").alias("kw"))


def pos_sql(src, dt, lat, lon, off):
    return f"""
p1 AS (SELECT *, {dt} + INTERVAL 450 SECOND AS mid FROM {src}), p2 AS (SELECT *, hour(mid) + minute(mid)/60.0 + second(mid)/3600.0 AS lh FROM p1),
p3 AS (SELECT *, 2*pi()/365*(dayofyear(mid) - 1 + (lh-12)/24) AS g FROM p2),
p4 AS (SELECT *, 229.18*(0.000075+0.001868*cos(g)-0.032077*sin(g)-0.014615*cos(2*g)-0.040849*sin(2*g)) AS eq, 0.006918-0.399912*cos(g)+0.070257*sin(g)-0.006758*cos(2*g)+0.000907*sin(2*g)-0.002697*cos(3*g)+0.00148*sin(3*g) AS dec FROM p3),
p5 AS (SELECT *, lh*60 + eq + 4*({lon}) - 60*({off}) AS t0 FROM p4), p6 AS (SELECT *, radians((t0 - floor(t0/1440)*1440)/4 - 180) AS ha, radians({lat}) AS la FROM p5),
v_pos AS (SELECT *, degrees(asin(sin(la)*sin(dec)+cos(la)*cos(dec)*cos(ha))) AS elev, degrees((atan2(sin(ha), cos(ha)*sin(la)-tan(dec)*cos(la)) + pi()) - floor((atan2(sin(ha), cos(ha)*sin(la)-tan(dec)*cos(la)) + pi())/(2*pi()))*2*pi()) AS az FROM p6)"""


# daylight time of the tables' years: first Sunday of April to last Sunday of October, 2 o'clock
_APR, _OCT = "make_date(year(dt), 4, 1)", "make_date(year(dt), 10, 31)"
DST_SQL = f"CASE WHEN dt >= CAST({_APR} + CAST((7 - isodow({_APR})) % 7 AS INTEGER) AS TIMESTAMP) + INTERVAL 2 HOUR AND dt < CAST({_OCT} - CAST(isodow({_OCT}) % 7 AS INTEGER) AS TIMESTAMP) + INTERVAL 2 HOUR THEN -7 ELSE -8 END"


@query("scl11_solar_position", f"WITH o AS (SELECT DISTINCT date_trunc('day', o_orderdate) + to_minutes(CAST(o_orderkey % 96 * 15 AS INTEGER)) AS dt FROM orders), oo AS (SELECT *, {DST_SQL} AS off FROM o)," + pos_sql("oo", "dt", "38.75", "-121.29", "off") + """
SELECT CAST(dt AS VARCHAR) AS dt, elev, az FROM v_pos""", r6=["elev", "az"])
def _(spark, d):
    o = table(spark, d, "orders")
    o = o.select(F.timestamp_add("MINUTE", (F.col("o_orderkey") % 96 * 15).cast("int"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp"))).alias("dt")).distinct()
    e, a = S.solar_position(F.col("dt"), 38.75, -121.29, S.local_utc_offset(F.col("dt"), "America/Los_Angeles"))
    return o.select(dstr("dt"), e.alias("elev"), a.alias("az"))


PHYS_SQL = "ww AS (SELECT * FROM v_weather)," + pos_sql("ww", "DT", "38.75", "-121.29", "-8") + f""",
y1 AS (SELECT *, greatest(sin(radians(elev)),0) AS zc FROM v_pos), y2 AS (SELECT *, CASE WHEN zc > 0 THEN 1098*zc*exp(-0.059/greatest(zc,0.065)) ELSE 0 END AS sky FROM y1),
y3 AS (SELECT *, CASE WHEN sky = 0 THEN 0 ELSE least(GHI_Wm2/sky,1.6) END AS csi FROM y2), y4 AS (SELECT *, GHI_Wm2*least(greatest(0.25+0.55*(1-least(csi,1)),0.2),0.85) AS dif FROM y3),
y5 AS (SELECT *, greatest(GHI_Wm2-dif,0) AS dirr, least(greatest(cos(radians(90-elev))*{math.cos(math.radians(25))!r} + sin(radians(90-elev))*{math.sin(math.radians(25))!r}*cos(radians(az)-pi()),0),1) AS inc FROM y4),
y6 AS (SELECT *, dirr*CASE WHEN zc = 0 THEN 0 ELSE least(inc/zc,4) END + dif*(1+{math.cos(math.radians(25))!r})/2 + GHI_Wm2*0.2*(1-{math.cos(math.radians(25))!r})/2 AS poa FROM y5),
y7 AS (SELECT *, coalesce((TempF-32)*5/9, 25) + poa/800*25 - coalesce(WindSpeedMph,0)*0.44704*0.35 AS cell FROM y6)"""


@query("scl12_pv_physics", ctes("weather") + "," + PHYS_SQL + """
SELECT series, CAST(DT AS VARCHAR) AS DT, csi, inc, poa, cell, greatest(poa/1000*least(greatest(1-0.004*(cell-25),0.7),1.08),0) AS kwh FROM y7""", r6=["csi", "inc", "poa", "cell", "kwh"])
def _(spark, d):
    from ..functions.weather import celsius, metres_per_second
    w = weather(spark, d)
    e, a = S.solar_position(F.col("DT"), 38.75, -121.29, F.lit(-8.0))
    nul = F.lit(None).cast("double")
    w = w.select("series", "DT", e.alias("SolarElevationDeg"), a.alias("SolarAzimuthDeg"), F.col("GHI_Wm2").alias("WeatherGHI_Wm2"), F.coalesce(celsius("TempF", F.lit("F")), F.lit(25.0)).alias("Temperature2m_C"),
                 F.coalesce(metres_per_second("WindSpeedMph", F.lit("mph")), F.lit(0.0)).alias("WindSpeed10m_mps"), *[nul.alias(n) for n in ("DiffuseRadiation_Wm2", "DirectRadiation_Wm2", "DirectNormalIrradiance_Wm2", "GlobalTiltedIrradiance_Wm2")])
    o = S.add_physics(w)
    return o.select("series", dstr("DT"), F.col("ClearSkyIndex").alias("csi"), F.col("IncidenceAngleCos").alias("inc"), F.col("PlaneOfArrayIrradiance_Wm2").alias("poa"), F.col("CellTemperature_C").alias("cell"), F.col("PVWatts_kWh_per_kW").alias("kwh"))


@query("scl13_weather_defaults", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, coalesce((TempF-32)*5/9, m, 25) AS t, coalesce(WindSpeedMph,0) AS w, coalesce(CloudCoverPct,0) AS c, coalesce(GHI_Wm2/1000,0) AS g FROM v_weather LEFT JOIN (SELECT series AS k, quantile_cont((TempF-32)*5/9, 0.5) AS m FROM v_weather GROUP BY 1) ON k IS NOT DISTINCT FROM series""", r6=["t", "w", "c", "g"])
def _(spark, d):
    from ..functions.weather import celsius
    w = weather(spark, d).select("series", "DT", celsius("TempF", F.lit("F")).alias("Temperature2m_C"), F.col("WindSpeedMph").alias("WindSpeed10m_mps"), "CloudCoverPct", F.lit(None).cast("double").alias("GHI_kWh_per_m2"), F.col("GHI_Wm2").alias("WeatherGHI_Wm2"))
    return S.default_weather(w).select("series", dstr("DT"), F.col("Temperature2m_C").alias("t"), F.col("WindSpeed10m_mps").alias("w"), F.col("CloudCoverPct").alias("c"), F.col("GHI_kWh_per_m2").alias("g"))


@query("prj16_low_sun_zeroing", W("""
SELECT seg, sum(CASE WHEN SolarElevationDeg < 3 THEN 0 ELSE Forecast_kWh END) AS f, sum(CASE WHEN SolarElevationDeg < 3 THEN 0 ELSE Actual_kWh END) AS a, CAST(count(*) FILTER (SolarElevationDeg < 3) AS BIGINT) AS low FROM v_int GROUP BY 1"""), r4=["f", "a"])
def _(spark, d):
    z = S.zero_low_sun(intervals(spark, d), "SolarElevationDeg", 3.0, ["Forecast_kWh", "Actual_kWh"])
    return z.groupBy("seg").agg(F.sum("Forecast_kWh").alias("f"), F.sum("Actual_kWh").alias("a"), F.count(F.when(F.col("SolarElevationDeg") < 3, 1)).alias("low"))


@query("agg11_capacity_weighted_weather", "WITH w AS (SELECT s_nationkey AS cluster, sum(s_acctbal) FILTER (s_acctbal > 0) AS kw FROM supplier GROUP BY 1)," + SQL_INT + """,
j AS (SELECT v_int.*, kw FROM v_int JOIN supplier ON site = s_suppkey LEFT JOIN w ON s_nationkey = cluster)
SELECT CAST("Date" AS VARCHAR) AS Date, sum(CloudCoverPct*kw)/sum(kw) FILTER (CloudCoverPct IS NOT NULL) AS cloud, sum(GHI_kWh_per_m2*kw)/sum(kw) AS ghi FROM j GROUP BY 1""", r6=["cloud", "ghi"])
def _(spark, d):
    s = site(spark, d)
    w = intervals(spark, d).join(s.select("site", "cluster"), "site")
    o = S.weighted_by_capacity(w, s, "cluster", "Date", ["CloudCoverPct", "GHI_kWh_per_m2"])
    return o.select(dstr("Date"), F.col("CloudCoverPct").alias("cloud"), F.col("GHI_kWh_per_m2").alias("ghi"))


@query("agg12_hourly_weather_mean", W("""
SELECT CAST(date_trunc('hour', IntervalStartDT) AS VARCHAR) AS h, avg(CloudCoverPct) AS cloud, avg(GHI_kWh_per_m2) AS ghi FROM v_int GROUP BY 1"""), r6=["cloud", "ghi"])
def _(spark, d):
    o = S.hourly_mean(intervals(spark, d).withColumn("h", F.date_trunc("hour", "IntervalStartDT")), "h", ["CloudCoverPct", "GHI_kWh_per_m2"])
    return o.select(dstr("h"), F.col("CloudCoverPct").alias("cloud"), F.col("GHI_kWh_per_m2").alias("ghi"))


@query("agg13_segment_collapse", W("""
SELECT CAST(IntervalStartDT AS VARCHAR) AS t, sum(Actual_kWh) AS kwh, array_to_string(list_sort(list(DISTINCT ExportSource)), '+') AS src FROM v_int GROUP BY 1"""), r4=["kwh"])
def _(spark, d):
    o = S.collapse_segments(intervals(spark, d), energy="Actual_kWh")
    return o.select(F.col("IntervalStartDT").cast("string").alias("t"), F.col("Actual_kWh").alias("kwh"), F.col("ExportSource").alias("src"))


@query("agg14_hourly_resample", W(""",
h AS (SELECT seg, date_trunc('hour', IntervalStartDT) AS h, sum(Forecast_kWh) AS e, max(Forecast_kWh*4) AS mx FROM v_int GROUP BY 1, 2),
g AS (SELECT seg, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM h GROUP BY 1)
SELECT seg, CAST(CAST(g.h AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS hours, sum(coalesce(e,0)) AS e, max(mx) AS mx FROM g LEFT JOIN h USING (seg, h) GROUP BY 1, 2"""), r4=["e", "mx"])
def _(spark, d):
    o = S.to_hourly(intervals(spark, d), ["seg"], fill_gaps=True)
    return o.groupBy("seg", F.to_date("HourDT").cast("string").alias("day")).agg(F.count("*").alias("hours"), F.sum("Forecast_kWh").alias("e"), F.max("Max_Forecast_kW").alias("mx"))


@query("agg15_active_capacity", ctes("site") + """,
dd AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(d AS VARCHAR) AS Date, coalesce((SELECT sum(capacity_kw) FROM v_site WHERE capacity_kw > 0 AND greatest("InterconnectionDate", (SELECT min(d) FROM dd)) <= dd.d),0) AS kw FROM dd""", r4=["kw"])
def _(spark, d):
    dd = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("Date")).distinct()
    return S.active_capacity(dd, site(spark, d)).select(dstr("Date"), F.col("ActiveCapacity_kW").alias("kw"))


@query("agg16_daily_shape", W(""",
b AS (SELECT seg, "Date", q, Actual_kWh AS v FROM v_int), pk AS (SELECT seg, "Date", max(v) AS p FROM b GROUP BY 1, 2 HAVING max(v) > 0),
s AS (SELECT seg, q, quantile_cont(v/p, 0.75) AS x FROM b JOIN pk USING (seg, "Date") GROUP BY 1, 2), r AS (SELECT seg, quantile_cont(p, 0.75) AS ref FROM pk GROUP BY 1), t AS (SELECT seg, max(x) AS top FROM s GROUP BY 1)
SELECT g.seg, CAST(sl AS INT) AS slot, coalesce(x,0)/top*ref AS kw FROM (SELECT DISTINCT seg, sl FROM v_int, range(96) z(sl)) g LEFT JOIN s ON s.seg = g.seg AND s.q = g.sl JOIN r ON r.seg = g.seg JOIN t ON t.seg = g.seg"""), r6=["kw"])
def _(spark, d):
    o = S.daily_shape(intervals(spark, d), "Actual_kWh", ["seg"])
    return o.select("seg", "slot", F.col("Average_kW").alias("kw"))


@query("agg17_intrahour_shape", W(""",
b AS (SELECT date_trunc('hour', IntervalStartDT) AS h, hour(IntervalStartDT) AS hh, minute(IntervalStartDT) AS mm, Actual_kWh AS v FROM v_int), tt AS (SELECT h, sum(v) AS t FROM b GROUP BY 1 HAVING sum(v) > 0),
s AS (SELECT hh, mm, quantile_cont(v/t, 0.75) AS x FROM b JOIN tt USING (h) GROUP BY 1, 2), g AS (SELECT hh, mm FROM range(24) a(hh), (VALUES (0),(15),(30),(45)) c(mm))
SELECT CAST(g.hh AS INT) AS hour, CAST(g.mm AS INT) AS minute, CASE WHEN sum(x) OVER (PARTITION BY g.hh) > 0 THEN coalesce(x,0)/sum(x) OVER (PARTITION BY g.hh) ELSE 0.25 END AS k FROM g LEFT JOIN s ON g.hh = s.hh AND g.mm = s.mm"""), r6=["k"])
def _(spark, d):
    return S.intrahour_shape(intervals(spark, d), "Actual_kWh").withColumnRenamed("IntraHourCoefficient", "k")


@query("joi13_quarter_hour_fan_out", W(""",
b AS (SELECT date_trunc('hour', IntervalStartDT) AS h, hour(IntervalStartDT) AS hh, minute(IntervalStartDT) AS mm, Actual_kWh AS v FROM v_int), tt AS (SELECT h, sum(v) AS t FROM b GROUP BY 1 HAVING sum(v) > 0),
s AS (SELECT hh, mm, avg(v/t) AS x FROM b JOIN tt USING (h) GROUP BY 1, 2), g AS (SELECT hh, mm FROM range(24) a(hh), (VALUES (0),(15),(30),(45)) c(mm)),
k AS (SELECT g.hh, g.mm, CASE WHEN sum(x) OVER (PARTITION BY g.hh) > 0 THEN coalesce(x,0)/sum(x) OVER (PARTITION BY g.hh) ELSE 0.25 END AS k FROM g LEFT JOIN s ON g.hh = s.hh AND g.mm = s.mm),
hr AS (SELECT date_trunc('hour', IntervalStartDT) AS h, sum(Forecast_kWh) AS e, max(SolarElevationDeg) AS el FROM v_int GROUP BY 1), th AS (SELECT quantile_cont(e, 0.9) AS t FROM hr),
m AS (SELECT h, mm, e, CASE WHEN t > 0 AND e >= t AND el >= 25 THEN 0.6*k + 0.4*CASE mm WHEN 0 THEN 0.2 WHEN 15 THEN 0.24 WHEN 30 THEN 0.27 ELSE 0.29 END ELSE k END AS k2 FROM hr, th JOIN k ON hour(hr.h) = k.hh)
SELECT CAST(h + to_minutes(CAST(mm AS INTEGER)) AS VARCHAR) AS t, e*k2/sum(k2) OVER (PARTITION BY h) AS kwh FROM m"""), r4=["kwh"])
def _(spark, d):
    i = intervals(spark, d)
    hr = i.groupBy(F.date_trunc("hour", "IntervalStartDT").alias("IntervalStartDT")).agg(F.sum("Forecast_kWh").alias("Hourly_kWh"), F.max("SolarElevationDeg").alias("SolarElevationDeg"))
    o = S.fan_to_quarters(hr, S.intrahour_shape(i, "Actual_kWh", method="mean"))
    return o.select(F.col("IntervalStartDT").cast("string").alias("t"), F.col("Forecast_kWh").alias("kwh"))


@query("joi14_export_semi_join", """WITH lk AS (SELECT l_suppkey AS spid, CASE WHEN l_linestatus='O' THEN 'REC' ELSE 'NET_NEGATIVE' END AS source, CAST(year(l_shipdate)*100+month(l_shipdate) AS BIGINT) AS month, l_linenumber AS file_id, count(*) AS n, max(l_orderkey) AS md FROM lineitem GROUP BY 1,2,3,4),
bs AS (SELECT *, row_number() OVER (PARTITION BY spid, source, month ORDER BY n DESC, md DESC, file_id DESC) AS rn FROM lk WHERE spid IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)),
r AS (SELECT l_suppkey AS spid, CASE WHEN l_linestatus='O' THEN 'REC' ELSE 'NET_NEGATIVE' END AS source, CAST(l_shipdate AS TIMESTAMP) + to_minutes(CAST((l_orderkey*7+l_linenumber)%96*15 AS INTEGER)) AS t, l_linenumber AS file_id, CASE WHEN l_linestatus='O' THEN l_quantity-10 ELSE 10-l_quantity END AS kwh, l_orderkey AS seq FROM lineitem),
f AS (SELECT r.spid, r.source, t, arg_max(greatest(CASE WHEN r.source='NET_NEGATIVE' THEN -kwh ELSE kwh END,0), seq) AS e FROM r JOIN bs ON bs.spid=r.spid AND bs.source=r.source AND bs.month=CAST(year(t)*100+month(t) AS BIGINT) AND bs.file_id=r.file_id AND rn=1 WHERE t >= TIMESTAMP '1996-01-01' AND t < TIMESTAMP '1999-01-01' GROUP BY 1,2,3)
SELECT CAST(t AS VARCHAR) AS t, sum(e) AS kwh, array_to_string(list_sort(list(DISTINCT source)),'+') AS src FROM f GROUP BY 1""", r4=["kwh"])
def _(spark, d):
    li = table(spark, d, "lineitem")
    src = F.when(F.col("l_linestatus") == "O", "REC").otherwise("NET_NEGATIVE")
    dt = F.timestamp_add("MINUTE", ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 96 * 15).cast("int"), F.col("l_shipdate").cast("timestamp"))
    mon = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("long")
    r = li.select(F.col("l_suppkey").alias("spid"), src.alias("source"), (dt + F.expr("INTERVAL 15 MINUTES")).alias("EndDT"), mon.alias("month"), F.col("l_linenumber").alias("file_id"),
                  F.when(F.col("l_linestatus") == "O", F.col("l_quantity") - 10).otherwise(10 - F.col("l_quantity")).alias("kwh"), F.col("l_orderkey").alias("seq"))
    lk = r.groupBy("spid", "source", "month", "file_id").agg(F.count("*").alias("row_count"), F.max("seq").alias("modified")).withColumn("location", F.col("spid"))
    st = site(spark, d).where("capacity_kw > 0").select(F.col("site").alias("location"))
    o = S.export_intervals(r, st, lk, "1996-01-01", "1999-01-01")
    return o.select(F.col("IntervalStartDT").cast("string").alias("t"), F.col("Export_kWh").alias("kwh"), F.col("ExportSource").alias("src"))


QUAL_SQL = """, ty AS (SELECT seg, quantile_cont(reads, 0.9) AS typ FROM v_int WHERE reads > 0 GROUP BY 1),
q1 AS (SELECT v_mw.*, CASE WHEN Forecast_kWh > 0 THEN Actual_kWh/Forecast_kWh END AS ratio, reads/typ AS rc FROM v_mw JOIN ty USING (seg)),
q2 AS (SELECT *, coalesce(Forecast_kWh >= 2500 AND GHI_kWh_per_m2 >= 0.35 AND rc <= 0.25, FALSE) OR coalesce(Forecast_kWh >= 2500 AND GHI_kWh_per_m2 >= 0.35 AND ClearSkyIndex >= 0.55 AND ratio <= 0.45, FALSE) AS sus FROM q1),
q3 AS (SELECT seg, "Date", count(*) FILTER (sus) >= 2 AND quantile_cont(rc, 0.5) <= 0.25 AS bad FROM q2 GROUP BY 1, 2), v_q AS (SELECT q2.*, sus OR bad AS ex FROM q2 JOIN q3 USING (seg, "Date"))"""


def flagged(spark, d):
    return S.quality_flags(intervals(spark, d), "Actual_kWh", "Forecast_kWh", 0.9, "reads", ["seg"])


@query("prj17_actual_quality_flags", W(QUAL_SQL + """
SELECT seg, ex AS excluded, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (sus) AS BIGINT) AS sus FROM (SELECT seg, CAST(ex AS INT) AS ex, sus FROM v_q) GROUP BY 1, 2"""))
def _(spark, d):
    return flagged(spark, d).groupBy("seg", F.col("SolarBacktestExcluded").cast("int").alias("excluded")).agg(F.count("*").alias("n"), F.count(F.when(F.col("ActualQualitySuspiciousHour"), 1)).alias("sus"))


@query("prj18_usable_training_days", W(""",
dy AS (SELECT seg, "Date", sum(Actual_kWh) AS a, sum(Forecast_kWh) AS f FROM v_int WHERE Forecast_kWh >= 50 GROUP BY 1, 2)
SELECT seg, CAST(count(*) AS BIGINT) AS n, sum(Actual_kWh) AS a FROM v_int WHERE EXISTS (SELECT 1 FROM dy WHERE dy.seg = v_int.seg AND dy."Date" = v_int."Date" AND (f < 5000 OR a/f >= 0.6)) GROUP BY 1"""), r4=["a"])
def _(spark, d):
    o = S.usable_days(intervals(spark, d), 50.0, 0.5, 0.6, 5.0, ["seg"])
    return o.groupBy("seg").agg(F.count("*").alias("n"), F.sum("Actual_kWh").alias("a"))


@query("joi12_actual_vs_forecast_join", W(""",
a AS (SELECT seg, date_trunc('hour', IntervalStartDT) AS h, sum(Actual_kWh) AS a FROM v_int WHERE q % 2 = 0 GROUP BY 1, 2), f AS (SELECT seg, date_trunc('hour', IntervalStartDT) AS h, sum(Forecast_kWh) AS f FROM v_int WHERE q % 3 > 0 GROUP BY 1, 2)
SELECT seg, CAST(h AS VARCHAR) AS h, f - a AS err, CASE WHEN a > 0 THEN abs(f-a)/a END AS ape FROM a JOIN f USING (seg, h)"""), r6=["err", "ape"])
def _(spark, d):
    i = intervals(spark, d).withColumn("h", F.date_trunc("hour", "IntervalStartDT"))
    a = i.where("q % 2 = 0").groupBy("seg", "h").agg(F.sum("Actual_kWh").alias("Actual_kWh")).withColumn("Actual_MW", F.col("Actual_kWh") / 1000)
    f = i.where("q % 3 > 0").groupBy("seg", "h").agg(F.sum("Forecast_kWh").alias("Forecast_kWh")).withColumn("Forecast_MW", F.col("Forecast_kWh") / 1000)
    return S.hourly_backtest(a, f, ["seg", "h"]).select("seg", dstr("h"), F.col("Error_kWh").alias("err"), F.col("APE").alias("ape"))


@query("agg18_solar_summary", W(QUAL_SQL + """
SELECT seg, CAST(count(*) FILTER (NOT ex) AS BIGINT) AS n, sum(Actual_kWh) FILTER (NOT ex)/1000 AS a, (sum(Forecast_kWh) FILTER (NOT ex) - sum(Actual_kWh) FILTER (NOT ex))/sum(Actual_kWh) FILTER (NOT ex)*100 AS bias, avg(abs(Forecast_MW-Actual_MW)) FILTER (NOT ex) AS mae,
 sum(abs(Forecast_kWh-Actual_kWh)) FILTER (NOT ex)/sum(Actual_kWh) FILTER (NOT ex) AS wmape, max(Actual_MW) FILTER (NOT ex) AS pk, CAST(count(*) FILTER (ex) AS BIGINT) AS excluded, coalesce(sum(Actual_kWh) FILTER (ex),0)/1000 AS xa FROM v_q GROUP BY 1"""), r6=["a", "bias", "mae", "wmape", "pk", "xa"])
def _(spark, d):
    o = S.solar_summary(flagged(spark, d), ["seg"])
    return o.select("seg", F.col("N").alias("n"), F.col("Actual_MWh").alias("a"), F.col("Bias_PCT").alias("bias"), F.col("MAE_MW").alias("mae"), F.col("WMAPE").alias("wmape"), F.col("ActualPeak_MW").alias("pk"),
                    F.col("ExcludedIntervals").alias("excluded"), F.col("ExcludedActual_MWh").alias("xa"))


@query("agg19_solar_slices", W(""",
tp AS (SELECT max(Actual_MW) AS t FROM v_mw WHERE Actual_MW > 0.1), b AS (SELECT *, hour(IntervalStartDT) AS h, Actual_MW > 0.1 AS dy, Actual_MW > 0.1 OR Forecast_MW > 0.1 AS lv FROM v_mw, tp),
s AS (SELECT 'Overall' AS sl, * FROM b UNION ALL SELECT 'DaylightActual', * FROM b WHERE dy UNION ALL SELECT 'ActiveSolar', * FROM b WHERE lv UNION ALL SELECT 'PeakSolarHours11to15', * FROM b WHERE dy AND h BETWEEN 11 AND 15 UNION ALL SELECT 'HighOutputActualGE75PctPeak', * FROM b WHERE dy AND Actual_MW >= 0.75*t
 UNION ALL SELECT 'CloudCover:' || CASE WHEN CloudCoverPct <= 20 THEN '0-20' WHEN CloudCoverPct <= 50 THEN '20-50' WHEN CloudCoverPct <= 80 THEN '50-80' ELSE '80-100' END, * FROM b WHERE lv AND CloudCoverPct IS NOT NULL
 UNION ALL SELECT 'ClearSkyIndex:' || CASE WHEN ClearSkyIndex <= 0.25 THEN '0-0.25' WHEN ClearSkyIndex <= 0.5 THEN '0.25-0.50' WHEN ClearSkyIndex <= 0.75 THEN '0.50-0.75' WHEN ClearSkyIndex <= 1 THEN '0.75-1.00' ELSE '>1.00' END, * FROM b WHERE lv AND ClearSkyIndex IS NOT NULL
 UNION ALL SELECT 'Hour:' || h, * FROM b WHERE dy UNION ALL SELECT 'Month:' || strftime(IntervalStartDT, '%Y-%m'), * FROM b)
SELECT sl AS slice, CAST(count(*) AS BIGINT) AS n, avg(abs(Forecast_MW-Actual_MW)) AS mae, sqrt(avg((Forecast_MW-Actual_MW)*(Forecast_MW-Actual_MW))) AS rmse, CASE WHEN sum(Actual_kWh) > 0 THEN sum(abs(Forecast_kWh-Actual_kWh))/sum(Actual_kWh) END AS wmape FROM s GROUP BY 1"""), r6=["mae", "rmse", "wmape"])
def _(spark, d):
    o = S.solar_slices(intervals(spark, d))
    return o.select(F.col("Slice").alias("slice"), F.col("N").alias("n"), F.col("MAE_MW").alias("mae"), F.col("RMSE_MW").alias("rmse"), F.col("WMAPE").alias("wmape"))


RG_SQL = """, rk AS (SELECT *, CASE WHEN coalesce(ClearSkyIndex,0) <= 0.2 THEN 'csi_000_020' WHEN ClearSkyIndex <= 0.5 THEN 'csi_020_050' WHEN ClearSkyIndex <= 0.8 THEN 'csi_050_080' WHEN ClearSkyIndex <= 1.05 THEN 'csi_080_105' ELSE 'csi_105_160' END AS ck,
 CASE WHEN coalesce(CloudCoverPct,0) <= 30 THEN 'cloud_000_030' WHEN CloudCoverPct <= 70 THEN 'cloud_030_070' ELSE 'cloud_070_100' END AS lk, CASE WHEN SolarElevationDeg <= 15 THEN 'elev_low' WHEN SolarElevationDeg <= 35 THEN 'elev_mid' ELSE 'elev_high' END AS ek FROM v_int),
r2 AS (SELECT *, 'regime|' || ck || '|' || lk || '|' || ek AS k1, 'csi|' || ck AS k2 FROM rk), fa AS (SELECT k, count(*) AS n, least(greatest((sum(Actual_kWh)+50000)/(sum(Forecast_kWh)+50000),0.6),1.15) AS f FROM (SELECT k1 AS k, * FROM r2 UNION ALL SELECT k2, * FROM r2) WHERE Actual_kWh >= 0 AND Forecast_kWh > 0 GROUP BY 1 HAVING count(*) >= 12 AND sum(Forecast_kWh) >= 10000)"""


@query("sol01_regime_factors", W(RG_SQL + """
SELECT k AS key, CAST(n AS BIGINT) AS rows, f AS factor FROM fa"""), r6=["factor"])
def _(spark, d):
    return S.regime_factors(intervals(spark, d), "Forecast_kWh", lo=0.6)


@query("sol01_regime_lookup", W(RG_SQL + """
SELECT r2.seg, CAST(count(*) AS BIGINT) AS n, sum(Forecast_kWh*coalesce(a.f,b.f,1)) AS kwh FROM r2 LEFT JOIN fa a ON a.k = k1 LEFT JOIN fa b ON b.k = k2 GROUP BY 1"""), r4=["kwh"])
def _(spark, d):
    i = intervals(spark, d)
    o = S.lookup_regime(i, S.regime_factors(i, "Forecast_kWh", lo=0.6))
    return o.groupBy("seg").agg(F.count("*").alias("n"), F.sum(F.col("Forecast_kWh") * F.col("RegimeCalibrationFactor")).alias("kwh"))


@query("sol02_holdout_pruned_factors", W(RG_SQL + """,
h AS (SELECT k, count(*) AS n, sum(Forecast_kWh) AS fs, sum(Actual_kWh) AS a, sum(abs(Forecast_kWh-Actual_kWh)) AS e0, sum(abs(Forecast_kWh*f-Actual_kWh)) AS e1, max(f) AS f FROM (SELECT k1 AS k, * FROM r2 UNION ALL SELECT k2, * FROM r2) x JOIN fa USING (k) WHERE "Date" >= DATE '2000-01-01' AND Actual_kWh >= 0 AND Forecast_kWh > 0 GROUP BY 1)
SELECT k AS key, f AS factor FROM h WHERE n >= 12 AND fs >= 10000 AND a > 0 AND e1/a <= e0/a - 0.0005"""), r6=["factor"])
def _(spark, d):
    i = intervals(spark, d)
    return S.prune_factors(i.where("Date >= DATE'2000-01-01'"), S.regime_factors(i, "Forecast_kWh", lo=0.6), "Forecast_kWh")


@query("sol03_month_factors", W(""",
m AS (SELECT seg, month(IntervalStartDT) AS mo, sum(Actual_kWh) AS a, sum(Forecast_kWh) AS f FROM v_int WHERE Actual_kWh >= 0 AND Forecast_kWh > 0 GROUP BY 1, 2)
SELECT seg, CAST(mo AS INT) AS Month, least(greatest((a + 100000*least(greatest(sum(a) OVER w/sum(f) OVER w,0.5),1.1))/(f+100000),0.5),1.1) AS factor FROM m WINDOW w AS (PARTITION BY seg)"""), r6=["factor"])
def _(spark, d):
    return S.month_factors(intervals(spark, d), "Forecast_kWh", by=["seg"], lo=0.5).select("seg", "Month", "factor")


@query("sol04_peak_factor", W(""",
w AS (SELECT seg, Actual_kWh*4 AS a, Forecast_kWh*4 AS f, Forecast_kWh*4/30000 AS cf FROM v_int WHERE Actual_kWh >= 0 AND Forecast_kWh > 0), t AS (SELECT seg, quantile_cont(cf, 0.95) AS t FROM w GROUP BY 1),
g AS (SELECT seg, t, count(*) FILTER (cf >= t) AS n, sum(f) FILTER (cf >= t) AS fs, least(greatest(0.9*max(a)/max(f),0.5),1.0) AS r FROM w JOIN t USING (seg) GROUP BY 1, 2)
SELECT seg, CASE WHEN n >= 12 AND fs/1000 >= 1 AND r < 0.999 THEN r ELSE 1 END AS peak_factor, CASE WHEN n >= 12 AND fs/1000 >= 1 AND r < 0.999 THEN t END AS threshold_cf FROM g"""), r6=["peak_factor", "threshold_cf"])
def _(spark, d):
    i = intervals(spark, d).withColumns({"a": F.col("Actual_kWh") * 4, "f": F.col("Forecast_kWh") * 4, "cap": F.lit(30000.0)})
    return S.peak_params(i, "a", "f", "cap", 0.95, 0.5, 0.9, by=["seg"])


@query("sol05_apply_calibration", W(RG_SQL + """,
m AS (SELECT month(IntervalStartDT) AS mo, sum(Actual_kWh) AS a, sum(Forecast_kWh) AS f FROM v_int WHERE Actual_kWh >= 0 AND Forecast_kWh > 0 GROUP BY 1), mf AS (SELECT mo, least(greatest((a + 100000*least(greatest(sum(a) OVER ()/sum(f) OVER (),0.5),1.1))/(f+100000),0.5),1.1) AS mfac FROM m),
z AS (SELECT r2.*, coalesce(x.f,y.f,1)*mfac*0.98 AS mid FROM r2 LEFT JOIN fa x ON x.k = k1 LEFT JOIN fa y ON y.k = k2 JOIN mf ON mo = month(IntervalStartDT))
SELECT seg, sum(CASE WHEN Forecast_kWh > 0 THEN Forecast_kWh*mid*CASE WHEN Forecast_kWh*4*mid/30000 >= 0.4 THEN 0.9 ELSE 1 END ELSE 0 END) AS kwh, avg(CASE WHEN Forecast_kWh > 0 THEN mid*CASE WHEN Forecast_kWh*4*mid/30000 >= 0.4 THEN 0.9 ELSE 1 END ELSE 1 END) AS factor FROM z GROUP BY 1"""), r4=["kwh", "factor"])
def _(spark, d):
    i = intervals(spark, d)
    o = S.lookup_regime(i, S.regime_factors(i, "Forecast_kWh", lo=0.6))
    o = S.lookup_month(o, S.month_factors(i, "Forecast_kWh", lo=0.5)).withColumns({"ResidualCalibrationFactor": F.lit(0.98), "ActiveCapacity_kW": F.lit(30000.0), "threshold_cf": F.lit(0.4), "peak_factor": F.lit(0.9)})
    return S.apply_calibration(o).groupBy("seg").agg(F.sum("Calibrated_kWh").alias("kwh"), F.avg("TotalCalibrationFactor").alias("factor"))


@query("sol06_same_day_correction", W(""",
u AS (SELECT seg, "Date", IntervalStartDT, sum(Actual_kWh) AS a, sum(Forecast_kWh) AS f, avg(CloudCoverPct) AS cl, avg(ClearSkyIndex) AS ci, min(q) AS q FROM v_int GROUP BY 1, 2, 3),
ob AS (SELECT seg, "Date", count(*) AS n, sum(a) AS a, sum(f) AS f, max(IntervalStartDT) AS l, sum(f*coalesce(cl,0))/nullif(sum(f),0) AS cl, sum(f*coalesce(ci,0))/nullif(sum(f),0) AS ci FROM u WHERE q < 52 GROUP BY 1, 2),
j AS (SELECT u.seg, u.f, CASE WHEN ob.n >= 2 AND ob.f > 0 AND u.IntervalStartDT > ob.l THEN least(greatest(1 + (least(greatest(ob.a/ob.f,0.7),1.3)-1)*pow(0.5,(epoch(u.IntervalStartDT)-epoch(ob.l))/3600/4)*coalesce(CASE WHEN u.cl IS NULL OR u.ci IS NULL THEN NULL ELSE least(greatest((least(greatest(1-abs(u.cl-ob.cl)/100,0),1)+least(greatest(1-abs(u.ci-ob.ci),0),1))/2,0.35),1) END,0.35),0.7),1.3) ELSE 1 END AS k
 FROM u LEFT JOIN ob ON ob.seg = u.seg AND ob."Date" = u."Date")
SELECT seg, sum(f*k) AS kwh, avg(k) AS k, CAST(count(*) FILTER (k <> 1) AS BIGINT) AS n FROM j GROUP BY 1"""), r4=["kwh", "k"])
def _(spark, d):
    u = intervals(spark, d).groupBy("seg", "Date", "IntervalStartDT").agg(F.sum("Actual_kWh").alias("Actual_kWh"), F.sum("Forecast_kWh").alias("Forecast_kWh"), F.avg("CloudCoverPct").alias("CloudCoverPct"), F.avg("ClearSkyIndex").alias("ClearSkyIndex"), F.min("q").alias("q"))
    o = S.same_day_correction(u.drop("Actual_kWh"), u.where("q < 52"), ["seg", "Date"], min_intervals=2)
    return o.groupBy("seg").agg(F.sum("Corrected_kWh").alias("kwh"), F.avg("SameDayCorrectionFactor").alias("k"), F.count(F.when(F.col("SameDayCorrectionFactor") != 1, 1)).alias("n"))
