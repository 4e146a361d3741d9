"""Queries: scans, payloads, store, history assembly, sets and small reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import keep_last
from ..core.scratch import shared_dir
from ..functions import buckets as B
from ..operators import history as H
from ..operators import lags as L
from ..operators import metrics as M
from ..operators import training as TR
from ..operators import weather_features as WF
from ..sources import scans as SR
from ..sources import store as ST
from .base import STAGES, ctes, daily, load, query, reading, replay, site, table, weather
from .c_scorecards import ACT, FIN, METRICS, RAW, STAGE_SQL, m_sql


def s(col, name=None):
    return F.col(col).cast("string").alias(name or col)


# ---- scans --------------------------------------------------------------------------------------

@query("src01_wide_hourly_load", ctes("load") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, MWH FROM v_load WHERE DT >= TIMESTAMP '2024-01-03' AND DT <= TIMESTAMP '2024-01-28 12:00:00'""", r6=["MWH"])
def _(spark, d):
    l = load(spark, d).withColumns({"Year": F.year("DT"), "Month": F.month("DT"), "Day": F.dayofmonth("DT"), "h": F.hour("DT") + 1})
    wide = l.groupBy("series", "Year", "Month", "Day").pivot("h", list(range(1, 25))).agg(F.max("MWH")).withColumnsRenamed({str(k): f"Hr{k}" for k in range(1, 25)})
    return SR.wide_load(wide, start="2024-01-03", cutoff="2024-01-28 12:00:00").where("MWH is not null").select("series", s("DT"), "MWH")


@query("src03_sensor_scan", ctes("reading") + """
SELECT series, CAST(date_trunc('minute', DT) AS VARCHAR) AS DT, arg_max(v, (event_id, v)) AS value FROM (SELECT *, value - 20 AS v FROM v_reading) WHERE v > 0 GROUP BY 1, 2""", r6=["value"])
def _(spark, d):
    r = reading(spark, d).select("series", F.date_trunc("minute", "DT").alias("DT"), (F.col("value") - 20).cast("string").alias("value"), "event_id")
    return SR.sensor(r, ["series"], "value", ["event_id"]).select("series", s("DT"), "value")


@query("src04_station_weather", ctes("reading") + """
SELECT series, CAST(date_trunc('hour', DT) AS VARCHAR) AS DT, arg_max(value, (DT, value)) AS value FROM v_reading WHERE value BETWEEN -30 AND 130 GROUP BY 1, 2""", r6=["value"])
def _(spark, d):
    return SR.station(reading(spark, d), ["series"], "value").select("series", s("DT"), "value")


_VARS = {"temperature_2m": "TempF", "cloud_cover": "CloudCoverPct", "wind_direction_10m": "WindDirectionDeg"}


@query("src07_json_payload_rows", ctes("weather") + """
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE WHEN TempF BETWEEN 60 AND 105 THEN TempF END AS t, CloudCoverPct AS c, WindDirectionDeg % 360 AS w FROM v_weather""")
def _(spark, d):
    w = weather(spark, d).withColumn("day", F.to_date("DT"))
    row = F.sort_array(F.collect_list(F.struct(F.date_format("DT", "yyyy-MM-dd'T'HH:mm").alias("time"), "TempF", "CloudCoverPct", "WindDirectionDeg")))
    p = w.groupBy("series", "day").agg(row.alias("a"))
    hourly = F.struct(F.col("a.time").alias("time"), F.col("a.TempF").alias("temperature_2m"), F.col("a.CloudCoverPct").alias("cloud_cover"), F.col("a.WindDirectionDeg").alias("wind_direction_10m"))
    p = p.select("series", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))
    o = SR.hourly_payload(p, "payload", _VARS, ["series"], limits={"TempF": (60.0, 105.0)}, angles=["WindDirectionDeg"])
    return o.select("series", s("DT"), F.col("TempF").alias("t"), F.col("CloudCoverPct").alias("c"), F.col("WindDirectionDeg").alias("w"))


PREV = ("TempF + 1 AS t1, TempF - 2 AS t2, CASE WHEN eh % 3 = 0 THEN NULL ELSE TempF + 3 END AS t3, CloudCoverPct AS c1, CloudCoverPct*0.5 AS c2")


def previous(spark, d):
    t, cl = F.col("TempF"), F.col("CloudCoverPct")
    w = weather(spark, d).select("series", "DT", (t + 1).alias("TempF_previous_day1"), (t - 2).alias("TempF_previous_day2"), F.when(F.col("eh") % 3 != 0, t + 3).alias("TempF_previous_day3"), cl.alias("CloudCoverPct_previous_day1"), (cl * 0.5).alias("CloudCoverPct_previous_day2"))
    return SR.previous_runs(w, ["TempF", "CloudCoverPct"], 3)


@query("src08_previous_run_unpivot", ctes("weather") + f""", p AS (SELECT series, DT, {PREV} FROM v_weather)
SELECT * FROM (SELECT series, CAST(DT AS VARCHAR) AS DT, 1 AS lead, t1 AS t, c1 AS c FROM p UNION ALL SELECT series, CAST(DT AS VARCHAR), 2, t2, c2 FROM p UNION ALL SELECT series, CAST(DT AS VARCHAR), 3, t3, NULL FROM p) WHERE t IS NOT NULL OR c IS NOT NULL""")
def _(spark, d):
    return previous(spark, d).select("series", s("DT"), F.col("Forecast_Weather_Lead_Days").alias("lead"), F.col("TempF").alias("t"), F.col("CloudCoverPct").alias("c"))


@query("joi11_fixed_lead_join", ctes("load", "weather") + f""", p AS (SELECT series, DT, {PREV} FROM v_weather), q AS (SELECT series, DT, 1 AS lead, t1 AS t FROM p UNION ALL SELECT series, DT, 2, t2 FROM p UNION ALL SELECT series, DT, 3, t3 FROM p)
SELECT l.series, CAST(l.DT AS VARCHAR) AS DT, CAST(lead AS INT) AS lead, MWH, t FROM (SELECT *, 1 + eh % 3 AS ld FROM v_load) l JOIN q ON q.series = l.series AND q.DT = l.DT AND q.lead = l.ld WHERE t IS NOT NULL""", r6=["MWH"])
def _(spark, d):
    l = load(spark, d).withColumn("Forecast_Weather_Lead_Days", (F.col("eh") % 3 + 1).cast("int"))
    j = l.join(previous(spark, d), ["series", "DT", "Forecast_Weather_Lead_Days"]).where("TempF is not null")
    return j.select("series", s("DT"), F.col("Forecast_Weather_Lead_Days").alias("lead"), "MWH", F.col("TempF").alias("t"))


_MEM = {f"temperature_2m_member{i:02d}": k for i, k in enumerate((0, 2, -3, 5, 1, 4))}


def ensemble(spark, d):
    w = weather(spark, d)
    return SR.ensemble_stats(w.select("series", "DT", "eh", F.col("TempF").alias("point"), *[F.when((F.col("eh") + abs(k)) % 11 != 0, F.col("TempF") + k).alias(n) for n, k in _MEM.items()]))


_ENS = "e AS (SELECT series, DT, eh, TempF, unnest([" + ",".join(f"CASE WHEN (eh + {abs(k)}) % 11 = 0 THEN NULL ELSE TempF + ({k}) END" for k in _MEM.values()) + "]) AS m FROM v_weather), es AS (SELECT series, DT, eh, any_value(TempF) AS p, avg(m) AS mean, stddev_samp(m) AS sd, count(m) AS n FROM e GROUP BY 1, 2, 3)"


@query("src09_ensemble_stats", ctes("weather") + "," + _ENS + """
SELECT series, CAST(DT AS VARCHAR) AS DT, mean, sd, CAST(n AS INT) AS n FROM es""", r6=["mean", "sd"])
def _(spark, d):
    return ensemble(spark, d).select("series", s("DT"), F.col("Ensemble_Mean").alias("mean"), F.col("Ensemble_Std").alias("sd"), F.col("Ensemble_Count").alias("n"))


@query("prj15_ensemble_outlier_guard", ctes("weather") + "," + _ENS + """
SELECT series, CAST(DT AS VARCHAR) AS DT, CASE WHEN n >= 5 AND abs(pt-mean) >= 10 THEN mean ELSE pt END AS v, CAST(coalesce(n >= 5 AND abs(pt-mean) >= 10, FALSE) AS INT) AS r FROM (SELECT *, p + CASE WHEN eh % 5 = 0 THEN 14 ELSE 0 END AS pt FROM es)""", r6=["v"])
def _(spark, d):
    e = ensemble(spark, d).withColumn("point", F.col("point") + F.when(F.col("eh") % 5 == 0, 14).otherwise(0))
    return SR.ensemble_guard(e, "point").select("series", s("DT"), F.col("point").alias("v"), F.col("Ensemble_Replaced").alias("r"))


LAKE_SQL = "lk AS (SELECT '/COM/GS2/NEM/REC/MONTHLY_' || strftime(l_shipdate, '%Y%m') || '/f' || l_linenumber || '.parquet' AS path, * FROM lineitem)"


def lake(spark, d):
    li = table(spark, d, "lineitem")
    path = F.concat(F.lit("/COM/GS2/NEM/REC/MONTHLY_"), F.date_format("l_shipdate", "yyyyMM"), F.lit("/f"), F.col("l_linenumber"), F.lit(".parquet"))
    li = li.withColumn("file_path", path)
    return li.withColumns(SR.lake_metadata(F.col("file_path"))).withColumns({"file_size": F.col("l_orderkey"), "modified": F.col("l_shipdate")})


@query("src10_lake_path_metadata", "WITH " + LAKE_SQL + """
SELECT path AS file_path, 'COM' AS segment, 'REC' AS channel, 'GS2' AS rate_group, 'NEM' AS nem_status, strftime(any_value(l_shipdate), '%Y%m') AS month, CAST(count(*) AS BIGINT) AS rows, max(l_orderkey) AS size FROM lk GROUP BY 1""")
def _(spark, d):
    return SR.file_catalog(lake(spark, d)).select("file_path", "segment", "channel", "rate_group", "nem_status", "month", "rows", F.col("file_size").alias("size"))


@query("src11_catalog_range", "WITH " + LAKE_SQL + """
SELECT 'REC' AS channel, CAST(min(strftime(l_shipdate, '%Y%m')) AS INT) AS first_month, CAST(max(strftime(l_shipdate, '%Y%m')) AS INT) AS last_month, CAST(count(DISTINCT path) AS BIGINT) AS files FROM lk""")
def _(spark, d):
    return SR.catalog_range(SR.file_catalog(lake(spark, d)), ["REC", "NET"])


@query("src12_service_point_index", "WITH " + LAKE_SQL + """
SELECT l_suppkey || '_' || l_linenumber AS spid, path AS file, CAST(l_suppkey AS VARCHAR) AS spid_base, CAST(count(*) AS BIGINT) AS rows FROM lk GROUP BY 1, 2, 3""")
def _(spark, d):
    l = lake(spark, d).withColumn("sp", F.concat_ws("_", "l_suppkey", "l_linenumber"))
    return SR.service_point_index(l, "sp", "file_path").select("spid", "file", "spid_base", "rows")


@query("src14_densest_series", """
SELECT l_suppkey AS site, CAST(count(*) AS BIGINT) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_quantity > 10 AND l_suppkey = (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 1) GROUP BY 1""", r4=["q"])
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_quantity") - 10).alias("v"), "l_quantity")
    return SR.densest_series(li, "l_suppkey", "v").groupBy(F.col("l_suppkey").alias("site")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


@query("src15_stable_plus_volatile_tail", ctes("weather") + """,
st AS (SELECT series, DT, TempF AS t FROM v_weather WHERE eh % 10 > 0 AND DT < TIMESTAMP '2024-01-25'), fr AS (SELECT series, DT, TempF + 100 AS t FROM v_weather WHERE DT >= TIMESTAMP '2024-01-15'),
u AS (SELECT *, 1 AS p FROM st WHERE DT < TIMESTAMP '2024-01-22' UNION ALL SELECT *, CASE WHEN DT < TIMESTAMP '2024-01-22' THEN 0 ELSE 2 END FROM fr)
SELECT series, CAST(DT AS VARCHAR) AS DT, first(t ORDER BY p DESC) AS t FROM u GROUP BY 1, 2""")
def _(spark, d):
    w = weather(spark, d)
    st = w.where("eh % 10 > 0 AND DT < TIMESTAMP'2024-01-25'").select("series", "DT", F.col("TempF").alias("t"))
    fr = w.where("DT >= TIMESTAMP'2024-01-15'").select("series", "DT", (F.col("TempF") + 100).alias("t"))
    return SR.stable_plus_tail(st, fr, ["series"], F.lit("2024-01-22").cast("timestamp")).select("series", s("DT"), "t")


@query("src16_cached_slice", """
SELECT CAST(count(*) AS BIGINT) AS n, sum(o_totalprice) AS t FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-01'""", r4=["t"])
def _(spark, d):
    path = shared_dir(spark)
    table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("DT"), "o_totalprice", "o_orderkey").write.parquet(path)
    return SR.cached_slice(spark, path, "1996-03-01", "1997-02-01", ["DT", "o_totalprice"]).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("t"))


@query("src17_results_as_weather", ctes("bt") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, sum(Temperature) AS t, sum(CloudCover_Norm) AS c FROM v_bt WHERE Temperature IS NOT NULL GROUP BY 1""", r4=["t", "c"])
def _(spark, d):
    r = replay(spark, d, "series", "DT", "Temperature", "CloudCover_Norm")
    o = SR.results_as_weather(r, {"Temperature": "TempF", "CloudCover_Norm": "CloudCoverPct", "HumidityPct": "HumidityPct"})
    return o.groupBy("series").agg(F.count("*").alias("n"), F.sum("TempF").alias("t"), F.sum("CloudCoverPct").alias("c"))


@query("src18_overlapping_extracts", ctes("weather") + """,
u AS (SELECT series, DT, TempF AS t, 0 AS i FROM v_weather WHERE eh % 2 = 0 UNION ALL SELECT series, DT, TempF + 1, 1 FROM v_weather WHERE eh % 3 = 0)
SELECT series, CAST(DT AS VARCHAR) AS DT, arg_max(t, i) AS t FROM u WHERE t IS NOT NULL AND DT BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1, 2""")
def _(spark, d):
    w = weather(spark, d)
    a, b = w.where("eh % 2 = 0").select("series", "DT", F.col("TempF").alias("t")), w.where("eh % 3 = 0").select("series", "DT", (F.col("TempF") + 1).alias("t"))
    return SR.overlapping_extracts([a, b], ["series"], "2024-01-05", "2024-01-20", ["t"]).select("series", s("DT"), "t")


@query("src06_solar_csv", ctes("load") + """
SELECT CAST(DT AS VARCHAR) AS DT, sum(MWH)/100 AS mw FROM v_load GROUP BY 1""", r6=["mw"])
def _(spark, d):
    root = shared_dir(spark)
    load(spark, d).groupBy(F.col("DT").alias("IntervalStartDT")).agg((F.sum("MWH") / 100).alias("Forecast_MW")).write.option("header", "true").csv(root)
    return SR.solar_csv(spark, root).select(s("DT"), F.col("Solar_Forecast_MW").alias("mw"))


# ---- store --------------------------------------------------------------------------------------

@query("snk01_run_append_and_read_back", ctes("load") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, sum(MWH) AS s FROM v_load GROUP BY 1""", r4=["s"])
def _(spark, d):
    root = shared_dir(spark)
    l = load(spark, d)
    ST.append_run({"forecast": l.where("eh % 2 = 0"), "weather": l}, root, "r1", {"source": "test"}, spark)
    ST.append_run({"forecast": l.withColumn("extra", F.lit(1.0)), "weather": l.limit(0)}, root, "r2", {"source": "test"}, spark)
    runs = spark.read.parquet(f"{root}/_runs").where("table_name = 'forecast'")
    return ST.latest_run(runs, ST.read_table(spark, root, "forecast")).groupBy("series").agg(F.count("*").alias("n"), F.sum("MWH").alias("s"))


@query("snk02_normalised_output", ctes("load") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, CAST(count(v) AS BIGINT) AS present, '{"k":"' || series || '"}' AS meta FROM (SELECT *, CASE WHEN eh % 4 = 0 THEN NULL ELSE MWH END AS v FROM v_load) GROUP BY 1""")
def _(spark, d):
    l = load(spark, d).withColumns({"v": F.when(F.col("eh") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("MWH")), "meta": F.struct(F.col("series").alias("k"))})
    return ST.normalise(l).groupBy("series", "meta").agg(F.count("*").alias("n"), F.count("v").alias("present"))


@query("snk03_additive_schema", ctes("load") + """
SELECT CAST(count(*) AS BIGINT) * 2 AS n, CAST(count(*) AS BIGINT) AS extra FROM v_load""")
def _(spark, d):
    root = shared_dir(spark)
    l = load(spark, d)
    l.write.parquet(f"{root}/t/RunID=a")
    l.withColumn("extra", F.lit(1.0)).write.parquet(f"{root}/t/RunID=b")
    return ST.read_table(spark, root, "t").agg(F.count("*").alias("n"), F.count("extra").alias("extra"))


SNAP_SQL = "sn AS (SELECT 'a' AS SnapshotID, TIMESTAMP '2024-01-02' AS arch, * FROM v_weather WHERE eh % 5 = 0 UNION ALL SELECT 'b', TIMESTAMP '2024-01-03', * FROM v_weather WHERE eh % 5 = 0 UNION ALL SELECT 'c', TIMESTAMP '2024-01-04', * FROM v_weather WHERE eh % 5 < 2)"


def snapshots(spark, d):
    w = weather(spark, d).select("series", "DT", "eh", "TempF", "CloudCoverPct")
    parts = [("a", "2024-01-02", "eh % 5 = 0"), ("b", "2024-01-03", "eh % 5 = 0"), ("c", "2024-01-04", "eh % 5 < 2")]
    tag = F.filter(F.array(*[F.when(F.expr(w_), F.struct(F.lit(i).alias("SnapshotID"), F.lit(a).cast("timestamp").alias("ArchivedAtUTC"))) for i, a, w_ in parts]), lambda x: x.isNotNull())
    return w.select("*", F.inline(tag))


@query("snk04_content_hash_dedupe", ctes("weather") + "," + SNAP_SQL + """
SELECT SnapshotID AS id, CAST(count(*) AS BIGINT) AS n, CAST(min(DT) AS VARCHAR) AS f, CAST(max(DT) AS VARCHAR) AS l FROM sn WHERE SnapshotID IN ('b', 'c') GROUP BY 1""")
def _(spark, d):
    sn = snapshots(spark, d)
    o = ST.new_snapshots(sn, spark.createDataFrame([("x",)], "ContentHash string"), ["SnapshotID"], ["series", "DT", "TempF", "CloudCoverPct"])
    return o.select(F.col("SnapshotID").alias("id"), F.col("rows").alias("n"), s("FirstDT", "f"), s("LastDT", "l"))


@query("snk05_latest_run_read", """
SELECT o_orderstatus AS st, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders) GROUP BY 1""")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("RunID", F.date_format("o_orderdate", "yyyyMMdd"))
    runs = o.groupBy("RunID").agg(F.max("o_orderdate").alias("StartedAtUTC"))
    return ST.latest_run(runs, o).groupBy(F.col("o_orderstatus").alias("st")).agg(F.count("*").alias("n"))


@query("snk06_latest_different_snapshot", ctes("weather") + "," + SNAP_SQL + """
SELECT 'b' AS id, CAST(count(*) AS BIGINT) AS n FROM sn WHERE SnapshotID = 'b'""")
def _(spark, d):
    sn = snapshots(spark, d)
    m = ST.content_hash(sn, ["SnapshotID", "ArchivedAtUTC"], ["series", "DT", "TempF", "CloudCoverPct"])
    cur = m.where("SnapshotID = 'c'").select("ContentHash").scalar()
    best = ST.latest_different(m, cur)
    return sn.join(best.select("SnapshotID"), "SnapshotID", "left_semi").groupBy(F.col("SnapshotID").alias("id")).agg(F.count("*").alias("n"))


@query("snk07_as_archived_by_lead", ctes("weather") + "," + SNAP_SQL + """,
x AS (SELECT series, DT, CAST(date_diff('day', CAST(arch AS DATE), CAST(DT AS DATE)) + 1 AS INT) AS lead, SnapshotID, arch FROM sn)
SELECT series, CAST(DT AS VARCHAR) AS DT, lead, arg_max(SnapshotID, arch) AS id FROM x WHERE lead BETWEEN 1 AND 7 GROUP BY 1, 2, 3""")
def _(spark, d):
    o = ST.as_archived(snapshots(spark, d), ["series"], 7)
    return o.select("series", s("DT"), F.col("Forecast_Weather_Lead_Days").alias("lead"), F.col("SnapshotID").alias("id"))


@query("src19_newest_and_prior_snapshot", ctes("weather") + "," + SNAP_SQL + """
SELECT series, CAST(count(*) AS BIGINT) AS n, CAST(count(p.DT) AS BIGINT) AS matched FROM (SELECT * FROM sn WHERE SnapshotID = 'c') c LEFT JOIN (SELECT series, DT FROM sn WHERE SnapshotID = 'b') p USING (series, DT) GROUP BY 1""")
def _(spark, d):
    sn = snapshots(spark, d)
    m = ST.content_hash(sn, ["SnapshotID", "ArchivedAtUTC"], ["series", "DT", "TempF", "CloudCoverPct"])
    newest = m.agg(F.max_by("ContentHash", "ArchivedAtUTC")).scalar()
    prior = sn.join(ST.latest_different(m, newest).select("SnapshotID"), "SnapshotID", "left_semi").select("series", "DT", F.lit(1).alias("p"))
    cur = sn.join(m.where(F.col("ContentHash") == newest).agg(F.max("SnapshotID").alias("SnapshotID")), "SnapshotID", "left_semi")
    return cur.join(prior, ["series", "DT"], "left").groupBy("series").agg(F.count("*").alias("n"), F.count("p").alias("matched"))


@query("snk08_csv_archive_import", ctes("load") + """
SELECT series AS src, CAST(count(*) AS BIGINT) AS n, sum(MWH) AS s FROM v_load GROUP BY 1""", r4=["s"])
def _(spark, d):
    root = shared_dir(spark)
    load(spark, d).select("series", "MWH").write.option("header", "true").csv(root)
    o = ST.import_csv_archive(spark, root, "series string, MWH double")
    return o.where("SnapshotID <> ''").groupBy(F.col("series").alias("src")).agg(F.count("*").alias("n"), F.sum("MWH").alias("s"))


@query("snk09_text_width_profile", """
SELECT 'c_name' AS "column", CAST(max(length(c_name)) AS INT) AS max_length, CAST(least(ceil(greatest(100, max(length(c_name))*3)/50)*50, 4000) AS INT) AS bound FROM customer
UNION ALL SELECT 'c_mktsegment', CAST(max(length(c_mktsegment)) AS INT), CAST(least(ceil(greatest(100, max(length(c_mktsegment))*3)/50)*50, 4000) AS INT) FROM customer""")
def _(spark, d):
    return ST.text_widths(table(spark, d, "customer"))


@query("snk10_diagnostics_export", ctes("bt") + """
SELECT Season, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1""")
def _(spark, d):
    root = shared_dir(spark)
    t = replay(spark, d, "Season").groupBy("Season").agg(F.count("*").alias("n"))
    ST.export({"by_season": t}, root)
    ST.export({"by_season_json": t}, root, "json")
    return spark.read.schema("Season string, n long").option("header", "true").csv(f"{root}/by_season")


@query("snk11_origin_cache", ctes("bt") + """
SELECT origin_id, CAST(count(*) AS BIGINT) AS n, sum(Raw_Forecast_MWH) AS s FROM v_bt WHERE origin_id IS NOT NULL GROUP BY 1""", r4=["s"])
def _(spark, d):
    root = shared_dir(spark)
    ST.persist_origins(replay(spark, d, "origin_id", "row_id", RAW).where("origin_id is not null"), root)
    c = spark.read.schema("row_id long, Raw_Forecast_MWH double, origin_id long").parquet(root)
    return c.groupBy("origin_id").agg(F.count("*").alias("n"), F.sum(RAW).alias("s"))


@query("snk12_replay_diagnostics_map", ctes("bt") + """
SELECT 'by_season' AS t, CAST(count(DISTINCT Season) AS BIGINT) AS n FROM v_bt UNION ALL SELECT 'settings', 1""")
def _(spark, d):
    t = replay(spark, d, "Season").groupBy("Season").agg(F.count("*").alias("n"))
    picked = ST.choose({"season": t, "cfg": {"a": 1, "b": "x"}, "other": t}, {"season": "by_season", "cfg": "settings"}, spark)
    parts = [v.agg(F.count("*").alias("n")).select(F.lit(k).alias("t"), "n") for k, v in picked.items()]
    return parts[0].unionByName(parts[1])


@query("snk13_diagnostic_snapshots_if_new", ctes("bt") + """
SELECT Season, CAST(count(*) AS BIGINT) AS n FROM v_bt GROUP BY 1""")
def _(spark, d):
    root = shared_dir(spark)
    t = replay(spark, d, "Season", "DT").groupBy("Season").agg(F.count("*").alias("n"), F.max("DT").alias("DT"))
    a = ST.archive(t, root, "first", ["Season", "n"])
    b = ST.archive(t.orderBy("n"), root, "second", ["Season", "n"])
    return spark.read.parquet(f"{root}/rows").where(F.col("SnapshotID") == F.lit(b if a == b else "none")).select("Season", "n")


# ---- projections and history --------------------------------------------------------------------

@query("prj11_scope_with_fallback", ctes("bt") + """,
k AS (SELECT series, bool_or(coalesce(Temperature_DailyMax >= 115 AND Hour BETWEEN 16 AND 20, FALSE)) AS a FROM v_bt GROUP BY 1)
SELECT series, CAST(count(*) FILTER (CASE WHEN a THEN coalesce(Temperature_DailyMax >= 115 AND Hour BETWEEN 16 AND 20, FALSE) ELSE coalesce(Temperature_DailyMax >= 115 AND IsWeekend = 0, FALSE) END) AS BIGINT) AS n FROM v_bt JOIN k USING (series) GROUP BY 1""")
def _(spark, d):
    b = replay(spark, d, "series", "Hour", "Temperature_DailyMax", "IsWeekend").withColumn("IsLikelySystemPeakHour", 1 - F.col("IsWeekend"))
    return TR.hot_scope(b, ["series"], TR.Weights(hot_day_min=115.0)).groupBy("series").agg(F.count(F.when(F.col("_hot"), 1)).alias("n"))


@query("prj12_until_incomplete", ctes("weather") + """,
f AS (SELECT series, min(DT) FILTER (TempF IS NULL OR HumidityPct IS NULL) AS b FROM v_weather GROUP BY 1)
SELECT series, CAST(count(*) AS BIGINT) AS n FROM v_weather JOIN f USING (series) WHERE b IS NULL OR DT < b GROUP BY 1""")
def _(spark, d):
    return H.until_incomplete(weather(spark, d), ["TempF", "HumidityPct"]).groupBy("series").agg(F.count("*").alias("n"))


@query("prj13_actuals_cutoff", ctes("load") + """
SELECT series, CAST(count(*) AS BIGINT) AS n FROM v_load WHERE DT <= TIMESTAMP '2024-01-20 06:30:00' GROUP BY 1""")
def _(spark, d):
    return H.to_cutoff(load(spark, d), "2024-01-20 00:00:00", 6.5).groupBy("series").agg(F.count("*").alias("n"))


@query("prj14_completeness_assertion", ctes("load") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, sum(MWH) AS s FROM v_load GROUP BY 1""", r4=["s"])
def _(spark, d):
    return H.require_complete(load(spark, d), ["MWH"], "load").groupBy("series").agg(F.count("*").alias("n"), F.sum("MWH").alias("s"))


@query("prj23_stage_discovery", ctes("bt") + """
SELECT unnest(['raw','residual_calibrated','recent_corrected','final_corrected']) AS stage, CAST(count(*) AS BIGINT) AS n FROM v_bt""")
def _(spark, d):
    b = replay(spark, d, *STAGES.values())
    present = {k: v for k, v in {**STAGES, "absent": "Nope_MWH"}.items() if v in b.columns}
    c = b.agg(*[F.count(v).alias(k) for k, v in present.items()])
    return c.select(F.inline(F.array(*[F.struct(F.lit(k).alias("stage"), F.col(k).alias("n")) for k in present]))).where("n > 0")


POLICIES = [{"stage": "recent_corrected", "reason": "near", "max_day": 3}, {"stage": "residual_calibrated", "reason": "summer_peak", "months": [6, 7, 8], "hours": [15, 16, 17, 18]},
            {"stage": "raw", "reason": "extreme", "min_temp": 105.0, "min_day": 2, "max_day": 9}]
_UP = "coalesce(CASE Month WHEN 7 THEN 1.5 WHEN 8 THEN 0.5 END, 0)"


@query("prj24_stage_selector", ctes("bt") + f""",
x AS (SELECT *, CASE WHEN coalesce(Temperature_DailyMax >= 105 AND Forecast_Day BETWEEN 2 AND 9, FALSE) THEN 'raw' WHEN Month IN (6,7,8) AND Hour BETWEEN 15 AND 18 THEN 'residual_calibrated' WHEN Forecast_Day <= 3 THEN 'recent_corrected' ELSE 'final_corrected' END AS src FROM v_bt)
SELECT row_id, src, CASE src WHEN 'raw' THEN 'extreme' WHEN 'residual_calibrated' THEN 'summer_peak' WHEN 'recent_corrected' THEN 'near' ELSE 'default' END AS reason,
 greatest(CASE src WHEN 'raw' THEN Raw_Forecast_MWH WHEN 'residual_calibrated' THEN Learned_Forecast_MWH WHEN 'recent_corrected' THEN Recent_Forecast_MWH ELSE Final_Forecast_MWH END + {_UP}, 0) AS fc FROM x""", r6=["fc"])
def _(spark, d):
    b = replay(spark, d, "row_id", "Month", "Hour", "Forecast_Day", "Temperature_DailyMax", *STAGES.values())
    o = H.select_stage(b, STAGES, POLICIES, "final_corrected", H.config_value("Month", {7: 1.5, 8: 0.5}, 0.0))
    return o.select("row_id", F.col("Stage_Source").alias("src"), F.col("Stage_Reason").alias("reason"), F.col("Stage_Selected_Forecast_MWH").alias("fc"))


@query("prj25_config_lookup", ctes("bt") + """
SELECT Month, Hour, CAST(count(*) AS BIGINT) AS n, max(CASE Month WHEN 7 THEN 1.5 WHEN 8 THEN 0.5 ELSE 0 END) AS a, max(CASE WHEN Month=7 AND Hour=17 THEN 1.2 WHEN Month=7 AND Hour=18 THEN 1.1 WHEN Month=8 AND Hour=17 THEN 0.9 ELSE 1 END) AS b FROM v_bt GROUP BY 1, 2""", r6=["a", "b"])
def _(spark, d):
    b = replay(spark, d, "Month", "Hour")
    return b.groupBy("Month", "Hour").agg(F.count("*").alias("n"), F.max(H.config_value("Month", {7: 1.5, 8: 0.5}, 0.0)).alias("a"), F.max(H.config_pair("Month", "Hour", {7: {17: 1.2, 18: 1.1}, 8: {17: 0.9}}, 1.0)).alias("b"))


@query("prj26_sample_weights", ctes("load") + """,
q AS (SELECT series, quantile_cont(MWH,0.9) AS q9, quantile_cont(MWH,0.95) AS q95, count(*) AS n FROM v_load GROUP BY 1),
x AS (SELECT v_load.*, q9, q95, q.n AS nn, row_number() OVER (PARTITION BY series ORDER BY eh) AS rn, 80 + eh % 30 AS t, hour(DT) AS h FROM v_load JOIN q USING (series))
SELECT series, CAST(DT AS VARCHAR) AS DT, least(greatest(least(greatest(CASE WHEN MWH >= q9 THEN 1.8 ELSE 1 END*CASE WHEN MWH >= q95 THEN 3 ELSE 1 END*CASE WHEN t >= 90 AND h BETWEEN 16 AND 20 AND eh % 2 = 0 THEN 1.7 ELSE 1 END,0.25),8)*(1+0.35*(rn-1)/(nn-1)),0.25),10.8) AS w FROM x""", r6=["w"])
def _(spark, d):
    l = load(spark, d).withColumns({"Temperature_DailyMax": (80 + F.col("eh") % 30).cast("double"), "Hour": F.hour("DT"), "IsLikelySystemPeakHour": (F.col("eh") % 2 == 0).cast("int")})
    return TR.add_load_weights(l, "MWH", keys=["series"], order="DT").select("series", s("DT"), F.col("SampleWeight").alias("w"))


@query("mod13_time_ordered_validation", ctes("load") + """,
e AS (SELECT series, max(eh) AS m FROM v_load GROUP BY 1)
SELECT series, CAST(count(*) FILTER (eh > m - 120) AS BIGINT) AS val, CAST(count(*) FILTER (eh <= m - 120) AS BIGINT) AS train FROM v_load JOIN e USING (series) GROUP BY 1""")
def _(spark, d):
    o = TR.validation_flag(load(spark, d), 5, 100, ["series"])
    return o.groupBy("series").agg(F.count(F.when(F.col("is_validation"), 1)).alias("val"), F.count(F.when(~F.col("is_validation"), 1)).alias("train"))


@query("prj27_readable_bins", ctes("bt") + """,
q AS (SELECT quantile_cont(BTM_Solar_Proxy_MW,0.25) AS a, quantile_cont(BTM_Solar_Proxy_MW,0.5) AS b, quantile_cont(BTM_Solar_Proxy_MW,0.75) AS c FROM v_bt WHERE BTM_Solar_Proxy_MW > 0)
SELECT CASE WHEN BTM_Solar_Proxy_MW <= 0 THEN 'None' WHEN BTM_Solar_Proxy_MW <= a THEN 'Low' WHEN BTM_Solar_Proxy_MW <= b THEN 'Medium-Low' WHEN BTM_Solar_Proxy_MW <= c THEN 'Medium-High' ELSE 'High' END AS solar,
 CASE WHEN Temperature_DailyMax <= 70 THEN 0e0 WHEN Temperature_DailyMax <= 80 THEN 1e0 WHEN Temperature_DailyMax <= 88 THEN 2e0 WHEN Temperature_DailyMax <= 94 THEN 3e0 WHEN Temperature_DailyMax <= 98 THEN 4e0 WHEN Temperature_DailyMax IS NOT NULL THEN 5e0 END AS band_bin, CAST(count(*) AS BIGINT) AS n FROM v_bt, q GROUP BY 1, 2""")
def _(spark, d):
    b = B.with_quartile_bucket(replay(spark, d, "BTM_Solar_Proxy_MW", "Temperature_DailyMax"), "BTM_Solar_Proxy_MW", "solar", labels=B.SOLAR_LABELS)
    return b.groupBy("solar", B.daily_max_bin("Temperature_DailyMax", "band").alias("band_bin")).agg(F.count("*").alias("n"))


@query("prj28_backtest_normalise", ctes("bt") + """,
n AS (SELECT origin_id, series, DT, row_id, row_number() OVER (PARTITION BY origin_id, series ORDER BY DT, row_id) AS lead, Actual_MWH - Final_Forecast_MWH AS r FROM v_bt)
SELECT origin_id, series, CAST(max(lead) AS BIGINT) AS n, CAST(max(CAST(floor((lead-1)/24) AS BIGINT)+1) AS BIGINT) AS days, sum(greatest(r,0)) AS under, sum(greatest(-r,0)) AS over FROM n GROUP BY 1, 2""", r4=["under", "over"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "series", "DT", "row_id", ACT, FIN)
    n = L.with_row_number(b, ["origin_id", "series"], "DT", 1, "lead", ["row_id"]).withColumn("r", F.col(ACT) - F.col(FIN))
    z = F.lit(0.0)
    return n.groupBy("origin_id", "series").agg(F.max("lead").cast("long").alias("n"), F.max(F.floor((F.col("lead") - 1) / 24) + 1).cast("long").alias("days"), F.sum(F.greatest("r", z)).alias("under"), F.sum(F.greatest(-F.col("r"), z)).alias("over"))


@query("win13_lead_numbering", ctes("load") + """,
n AS (SELECT series, CAST(eh/240 AS BIGINT) AS o, DT, row_number() OVER (PARTITION BY series, CAST(floor(eh/240) AS BIGINT) ORDER BY eh) AS lead FROM v_load)
SELECT series, CAST(DT AS VARCHAR) AS DT, CAST(lead AS INT) AS lead, CAST(floor((lead-1)/24)+1 AS INT) AS day, CASE WHEN floor((lead-1)/24)+1 <= 1 THEN 'Day1' WHEN floor((lead-1)/24)+1 <= 7 THEN 'Days2to7' ELSE 'Days8to16' END AS bucket FROM n""")
def _(spark, d):
    l = load(spark, d).withColumn("o", F.floor(F.col("eh") / 240))
    n = l.withColumn("lead", F.row_number().over(Window.partitionBy("series", "o").orderBy("eh")))
    n = n.withColumn("day", (F.floor((F.col("lead") - 1) / 24) + 1).cast("int"))
    return n.select("series", s("DT"), "lead", "day", B.horizon_bucket("day", "replay").alias("bucket"))


@query("prj29_future_peak_muting_audit", ctes("bt") + """,
f AS (SELECT series, "Date", max(Final_Forecast_MWH) AS pk, arg_max(Hour, (Final_Forecast_MWH, -epoch(DT))) AS ph, max(Temperature_DailyMax) AS t, max(greatest(Raw_Forecast_MWH*1.05, MWH_Lag24) - Final_Forecast_MWH) FILTER (Hour BETWEEN 14 AND 20) AS gap FROM v_bt WHERE origin_id >= 200101 GROUP BY 1, 2),
h AS (SELECT series, CAST(floor(t/5) AS BIGINT) AS b, avg(a) AS am, quantile_cont(a, 0.9) AS p90, max(a) AS mx FROM (SELECT series, "Date", max(Actual_MWH) AS a, max(Temperature_DailyMax) AS t FROM v_bt WHERE origin_id < 200101 GROUP BY 1, 2) GROUP BY 1, 2)
SELECT f.series, CAST(f."Date" AS VARCHAR) AS Date, pk, CAST(ph AS INT) AS ph, gap, am, p90, mx, CAST(coalesce(pk < am AND t >= 95, FALSE) AS INT) AS muted FROM f LEFT JOIN h ON h.series = f.series AND h.b = CAST(floor(t/5) AS BIGINT)""", r6=["pk", "gap", "am", "p90", "mx"])
def _(spark, d):
    from ..operators import reports as RP
    b = replay(spark, d, "series", "origin_id", "Date", "DT", "Hour", "Temperature_DailyMax", FIN, RAW, ACT, "MWH_Lag24").withColumn("stress", F.greatest(F.col(RAW) * 1.05, "MWH_Lag24"))
    return RP.peak_muting(b.where("origin_id >= 200101"), b.where("origin_id < 200101"), FIN, "stress").withColumn("Date", F.col("Date").cast("string"))


@query("prj30_smoothed_display_band", ctes("load") + """,
b AS (SELECT series, CAST(DT AS DATE) AS d, DT, abs(MWH - 60)/4 AS band FROM v_load), c AS (SELECT series, d, quantile_cont(band, 0.95) AS cap FROM b GROUP BY 1, 2),
m AS (SELECT *, quantile_cont(band, 0.5) OVER (PARTITION BY series, d ORDER BY DT ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS md FROM b), z AS (SELECT *, avg(md) OVER (PARTITION BY series, d ORDER BY DT ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS sm FROM m)
SELECT series, CAST(DT AS VARCHAR) AS DT, greatest(least(sm, cap), 1) AS band FROM z JOIN c USING (series, d)""", r6=["band"])
def _(spark, d):
    b = load(spark, d).select("series", F.to_date("DT").alias("d"), "DT", (F.abs(F.col("MWH") - 60) / 4).alias("b"))
    return H.smoothed_band(b, "b", ["series", "d"]).select("series", s("DT"), F.col("Display_Band").alias("band"))


@query("prj31_display_union", ctes("load") + """,
e AS (SELECT series, max(eh) FILTER (DT < TIMESTAMP '2024-01-20') AS m FROM v_load GROUP BY 1)
SELECT series, t, CAST(count(*) AS BIGINT) AS n FROM (SELECT series, CASE WHEN DT < TIMESTAMP '2024-01-20' THEN 'history' ELSE 'forecast' END AS t, m - eh AS age FROM v_load JOIN e USING (series)) WHERE (t = 'history' AND age < 72) OR (t = 'forecast' AND age < 0 AND age >= -120) GROUP BY 1, 2""")
def _(spark, d):
    l = load(spark, d)
    o = H.display_rows(l.where("DT < TIMESTAMP'2024-01-20'"), l.where("DT >= TIMESTAMP'2024-01-20'"), history_hours=72, horizon_days=5)
    return o.groupBy("series", F.col("Row_Type").alias("t")).agg(F.count("*").alias("n"))


@query("prj32_lead_day_resolve", ctes("load") + """,
x AS (SELECT series, DT, CASE WHEN series = 'click' THEN eh % 7 + 1 END AS ld, CASE WHEN DT >= TIMESTAMP '2024-01-10' THEN MWH END AS f FROM v_load), g AS (SELECT series, count(ld) AS n, min(CAST(DT AS DATE)) FILTER (f IS NOT NULL) AS d0 FROM x GROUP BY 1)
SELECT series, CAST(DT AS VARCHAR) AS DT, CAST(CASE WHEN n > 0 THEN ld ELSE date_diff('day', d0, CAST(DT AS DATE)) + 1 END AS DOUBLE) AS lead FROM x JOIN g USING (series)""")
def _(spark, d):
    x = load(spark, d).withColumns({"ld": F.when(F.col("series") == "click", (F.col("eh") % 7 + 1).cast("double")), "f": F.when(F.col("DT") >= F.lit("2024-01-10").cast("timestamp"), F.col("MWH"))})
    return H.lead_days(x, ["missing", "ld"], "f", ["series"]).select("series", s("DT"), F.col("Lead_Days").alias("lead"))


@query("win12_bounded_interpolation", ctes("weather") + """,
x AS (SELECT series, DT, eh, CASE WHEN eh % 12 < 5 THEN NULL ELSE TempF END AS v, row_number() OVER (PARTITION BY series ORDER BY eh) AS p FROM v_weather),
k AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN p END) OVER (PARTITION BY series ORDER BY p) AS a, min(CASE WHEN v IS NOT NULL THEN p END) OVER (PARTITION BY series ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM x)
SELECT k.series, CAST(k.DT AS VARCHAR) AS DT, CASE WHEN k.v IS NOT NULL THEN k.v WHEN coalesce(k.p-k.a <= 2, FALSE) OR coalesce(k.b-k.p <= 2, FALSE) THEN CASE WHEN k.a IS NULL THEN y.v WHEN k.b IS NULL THEN z.v ELSE z.v + (y.v-z.v)*(k.eh-z.eh)/(y.eh-z.eh) END END AS v
FROM k LEFT JOIN x z ON z.series = k.series AND z.p = k.a LEFT JOIN x y ON y.series = k.series AND y.p = k.b""", r6=["v"])
def _(spark, d):
    w = weather(spark, d).select("series", "DT", F.when(F.col("eh") % 12 >= 5, F.col("TempF")).alias("v"))
    return H.interpolate(w, "v", limit=2).select("series", s("DT"), "v")


# ---- joins --------------------------------------------------------------------------------------

@query("joi01_training_frame", ctes("load", "weather") + """
SELECT l.series, CAST(count(*) AS BIGINT) AS n, sum(MWH) AS m, sum(TempF) AS t FROM v_load l JOIN v_weather w ON l.series = w.series AND l.DT = w.DT WHERE TempF IS NOT NULL GROUP BY 1""", r4=["m", "t"])
def _(spark, d):
    return H.training_rows(load(spark, d), weather(spark, d).drop("eh")).groupBy("series").agg(F.count("*").alias("n"), F.sum("MWH").alias("m"), F.sum("TempF").alias("t"))


@query("joi02_forecast_frame", ctes("weather") + """
SELECT series, CAST(count(*) AS BIGINT) AS n, sum(CASE WHEN hour(DT) BETWEEN 16 AND 20 THEN 1 ELSE 0 END) AS pk, sum(999.0) AS age FROM v_weather GROUP BY 1""", r4=["pk", "age"])
def _(spark, d):
    from ..functions import calendar as C
    from ..operators import intraday as I
    o = I.zeroed(WF.add_weather_features(C.add_time_features(weather(spark, d))))
    return o.groupBy("series").agg(F.count("*").alias("n"), F.sum(F.col("Hour").between(16, 20).cast("int")).alias("pk"), F.sum("FiveMin_Data_Age_Hours").alias("age"))


BIAS_SQL = """mt AS (SELECT w.series, w.DT, CAST(month(w.DT) AS INT) AS mo, CAST(hour(w.DT) AS INT) AS h, l.MWH - (w.TempF - 20) AS dl FROM v_weather w JOIN v_load l ON l.series = w.series AND l.DT = w.DT WHERE abs(l.MWH - (w.TempF - 20)) <= 25),
bh AS (SELECT mo, h, count(*) AS n, avg(dl) AS b FROM mt GROUP BY 1, 2), bm AS (SELECT mo, avg(dl) AS b FROM mt GROUP BY 1)"""


def biased(spark, d):
    from ..operators import reports as RP
    w = weather(spark, d).select("series", "DT", (F.col("TempF") - 20).alias("TempF"))
    return w, RP.matched_bias(w, load(spark, d).select("series", "DT", F.col("MWH").alias("LocalStation_TempF")), 25.0)


@query("joi04_bias_matched_join", ctes("load", "weather") + "," + BIAS_SQL + """
SELECT series, CAST(count(*) AS BIGINT) AS n, avg(dl) AS m FROM mt GROUP BY 1""", r6=["m"])
def _(spark, d):
    return biased(spark, d)[1].groupBy("series").agg(F.count("*").alias("n"), F.avg("LocalStation_TempDelta_F").alias("m"))


@query("unc10_temperature_bias_lookup", ctes("load", "weather") + "," + BIAS_SQL + """
SELECT bh.mo AS month, h AS hour, CAST(n AS BIGINT) AS n, CASE WHEN n >= 70 THEN bh.b ELSE bm.b END AS delta, CASE WHEN n >= 70 THEN 'month_hour' ELSE 'month' END AS src FROM bh JOIN bm USING (mo)""", r6=["delta"])
def _(spark, d):
    from ..operators import reports as RP
    o = RP.bias_lookup(biased(spark, d)[1], 70)
    return o.select(F.col("Month").alias("month"), F.col("Hour").alias("hour"), F.col("N").alias("n"), F.col("Applied_Delta_F").alias("delta"), F.col("Bias_Source").alias("src"))


@query("joi05_bias_lookup_join", ctes("load", "weather") + "," + BIAS_SQL + """
SELECT w.series, CAST(w.DT AS VARCHAR) AS DT, TempF - 20 + 0.5*least(greatest(coalesce(CASE WHEN n >= 70 THEN bh.b ELSE bm.b END, (SELECT avg(dl) FROM mt)), -4), 4) AS t FROM v_weather w LEFT JOIN bh ON bh.mo = month(DT) AND bh.h = hour(DT) LEFT JOIN bm ON bm.mo = month(DT)""", r6=["t"])
def _(spark, d):
    from ..operators import reports as RP
    w, m = biased(spark, d)
    return RP.apply_bias(w, RP.bias_lookup(m, 70), m, 0.5, 4.0).select("series", s("DT"), F.col("TempF").alias("t"))


@query("agg31_temperature_bias_summary", ctes("load", "weather") + "," + BIAS_SQL + """
SELECT coalesce('Month ' || mo, 'Overall') AS segment, CAST(count(*) AS BIGINT) AS n, avg(dl) AS mean, quantile_cont(dl, 0.5) AS median, avg(abs(dl)) AS mae, quantile_cont(abs(dl), 0.9) AS p90 FROM mt GROUP BY GROUPING SETS ((), (mo))""", r6=["mean", "median", "mae", "p90"])
def _(spark, d):
    from ..operators import reports as RP
    return RP.bias_summary(biased(spark, d)[1])


ANALOG_SQL = ctes("bt") + """,
sc AS (SELECT DISTINCT series, make_date(CAST(origin_id/100 AS INT), CAST(origin_id%100 AS INT), 1) AS o, Hour, Month, Temperature_DailyMax AS t FROM v_bt WHERE Temperature_DailyMax >= 105 AND Hour BETWEEN 14 AND 20 AND Month IN (6,7,8,9)),
sr AS (SELECT series, DT, arg_min(Hour, row_id) AS h, arg_min(Month, row_id) AS m, arg_min(Temperature_DailyMax, row_id) AS t, arg_min(Actual_MWH, row_id) AS a FROM v_bt WHERE Temperature_DailyMax >= 105 GROUP BY 1, 2),
j AS (SELECT sc.*, count(*) FILTER (sr.m = sc.Month) AS n1, avg(a) FILTER (sr.m = sc.Month) AS v1, count(*) FILTER (sr.m IN (6,7,8,9)) AS n2, avg(a) FILTER (sr.m IN (6,7,8,9)) AS v2, count(*) AS n3, avg(a) AS v3 FROM sc JOIN sr ON sr.series = sc.series AND sr.h = sc.Hour AND sr.DT < sc.o AND abs(sr.t - sc.t) <= 3 GROUP BY ALL),
k AS (SELECT *, CASE WHEN n1 >= 3 THEN v1 WHEN n2 >= 3 THEN v2 WHEN n3 >= 3 THEN v3 END AS v, CASE WHEN n1 >= 3 THEN 'same_month_multi_summer' WHEN n2 >= 3 THEN 'summer_months_multi_summer' WHEN n3 >= 3 THEN 'all_prior_same_hour_temp' END AS nm FROM j)""".replace("origin_id/100", "origin_id//100")


@query("joi10_heat_analog_range_join", ANALOG_SQL + """
SELECT row_id, coalesce(nm, 'no_pre_origin_match') AS src, CASE WHEN v IS NULL THEN 0 ELSE least(greatest((v - Raw_Forecast_MWH)*0.5, -12), 12) END AS corr FROM v_bt b LEFT JOIN k ON k.series = b.series AND k.Hour = b.Hour AND k.Month = b.Month AND k.t = b.Temperature_DailyMax AND k.o = make_date(CAST(b.origin_id/100 AS INT), CAST(b.origin_id%100 AS INT), 1)
WHERE b.Temperature_DailyMax >= 105 AND b.Hour BETWEEN 14 AND 20 AND b.Month IN (6,7,8,9)""".replace("origin_id/100", "origin_id//100"), r6=["corr"])
def _(spark, d):
    return analogs(spark, d).where("Heat_Analog_Scope_Flag = 1").select("row_id", F.col("Heat_Analog_Source").alias("src"), F.col("Heat_Analog_Shadow_Correction_MWH").alias("corr"))


def analogs(spark, d):
    b = replay(spark, d, "series", "row_id", "origin_id", "DT", "Hour", "Month", "Temperature_DailyMax", RAW, ACT)
    o = F.make_date(F.floor(F.col("origin_id") / 100).cast("int"), (F.col("origin_id") % 100).cast("int"), F.lit(1))
    return H.heat_analogs(b.withColumn("origin_dt", o), RAW, "origin_dt", first=["row_id"])


@query("rep11_analog_detail_metrics", ANALOG_SQL + """,
z AS (SELECT b.*, coalesce(nm, 'no_pre_origin_match') AS src, Raw_Forecast_MWH + CASE WHEN v IS NULL THEN 0 ELSE least(greatest((v - Raw_Forecast_MWH)*0.5, -12), 12) END AS g FROM v_bt b LEFT JOIN k ON k.series = b.series AND k.Hour = b.Hour AND k.Month = b.Month AND k.t = b.Temperature_DailyMax AND k.o = make_date(CAST(b.origin_id//100 AS INT), CAST(b.origin_id%100 AS INT), 1)
 WHERE b.Temperature_DailyMax >= 105 AND b.Hour BETWEEN 14 AND 20 AND b.Month IN (6,7,8,9)), u AS (SELECT 'raw' AS "Stage", src, Hour, Actual_MWH, Raw_Forecast_MWH AS f FROM z UNION ALL SELECT 'analog', src, Hour, Actual_MWH, g FROM z)
SELECT "Stage", src AS "Heat_Analog_Source", Hour, """ + m_sql("f", p90=False) + " FROM u GROUP BY 1, 2, 3", r6=METRICS)
def _(spark, d):
    a = analogs(spark, d).where("Heat_Analog_Scope_Flag = 1")
    return M.stage_metrics(a, {"raw": RAW, "analog": "Heat_Analog_Shadow_Forecast_MWH"}, ["Heat_Analog_Source", "Hour"], p90=False)


@query("joi16_prior_run_attach", ctes("weather") + "," + SNAP_SQL + """
SELECT c.series, CAST(c.DT AS VARCHAR) AS DT, c.TempF - p.TempF AS change, CAST(p.DT IS NOT NULL AS INT) AS has_prior FROM (SELECT * FROM sn WHERE SnapshotID = 'c') c LEFT JOIN (SELECT series, DT, TempF - eh % 3 AS TempF FROM sn WHERE SnapshotID = 'b') p ON p.series = c.series AND p.DT = c.DT""")
def _(spark, d):
    sn = snapshots(spark, d)
    prior = keep_last(sn.where("SnapshotID = 'b'").select("series", "DT", (F.col("TempF") - F.col("eh") % 3).alias("pt"), F.lit(1).alias("p")), ["series", "DT"], ["p"])
    j = sn.where("SnapshotID = 'c'").join(prior, ["series", "DT"], "left")
    return j.select("series", s("DT"), (F.col("TempF") - F.col("pt")).alias("change"), F.coalesce("p", F.lit(0)).alias("has_prior"))


@query("joi17_stage_realism_merge", ctes("bt") + """, r AS (SELECT origin_id, row_id, max(Recent_Forecast_MWH) AS w FROM v_bt WHERE row_id % 4 > 0 GROUP BY 1, 2)
SELECT b.origin_id, CAST(count(*) AS BIGINT) AS n, sum(w - Final_Forecast_MWH) AS dl, CAST(count(*) FILTER (w IS NULL) AS BIGINT) AS missing FROM v_bt b LEFT JOIN r ON r.origin_id = b.origin_id AND r.row_id = b.row_id GROUP BY 1""", r4=["dl"])
def _(spark, d):
    b = replay(spark, d, "origin_id", "row_id", FIN, STAGES["recent_corrected"])
    r = b.where("row_id % 4 > 0").select("origin_id", "row_id", F.col(STAGES["recent_corrected"]).alias("WeatherRealism_Forecast_MWH"))
    key = r.groupBy("origin_id", "row_id").agg(F.max("WeatherRealism_Forecast_MWH").alias("WeatherRealism_Forecast_MWH"))
    j = b.join(key, ["origin_id", "row_id"], "left")
    return j.groupBy("origin_id").agg(F.count("*").alias("n"), F.sum(F.col("WeatherRealism_Forecast_MWH") - F.col(FIN)).alias("dl"), F.count(F.when(F.col("WeatherRealism_Forecast_MWH").isNull(), 1)).alias("missing"))


@query("joi18_archive_gap_fill", ctes("weather", "load") + """,
lt AS (SELECT series, max(DT) FILTER (DT < TIMESTAMP '2024-01-28') AS l FROM v_load GROUP BY 1), u AS (SELECT series, DT, TempF AS t, 1 AS p FROM v_weather WHERE eh % 4 > 0 UNION ALL SELECT w.series, w.DT, TempF + 1, 0 FROM v_weather w JOIN lt ON lt.series = w.series AND w.DT <= l)
SELECT series, CAST(DT AS VARCHAR) AS DT, first(t ORDER BY p DESC) AS t FROM u GROUP BY 1, 2""")
def _(spark, d):
    w = weather(spark, d).select("series", "DT", "eh", F.col("TempF").alias("t"))
    latest = load(spark, d).where("DT < TIMESTAMP'2024-01-28'").groupBy("series").agg(F.max("DT").alias("latest"))
    o = H.extend_with_forecast(w.where("eh % 4 > 0").drop("eh"), w.select("series", "DT", (F.col("t") + 1).alias("t")), latest)
    return o.select("series", s("DT"), "t")


@query("joi19_missing_dates", """
WITH c AS (SELECT CAST(l_shipdate AS DATE) AS d, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) >= 2)
SELECT CAST(CAST(g AS DATE) AS VARCHAR) AS Date FROM generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY) t(g) WHERE CAST(g AS DATE) NOT IN (SELECT d FROM c)""")
def _(spark, d):
    c = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("Date"), F.col("l_returnflag").alias("site"))
    return H.missing_dates(c, 2, "1996-01-01", "1996-12-31").select(s("Date"))


@query("joi20_fixed_origins", ctes("load") + """,
o AS (SELECT DISTINCT unnest([TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-10', TIMESTAMP '2024-03-01']) AS origin)
SELECT CAST(origin AS VARCHAR) AS origin, CAST(count(*) AS BIGINT) AS rows FROM o JOIN v_load ON DT >= origin AND DT < origin + INTERVAL 5 DAY GROUP BY 1 HAVING count(*) >= 24""")
def _(spark, d):
    return H.fixed_origins(["2024-01-10", "2024-01-20", "2024-01-10", "2024-03-01"], load(spark, d), 5).select(s("origin"), "rows")


@query("top05_seasonal_origins", ctes("daily") + """,
k AS (SELECT DATE '2001-06-01' - CAST(28*i AS INTEGER) AS o FROM range(0, 200) t(i)), c AS (SELECT o, sum(n) AS rows FROM k JOIN v_daily ON "Date" >= o AND "Date" < o + 16 WHERE o >= (SELECT min("Date") FROM v_daily) GROUP BY 1 HAVING sum(n) >= 24),
z AS (SELECT *, CASE WHEN month(o) IN (12,1,2) THEN 'Winter' WHEN month(o) IN (3,4,5) THEN 'Spring' WHEN month(o) BETWEEN 6 AND 9 THEN 'Summer' ELSE 'Fall' END AS season FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY o DESC) AS rn, CASE season WHEN 'Winter' THEN 1 WHEN 'Spring' THEN 2 WHEN 'Summer' THEN 3 ELSE 4 END AS si FROM z),
f AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN rn <= 2 THEN 0 ELSE 1 END, CASE WHEN rn <= 2 THEN si END, o DESC) AS rk FROM r)
SELECT CAST(o AS VARCHAR) AS origin, season, CAST(rows AS BIGINT) AS rows FROM f WHERE rk <= 10""")
def _(spark, d):
    o = H.seasonal_origins(daily(spark, d).select("Date", "n"), "2001-06-01", 28, 2, 10, 24, 16)
    return o.select(s("origin"), "season", "rows")


# ---- small reports ------------------------------------------------------------------------------

BREEZE = {"evening": "Hour BETWEEN 18 AND 23", "clear_hot": "Hour BETWEEN 18 AND 23 AND Temperature_DailyMax >= 95 AND CloudCover_Norm <= 0.2", "cooling": "Hour BETWEEN 18 AND 23 AND Temperature_DailyMax >= 95 AND CloudCover_Norm <= 0.2 AND Temperature_DailyMax - Temperature >= 5"}


@query("agg35_evening_cooling_metrics", ctes("bt") + "," + STAGE_SQL + ", s AS (" + " UNION ALL ".join(f"SELECT '{n}' AS \"Slice\", * FROM v_st WHERE {w}" for n, w in BREEZE.items()) + """)
SELECT "Slice", "Stage", CAST(count(*) AS BIGINT) AS n, avg(abs(Actual_MWH-f)) AS mae, avg(Temperature_DailyMax-Temperature) AS drop FROM s GROUP BY 1, 2""", r6=["mae", "drop"])
def _(spark, d):
    b = replay(spark, d, "Hour", "Temperature", "Temperature_DailyMax", "CloudCover_Norm", ACT, *STAGES.values()).withColumn("dr", F.col("Temperature_DailyMax") - F.col("Temperature"))
    long = M.by_stage(M.explode_slices(b, {n: F.expr(w) for n, w in BREEZE.items()}), STAGES, ["Slice", ACT, "dr"])
    o = M.grouped_metrics(long, ["Slice", "Stage"], p90=False, extra={"drop": F.avg("dr")})
    return o.select("Slice", "Stage", F.col("N").alias("n"), F.col("MAE_MWH").alias("mae"), "drop")


@query("agg37_serial_dependence", ctes("load") + """,
x AS (SELECT series, MWH - 60 AS v, lag(MWH - 60) OVER w AS p FROM v_load WINDOW w AS (PARTITION BY series ORDER BY eh))
SELECT series, corr(v, p) AS acf1, sum((v-p)*(v-p))/sum(v*v) AS dw FROM x GROUP BY 1""", r6=["acf1", "dw"])
def _(spark, d):
    from ..operators import reports as RP
    return RP.serial_dependence(load(spark, d).withColumn("v", F.col("MWH") - 60), "v", ["series"])


@query("agg37_autocorrelation_at_lags", ctes("load") + """,
x AS (SELECT series, MWH - 60 AS v, lag(MWH - 60, 1) OVER w AS p1, lag(MWH - 60, 2) OVER w AS p2, lag(MWH - 60, 24) OVER w AS p24 FROM v_load WINDOW w AS (PARTITION BY series ORDER BY eh)),
u AS (SELECT series, 1 AS lag, v, p1 AS p FROM x UNION ALL SELECT series, 2, v, p2 FROM x UNION ALL SELECT series, 24, v, p24 FROM x)
SELECT series, lag, CAST(count(*) AS BIGINT) AS pairs, CASE WHEN count(*) > 1 AND stddev_pop(v) >= 1e-9 AND stddev_pop(p) >= 1e-9 THEN corr(v, p) END AS acf FROM u WHERE p IS NOT NULL GROUP BY 1, 2""", r6=["acf"])
def _(spark, d):
    from ..operators import reports as RP
    return RP.autocorrelation(load(spark, d).withColumn("v", F.col("MWH") - 60), "v", ["series"], (1, 2, 24))


@query("agg38_yearly_trend", ctes("daily") + """,
y AS (SELECT year("Date") AS y, count(*) AS n, avg(n) AS m, quantile_cont(n, 0.5) AS md, max(n) AS mx FROM v_daily WHERE Temperature_DailyMax BETWEEN 85 AND 100 GROUP BY 1)
SELECT CAST(a.y AS INT) AS y, CAST(a.n AS BIGINT) AS n, a.m, a.md, a.mx, CASE WHEN count(b.y) >= 2 THEN regr_intercept(b.m, b.y) + regr_slope(b.m, b.y)*a.y END AS trend FROM y a LEFT JOIN y b ON b.y < a.y GROUP BY 1, 2, 3, 4, 5, a.y""", r6=["m", "md", "mx", "trend"])
def _(spark, d):
    from ..operators import reports as RP
    return RP.yearly_trend(daily(spark, d).where("Temperature_DailyMax between 85 and 100"), "n")


@query("agg39_new_records", ctes("daily") + """,
u AS (SELECT "Date", 'mx' AS f, Temperature_DailyMax AS v FROM v_daily UNION ALL SELECT "Date", 'mn', Temperature_DailyMin FROM v_daily), p AS (SELECT f, max(v) AS mx, quantile_cont(v, 0.99) AS p99 FROM u WHERE "Date" < DATE '2000-06-01' GROUP BY 1)
SELECT f AS feature, CAST("Date" AS VARCHAR) AS Date, v, mx, p99, CAST(v > mx AS INT) AS record FROM u JOIN p USING (f) WHERE "Date" BETWEEN DATE '2000-06-01' AND DATE '2000-08-31' AND v > p99""", r6=["v", "mx", "p99"])
def _(spark, d):
    from ..operators import reports as RP
    x = daily(spark, d).select("Date", F.col("Temperature_DailyMax").alias("mx"), F.col("Temperature_DailyMin").alias("mn"))
    return RP.new_records(x, ["mx", "mn"], "2000-06-01", "2000-08-31").withColumn("Date", F.col("Date").cast("string"))


@query("top06_ranked_scorecard", ctes("bt") + """
SELECT Season, mae, CAST(row_number() OVER (ORDER BY mae DESC, Season) AS INT) AS rk FROM (SELECT Season, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS mae FROM v_bt GROUP BY 1)""", r6=["mae"])
def _(spark, d):
    g = replay(spark, d, "Season", ACT, FIN).groupBy("Season").agg(F.avg(F.abs(F.col(ACT) - F.col(FIN))).alias("mae"))
    return g.withColumn("rk", F.row_number().over(Window.orderBy(F.desc("mae"), "Season")))


@query("top07_weight_grid_search", ctes("bt") + """,
w AS (SELECT a/10.0 AS wa, b/10.0 AS wb, (10-a-b)/10.0 AS wc FROM range(0, 11) x(a), range(0, 11) y(b) WHERE a + b <= 10), r AS (SELECT Actual_MWH AS y, Raw_Forecast_MWH AS f1, Learned_Forecast_MWH AS f2, Recent_Forecast_MWH AS f3, Hour BETWEEN 14 AND 18 AS pk FROM v_bt),
g AS (SELECT wa, wb, wc, avg(abs(y-(wa*f1+wb*f2+wc*f3))) AS mae, avg(greatest(y-(wa*f1+wb*f2+wc*f3),0)) FILTER (pk) AS pu FROM w, r GROUP BY 1, 2, 3)
SELECT wa, wb, mae, pu FROM g WHERE pu <= (SELECT min(pu) + 1.0 FROM g) ORDER BY mae, wa, wb LIMIT 1""", r6=["wa", "wb", "mae", "pu"])
def _(spark, d):
    from ..operators import reports as RP
    b = replay(spark, d, "Hour", ACT, RAW, STAGES["residual_calibrated"], STAGES["recent_corrected"])
    return RP.weight_search(b, [RAW, STAGES["residual_calibrated"], STAGES["recent_corrected"]], 0.1, 1.0)


@query("rep19_guard_parameter_sweep", ctes("bt") + """,
p AS (SELECT CAST(b/4.0 AS DOUBLE) AS blend, CAST(c AS DOUBLE) AS cap FROM range(0, 5) x(b), range(1, 4) y(c))
SELECT blend, cap, avg(abs(Actual_MWH - (Final_Forecast_MWH + least(greatest((MWH_Lag24-Final_Forecast_MWH)*blend,-cap),cap)))) AS mae, avg(abs(Actual_MWH-Final_Forecast_MWH)) AS base FROM p, v_bt WHERE Hour BETWEEN 14 AND 18 GROUP BY 1, 2""", r6=["mae", "base"])
def _(spark, d):
    from ..operators import reports as RP
    b = replay(spark, d, "Hour", ACT, FIN, "MWH_Lag24").where("Hour between 14 and 18")
    return RP.guard_sweep(b, FIN, "MWH_Lag24", [x / 4 for x in range(5)], [1.0, 2.0, 3.0])


@query("set01_heterogeneous_union", ctes("bt") + """
SELECT k, CAST(count(*) AS BIGINT) AS n, CAST(count(Season) AS BIGINT) AS s, CAST(count(Hour) AS BIGINT) AS h FROM (SELECT 'season' AS k, Season, NULL AS Hour FROM v_bt GROUP BY 2 UNION ALL SELECT 'hour', NULL, Hour FROM v_bt GROUP BY Hour) GROUP BY 1""")
def _(spark, d):
    b = replay(spark, d, "Season", "Hour")
    u = b.select(F.lit("season").alias("k"), "Season").distinct().unionByName(b.select(F.lit("hour").alias("k"), "Hour").distinct(), allowMissingColumns=True)
    return u.groupBy("k").agg(F.count("*").alias("n"), F.count("Season").alias("s"), F.count("Hour").alias("h"))


@query("set03_key_intersection", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders WHERE o_totalprice > 200000 INTERSECT SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) FROM lineitem WHERE l_quantity > 40""")
def _(spark, d):
    a = table(spark, d, "orders").where("o_totalprice > 200000").select(F.to_date("o_orderdate").cast("string").alias("d"))
    return a.intersect(table(spark, d, "lineitem").where("l_quantity > 40").select(F.to_date("l_shipdate").cast("string").alias("d")))


@query("set04_key_difference", """
SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def _(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).distinct().join(table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k")), "k", "left_anti")


RNG_SQL = """WITH dd AS (SELECT DISTINCT l_suppkey AS s, CAST(l_shipdate AS DATE) AS d FROM lineitem), i AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY s ORDER BY d) AS INTEGER) AS g FROM dd),
r AS (SELECT s, min(d) AS a, max(d) AS b, count(*) AS n FROM i GROUP BY s, g)"""


def ranges(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.to_date("l_shipdate").alias("Date"))
    return H.contiguous_ranges(li, ["s"])


@query("set05_contiguous_ranges", RNG_SQL + "\nSELECT s, CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, CAST(n AS BIGINT) AS n FROM r")
def _(spark, d):
    return ranges(spark, d).select("s", s("start", "a"), s("end", "b"), F.col("days").alias("n"))


@query("set05_range_chunks", RNG_SQL + ", c AS (SELECT s, b, unnest(generate_series(a, b, INTERVAL 7 DAY)) AS x FROM r)\nSELECT s, CAST(CAST(x AS DATE) AS VARCHAR) AS a, CAST(least(CAST(x AS DATE) + 6, b) AS VARCHAR) AS b FROM c")
def _(spark, d):
    return H.chunk_ranges(ranges(spark, d), 7).select("s", s("start", "a"), s("end", "b"))


@query("set05_months_touched", RNG_SQL + "\nSELECT DISTINCT s, CAST(CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE) AS VARCHAR) AS month FROM r")
def _(spark, d):
    return H.months_touched(ranges(spark, d)).select("s", F.to_date("month").cast("string").alias("month")).distinct()
