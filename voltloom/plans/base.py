"""Query registry and the views that give the shared tables a time-series reading.

A query is a Spark function plus, where SQL can say it, an independent DuckDB
text over the same tables.  Views are written once as column lists; an entry is
``(name, expression)`` when Spark and DuckDB share the text and
``(name, spark, duckdb)`` when they do not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

Entry = tuple[str, ...]

# A mean of a few two-decimal values often lies exactly between two roundings and
# float sums differ in the last bit by order; this offset, far below the kept
# digits, sends such ties the same way in both engines.
TIE = {6: 1.2345e-08, 4: 1.2345e-06}


def query(name: str, sql: str | None = None, r6: Sequence[str] = (), r4: Sequence[str] = ()):
    """Register a query; ``r6``/``r4`` columns are rounded alike on both sides."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(spark, sf_dir)
            cols = {c: F.round(F.col(c).cast("double") + F.lit(TIE[n]), n) + F.lit(0.0) for n, cs in ((6, r6), (4, r4)) for c in cs}
            return df.withColumns(cols) if cols else df

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            rep = [f'round(CAST("{c}" AS DOUBLE) + {TIE[n]!r}, {n}) + 0.0 AS "{c}"' for n, cs in ((6, r6), (4, r4)) for c in cs]
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) q" if rep else sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a shared table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has few splits for the session's cores, as a file of one row group has; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df._jdf.rdd().getNumPartitions() <= cores else df


def _spark_cols(entries: Sequence[Entry]) -> list:
    return [F.expr(e[1]).alias(e[0]) for e in entries]


def _duck_cols(entries: Sequence[Entry]) -> str:
    return ",\n  ".join(f'{e[-1]} AS "{e[0]}"' for e in entries)


SEASON = ("CASE WHEN {m} IN (12,1,2) THEN 'Winter' WHEN {m} IN (3,4,5) THEN 'Spring' "
          "WHEN {m} IN (6,7,8,9) THEN 'Summer' ELSE 'Fall' END")
HOUR_GROUP = ("CASE WHEN {h} <= 5 THEN 'Overnight' WHEN {h} <= 9 THEN 'Morning' WHEN {h} <= 15 THEN 'Midday' "
              "WHEN {h} <= 20 THEN 'Peak' ELSE 'LateEvening' END")

# -- events: an irregular sensor feed -------------------------------------------------------------
READING: list[Entry] = [
    ("series", "event_type"),
    ("DT", "CAST(ts AS TIMESTAMP)"),
    ("event_id", "event_id"),
    ("user_id", "user_id"),
    ("value", "CAST(value AS DOUBLE)"),
]


def reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*_spark_cols(READING))


SQL_READING = f"v_reading AS (SELECT {_duck_cols(READING)} FROM events)"

SQL_LOAD = """v_load AS (
  SELECT series, date_trunc('hour', DT) AS DT, CAST(floor(epoch(date_trunc('hour', DT)) / 3600) AS BIGINT) AS eh,
         avg(value) AS MWH, CAST(count(*) AS BIGINT) AS n
  FROM v_reading GROUP BY 1, 2, 3)"""


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, hour) mean reading: a load series with real gaps."""
    r = reading(spark, sf_dir).groupBy("series", F.date_trunc("hour", "DT").alias("DT"))
    out = r.agg(F.avg("value").alias("MWH"), F.count("*").alias("n"))
    return out.withColumn("eh", F.floor(F.unix_seconds("DT") / 3600).cast("long"))


# -- events: weather per (series, hour), made from whole-number sums so both engines agree ---------
WEATHER: list[Entry] = [
    ("series", "series"), ("DT", "DT"), ("eh", "eh"),
    ("TempF", "CASE WHEN s_user % 37 = 0 THEN NULL ELSE 62e0 + (s_user % 45) + CASE WHEN hod BETWEEN 11 AND 19 THEN 6e0 ELSE 0e0 END END"),
    ("HumidityPct", "CASE WHEN s_user % 41 = 0 THEN NULL ELSE 15e0 + (s_user * 7 % 70) END"),
    ("CloudCoverPct", "CASE WHEN s_user % 43 = 0 THEN NULL ELSE (s_user * 11 % 101) * 1e0 END"),
    ("WindSpeedMph", "CASE WHEN s_user % 29 = 0 THEN NULL ELSE (s_user * 3 % 180) / 10e0 END"),
    ("WindDirectionDeg", "CASE WHEN s_user % 31 = 0 THEN NULL ELSE (s_user * 17 % 720) * 1e0 END"),
    ("PrecipIn", "CASE WHEN s_user % 9 = 0 THEN 0.1e0 ELSE 0e0 END"),
    ("GHI_Wm2", "CASE WHEN hod BETWEEN 6 AND 18 THEN (s_user * 19 % 900) * 1e0 ELSE 0e0 END"),
]


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reading(spark, sf_dir).groupBy("series", F.date_trunc("hour", "DT").alias("DT"))
    r = r.agg((F.sum("user_id") + F.sum("event_id") % 97).alias("s_user"))
    r = r.withColumn("eh", F.floor(F.unix_seconds("DT") / 3600).cast("long")).withColumn("hod", F.hour("DT"))
    return r.select(*_spark_cols(WEATHER))


SQL_WEATHER = f"""v_weather0 AS (
  SELECT series, date_trunc('hour', DT) AS DT, CAST(floor(epoch(date_trunc('hour', DT)) / 3600) AS BIGINT) AS eh,
         hour(date_trunc('hour', DT)) AS hod, CAST(sum(user_id) + sum(event_id) % 97 AS BIGINT) AS s_user
  FROM v_reading GROUP BY 1, 2, 3, 4),
v_weather AS (SELECT {_duck_cols(WEATHER)} FROM v_weather0)"""

# -- orders: one row per day over several years ----------------------------------------------------


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("Date"))
    return o.agg((F.max("o_totalprice") / 4500).alias("Temperature_DailyMax"),
                 (F.min("o_totalprice") / 4500).alias("Temperature_DailyMin"),
                 F.count("*").alias("n"))


SQL_DAILY = """v_daily AS (
  SELECT CAST(o_orderdate AS DATE) AS "Date", max(o_totalprice) / 4500 AS Temperature_DailyMax,
         min(o_totalprice) / 4500 AS Temperature_DailyMin, CAST(count(*) AS BIGINT) AS n
  FROM orders GROUP BY 1)"""

# -- lineitem: a replay cube with stage forecasts and weather context -------------------------------
_H = "((l_orderkey * 7 + l_linenumber) % 24)"
_M = "month(l_shipdate)"
_RAW = "(l_extendedprice / 1000)"
_TMAX = "(60e0 + (l_partkey % 56) + (l_linenumber % 2) * 0.5e0)"
BT: list[Entry] = [
    ("series", "l_returnflag"),
    ("row_id", "l_orderkey * 10 + l_linenumber"),
    ("part_id", "l_partkey"),
    ("origin_id", "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT)"),
    ("Date", "CAST(l_shipdate AS DATE)"),
    ("DT", f"timestampadd(HOUR, CAST({_H} AS INT), CAST(l_shipdate AS TIMESTAMP))", f"CAST(l_shipdate AS TIMESTAMP) + to_hours({_H})"),
    ("Hour", f"CAST({_H} AS INT)"),
    ("Month", f"CAST({_M} AS INT)"),
    ("Season", SEASON.format(m=_M)),
    ("HourGroup", HOUR_GROUP.format(h=_H)),
    ("IsWeekend", "CAST(CASE WHEN weekday(l_shipdate) >= 5 THEN 1 ELSE 0 END AS INT)",
     "CAST(CASE WHEN isodow(l_shipdate) >= 6 THEN 1 ELSE 0 END AS INT)"),
    ("Forecast_Day", "CAST(1 + CAST(l_quantity AS BIGINT) % 16 AS INT)"),
    ("Forecast_Lead_Hour", f"CAST((CAST(l_quantity AS BIGINT) % 16) * 24 + {_H} + 1 AS INT)"),
    ("Temperature_DailyMax", f"CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {_TMAX} END"),
    ("Temperature", f"CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {_TMAX} - (l_suppkey % 25) END"),
    ("CloudCover_Norm", "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE ((l_partkey * 13) % 101) / 100e0 END"),
    ("BTM_Solar_Proxy_MW", "((l_orderkey * 3) % 80) / 2e0"),
    ("BTM_Solar_Loss_From_ClearSky_MW",
     f"CASE WHEN {_H} BETWEEN 8 AND 17 THEN ((l_suppkey * 7 + l_linenumber) % 40) / 2e0 ELSE 0e0 END"),
    ("Raw_Forecast_MWH", f"{_RAW}"),
    ("Actual_MWH", f"{_RAW} * (1 - l_discount) * (1 + l_tax)"),
    ("Residual_MWH", f"{_RAW} * (1 - l_discount) * (1 + l_tax) - {_RAW}"),
    ("Learned_Forecast_MWH", f"{_RAW} + (l_linenumber - 4) * 0.25e0"),
    ("Recent_Forecast_MWH", f"{_RAW} * (1 - l_discount)"),
    ("Final_Forecast_MWH", f"{_RAW} * (1 - l_discount) * (1 + l_tax / 2)"),
    ("MWH_Lag1", f"CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE {_RAW} * (1 - l_discount / 2) END"),
    ("MWH_Lag24", f"{_RAW} * (1 + l_tax)"),
    ("MWH_SameHour7DayMean", f"{_RAW} * (1 - l_discount) + 1"),
]
STAGES = {
    "raw": "Raw_Forecast_MWH",
    "residual_calibrated": "Learned_Forecast_MWH",
    "recent_corrected": "Recent_Forecast_MWH",
    "final_corrected": "Final_Forecast_MWH",
}


def replay(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Replay cube; name ``cols`` to keep the scan narrow."""
    want = [e for e in BT if not cols or e[0] in cols]
    return spread(table(spark, sf_dir, "lineitem").select(*_spark_cols(want)))


SQL_BT = f"v_bt AS (SELECT {_duck_cols(BT)} FROM lineitem)"

# -- supplier: sites with capacity and cluster ------------------------------------------------------
SITE: list[Entry] = [
    ("site", "s_suppkey"),
    ("capacity_kw", "CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 0e0 END"),
    ("cluster", "CAST(s_nationkey AS BIGINT)"),
    ("Latitude", "32e0 + (s_suppkey % 50) / 10e0"),
    ("Longitude", "-124e0 + (s_suppkey * 7 % 90) / 10e0"),
    ("InterconnectionDate", "date_add(DATE'1995-01-01', CAST(s_suppkey * 37 % 2200 AS INT))",
     "CAST(DATE '1995-01-01' + CAST(s_suppkey * 37 % 2200 AS INTEGER) AS DATE)"),
    ("MeterType", "CASE WHEN s_suppkey % 4 = 0 THEN 'NET' WHEN s_suppkey % 4 = 1 THEN 'DELREC' WHEN s_suppkey % 4 = 2 THEN 'NEMSOLAR' ELSE 'OTHER' END"),
    ("RateSchedule", "CASE WHEN s_suppkey % 3 = 0 THEN 'NEM-R1' WHEN s_suppkey % 3 = 1 THEN 'R-SOLAR2' ELSE 'GS1' END"),
]


def site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(*_spark_cols(SITE))


SQL_SITE = f"v_site AS (SELECT {_duck_cols(SITE)} FROM supplier)"

_VIEWS = {
    "reading": [SQL_READING],
    "load": [SQL_READING, SQL_LOAD],
    "weather": [SQL_READING, SQL_WEATHER],
    "daily": [SQL_DAILY],
    "bt": [SQL_BT],
    "site": [SQL_SITE],
}


def ctes(*names: str) -> str:
    """``WITH`` clause holding the named views, for the start of an oracle text."""
    parts: list[str] = []
    for n in names:
        for p in _VIEWS[n]:
            if p not in parts:
                parts.append(p)
    return "WITH " + ",\n".join(parts)
