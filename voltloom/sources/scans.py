"""Readers: typed scans, payload flattening, catalogs and incremental loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core import keep_last
from ..functions.clock import localize, to_number

c = F.col


def database_query(spark: SparkSession, url: str, query: str, partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """Run a SQL text in a database; ``partition`` = (column, lower, upper, parts) splits the read."""
    r = spark.read.format("jdbc").option("url", url)
    if partition:
        col, lo, hi, parts = partition
        r = r.option("dbtable", f"({query}) q").option("partitionColumn", col).option("lowerBound", str(lo)).option("upperBound", str(hi)).option("numPartitions", str(parts))
    else:
        r = r.option("query", query)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def wide_load(df: DataFrame, keys: Sequence[str] = ("series",), prefix: str = "Hr", tz: str | None = None, start: str | None = None, cutoff: str | None = None) -> DataFrame:
    """Day rows with ``Year, Month, Day, Hr1..Hr24`` to hourly rows; column n is hour n-1.

    With ``tz`` the local times become instants and skipped or repeated ones are
    dropped.
    """
    hours = [x for x in df.columns if x.startswith(prefix) and x[len(prefix):].isdigit()]
    long = df.unpivot([*keys, "Year", "Month", "Day"], hours, "HourLabel", "MWH")
    h = F.regexp_extract("HourLabel", r"(\d+)$", 1).cast("int") - 1
    local = F.make_timestamp(c("Year"), c("Month"), c("Day"), h, F.lit(0), F.lit(0.0))
    out = long.select(*keys, (localize(local, tz) if tz else local).alias("DT"), to_number(c("MWH")).alias("MWH")).where("DT is not null")
    if start:
        out = out.where(c("DT") >= F.lit(start).cast("timestamp"))
    return out.where(c("DT") <= F.lit(cutoff).cast("timestamp")) if cutoff else out


def sensor(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = (), tz: str | None = None) -> DataFrame:
    """Typed readings: values that are not positive dropped, one row per time (the last)."""
    v = to_number(c(value))
    dt = localize(c("DT"), tz) if tz else c("DT").cast("timestamp")
    x = df.select(*keys, dt.alias("DT"), F.when(v > 0, v).alias(value), *order).where(f"DT is not null and {value} is not null")
    return keep_last(x, [*keys, "DT"], [*order, value] if order else [value])


def station(df: DataFrame, keys: Sequence[str], value: str, lo: float = -30.0, hi: float = 130.0) -> DataFrame:
    """Station readings inside the valid range, one per hour (the last)."""
    v = to_number(c(value))
    x = df.select(*keys, c("DT").cast("timestamp").alias("_t"), F.date_trunc("hour", c("DT").cast("timestamp")).alias("DT"), F.when(v.between(lo, hi), v).alias(value)).where(f"_t is not null and {value} is not null")
    return keep_last(x, [*keys, "DT"], ["_t", value]).drop("_t")


SOLAR_CSV = "IntervalStartDT timestamp, Forecast_MW double"


def solar_csv(spark: SparkSession, path: str, tz: str | None = None) -> DataFrame:
    """Solar forecast CSV with a fixed schema; a path that matches nothing gives an empty frame."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(p):
        return spark.createDataFrame([], "DT timestamp, Solar_Forecast_MW double")
    df = spark.read.schema(SOLAR_CSV).option("header", "true").csv(path)
    dt = localize(c("IntervalStartDT"), tz) if tz else c("IntervalStartDT")
    return df.select(dt.alias("DT"), c("Forecast_MW").alias("Solar_Forecast_MW")).where("DT is not null")


def hourly_payload(df: DataFrame, json_col: str, variables: Mapping[str, str], keys: Sequence[str] = (), tz: str | None = None, limits: Mapping[str, tuple[float, float]] | None = None,
                   angles: Sequence[str] = (), shift_hours: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays under ``hourly`` to one row per time.

    ``variables``: payload field to output column.  Out-of-range values become
    null, angles are taken modulo 360, one row per time is kept (the last).
    """
    fields = ", ".join(f"`{v}`: ARRAY<DOUBLE>" for v in variables)
    p = df.select(*keys, *order, F.from_json(json_col, f"hourly STRUCT<time: ARRAY<STRING>, {fields}>").alias("_p"))
    z = F.arrays_zip(*[c(f"_p.hourly.{v}") for v in ("time", *variables)])
    rows = p.select(*keys, *order, F.explode(z).alias("_r"))
    local = c("_r.time").try_cast("timestamp")
    dt = localize(local, tz) if tz else local
    if shift_hours:
        dt = dt + F.make_dt_interval(hours=F.lit(shift_hours))

    def clean(v: str, name: str) -> Column:
        x = c(f"_r.{v}")
        x = F.when(~F.isnan(x), x)
        if limits and name in limits:
            x = F.when(x.between(*limits[name]), x)
        return F.pmod(x, F.lit(360.0)) if name in angles else x

    out = rows.select(*keys, dt.alias("DT"), *[clean(v, n).alias(n) for v, n in variables.items()], *order).where("DT is not null")
    return keep_last(out, [*keys, "DT"], list(order)) if order else out


def previous_runs(df: DataFrame, variables: Sequence[str], max_lead: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Columns ``<var>_previous_dayN`` to one row per (time, lead) with a column per variable; rows without any value are dropped."""
    parts = F.array(*[F.struct(F.lit(n).alias("Forecast_Weather_Lead_Days"), *[c(f"{v}_previous_day{n}").alias(v) if f"{v}_previous_day{n}" in df.columns else F.lit(None).cast("double").alias(v) for v in variables])
                      for n in range(1, max_lead + 1)])
    out = df.select(*keys, "DT", F.inline(parts))
    return out.where(F.coalesce(*[c(v) for v in variables]).isNotNull())


def ensemble_stats(df: DataFrame, prefix: str = "temperature_2m_member") -> DataFrame:
    """Mean, sample standard deviation and count over the member columns of a row."""
    arr = F.array_compact(F.array(*[c(x) for x in df.columns if x.startswith(prefix)]))
    n = F.size(arr)
    mean = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.nullif(n, F.lit(0))
    out = df.withColumns({"_arr": arr, "Ensemble_Count": n, "Ensemble_Mean": mean})
    ss = F.aggregate("_arr", F.lit(0.0), lambda a, x: a + (x - c("Ensemble_Mean")) * (x - c("Ensemble_Mean")))
    return out.withColumn("Ensemble_Std", F.when(c("Ensemble_Count") > 1, F.sqrt(ss / (c("Ensemble_Count") - 1)))).drop("_arr")


def ensemble_guard(df: DataFrame, value: str, min_members: int = 5, limit: float = 10.0) -> DataFrame:
    """The ensemble mean replaces a point value that is too far from it, if enough members exist."""
    far = F.coalesce((c("Ensemble_Count") >= min_members) & (F.abs(c(value) - c("Ensemble_Mean")) >= limit), F.lit(False))
    return df.withColumns({"Ensemble_Replaced": far.cast("int"), value: F.when(far, c("Ensemble_Mean")).otherwise(c(value))})


# Path parts of an interval lake: segment, rate group, NEM mark, channel and month folder.
LAKE_PATTERNS = {"segment": r"(?i)/(COM|RES)/", "channel": r"(?i)/(DEL|NET|REC)/", "month": r"(?i)/MONTHLY_(\d{6})(?:/|_)"}


def lake_metadata(path: Column) -> dict[str, Column]:
    """Segment, channel, rate group, NEM status and month of a file path; empty parts are null."""
    got = {n: F.upper(F.nullif(F.regexp_extract(path, p, 1), F.lit(""))) for n, p in LAKE_PATTERNS.items()}
    return {**got, "rate_group": F.coalesce(F.upper(F.nullif(F.regexp_extract(path, r"(?i)/(GS[^/]*)/", 1), F.lit(""))), F.lit("RES")),
            "nem_status": F.when(F.upper(path).contains("/NEM/"), "NEM").otherwise("Non-NEM")}


def interval_lake(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """All interval files under a root with their path metadata, size and change time."""
    r = spark.read.option("recursiveFileLookup", "true")
    df = (r.schema(schema) if schema else r).parquet(root)
    return df.withColumns({**lake_metadata(c("_metadata.file_path")), "file_path": c("_metadata.file_path"), "file_size": c("_metadata.file_size"), "modified": c("_metadata.file_modification_time")})


def file_catalog(lake: DataFrame) -> DataFrame:
    """One row per file: metadata, size, change time and rows."""
    return lake.groupBy("file_path", "segment", "channel", "month", "rate_group", "nem_status").agg(F.max("file_size").alias("file_size"), F.max("modified").alias("modified"), F.count("*").alias("rows"))


def catalog_range(catalog: DataFrame, channels: Sequence[str]) -> DataFrame:
    m = catalog.where(c("channel").isin(*channels)).select("channel", c("month").cast("int").alias("month"))
    return m.groupBy("channel").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count("*").alias("files"))


def service_point_index(lake: DataFrame, spid: str, file: str, buckets: int = 256) -> DataFrame:
    """Rows per (service point, file), base id (text before '_') and a hash bucket to partition by."""
    g = lake.groupBy(c(spid).cast("string").alias("spid"), c(file).alias("file")).agg(F.count("*").alias("rows"))
    base = F.split_part(c("spid"), F.lit("_"), F.lit(1))
    return g.withColumns({"spid_base": base, "bucket": F.pmod(F.xxhash64(base), F.lit(buckets)).cast("int")})


def densest_series(df: DataFrame, key: str, value: str) -> DataFrame:
    """Positive readings of the key with the most rows (the smallest key on ties)."""
    best = df.groupBy(key).agg(F.count("*").alias("_n")).agg(F.max_by(key, F.struct("_n", -c(key)))) if dict(df.dtypes)[key] != "string" else df.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), key).limit(1).select(key)
    return df.where(c(key) == best.scalar()).where(c(value) > 0)


def stable_plus_tail(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], cutoff: Column) -> DataFrame:
    """Stored rows before the cutoff, fresh rows elsewhere or where the store has none; a fresh row wins from the cutoff on."""
    s = stored.where(c("DT") < cutoff).withColumn("_p", F.lit(1))
    f = fresh.withColumn("_p", F.when(c("DT") < cutoff, 0).otherwise(2))
    return keep_last(s.unionByName(f, allowMissingColumns=True), [*keys, "DT"], ["_p"]).drop("_p")


def cached_slice(spark: SparkSession, path: str, start: str, end: str, columns: Sequence[str]) -> DataFrame:
    """Date slice of a stored table; both the filter and the columns reach the scan."""
    df = spark.read.parquet(path)
    missing = [x for x in columns if x not in df.columns]
    if missing:
        raise ValueError(f"cache {path} lacks {missing}")
    return df.select(*columns).where(c("DT").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def results_as_weather(results: DataFrame, mapping: Mapping[str, str], keys: Sequence[str] = ("series",)) -> DataFrame:
    """A weather table rebuilt from stored forecast results: columns renamed, rows without temperature dropped."""
    have = {s: t for s, t in mapping.items() if s in results.columns}
    out = results.select(*keys, "DT", *[c(s).cast("double").alias(t) for s, t in have.items()])
    return out.where("TempF is not null") if "TempF" in have.values() else out


def overlapping_extracts(extracts: Sequence[DataFrame], keys: Sequence[str], start: str, end: str, required: Sequence[str]) -> DataFrame:
    """Union of extracts that cover a window, usable rows only; a later extract wins."""
    tagged = [e.withColumn("_i", F.lit(i)) for i, e in enumerate(extracts)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    u = u.where(c("DT").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    for r in required:
        u = u.where(c(r).isNotNull())
    return keep_last(u, [*keys, "DT"], ["_i"]).drop("_i")
