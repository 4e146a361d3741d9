"""Run store and snapshot archive on parquet: append by run, additive schema, content hashes."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import keep_last, nan_to_null

c = F.col


def normalise(df: DataFrame) -> DataFrame:
    """Storable columns: NaN to null, nested values to JSON text, dates and times kept typed."""
    d = nan_to_null(df)
    out = []
    for f in d.schema.fields:
        if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)):
            out.append(F.to_json(f.name).alias(f.name))
        elif isinstance(f.dataType, T.NullType):
            out.append(c(f.name).cast("string").alias(f.name))
        else:
            out.append(c(f.name))
    return d.select(*out)


def new_run_id() -> str:
    return uuid.uuid4().hex


def append_run(tables: Mapping[str, DataFrame], root: str, run_id: str, metadata: Mapping[str, str] | None = None, spark: SparkSession | None = None) -> None:
    """Append each table under one run id, then the run row.

    The run row is written last, so a run is visible only when its tables are
    complete; readers go through it.  Each table lands in its own ``RunID=``
    partition, and a retry overwrites just that partition.
    """
    spark = spark or next(iter(tables.values())).sparkSession
    counts = []
    for name, df in tables.items():
        out = normalise(df).withColumn("InsertedAtUTC", F.current_timestamp())
        out.write.mode("overwrite").parquet(f"{root}/{name}/RunID={run_id}")
        s = spark.read.parquet(f"{root}/{name}/RunID={run_id}")
        agg = [F.count("*").alias("rows")]
        agg += [F.min("DT").cast("string").alias("first_dt"), F.max("DT").cast("string").alias("last_dt")] if "DT" in s.columns else [F.lit(None).cast("string").alias("first_dt"), F.lit(None).cast("string").alias("last_dt")]
        counts.append(s.agg(*agg).select(F.lit(name).alias("table_name"), "rows", "first_dt", "last_dt"))
    summary = counts[0]
    for x in counts[1:]:
        summary = summary.unionByName(x)
    meta = F.to_json(F.create_map(*[x for k, v in (metadata or {}).items() for x in (F.lit(k), F.lit(str(v)))])) if metadata else F.lit("{}")
    run = summary.withColumns({"StartedAtUTC": F.current_timestamp(), "MetadataJson": meta})
    run.write.mode("overwrite").parquet(f"{root}/_runs/RunID={run_id}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every run of a table; columns added by later runs are null in earlier ones."""
    return spark.read.option("mergeSchema", "true").option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")


def latest_run(runs: DataFrame, rows: DataFrame, started: str = "StartedAtUTC", run: str = "RunID", by: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest run (greatest start, then id), per key if given."""
    top = runs.groupBy(*by).agg(F.max_by(run, F.struct(started, run)).alias(run)) if by else runs.agg(F.max_by(run, F.struct(started, run)).alias(run))
    return rows.join(top, [*by, run], "left_semi")


def row_digest(cols: Sequence[str]) -> Column:
    return F.xxhash64(*[F.coalesce(c(x).cast("string"), F.lit("\u0000")) for x in cols])


def content_hash(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Order-free content hash per snapshot, with rows and first and last time.

    Two 64-bit row digests are summed exactly as decimals, so any group size is
    combined before the shuffle; equal rows in any order give the same text.
    """
    a, b = row_digest(cols), F.xxhash64(F.lit("salt"), *[F.coalesce(c(x).cast("string"), F.lit("\u0000")) for x in cols])
    d = lambda x: F.sum(x.cast("decimal(20,0)"))
    text = F.concat_ws(":", F.count("*").cast("string"), d(a).cast("string"), d(b).cast("string"))
    return df.groupBy(*by).agg(F.sha2(text, 256).alias("ContentHash"), F.count("*").alias("rows"), F.min("DT").alias("FirstDT"), F.max("DT").alias("LastDT"))


def new_snapshots(incoming: DataFrame, manifest: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Snapshots whose content the manifest has not seen (one per content)."""
    h = content_hash(incoming, by, cols)
    one = keep_last(h, ["ContentHash"], list(by))
    return one.join(manifest.select("ContentHash").distinct(), "ContentHash", "left_anti").select(*by, "ContentHash", "rows", "FirstDT", "LastDT")


def archive(df: DataFrame, root: str, snapshot_id: str, cols: Sequence[str], archived_at: Column | None = None) -> str:
    """Store a snapshot unless its content is already archived; gives the id that holds the content.

    Only the one-row hash and a lookup by hash reach the driver.
    """
    spark = df.sparkSession
    h = content_hash(df.withColumn("_one", F.lit(1)), ["_one"], cols).select("ContentHash", "rows", "FirstDT", "LastDT")
    row = h.first()
    if row is None:
        return ""
    known = _manifest(spark, root)
    if known is not None:
        hit = known.where(c("ContentHash") == row["ContentHash"]).select("SnapshotID").limit(1).collect()
        if hit:
            return hit[0]["SnapshotID"]
    at = archived_at if archived_at is not None else F.current_timestamp()
    normalise(df).withColumn("ArchivedAtUTC", at).write.mode("overwrite").parquet(f"{root}/rows/SnapshotID={snapshot_id}")
    spark.createDataFrame([(snapshot_id, row["ContentHash"], row["rows"], row["FirstDT"], row["LastDT"])], "SnapshotID string, ContentHash string, rows long, FirstDT timestamp, LastDT timestamp").withColumn(
        "ArchivedAtUTC", at).write.mode("append").parquet(f"{root}/manifest")
    return snapshot_id


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(f"{root}/manifest") if fs.exists(p) else None


def latest_different(manifest: DataFrame, current_hash: Column, by: Sequence[str] = ()) -> DataFrame:
    """Newest snapshot whose hash differs from the current one."""
    m = manifest.where(c("ContentHash") != current_hash)
    best = F.max_by(F.struct("SnapshotID", "ContentHash", "ArchivedAtUTC"), F.struct("ArchivedAtUTC", "SnapshotID")).alias("_b")
    return m.groupBy(*by).agg(best).select(*by, "_b.*") if by else m.agg(best).select("_b.*")


def as_archived(rows: DataFrame, keys: Sequence[str], max_lead: int, tz: str = "UTC") -> DataFrame:
    """Weather as it was known: lead in local days (same day = 1), 1..max, newest archive per (time, lead)."""
    local = lambda x: F.to_date(F.from_utc_timestamp(c(x), tz))
    lead = F.datediff(local("DT"), local("ArchivedAtUTC")) + 1
    r = rows.withColumn("Forecast_Weather_Lead_Days", lead).where(c("Forecast_Weather_Lead_Days").between(1, max_lead))
    return keep_last(r, [*keys, "DT", "Forecast_Weather_Lead_Days"], ["ArchivedAtUTC"])


def import_csv_archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Archived CSV files as snapshots named by their file."""
    df = spark.read.schema(schema).option("header", "true").csv(path)
    return df.withColumns({"SnapshotID": F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.csv)?$", 1), "ArchivedAtUTC": c("_metadata.file_modification_time")})


def text_widths(df: DataFrame) -> DataFrame:
    """Longest text and padded bound of every text column, in one pass; beyond 4000 there is no bound."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    one = df.agg(*[F.max(F.length(x)).alias(x) for x in cols])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(x).alias("column"), c(x).cast("int").alias("max_length")) for x in cols])))
    n = F.coalesce("max_length", F.lit(0))
    bound = F.least(F.ceil(F.greatest(F.lit(100), n * 3) / 50) * 50, F.lit(4000)).cast("int")
    return long.withColumn("bound", F.when(n <= 4000, bound))


def export(tables: Mapping[str, DataFrame], root: str, fmt: str = "csv") -> None:
    """Every table to its own CSV or JSON folder."""
    for name, df in tables.items():
        w = normalise(df).write.mode("overwrite")
        (w.option("header", "true").csv if fmt == "csv" else w.json)(f"{root}/{name}")


def persist_origins(cube: DataFrame, root: str, origin: str = "origin_id") -> None:
    """Per-origin raw frames for many later scorings, partitioned by origin; existing origins are replaced one by one."""
    cube.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(origin).parquet(root)


def one_row(values: Mapping[str, object], spark: SparkSession) -> DataFrame:
    """A mapping as a one-row frame, for tables that store settings."""
    return spark.range(1).select(*[F.lit(v if isinstance(v, (int, float, str, bool)) or v is None else str(v)).alias(k) for k, v in values.items()])


def choose(diagnostics: Mapping[str, DataFrame | Mapping], table_map: Mapping[str, str], spark: SparkSession) -> dict[str, DataFrame]:
    """Named diagnostics to persist; mappings become one-row frames."""
    out = {}
    for key, table in table_map.items():
        if key in diagnostics:
            v = diagnostics[key]
            out[table] = v if isinstance(v, DataFrame) else one_row(v, spark)
    return out
