"""The tables of a replay, from one aggregate over one scan.

Rows fold to cells of all keys, slices and stages, whose number is bounded by the
calendar and the bins. Every cell is dealt to the tables whose slice holds it, with its
key in each, and a second aggregate gives all tables, which are written as one set
partitioned by table with a manifest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.scratch import shared_dir
from ..functions.buckets import daily_max_bucket
from ..functions.calendar import season
from .lookups import MISSING
from .metrics import ACTUAL, by_stage, metric_sums, metrics_of_sums

c = F.col


@dataclass(frozen=True)
class Table:
    """A metric table: its keys, and the rows it covers as SQL text (all, if empty)."""

    keys: tuple[str, ...] = ()
    where: str = ""


_CANDIDATE = ("Replay_Horizon_Bucket", "Month", "DailyMaxTempBucket", "CloudCoverBucket")
# Names, keys and slices of the replay's metric tables.
TABLES = {
    "stage_metrics": Table(),
    "origin_metrics_by_stage": Table(("Replay_Origin_ID", "Replay_Origin_Season", "Replay_Origin_Month")),
    "scored_season_metrics_by_stage": Table(("Season", "Replay_Horizon_Bucket")),
    "origin_season_metrics_by_stage": Table(("Replay_Origin_Season", "Replay_Horizon_Bucket")),
    "horizon_metrics_by_stage": Table(("Replay_Horizon_Bucket",)),
    "peak_window_metrics_by_stage": Table(("Replay_Horizon_Bucket", "Hour"), "Hour BETWEEN 14 AND 18"),
    "peak_window_14to20_metrics_by_stage": Table(("Replay_Horizon_Bucket", "Hour"), "Hour BETWEEN 14 AND 20"),
    "extreme_heat_peak_metrics_by_stage": Table(("Replay_Horizon_Bucket",), "Hour BETWEEN 14 AND 20 AND Temperature_DailyMax >= 105"),
    "hot_peak_metrics_by_stage": Table(("Replay_Horizon_Bucket", "DailyMaxTempBucket", "Hour"), "HourGroup = 'Peak' AND Temperature_DailyMax >= 90"),
    "hot_peak_candidate_metrics_by_stage": Table(_CANDIDATE, "HourGroup = 'Peak' AND Temperature_DailyMax >= 90"),
    "weekend_metrics_by_stage": Table(("Replay_Horizon_Bucket",), "IsWeekend = 1"),
    "long_horizon_metrics_by_stage": Table(("Replay_Horizon_Bucket",), "Forecast_Day BETWEEN 8 AND 16"),
}


def with_replay_context(df: DataFrame, origin: str, origin_month: Column) -> DataFrame:
    """Origin and bucket columns that the tables are keyed by."""
    day = c("Forecast_Day")
    bucket = F.when(day <= 1, "Day1").when(day <= 7, "Days2to7").when(day <= 16, "Days8to16").when(day.isNotNull(), "Days17Plus")
    return df.withColumns({"Replay_Origin_ID": c(origin), "Replay_Origin_Month": origin_month, "Replay_Origin_Season": season(origin_month), "Replay_Horizon_Bucket": bucket,
                           "DailyMaxTempBucket": daily_max_bucket("Temperature_DailyMax")})


def _key(t: Table) -> Column:
    return F.concat_ws("|", *[F.coalesce(c(k).cast("string"), F.lit(MISSING)) for k in t.keys]) if t.keys else F.lit("all")


def bundle_rows(df: DataFrame, stages: Mapping[str, str], tables: Mapping[str, Table] = TABLES) -> DataFrame:
    """``table, key, Stage`` and the accuracy metrics: all tables from the cells of one scan."""
    keys = list(dict.fromkeys(k for t in tables.values() for k in t.keys))
    slices = {w: f"_in{i}" for i, w in enumerate(dict.fromkeys(t.where for t in tables.values() if t.where))}
    inside = df.where(c(ACTUAL).isNotNull()).withColumns({n: F.coalesce(F.expr(w), F.lit(False)) for w, n in slices.items()})
    cell = [*keys, *slices.values()]
    long = by_stage(inside, stages, [*cell, ACTUAL]).where(c("Forecast_MWH").isNotNull())
    cells = long.groupBy(*cell, "Stage").agg(*[a.alias(n) for n, a in metric_sums().items()])
    parts = F.array_compact(F.array(*[F.when(c(slices[t.where]) if t.where else F.lit(True), F.struct(F.lit(n).alias("table"), _key(t).alias("key"))) for n, t in tables.items()]))
    dealt = cells.select("Stage", *metric_sums(), F.inline(parts))
    return dealt.groupBy("table", "key", "Stage").agg(*[a.alias(n) for n, a in metrics_of_sums().items()])


def write_bundle(df: DataFrame, stages: Mapping[str, str], tables: Mapping[str, Table] = TABLES, folder: str | None = None) -> str:
    """Write the tables below ``folder`` (a fresh shared one by default), one partition a table; gives the folder."""
    out = folder or shared_dir(df.sparkSession)
    bundle_rows(df, stages, tables).repartition("table").write.partitionBy("table").parquet(f"{out}/tables")
    return out


def read_table(spark: SparkSession, folder: str, name: str, tables: Mapping[str, Table] = TABLES) -> DataFrame:
    """One table of a written bundle with its key columns as text."""
    rows = spark.read.parquet(f"{folder}/tables").where(c("table") == name).drop("table")
    keys = tables[name].keys
    value = F.split("key", r"\|")
    return rows.select(*[F.when(value[i] != MISSING, value[i]).alias(k) for i, k in enumerate(keys)], *[x for x in rows.columns if x != "key"])


def manifest(spark: SparkSession, folder: str, tables: Sequence[str] | Mapping[str, Table] = TABLES) -> DataFrame:
    """``table, keys, rows, scored`` of a written bundle: a row per table, also of those without any; ``scored`` counts rows times stages."""
    rows = spark.read.parquet(f"{folder}/tables").groupBy("table").agg(F.count(F.lit(1)).alias("rows"), F.sum("N").alias("scored"))
    names = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("table"), F.lit("|".join(tables[n].keys)).alias("keys")) for n in tables])))
    out = names.join(rows, "table", "left")
    return out.select("table", "keys", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("scored", F.lit(0)).alias("scored"))
