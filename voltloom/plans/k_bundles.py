"""Queries: the replay's tables as one written set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.buckets import cloud_bucket
from ..operators import bundle as BU
from .a_features import CLOUD_BUCKET_SQL, TEMP_BUCKET_SQL
from .base import SEASON, STAGES, ctes, query, replay
from .c_scorecards import ACT

COLS = ("origin_id", "Hour", "Month", "Season", "HourGroup", "IsWeekend", "Forecast_Day", "Temperature_DailyMax", "CloudCover_Norm", ACT, *STAGES.values())


def prepared(spark, d):
    b = replay(spark, d, *COLS).withColumn("CloudCoverBucket", cloud_bucket("CloudCover_Norm"))
    return BU.with_replay_context(b, "origin_id", (F.col("origin_id") % 100).cast("int"))


_M = "CAST(origin_id % 100 AS INT)"
CONTEXT_SQL = f"""v_rx AS MATERIALIZED (SELECT *, origin_id AS Replay_Origin_ID, {_M} AS Replay_Origin_Month, {SEASON.format(m=_M)} AS Replay_Origin_Season, {TEMP_BUCKET_SQL} AS DailyMaxTempBucket, {CLOUD_BUCKET_SQL} AS CloudCoverBucket,
  CASE WHEN Forecast_Day <= 1 THEN 'Day1' WHEN Forecast_Day <= 7 THEN 'Days2to7' WHEN Forecast_Day <= 16 THEN 'Days8to16' WHEN Forecast_Day IS NOT NULL THEN 'Days17Plus' END AS Replay_Horizon_Bucket FROM v_bt)"""


def _key_sql(keys):
    return " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '<missing>')" for k in keys) or "'all'"


TABLES_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", {_key_sql(t.keys)} AS key, '{stage}' AS "Stage", Actual_MWH AS a, {col} AS f FROM v_rx{' WHERE ' + t.where if t.where else ''}""" for name, t in BU.TABLES.items() for stage, col in STAGES.items())
METRICS = ["Actual_Mean_MWH", "Forecast_Mean_MWH", "Bias_MWH", "MAE_MWH", "RMSE_MWH", "MAPE_PCT", "Underforecast_Rate_PCT", "Max_Underforecast_MWH", "Max_Overforecast_MWH"]


@query("rep05_replay_bundle", ctes("bt") + f""", {CONTEXT_SQL}, u AS ({TABLES_SQL})
SELECT "table", key, "Stage", CAST(count(*) AS BIGINT) AS "N", avg(a) AS "Actual_Mean_MWH", avg(f) AS "Forecast_Mean_MWH", avg(a - f) AS "Bias_MWH", avg(abs(a - f)) AS "MAE_MWH", sqrt(avg((a - f) * (a - f))) AS "RMSE_MWH",
  avg(CASE WHEN abs(a) > 1e-9 THEN abs(a - f) / abs(a) * 100 END) AS "MAPE_PCT", avg(CASE WHEN a > f THEN 100.0 ELSE 0 END) AS "Underforecast_Rate_PCT", max(a - f) AS "Max_Underforecast_MWH", greatest(max(f - a), 0) AS "Max_Overforecast_MWH"
FROM u GROUP BY ALL""", r6=METRICS)
def _(spark, d):
    folder = BU.write_bundle(prepared(spark, d), STAGES)
    return spark.read.parquet(f"{folder}/tables").select("table", "key", "Stage", "N", *METRICS)


@query("rep13_bundle_manifest", ctes("bt") + f""", {CONTEXT_SQL}, u AS ({TABLES_SQL})
SELECT "table", CAST(count(DISTINCT key || '#' || "Stage") AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS scored FROM u GROUP BY 1""")
def _(spark, d):
    return BU.manifest(spark, BU.write_bundle(prepared(spark, d), STAGES)).select("table", "rows", "scored")
