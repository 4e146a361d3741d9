"""Query registry and text helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPACES = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its DuckDB text."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits of any script; null has none."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " ")
    return F.array_remove(F.split(flat, " ", -1), "")


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The row as one struct ``doc`` beside the columns in use, so that names of extra columns cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *[F.col(c) for c in used])
