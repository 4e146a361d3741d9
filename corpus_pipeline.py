"""A training corpus from raw documents: quality rules, near-dedup, decontamination, mix, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltloom.core.scratch import discard, passing
from voltloom.llm import decontam, minmax, mixing, quality, token_files
from voltloom.llm.base import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept; the cutoffs are certified on the labelled ones among them."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minmax.keep_one(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, those labelled as good more likely; one taken twice is two rows."""
    return mixing.mixed_rows(docs, table(spark, sf_dir, "labels"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and per document what they hold."""
    return token_files.encode_and_read(docs, spark)


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", keep_distinct),
    ("decontamination", keep_unleaked),
    ("source mix", mix_sources),
    ("token files", to_tokens),
]

ORACLE_SQL = None  # tokenization is beyond SQL; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; a stage's own tables go when its result is written, that when the next one is."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with passing(spark) as keep:
            left = keep(stage(spark, docs, sf_dir))
        discard(docs, spark)
        docs = left
    return docs
