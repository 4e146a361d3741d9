"""The mix on rows that share a key: repeated rows, null ids, and both beside ordinary documents."""

import random

import pytest
from pyspark.sql import functions as F

from voltloom.llm import mixing

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def text(rng, n):
    return " ".join(f"w{rng.randrange(9999)}" for _ in range(n))


@pytest.mark.parametrize("kind", ["one row repeated", "null ids", "mixed"])
def test_taken_words_come_near_the_target(spark, kind):
    rng = random.Random(kind)
    same = text(rng, 100)
    if kind == "one row repeated":
        rows = [(1, same, "en", "a", 5)] * 1000
    elif kind == "null ids":
        rows = [(None, same, "en", "a", i % 7) for i in range(700)]
    else:
        rows = [(1, same, "en", "a", 5)] * 300 + [(None, same, None, "a", None)] * 200 + [(i, text(rng, 100), "en", "a", 1) for i in range(2, 300)]
    rows += [(10_000 + i, text(rng, 100), "en", "b", 1) for i in range(100)] + [(20_000, None, None, None, None), (20_001, "one", "en", None, 3)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df)
    assert got.count() == len(rows)
    by = df.select("doc_id", "text", "source").distinct()
    near = got.join(by.select(F.col("doc_id").alias("_i"), "source").distinct(), F.col("doc_id").eqNullSafe(F.col("_i")))
    for r in near.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("goal"), F.max(F.try_divide("taken", "size")).alias("most")).collect():
        assert abs(r["t"] - r["goal"]) <= 100, (kind, r)
        assert r["most"] is None or r["most"] <= 2
    again = sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert again == sorted(map(str, got.collect()))
    want = got.where("taken > 0").groupBy("doc_id").agg(F.sum(F.try_divide("taken", "size")).cast("long").alias("n"))
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    out = out.where("text IS NOT NULL")  # a row without words counts nothing, however often it is there
    assert sorted(map(str, out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect())) == sorted(map(str, want.collect()))


def test_copies_of_any_number(spark):
    got = mixing._copies(spark.createDataFrame([(1, 25_001), (2, 0), (3, 1), (4, 10_000)], "a int, n long"), F.col("n")).groupBy("a").agg(F.count(F.lit(1)), F.countDistinct("_i"), F.max("_i")).collect()
    assert sorted(map(tuple, got)) == [(1, 25_001, 25_001, 25_000), (3, 1, 1, 0), (4, 10_000, 10_000, 9_999)]
