"""What the pipeline's stages leave on disk and shuffle."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from voltloom.core import scratch
from voltloom.llm import minmax, mixing, quality

DOCS = "doc_id bigint, text string, lang string, source string"


def rows(n, seed=1):
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(60, 120))) for _ in range(n)]
    texts[1::10] = texts[0::10]
    texts[2::10] = [t + " more" for t in texts[0::10]]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])) for i, t in enumerate(texts)] + [(n, None, None, None), (None, "one two", "en", "a")]


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    return tmp_path


def test_passing_tables_go_and_kept_ones_stay(spark, folder):
    def ids(df):
        return sorted(r[0] for r in df.collect())

    with scratch.passing(spark) as keep:
        a = scratch.materialise(spark.range(3))
        with scratch.passing(spark) as keep_inner:
            b = keep_inner(scratch.materialise(a.union(a)).distinct())
        assert len(os.listdir(folder)) == 2 and ids(b) == [0, 1, 2]
        c = keep(b.where("id > 0"))
    assert len(os.listdir(folder)) == 1 and ids(c) == [1, 2]
    with pytest.raises(ValueError), scratch.passing(spark):
        scratch.materialise(spark.range(3))
        raise ValueError
    assert len(os.listdir(folder)) == 1
    scratch.discard(c.where("id > 1"), spark)
    assert ids(c) == [1, 2]
    scratch.discard(c, spark)
    assert not os.listdir(folder)


def test_near_duplicates_leave_only_their_result(spark, folder):
    docs = spark.createDataFrame(rows(100), DOCS)
    v = minmax.near_duplicates(docs)
    assert len(os.listdir(folder)) == 1
    assert v.count() == 102 and v.where("kept").count() == 82


def test_measured_texts_are_packed(spark, folder):
    docs = spark.createDataFrame(rows(50), DOCS)
    quality.filter_quality(docs, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"))
    packed = [f for d, _, names in os.walk(folder) for f in names if f.endswith(".zstd.parquet")]
    assert packed


@pytest.mark.parametrize("labelled", [True, False])
def test_only_texts_whose_label_decides_meet_the_labels(spark, monkeypatch, labelled):
    docs = spark.createDataFrame(rows(1500), DOCS)
    labels = spark.createDataFrame([(i, q) for i, q in zip(range(0, 1500, 2), [0, 1, None] * 250)] + [(0, 1), (None, 1)], "doc_id bigint, quality int") if labelled else None
    met, plain = [], mixing._weighted

    def spy(drawn, labels):
        if "_row" in drawn.columns:
            met.append(drawn.count())
        return plain(drawn, labels)

    monkeypatch.setattr(mixing, "_weighted", spy)
    got = mixing.mixed_rows(docs, labels).where("text IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    want = mixing.mix(docs, labels).where("taken > 0").select("doc_id", F.expr("taken div size").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert 0 < sum(met) < 1502 / 2
    if not labelled:
        assert max(met) <= 20  # the rows at the stop of each source


def test_pipeline_drops_the_tables_of_each_stage(spark, folder, monkeypatch):
    import corpus_pipeline

    def stage(spark, docs, sf_dir):
        return scratch.materialise(docs).withColumn("n", F.lit(1))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert len(os.listdir(folder)) == 1
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
