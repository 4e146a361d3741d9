"""What the seeds of texts cost: words made once, seeds in compiled code, nothing left out."""

import random

from pyspark.sql import functions as F

from voltloom.llm import decontam
from voltloom.llm.base import tokens


def test_words_are_made_once_and_seeds_are_compiled(spark, tmp_path, monkeypatch):
    leak = [f"q{i}" for i in range(20)]
    rows = [(1, "a b " + " ".join(leak) + " c"), (2, "clean " * 30), (3, None), (4, ""), (None, " ".join(leak[:9] + ["z"] + leak[10:]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    items = spark.createDataFrame([(1, " ".join(leak)), (2, "three short words")], "item_id long, text string")
    plans, write = [], decontam.materialise

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(decontam, "materialise", spy)
    for most in (decontam.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontam, "BROADCAST_SEEDS", most)
        got = decontam.contaminated(spark.read.parquet(f"{tmp_path}/docs"), items)
        assert {tuple(r) for r in got.collect()} == {(1, 1, 13, 13, 20, 2), (None, 1, 12, 13, 19, 0)}
        of_texts = plans[-1]
        assert of_texts.count("regexp_replace") == 1 and "lambda" not in of_texts


def test_every_window_of_every_mask_has_a_seed(spark):
    rng = random.Random(5)
    texts = [None, "", "...", "one", *(" ".join(rng.choice("abc") for _ in range(n)) for n in range(1, 40))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", tokens(F.col("text")).alias("tok"))
    of_n = {13: decontam.MASKS, **decontam.SHORT_MASKS}
    masks = {m for ms in of_n.values() for m in ms}
    seeds: dict[int, list] = {}
    for r in decontam._seeds(rows, "tok", of_n).collect():
        seeds.setdefault(r["seed"], []).append((r["doc_id"], r["pos"]))
    got = sorted(x for at in seeds.values() for x in at)
    words = {i: (t or "").replace(".", "").split() for i, t in enumerate(texts)}
    want: dict[tuple, list] = {}
    for i, ws in words.items():
        for m in masks:
            for p in range(len(ws) - len(m) + 1):
                want.setdefault((m, *(ws[p + o] for o in decontam._ones(m))), []).append((i, p))
    assert got == sorted(x for at in want.values() for x in at)
    assert sorted(map(sorted, seeds.values())) == sorted(map(sorted, want.values()))
