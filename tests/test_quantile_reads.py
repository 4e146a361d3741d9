"""Quantiles store and shuffle only the values of buckets that hold a wanted rank."""

import numpy as np
from pyspark.sql import functions as F

from voltloom.core import group_quantiles
from voltloom.core import quantiles as Q
from voltloom.operators import bands as BD


def test_only_wanted_buckets_are_stored(spark, monkeypatch):
    stored, write = [], Q.materialise

    def spy(df, *a):
        out = write(df, *a)
        stored.append(out.count())
        return out

    monkeypatch.setattr(Q, "materialise", spy)
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "a").alias("k"), (F.exp((F.col("id") % 9973) / 2000.0) - 3).alias("v"))
    got = {r["k"]: r for r in group_quantiles(df, ["k"], "v", {"m": 0.5, "z": 0.93}, "n", mean_as="mean").collect()}
    assert len(got) == 2 and max(stored) < 1000
    rows = df.toPandas()
    for k, g in (("a", rows[rows.k == "a"]), (None, rows[rows.k.isna()])):
        r = got[k]
        assert r["n"] == len(g) and np.allclose([r["m"], r["z"], r["mean"]], [np.quantile(g.v, 0.5), np.quantile(g.v, 0.93), g.v.mean()])


def test_prior_origin_quantiles_fold_only_wanted_buckets(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("o"), ((F.col("id") * 37 % 3001) / 100.0).alias("ae"), F.when(F.col("id") % 5 > 0, "x").alias("Weather_Input_Risk_Class"), F.lit("Day1").alias("Replay_Horizon_Bucket"))
    q = BD.prior_origin_quantiles(df, "o", "ae")
    assert "LeftSemi" in q._jdf.queryExecution().optimizedPlan().toString()
    got = {r["o"]: (r["q"], r["count"]) for r in q.where("level = 'global'").collect()}
    rows = df.toPandas()
    assert set(got) == {1, 2}
    for o, (v, n) in got.items():
        past = rows[rows.o < o].ae
        assert n == len(past) and abs(v - np.quantile(past, 0.8)) < 1e-9
