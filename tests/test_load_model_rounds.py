"""The load model boosts until the loss of later rows no longer falls."""

import random

from voltloom.models import learners as ML
from voltloom.plans import h_flows as HF


def test_load_model_ends_by_its_validation_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        f = [float(rng.randrange(24)), *[rng.random() * 30 for _ in range(5)]]
        rows.append((f"2024-0{1 + i // 400}-11 00:00:00", int(f[0]), *f[1:], 20 * f[1] + f[2] * f[3] + rng.gauss(0, 5)))
    df = spark.createDataFrame(rows, "t string, Hour int, Temperature double, Temperature_DailyMax double, CloudCover_Norm double, MWH_Lag24 double, MWH_SameHour7DayMean double, Actual_MWH double")
    df = df.selectExpr("*", "CAST(t AS TIMESTAMP) AS DT", "CAST(t AS DATE) AS Date").coalesce(1).cache()
    fitted, fit = [], ML.fit

    def spy(*a, **kw):
        fitted.append((fit(*a, **kw), a[0]))
        return fitted[-1][0]

    monkeypatch.setattr(HF, "model_rows", lambda *_: df)
    monkeypatch.setattr(ML, "fit", spy)
    from voltloom.plans.base import QUERIES

    assert QUERIES["mod01_boosted_load_model"](spark, "").count() == 24
    model, used = fitted[0]
    trees = model.model.stages[-1].getNumTrees
    assert 20 < trees < HF.LOAD_ROUNDS
    late = model.model.stages[0].transform(ML.filled(used.where("is_validation"), model.fill))
    losses = model.model.stages[-1].evaluateEachIteration(late, "squared")
    assert all(b <= a for a, b in zip(losses, losses[1:]))
