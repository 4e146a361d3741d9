"""Spark ML learners: load model, blend, recursion, residual learners, clustering, importance."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import epoch_hour, epoch_second, safe_div
from ..functions.weather import clip

c = F.col


def medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> dict[str, float]:
    """Approximate medians for feature filling (one bounded sketch per column); a column without values gives 0."""
    row = df.agg(*[F.percentile_approx(x, 0.5, accuracy).alias(x) for x in cols]).first()
    return {x: float(row[x]) if row is not None and row[x] is not None else 0.0 for x in cols}


def filled(df: DataFrame, fill: Mapping[str, float]) -> DataFrame:
    return df.withColumns({k: F.coalesce(c(k).cast("double"), F.lit(v)) for k, v in fill.items()})


def tree_pipeline(features: Sequence[str], label: str, weight: str | None = None, validation: str | None = None, loss: str = "squared", kind: str = "gbt",
                  iters: int = 20, depth: int = 5, prediction: str = "prediction", tol: float = 0.01) -> Pipeline:
    """Assembler and boosted trees (or a forest) with row weights and a time-ordered validation flag.

    With ``validation`` a boosted fit ends with the round after which the loss of the flagged rows falls by
    less than the share ``tol``; with 0 it goes on as long as the loss falls.
    """
    asm = VectorAssembler(inputCols=list(features), outputCol="_x")
    if kind == "forest":
        reg = RandomForestRegressor(featuresCol="_x", labelCol=label, predictionCol=prediction, numTrees=iters, maxDepth=depth, seed=7)
    else:
        reg = GBTRegressor(featuresCol="_x", labelCol=label, predictionCol=prediction, maxIter=iters, maxDepth=depth, lossType=loss, seed=7)
        if validation:
            reg = reg.setValidationIndicatorCol(validation).setParams(validationTol=tol)
    if weight:
        reg = reg.setWeightCol(weight)
    return Pipeline(stages=[asm, reg])


@dataclass
class Fitted:
    """A fitted pipeline with the medians its features are filled with."""

    model: PipelineModel
    fill: dict[str, float]
    features: tuple[str, ...]

    def score(self, df: DataFrame) -> DataFrame:
        return self.model.transform(filled(df, self.fill)).drop("_x")


def fit(df: DataFrame, features: Sequence[str], label: str, **kw) -> Fitted:
    """Fit on rows that have the label; absent feature values take the median of the fit rows."""
    work = df.where(c(label).isNotNull())
    fill = medians(work, features)
    return Fitted(tree_pipeline(features, label, **kw).fit(filled(work, fill)), fill, tuple(features))


def importance(fitted: Fitted, spark) -> DataFrame:
    """Feature importances, largest first; as many rows as features."""
    imp = fitted.model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(fitted.features, imp, strict=True)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def blend(parts: Mapping[str, float]) -> Column:
    """Weighted mean of the components a row has; null when it has none."""
    num = sum((F.coalesce(c(p) * w, F.lit(0.0)) for p, w in parts.items()), F.lit(0.0))
    den = sum((F.when(c(p).isNotNull(), F.lit(float(w))).otherwise(0.0) for p, w in parts.items()), F.lit(0.0))
    return safe_div(num, den)


def trend_seasonality_columns(t: Column, day_of_year: Column, hour: Column, harmonics: int = 2) -> dict[str, Column]:
    """Linear trend and Fourier columns of the year and the day."""
    out = {"trend": t}
    for k in range(1, harmonics + 1):
        for name, x, period in (("y", day_of_year, 365.25), ("d", hour, 24.0)):
            out[f"{name}s{k}"] = F.sin(x * (2 * math.pi * k / period))
            out[f"{name}c{k}"] = F.cos(x * (2 * math.pi * k / period))
    return out


def fit_linear(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.0) -> PipelineModel:
    asm = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="skip")
    return Pipeline(stages=[asm, LinearRegression(featuresCol="_x", labelCol=label, regParam=reg)]).fit(df)


def recursive_forecast(history: DataFrame, coef: Mapping[int, float], intercept: float, horizon: int, keys: Sequence[str] = ("series",), value: str = "MWH", memory: int = 168) -> DataFrame:
    """Multi-step forecast that feeds its own values back as lags, all series at once.

    The state is the last ``memory`` hourly values of a series (gaps take the
    mean), an array of fixed length; the steps are a fold over it.  ``coef``
    maps lag hours to weights.
    """
    end = history.groupBy(*keys).agg(F.max(epoch_hour("DT")).alias("_end"))
    h = history.join(end, list(keys)).withColumn("_age", c("_end") - epoch_hour("DT")).where(c("_age") < memory)
    s = h.groupBy(*keys, "_end").agg(F.map_from_entries(F.collect_list(F.struct("_age", value))).alias("_m"), F.avg(value).alias("_avg"))
    seed = F.transform(F.sequence(F.lit(memory - 1), F.lit(0)), lambda a: F.coalesce(F.try_element_at("_m", a.cast("long")), c("_avg")))
    state = F.struct(seed.alias("w"), F.array().cast("array<double>").alias("y"))

    def step(acc, _):
        y = F.lit(float(intercept))
        for lag, k in coef.items():
            y = y + F.lit(float(k)) * F.element_at(acc["w"], -lag)
        return F.struct(F.concat(F.slice(acc["w"], 2, memory - 1), F.array(y)).alias("w"), F.concat(acc["y"], F.array(y)).alias("y"))

    run = s.select(*keys, "_end", F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), state, step).alias("_r"))
    out = run.select(*keys, "_end", F.posexplode("_r.y").alias("_i", "Raw_Forecast_MWH"))
    return out.select(*keys, F.timestamp_seconds((c("_end") + c("_i") + 1) * 3600).alias("DT"), (c("_i") + 1).alias("Forecast_Lead_Hour"), "Raw_Forecast_MWH")


@dataclass
class ResidualLearner:
    """A global residual model and an event model on what it leaves."""

    all_rows: Fitted
    event: Fitted | None


def fit_two_stage(df: DataFrame, features: Sequence[str], residual: str, event: Column, min_event_rows: int = 48, iters: int = 10, depth: int = 4, min_rows: int = 336) -> ResidualLearner | None:
    """None below ``min_rows`` rows with a residual, no event model below ``min_event_rows`` event rows."""
    if df.where(c(residual).isNotNull()).limit(min_rows).count() < min_rows:
        return None
    g = fit(df, features, residual, loss="absolute", iters=iters, depth=depth, prediction="_g")
    left = g.score(df.where(event & c(residual).isNotNull())).withColumn("_left", c(residual) - c("_g")).drop("_g")
    if left.limit(min_event_rows).count() < min_event_rows:
        return ResidualLearner(g, None)
    return ResidualLearner(g, fit(left, features, "_left", loss="absolute", iters=iters, depth=depth, prediction="_e"))


def apply_two_stage(df: DataFrame, learner: ResidualLearner | None, base: str, event: Column, blend_share: float = 0.5, cap: float = 8.0, out: str = "Targeted_Meta_MWH") -> DataFrame:
    """Blended and capped residual correction; the event part acts on event rows only.  Without a learner (too few rows) it is zero."""
    if learner is None:
        return df.withColumns({out: F.lit(0.0), f"{out}_Forecast": clip(c(base), lo=0.0)})
    s = learner.all_rows.score(df)
    extra = F.lit(0.0)
    if learner.event is not None:
        s = learner.event.score(s)
        extra = F.when(F.coalesce(event, F.lit(False)), c("_e")).otherwise(0.0)
    s = s.withColumn(out, clip((c("_g") + extra) * blend_share, -cap, cap)).drop("_g", "_e")
    return s.withColumn(f"{out}_Forecast", clip(c(base) + c(out), lo=0.0))


def gated_correction(correction: Column, gate: Column, cap: float) -> Column:
    """Correction inside a gate, capped; zero outside."""
    return F.when(F.coalesce(gate, F.lit(False)), clip(correction, -cap, cap)).otherwise(0.0)


def shadow_columns(df: DataFrame, correction: str, base: str, scopes: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """A correction column and forecast per named scope beside the production one; the base is left as it is."""
    out = df
    for name, (scope, cap) in scopes.items():
        out = out.withColumn(f"{name}_Correction_MWH", gated_correction(c(correction), scope, cap))
        out = out.withColumn(f"{name}_Forecast_MWH", clip(c(base) + c(f"{name}_Correction_MWH"), lo=0.0))
    return out


def cluster_sites(sites: DataFrame, k: int) -> DataFrame:
    """Geographic clusters of the sites."""
    asm = VectorAssembler(inputCols=["Latitude", "Longitude"], outputCol="_x")
    m = Pipeline(stages=[asm, KMeans(featuresCol="_x", predictionCol="WeatherCluster", k=k, seed=42)]).fit(sites)
    return m.transform(sites).drop("_x")


def representatives(sites: DataFrame, cluster: str = "WeatherCluster", weight: str = "capacity_kw", key: str = "site") -> DataFrame:
    """Site nearest to the capacity-weighted centre of each cluster."""
    w = F.when(c(weight) > 0, c(weight)).otherwise(F.lit(0.0))
    ctr = sites.groupBy(cluster).agg(F.coalesce(safe_div(F.sum(w * c("Latitude")), F.sum(w)), F.avg("Latitude")).alias("_la"), F.coalesce(safe_div(F.sum(w * c("Longitude")), F.sum(w)), F.avg("Longitude")).alias("_lo"))
    d = (c("Latitude") - c("_la")) * (c("Latitude") - c("_la")) + (c("Longitude") - c("_lo")) * (c("Longitude") - c("_lo"))
    return sites.join(ctr, cluster).groupBy(cluster).agg(F.min_by(key, F.struct(d, c(key))).alias(key), F.sum(weight).alias(weight), F.count("*").alias("sites"))


def performance_ratio(df: DataFrame, features: Sequence[str], available: str, actual: str = "Actual_kWh", min_rows: int = 24, lo: float = 0.0, hi: float = 1.10, fallback: float = 0.75) -> DataFrame:
    """Ratio of export to modelled energy from shallow weighted trees; the median ratio (or the fallback) with too few rows."""
    x = df.where((c(available) > 0) & c(actual).isNotNull()).withColumns({"_y": clip(c(actual) / c(available), lo, hi), "_w": c(available)})
    if x.limit(min_rows).count() < min_rows:
        m = x.agg(F.percentile_approx("_y", 0.5)).first()
        return df.withColumn("PerformanceRatio", F.lit(float(m[0]) if m and m[0] is not None else fallback))
    f = fit(x, features, "_y", weight="_w", iters=10, depth=2, prediction="_p")
    return f.score(df).withColumn("PerformanceRatio", clip("_p", lo, hi)).drop("_p")


def latest_rows_hold_out(df: DataFrame, share: float = 0.2, keys: Sequence[str] = ()) -> DataFrame:
    """``holdout`` flag of the latest part of each key's time span."""
    g = df.groupBy(*keys).agg(F.min(epoch_second("IntervalStartDT")).alias("_a"), F.max(epoch_second("IntervalStartDT")).alias("_b")) if keys else df.agg(F.min(epoch_second("IntervalStartDT")).alias("_a"), F.max(epoch_second("IntervalStartDT")).alias("_b"))
    j = df.join(g, list(keys)) if keys else df.withColumn("_g", g.select(F.struct("*")).scalar()).select("*", "_g.*").drop("_g")
    return j.withColumn("holdout", epoch_second("IntervalStartDT") > c("_b") - (c("_b") - c("_a")) * share).drop("_a", "_b")


