"""Chain runner, holdout backtest, config scoring, ablation, split stability."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core.scratch import materialise
from .metrics import ACTUAL, by_stage, grouped_metrics, stage_metrics

c = F.col
Stage = Callable[[DataFrame], DataFrame]


def run_chain(df: DataFrame, stages: Sequence[Stage], cut_every: int = 0) -> DataFrame:
    """Stages in fixed order; with ``cut_every`` the frame is written out after that many stages, so plans stay small."""
    out = df
    for i, st in enumerate(stages, 1):
        out = out.transform(st)
        if cut_every and i % cut_every == 0 and i < len(stages):
            out = materialise(out)
    return out


def holdout_backtest(load: DataFrame, days: int, keys: Sequence[str] = ("series",), value: str = "MWH") -> DataFrame:
    """Hour profile of the rows before each key's last ``days``, scored on those days."""
    end = load.groupBy(*keys).agg(F.max("DT").alias("_end"))
    j = load.join(end, list(keys)).withColumns({"Hour": F.hour("DT"), "_late": c("DT") >= c("_end") - F.make_dt_interval(days=F.lit(days))})
    prof = j.where(~c("_late")).groupBy(*keys, "Hour").agg(F.avg(value).alias("Raw_Forecast_MWH"))
    return j.where(c("_late")).join(prof, [*keys, "Hour"]).drop("_end", "_late")


def prior_block_means(df: DataFrame, block: str, keys: Sequence[str], value: str) -> DataFrame:
    """Per block and key the mean over all earlier blocks: block sums, then a running sum over the few blocks."""
    g = df.groupBy(block, *keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return g.select(block, *keys, (F.sum("_s").over(w) / F.sum("_n").over(w)).alias("prior_mean")).where("prior_mean is not null")


def score_configs(cached: DataFrame, shares: Mapping[str, float], base: str, corrected: str, keys: Sequence[str], actual: str = ACTUAL) -> DataFrame:
    """Cached rows scored under every config at once: a literal array of configs is inlined."""
    parts = F.array(*[F.struct(F.lit(n).alias("config"), F.abs(c(actual) - (c(base) + float(k) * (c(corrected) - c(base)))).alias("_e")) for n, k in shares.items()])
    return cached.select(*keys, F.inline(parts)).groupBy("config", *keys).agg(F.avg("_e").alias("mae"))


def ablation(df: DataFrame, full: str, variants: Mapping[str, str], origin: str, margin: float = 0.05) -> DataFrame:
    """Change of MAE per origin when a stage is off: mean, and origins better and worse by a margin."""
    long = by_stage(df, {**variants, "_full": full}, [origin, ACTUAL])
    m = grouped_metrics(long, [origin, "Stage"], p90=False).select(origin, "Stage", "MAE_MWH")
    b = m.where("Stage = '_full'").select(origin, c("MAE_MWH").alias("_b"))
    d = m.where("Stage <> '_full'").join(b, origin).withColumn("_d", c("MAE_MWH") - c("_b"))
    return d.groupBy(c("Stage").alias("variant")).agg(F.count("*").alias("origins"), F.avg("_d").alias("delta"), F.count(F.when(c("_d") < -margin, 1)).alias("better"), F.count(F.when(c("_d") > margin, 1)).alias("worse"))


def diagnostics_bundle(prepared: DataFrame, stages: Mapping[str, str], groupings: Mapping[str, Sequence[str]], final: str) -> dict[str, DataFrame]:
    """Named tables over one prepared (and materialised) frame; a table not used is never computed."""
    out = {n: grouped_metrics(prepared, keys, final, p90=False) for n, keys in groupings.items()}
    return {**out, "stages": stage_metrics(prepared, stages, p90=False)}


def split_stability(df: DataFrame, origin: str, forecast: str, seeds: Sequence[int], holdout: float, actual: str = ACTUAL) -> DataFrame:
    """Holdout MAE of seeded origin splits and its spread over the seeds."""
    m = df.groupBy(origin).agg(F.sum(F.abs(c(actual) - c(forecast))).alias("_e"), F.count("*").alias("_n"))
    ins = F.array_compact(F.array(*[F.when(F.pmod(F.xxhash64(c(origin), F.lit(sd)), F.lit(1000)) < int(holdout * 1000), F.lit(sd)) for sd in seeds]))
    per = m.select("_e", "_n", F.explode(ins).alias("seed")).groupBy("seed").agg((F.sum("_e") / F.sum("_n")).alias("mae"), F.count("*").alias("origins"))
    spread = per.agg(F.stddev_samp("mae")).scalar()
    return per.withColumn("mae_spread", spread)


def promotion_guard(df: DataFrame, candidate: str, reference: str, risk: Column, actual: str = ACTUAL) -> DataFrame:
    """Candidate against reference overall and on risk rows; promoted only if neither is worse."""
    e0, e1 = F.abs(c(actual) - c(reference)), F.abs(c(actual) - c(candidate))
    r = F.coalesce(risk, F.lit(False))
    g = df.agg(F.count("*").alias("n"), F.avg(e0).alias("reference_mae"), F.avg(e1).alias("candidate_mae"), F.avg(F.when(r, e0)).alias("risk_reference_mae"), F.avg(F.when(r, e1)).alias("risk_candidate_mae"))
    return g.withColumn("promote", ((c("candidate_mae") < c("reference_mae")) & (F.coalesce("risk_candidate_mae", F.lit(0.0)) <= F.coalesce("risk_reference_mae", F.lit(0.0)))).cast("int"))


def per_key_search(df: DataFrame, shares: Sequence[float], value: str = "MWH") -> DataFrame:
    """Last-resort user routine per series: the mix of hour mean and day mean with the least error.

    Runs on (series, hour) summaries, so a group never holds more than 24 rows.
    """
    total = Window.partitionBy("series")
    g = df.groupBy("series", "Hour").agg(F.avg(value).alias("hm"), F.sum(value).alias("s"), F.sum(c(value) * c(value)).alias("q"), F.count("*").alias("n"))
    g = g.withColumn("dm", F.sum("s").over(total) / F.sum("n").over(total))
    grid = np.asarray(list(shares), dtype=float)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        f = grid[:, None] * pdf["hm"].to_numpy() + (1 - grid[:, None]) * pdf["dm"].to_numpy()
        sse = (pdf["q"].to_numpy() - 2 * f * pdf["s"].to_numpy() + f * f * pdf["n"].to_numpy()).sum(axis=1)
        i = int(sse.argmin())
        return pd.DataFrame({"series": [pdf["series"].iloc[0]], "share": [grid[i]], "rmse": [float(np.sqrt(max(sse[i], 0.0) / pdf["n"].sum()))]})

    return g.groupBy("series").applyInPandas(search, "series string, share double, rmse double")


