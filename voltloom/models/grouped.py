"""One model per group, all groups in one job: least squares from grouped normal equations, and recursion over the horizon.

The sums of products are an ordinary aggregate (combined before the shuffle, so a hot
group costs no more than its columns), and the small systems are solved a batch at a
time.  With origins the sums of a calibration window come from sums per step of the
grid along the ordered origins, so every origin's model costs one aggregate in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import chunk_window, chunked, epoch_hour, null_safe_join, own_rows
from ..core.scratch import materialise
from ..operators.replay import Origins

c = F.col


def _terms(features: Sequence[Column]) -> list[Column]:
    return [F.lit(1.0), *[f.cast("double") for f in features]]


def _sums(features: Sequence[Column], label: Column) -> dict[str, Column]:
    """Named products to be summed: the upper triangle of X'X, X'y and the count; a row with a null term counts nowhere."""
    x = _terms(features)
    whole = label.isNotNull()
    for f in x[1:]:
        whole = whole & f.isNotNull()
    out = {f"x{i}_{j}": F.when(whole, x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))}
    out.update({f"y{i}": F.when(whole, x[i] * label.cast("double")) for i in range(len(x))})
    return {**out, "n": F.when(whole, F.lit(1))}


def _solver(keys: Sequence[str], size: int, ridge: float, min_rows: int):
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    penalty = np.diag([0.0] + [ridge] * (size - 1))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b["n"] >= min_rows]
            a = np.zeros((len(b), size, size))
            for i, j in upper:
                a[:, i, j] = a[:, j, i] = b[f"x{i}_{j}"]
            rhs = b[[f"y{i}" for i in range(size)]].to_numpy(float)
            coef = []
            for m, y in zip(a + penalty, rhs):
                try:
                    coef.append(np.linalg.solve(m, y).tolist())
                except np.linalg.LinAlgError:  # terms that depend on each other: the shortest solution
                    coef.append(np.linalg.lstsq(m, y, rcond=None)[0].tolist())
            out = b[[*keys, "n"]].copy()
            out["coef"] = coef
            yield out

    return solve


def fit_groups(df: DataFrame, features: Sequence[Column], label: str, keys: Sequence[str], ridge: float = 0.0, min_rows: int = 1) -> DataFrame:
    """``keys, n, coef``: least squares of every group, intercept first and without penalty; groups below ``min_rows`` are absent."""
    sums = _sums(features, c(label))
    g = df.groupBy(*keys).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    return _solved(g, len(features) + 1, keys, ridge, min_rows)


def fit_groups_by_origin(df: DataFrame, features: Sequence[Column], label: str, keys: Sequence[str], o: Origins, ridge: float = 0.0, min_rows: int = 1) -> DataFrame:
    """``Origin, keys, n, coef``: the models of every origin, each from the calibration days before it."""
    sums = _sums(features, c(label))
    g = df.groupBy(*keys, o.first_after().alias("_k")).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    leaves = g.select(*keys, (c("_k") + o.steps).alias("_k"), *[(c(k) * 0).alias(k) for k in sums])
    points = g.unionByName(leaves).groupBy(*keys, "_k").agg(*[F.sum(k).alias(k) for k in sums])
    along = Window.partitionBy(*keys).orderBy("_k")  # at most one row a step of the grid
    seen = along.rangeBetween(-(o.steps - 1), 0)
    runs = points.select(*keys, "_k", F.lead("_k").over(along).alias("_next"), *[F.sum(k).over(seen).alias(k) for k in sums]).where("n > 0")
    lo, hi = F.greatest(c("_k"), F.lit(0)), F.least(F.coalesce(c("_next"), F.lit(o.count)) - 1, F.lit(o.count - 1))
    each = runs.withColumn("Origin", F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>")))).drop("_k", "_next")
    return _solved(each, len(features) + 1, ["Origin", *keys], ridge, min_rows)


def _solved(g: DataFrame, size: int, keys: Sequence[str], ridge: float, min_rows: int) -> DataFrame:
    kinds = ", ".join(f"{k} {g.schema[k].dataType.simpleString()}" for k in keys)
    return g.mapInPandas(_solver(keys, size, ridge, min_rows), f"{kinds}, n bigint, coef array<double>")


def dot(features: Sequence[Column], coef: str = "coef") -> Column:
    """Value of a fitted group model on a row; null with a null term."""
    out = c(coef)[0]
    for i, f in enumerate(features, 1):
        out = out + c(coef)[i] * f.cast("double")
    return out


def predict_groups(df: DataFrame, models: DataFrame, features: Sequence[Column], keys: Sequence[str], out: str = "prediction") -> DataFrame:
    """Every row scored by its group's model; null where the group has none."""
    return null_safe_join(df, models.select(*keys, "coef"), keys).withColumn(out, dot(features)).drop("coef")


def ring_rows(df: DataFrame, memory: int, keys: Sequence[str] = ("series",), value: str = "MWH", chunk_hours: int = 2160) -> DataFrame:
    """Rows whose ``memory`` hours before all have a value, with these as the array ``_ring``, oldest first.

    One row per (keys, hour).  The frame runs per time chunk with a halo, so a long series spreads over many tasks.
    """
    w = chunked(df, epoch_hour("DT"), chunk_hours, back=memory)
    past = F.collect_list(F.struct("_ct", value)).over(chunk_window(keys).rangeBetween(-memory, -1))  # at most ``memory`` entries
    w = own_rows(w.withColumn("_p", past), chunk_hours).where(F.size("_p") == memory)
    return w.withColumn("_ring", F.transform("_p", lambda r: r[value])).drop("_p")


def decayed_mean(ring: Column | str, memory: int, half: float) -> Column:
    """Mean of a ring whose weights halve every ``half`` hours back."""
    w = [0.5 ** (age / half) for age in range(memory)]
    weights = F.array(*[F.lit(x / sum(w)) for x in reversed(w)])
    return F.aggregate(F.zip_with(ring, weights, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def recursive_steps(history: DataFrame, score: Callable[[DataFrame], DataFrame], horizon: int, keys: Sequence[str] = ("series",), value: str = "MWH", lags: Sequence[int] = (1, 24, 168),
                    memory: int = 168, carry: DataFrame | None = None, decay: Mapping[str, float] | None = None, cut_every: int = 4) -> DataFrame:
    """Multi-step forecast with a fitted model that sees its own earlier forecasts as lags.

    The state is a row per key: the last ``memory`` hourly values (``_ring``; an hour
    without a value takes the mean of those there are).  Each of the ``horizon`` steps
    gives all keys the columns ``lag_<k>``, ``DT``, ``Hour``, ``Forecast_Lead_Hour`` and,
    per entry of ``decay`` (name to half-life in hours), the decayed mean of the ring;
    ``score`` adds ``prediction`` to that frame with one call for all keys.  ``carry``
    (``keys`` and further columns) is joined to the state once, such as the keys'
    coefficients; keys without an entry get no forecast.  The plan is cut into the shared folder every ``cut_every`` steps.
    """
    end = history.groupBy(*keys).agg(F.max(epoch_hour("DT")).alias("_end"))
    near = history.join(end, list(keys)).withColumn("_age", c("_end") - epoch_hour("DT")).where(c("_age") < memory)
    s = near.groupBy(*keys, "_end").agg(F.map_from_entries(F.collect_list(F.struct("_age", value))).alias("_m"), F.avg(value).alias("_avg"))  # at most ``memory`` values
    ring = F.transform(F.sequence(F.lit(memory - 1), F.lit(0)), lambda a: F.coalesce(F.try_element_at("_m", a.cast("long")), c("_avg")))
    state = s.select(*keys, "_end", ring.alias("_ring"), F.array().cast("array<double>").alias("_out"))
    if carry is not None:
        state = null_safe_join(state, carry, keys, "inner")
    state = materialise(state)
    kept = state.columns
    for h in range(1, horizon + 1):
        at = F.timestamp_seconds((c("_end") + h) * 3600)
        new = {f"lag_{k}": F.element_at("_ring", -k) for k in lags}
        for name, half in (decay or {}).items():
            new[name] = decayed_mean("_ring", memory, half)
        scored = score(state.withColumns({**new, "DT": at, "Hour": F.hour(at), "Forecast_Lead_Hour": F.lit(h)}))
        step = F.array(c("prediction").cast("double"))
        state = scored.withColumns({"_ring": F.concat(F.slice("_ring", 2, memory - 1), step), "_out": F.concat("_out", step)}).select(*kept)
        if h % cut_every == 0 or h == horizon:
            state = materialise(state)
    out = state.select(*keys, "_end", F.posexplode("_out").alias("_i", "Raw_Forecast_MWH"))
    return out.select(*keys, F.timestamp_seconds((c("_end") + c("_i") + 1) * 3600).alias("DT"), (c("_i") + 1).alias("Forecast_Lead_Hour"), "Raw_Forecast_MWH")
