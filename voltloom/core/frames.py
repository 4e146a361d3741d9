"""Column and frame helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import materialise


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ensure_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add every missing column of ``spec`` as a typed null, so plans stay static."""
    missing = {n: F.lit(None).cast(t) for n, t in spec.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN means 'absent' in the sources; Spark must see it as null."""
    want = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        if floating and (want is None or f.name in want):
            out.append(F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def epoch_second(ts: Column | str) -> Column:
    return F.unix_seconds(_c(ts).cast("timestamp"))


def epoch_hour(ts: Column | str) -> Column:
    return F.floor(epoch_second(ts) / 3600).cast("long")


def safe_div(a: Column, b: Column) -> Column:
    """``a / b`` with null for a zero divisor."""
    return a / F.nullif(b, F.lit(0.0))


def any_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def cut_right(value: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """Bins ``(a, b]`` with the lowest edge included; outside gives null."""
    v = _c(value)
    out = F.when(v < edges[0], None)
    for hi, label in zip(edges[1:], labels, strict=True):
        out = out.when(v <= hi, F.lit(label))
    return out


def cut_left(value: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """Bins ``[a, b)``; outside gives null."""
    v = _c(value)
    out = F.when(v < edges[0], None)
    for hi, label in zip(edges[1:], labels, strict=True):
        out = out.when(v < hi, F.lit(label))
    return out


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = pick(F.struct(*rest), F.struct(*[_c(o) for o in order]))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    An aggregate, not a window: copies of a hot key are combined before the
    shuffle, so one task never holds all copies.
    """
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` tuple."""
    return _keep(df, keys, order, F.min_by)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join in which null keys match null keys; the right keys are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    if not keys:
        raise ValueError("at least one key is needed")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def join_small(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``null_safe_join`` with a right side of one row per key or combination of bins.

    It is written first, so the join is planned from its measured size: a small one goes
    to the left rows, which are not shuffled by a few hot keys; a large one is a shuffle
    join as ever.
    """
    return null_safe_join(left, materialise(right), keys, how)


def weighted_mean(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Row-wise weighted mean that skips null values; null when no value is present."""
    num = reduce(lambda a, b: a + b, [F.coalesce(v * w, F.lit(0.0)) for v, w in pairs])
    den = reduce(lambda a, b: a + b, [F.when(v.isNotNull(), w).otherwise(F.lit(0.0)) for v, w in pairs])
    return safe_div(num, den)
