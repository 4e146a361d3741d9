"""Exact group quantiles that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one buffer, which a hot
group makes unbounded.  Here counts per value bucket, combined before the shuffle,
locate the wanted ranks, and only the values of buckets that hold one are folded,
written and ordered.  The source is read twice for that, but the other values are never
shuffled.  Where such a bucket has more than ``MOST`` distinct values, a second level of sub-buckets, 2e-7 of the value wide, is counted first and
only the sub-buckets with a wanted rank are ordered; equal values are one row in it.
The result does not depend on which way is taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import materialise

_PER_UNIT = 128.0   # buckets per unit of log1p: neighbours differ by 0.8 %
_PARTS = 32768.0    # sub-buckets of a bucket
MOST = 200_000      # distinct values of a bucket that one task orders


def _bucket(v: Column) -> tuple[Column, Column]:
    """Monotone whole-number (bucket, sub-bucket) of a value, finer near zero; needs no bounds of the data."""
    at = F.signum(v) * F.log1p(F.abs(v)) * F.lit(_PER_UNIT)
    return F.floor(at).cast("long"), F.floor((at - F.floor(at)) * F.lit(_PARTS)).cast("int")


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                    count_as: str | None = None, distinct_as: str | None = None, mean_as: str | None = None) -> DataFrame:
    """``keys`` + one column per entry of ``probs``: linear interpolation between ranks, nulls and NaN ignored.

    Null keys form groups of their own; groups without a value are absent.
    ``count_as``, ``distinct_as`` and ``mean_as`` add the number of values, of
    distinct values, and their mean.
    With ``distinct_as`` the source is read once, into a stored table of all folded values.
    """
    v = F.col(value).cast("double")
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_one"))
    bucket, part = _bucket(F.col("_v"))
    base = df.select(key.alias("_g"), v.alias("_v")).where("_v is not null and not isnan(_v)").withColumn("_b", bucket)

    def fold(rows: DataFrame) -> DataFrame:
        return materialise(rows.groupBy("_g", "_b", "_v").agg(F.count("*").alias("_n")))

    group = Window.partitionBy("_g")
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    if distinct_as:
        folded = fold(base)
        hist = folded.groupBy("_g", "_b").agg(F.sum("_n").alias("_bn"), F.count("*").alias("_bd"), F.sum(F.col("_v") * F.col("_n")).alias("_bs"))
    else:
        hist = base.groupBy("_g", "_b").agg(F.count("*").alias("_bn"), F.sum("_v").alias("_bs")).withColumn("_bd", F.lit(None).cast("long"))
    hist = hist.withColumns({"_end": F.sum("_bn").over(upto), "_total": F.sum("_bn").over(group), "_distinct": F.sum("_bd").over(group),
                             "_mean": F.sum("_bs").over(group) / F.sum("_bn").over(group)})

    def ranks(p: float) -> tuple[Column, Column]:
        pos = (F.col("_total") - 1) * F.lit(float(p))
        return F.floor(pos).cast("long"), F.ceil(pos).cast("long")

    def inside(rank: Column, start: Column, end: Column) -> Column:
        return (rank >= start) & (rank < end)

    all_ranks = [r for p in probs.values() for r in ranks(p)]

    def wanted(start: Column, end: Column) -> Column:
        return reduce(or_, [inside(r, start, end) for r in all_ranks])

    carried = ["_total", "_distinct", "_mean"]
    before = F.col("_end") - F.col("_bn")
    target = materialise(hist.where(wanted(before, F.col("_end"))).select("_g", "_b", *carried, before.alias("_before")))
    near = target.select("_g", "_b")
    if not distinct_as:
        folded = fold(base.join(near, ["_g", "_b"], "left_semi"))
    at, held = ["_g", "_b"], folded
    most = held.join(near, at, "left_semi").groupBy(*at).agg(F.count("*").alias("_bd")).agg(F.max("_bd")).first()[0]
    if (most or 0) > MOST:
        at, held = ["_g", "_b", "_s"], folded.withColumn("_s", part)
        sub = Window.partitionBy("_g", "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)  # at most _PARTS + 1 rows
        parts = held.join(target, ["_g", "_b"]).groupBy(*at).agg(F.sum("_n").alias("_sn"), *[F.first(x).alias(x) for x in (*carried, "_before")])
        parts = parts.withColumn("_end", F.sum("_sn").over(sub) + F.col("_before"))
        before = F.col("_end") - F.col("_sn")
        target = parts.where(wanted(before, F.col("_end"))).select(*at, *carried, before.alias("_before"))

    order = Window.partitionBy(*at).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    run = held.join(target, at).withColumn("_to", F.sum("_n").over(order) + F.col("_before"))
    start, end = F.col("_to") - F.col("_n"), F.col("_to")
    found = run.where(wanted(start, end))
    aggs = []
    for name, p in probs.items():
        lo_r, hi_r = ranks(p)
        lo, hi = (F.max(F.when(inside(r, start, end), F.col("_v"))) for r in (lo_r, hi_r))
        frac = F.max((F.col("_total") - 1) * F.lit(float(p)) - lo_r)
        aggs.append((lo + (hi - lo) * frac).alias(name))
    extra = [F.max(c).alias(n) for c, n in (("_total", count_as), ("_distinct", distinct_as), ("_mean", mean_as)) if n]
    out = found.groupBy("_g").agg(*aggs, *extra)
    return out.select(*[F.col("_g")[k].alias(k) for k in keys], *probs, *[n for n in (count_as, distinct_as, mean_as) if n])
