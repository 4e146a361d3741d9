"""Windows over time that stay parallel inside one hot series.

A window partitioned by series alone puts a whole series in one task.  Every
bounded look-back or look-ahead is instead computed per (series, time chunk):
a row is copied into the neighbouring chunks whose frames can see it, the
window runs inside the chunk, and only rows in their own chunk are kept.  The
copies are a fixed fraction (halo / chunk length), so a series of any length
spreads over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

CHUNK = "_chunk"
T_COL = "_ct"


def chunked(df: DataFrame, t: Column, size: int, back: int = 0, ahead: int = 0) -> DataFrame:
    """Add ``_chunk`` (with halo copies) and ``_ct`` (the numeric time).

    ``t`` is a whole-number time (hours or seconds), ``size`` the chunk length in
    the same unit; frames may look ``back`` behind and ``ahead`` in front.
    """
    out = df.withColumn(T_COL, t.cast("long"))
    tc = F.col(T_COL)
    if not back and not ahead:
        return out.withColumn(CHUNK, F.floor(tc / size).cast("long"))
    lo = F.floor((tc - ahead) / size).cast("long")
    hi = F.floor((tc + back) / size).cast("long")
    return out.withColumn(CHUNK, F.explode(F.sequence(lo, hi)))


def chunk_window(keys: Sequence[str], *more_order: Column | str) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(T_COL, *more_order)


def own_rows(df: DataFrame, size: int) -> DataFrame:
    """Drop the halo copies and the helper columns."""
    return df.where(F.col(CHUNK) == F.floor(F.col(T_COL) / size)).drop(CHUNK, T_COL)


def _tagged(left: DataFrame, right: DataFrame, keys: Sequence[str], payload: Sequence[str],
            left_chunk: Column, right_chunk: Column, left_t: Column, right_t: Column) -> tuple[DataFrame, list[str]]:
    carry = [c for c in left.columns if c not in keys]
    pay = F.struct(*[F.col(c) for c in payload], F.col("_rt"))
    r = right.withColumn("_rt", right_t.cast("long")).withColumn(CHUNK, right_chunk)
    r = r.select(*keys, CHUNK, F.col("_rt").alias(T_COL), F.lit(0).alias("_side"), pay.alias("_pay"))
    lf = left.withColumn(T_COL, left_t.cast("long")).withColumn(CHUNK, left_chunk)
    lf = lf.select(*keys, CHUNK, T_COL, F.lit(1).alias("_side"), F.struct(*carry).alias("_row"))
    return lf.unionByName(r, allowMissingColumns=True), carry


def asof_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: Column, right_t: Column,
                  payload: Sequence[str], tolerance: int, size: int) -> DataFrame:
    """Latest right row at or before each left row, at most ``tolerance`` old.

    One shuffle on (keys, chunk): right rows are copied forward into the chunks
    their tolerance reaches.  Adds ``payload`` and ``_rt`` (matched right time).
    Right times must be unique per key (see ``keep_last``).
    """
    hi = F.floor((F.col("_rt") + tolerance) / size).cast("long")
    lo = F.floor(F.col("_rt") / size).cast("long")
    both, carry = _tagged(left, right, keys, payload, F.floor(F.col(T_COL) / size).cast("long"),
                          F.explode(F.sequence(lo, hi)), left_t, right_t)
    w = chunk_window(keys, "_side").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.last("_pay", ignorenulls=True).over(w)
    out = both.withColumn("_hit", hit).where("_side = 1")
    ok = F.col(T_COL) - F.col("_hit._rt") <= tolerance
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in carry],
                      *[F.when(ok, F.col(f"_hit.{c}")).alias(c) for c in (*payload, "_rt")])


def asof_backward_unbounded(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: Column, right_t: Column,
                            payload: Sequence[str], size: int) -> DataFrame:
    """Latest right row at or before each left row, however old.

    Each chunk is seeded with the last right row of the chunks before it; that
    carry table has one row per (key, chunk), so only it is windowed by key.
    """
    chunk_of = F.floor(F.col(T_COL) / size).cast("long")
    both, carry = _tagged(left, right, keys, payload, chunk_of, F.floor(F.col("_rt") / size).cast("long"),
                          left_t, right_t)
    ends = both.groupBy(*keys, CHUNK).agg(
        F.max_by("_pay", F.when(F.col("_side") == 0, F.col(T_COL))).alias("_pay"))
    w_ends = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    seeds = ends.select(*keys, CHUNK, (F.col(CHUNK) * size - 1).alias(T_COL), F.lit(0).alias("_side"),
                        F.last("_pay", ignorenulls=True).over(w_ends).alias("_pay")).where("_pay is not null")
    seeded = both.unionByName(seeds, allowMissingColumns=True)
    w = chunk_window(keys, "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = seeded.withColumn("_hit", F.last("_pay", ignorenulls=True).over(w)).where("_side = 1")
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in carry],
                      *[F.col(f"_hit.{c}").alias(c) for c in (*payload, "_rt")])


def rows_before(df: DataFrame, keys: Sequence[str], t: Column, size: int, value: Column, n: int, *order: Column | str) -> DataFrame:
    """Add ``_before1`` .. ``_before<n>``: ``value`` of the rows before by time, however old; null where there is none.

    Inside a chunk they are plain lags; the first rows of a chunk take what is missing
    from the last ``n`` rows of the chunks before.  Only those ends are windowed by key,
    at most ``n`` rows a chunk.
    """
    ch = chunked(df, t, size).withColumn("_v", F.struct(value.alias("v")))
    inside = chunk_window(keys, *order)
    latest = Window.partitionBy(*keys, CHUNK).orderBy(F.desc(T_COL), *[F.desc(o) for o in order])
    ends = ch.withColumn("_e", F.row_number().over(latest)).where(F.col("_e") <= n)
    ends = ends.groupBy(*keys, CHUNK).agg(F.sort_array(F.collect_list(F.struct((-F.col("_e")).alias("at"), "_v"))).alias("_ends"))
    by = Window.partitionBy(*keys).orderBy(CHUNK)
    back = F.flatten(F.collect_list("_ends").over(by.rowsBetween(-n, -1)))
    ends = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(CHUNK).alias("_kc"), back.alias("_back"))
    same = F.col(CHUNK) == F.col("_kc")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    j = ch.join(ends, same).drop(*[f"_k{i}" for i in range(len(keys))], "_kc").withColumn("_rn", F.row_number().over(inside))
    for k in range(1, n + 1):
        carried = F.try_element_at("_back", -(F.lit(k + 1) - F.col("_rn")))["_v"]
        j = j.withColumn(f"_before{k}", F.when(F.col("_rn") > k, F.lag("_v", k).over(inside)).otherwise(carried)["v"])
    return j.drop(CHUNK, T_COL, "_v", "_back", "_rn")
