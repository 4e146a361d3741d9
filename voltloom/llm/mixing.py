"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target in words.  Whole epochs of a source come first; the rest of
its target is a weighted sample without replacement: every document has the
exponential key -ln(u) / weight, documents are taken in the order of their keys, and
the prefix sum of their sizes decides where to stop.

No source is ever sorted in one task.  Keys fall into buckets sized by the source's
row count, bucket sums place the stop in one bucket, and only that bucket is ordered,
equal keys folded to one row.  The stop is then a key per source and how many of the
rows that share it are taken, so the decision for a row needs that one small table and
its label.  ``mix`` moves numbers only; ``mixed_rows`` shuffles the texts whose label
decides (under half of any source), each once.  Rows that share the stop key are equal
in id and text; they are folded to one row with a count before some of them are taken.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.scratch import materialise
from voltloom.llm.base import n_words, query, table

WEIGHTS = (5.0, 2.0, 1.0)  # by position of the source in code-point order, repeating
SHARE = 1.5                # all targets together, as a share of all sizes
MOST = 2.0                 # no source beyond this multiple of its size
ROWS_PER_BUCKET = 1000     # mean rows of a key bucket
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5, None: 1.0}


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, n_rows, target`` from (source, source_size, n_rows).

    Sharing by weight with the excess over ``most`` times a size shared again ends at
    min(cap, level x weight) with one level for all.  Order the sources by cap / weight
    and let the first i be at their caps: the level left for the others rises with i
    until no other source is above its cap and falls from there, so the largest of
    these levels is the one.  The table has one row per source, a list a person writes
    weights for, so its order is taken in one task.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("_w", F.get(cyc, (F.row_number().over(by_name) - 1) % len(weights))).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "_total": F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)),
        "_full": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        "_left": F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    s = s.withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_left"))
    s = s.withColumn("_lv", F.max("_level").over(Window.partitionBy()))
    return s.select("source", "source_size", "n_rows", F.least("_cap", F.col("_lv") * F.col("_w")).alias("target"))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight with u from a digest of seed, id and text, so reruns agree."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / weight


def _drawn(docs: DataFrame, seed: str, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, source, size`` and ``_e``, the key that weight 1 gives, for every row."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), sampling_key(F.col("doc_id"), F.col("text"), F.lit(1.0), seed).alias("_e"), *keep)


def _weighted(drawn: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Add ``weight`` and ``key`` to drawn rows."""
    w = F.lit(QUALITY_WEIGHTS[None])
    if labels is not None:
        q = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_q"))
        drawn = drawn.join(q, F.col("doc_id") == F.col("_id"), "left")
        w = F.coalesce(*[F.when(F.col("_q") == k, F.lit(v)) for k, v in QUALITY_WEIGHTS.items() if k is not None], w)
    return drawn.withColumns({"key": F.col("_e") / w, "weight": w}).drop("_id", "_q")


def scored(docs: DataFrame, labels: DataFrame | None, seed: str) -> DataFrame:
    """``doc_id, source, size, key, weight`` for every row.

    The quality weight comes from the labels (folded to the best per document); a row
    without a label, or with another value than 0 and 1, has weight 1.
    """
    return _weighted(_drawn(docs, seed), labels).select("doc_id", "source", "size", "key", "weight")


def _bucket() -> Column:
    """Equal shares of an exponential distribution with the source's mean weight."""
    return F.floor((1 - F.exp(-F.col("key") * F.col("_mean"))) * F.col("_nb")).cast("int")


def stops(numbers: DataFrame) -> DataFrame:
    """``source, source_size, target, epochs, samples, stop_key, stop_size, stop_rows``.

    Rows with a smaller (key, size) than the stop are taken once more, and ``stop_rows``
    of those that share it.  The document that reaches over the rest of the target is
    taken when its middle still lies within; a source whose target is whole epochs has
    no stop key.
    """
    sizes = numbers.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"), F.avg("weight").alias("_mean"))
    sizes = materialise(sizes)
    t = targets(sizes.drop("_mean")).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    t = t.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("_nb", F.greatest(F.lit(16), F.ceil(F.col("n_rows") / ROWS_PER_BUCKET)))
    m = sizes.select(F.col("source").alias("_s"), "_mean")
    plan = materialise(t.join(m, t["source"].eqNullSafe(m["_s"])).drop("_s"))
    p = plan.select(F.col("source").alias("_s"), "_rest", "_nb", "_mean")
    placed = numbers.join(p, numbers["source"].eqNullSafe(p["_s"])).where("_rest > 0 AND size > 0").select("source", "key", "size", "_rest", _bucket().alias("_b"))
    sums = placed.groupBy("source", "_b", "_rest").agg(F.sum("size").alias("_n"))
    run = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    last = materialise(sums.where("_before <= _rest AND _before + _n > _rest").select(F.col("source").alias("_s"), F.col("_b").alias("_lb"), "_before"))
    edge = placed.join(last, placed["source"].eqNullSafe(last["_s"]) & (F.col("_b") == F.col("_lb")))
    edge = edge.groupBy("source", "key", "size", "_rest", "_before").agg(F.count(F.lit(1)).alias("_c"))
    inside = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    first_mid = F.col("_before") + F.coalesce(F.sum(F.col("size") * F.col("_c")).over(inside), F.lit(0)) + F.col("size") / 2
    fits = F.greatest(F.lit(0), F.floor((F.col("_rest") - first_mid) / F.col("size")) + 1).cast("long")
    out = edge.withColumn("_k", fits).where("_k < _c").groupBy("source").agg(F.min(F.struct("key", "size", "_k")).alias("stop"))
    last_b = last.select(F.col("_s").alias("_q"), "_lb")
    beyond = placed.join(last_b, placed["source"].eqNullSafe(last_b["_q"]) & (F.col("_b") > F.col("_lb"))).groupBy("source").agg(F.min(F.struct("key", "size", F.lit(0).cast("long").alias("_k"))).alias("stop"))
    # no row of the bucket lies beyond the stop: the first of the buckets after it does
    stop = out.unionByName(beyond).groupBy("source").agg(F.min("stop").alias("stop")).select(F.col("source").alias("_s"), "stop")
    done = plan.join(stop, plan["source"].eqNullSafe(stop["_s"]), "left")
    return materialise(done.select("source", "source_size", "target", "epochs", (F.col("_rest") > 0).alias("samples"), F.col("stop.key").alias("stop_key"), F.col("stop.size").alias("stop_size"), F.col("stop._k").alias("stop_rows")))


def _at_stop() -> Column:
    return F.coalesce(F.col("samples") & (F.col("size") > 0) & (F.col("key") == F.col("stop_key")) & (F.col("size") == F.col("stop_size")), F.lit(False))


def times() -> Column:
    """How often a row joined with its source's stop is taken; one that shares the stop key perhaps once more."""
    sampled = F.col("samples") & (F.col("size") > 0) & (F.col("stop_key").isNull() | (F.struct("key", "size") < F.struct(F.col("stop_key").alias("key"), F.col("stop_size").alias("size"))))
    return F.col("epochs") + F.when(sampled, 1).otherwise(0)


def _shared(ties: DataFrame, row: Sequence[str]) -> DataFrame:
    """``row`` and the stop's columns of the rows that share a stop key, equal ones folded: ``_n`` of them, ``_more`` of which are taken once more.

    The folded rows of a source are numbered in buckets of their hash, so no task holds them all.
    """
    stop = ["source", "epochs", "stop_rows"]
    f = ties.groupBy(*stop, *row).agg(F.count(F.lit(1)).alias("_n"))
    f = f.withColumn("_h", F.xxhash64(*row)).withColumn("_b", F.pmod("_h", F.lit(4096)))
    of = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    sums = f.groupBy("source", "_b").agg(F.sum("_n").alias("_bn")).select(F.col("source").alias("_s"), F.col("_b").alias("_sb"), F.coalesce(F.sum("_bn").over(of), F.lit(0)).alias("_before"))
    f = f.join(sums, f["source"].eqNullSafe(sums["_s"]) & (F.col("_b") == F.col("_sb")))
    inside = Window.partitionBy("source", "_b").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("stop_rows") - F.col("_before") - F.coalesce(F.sum("_n").over(inside), F.lit(0))
    return f.withColumn("_more", F.greatest(F.lit(0), F.least("_n", left))).drop("_h", "_b", "_s", "_sb", "_before")


def _copies(rows: DataFrame, n: Column) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``_i``; a count of any size is dealt out in two steps."""
    step = 10_000
    parts = rows.withColumn("_total", n.cast("long")).where("_total > 0").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_total") - 1) / step))))
    size = F.least(F.lit(step).cast("long"), F.col("_total") - F.col("_part") * step)
    first = F.col("_part") * step
    return parts.withColumn("_i", F.explode(F.sequence(first, first + size - 1))).drop("_total", "_part")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.withColumnRenamed("source", "_s")
    return rows.join(p, rows["source"].eqNullSafe(p["_s"])).drop("_s")


def mix(docs: DataFrame, labels: DataFrame | None = None, seed: str = "mix-1") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row.

    A null source is a source of its own, last in order; null and empty texts have size
    0 and are never taken.  Rows equal in id and text share one key; where the stop falls
    on them, as many are taken once more as the target has room for.
    """
    numbers = materialise(scored(docs, labels, seed))
    all_rows = _with_plan(numbers, stops(numbers))
    cols = ["doc_id", "size", "source_size", "target"]
    single = all_rows.where(~_at_stop()).select(*cols, (times() * F.col("size")).alias("taken"))
    tied = _shared(all_rows.where(_at_stop()), cols)
    tied = _copies(tied, F.col("_n")).select(*cols, ((F.col("epochs") + F.when(F.col("_i") < F.col("_more"), 1).otherwise(0)) * F.col("size")).alias("taken"))
    return single.unionByName(tied)


def mixed_rows(docs: DataFrame, labels: DataFrame | None = None, seed: str = "mix-1") -> DataFrame:
    """The mix itself: every row as often as ``mix`` takes it, with the columns of ``docs``.

    Of rows with equal id and text but other columns that differ, those with the smaller
    hash are taken where only some are.  A row whose key lies on one side of the stop
    under every weight is decided where it is read; only the others meet the labels.
    """
    plan = stops(materialise(scored(docs, labels, seed)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    drawn = _with_plan(_drawn(docs.select("doc_id", "source", "text", row.alias("_row")), seed, keep=("_row",)), plan)
    weights = [QUALITY_WEIGHTS[None]] if labels is None else list(QUALITY_WEIGHTS.values())
    stop = F.struct(F.col("stop_key").alias("key"), F.col("stop_size").alias("size"))
    under = lambda w: F.struct((F.col("_e") / F.lit(w)).alias("key"), "size")
    between = F.coalesce(F.col("samples") & (F.col("size") > 0) & F.col("stop_key").isNotNull() & (under(max(weights)) <= stop) & (under(min(weights)) >= stop), F.lit(False))
    decided = _copies(drawn.where(~between).withColumn("key", F.col("_e") / F.lit(weights[0])), times()).select("_row.*")
    open_ = drawn.where(between)
    single = _copies(_weighted(open_, labels).where(~_at_stop()), times()).select("_row.*")
    near = functools.reduce(Column.__or__, [under(w) == stop for w in weights])  # else the tied rows are looked for among all open texts
    tied = _shared(_weighted(open_.where(near), labels).where(_at_stop()), ["_row"])
    return decided.unionByName(single).unionByName(_copies(tied, F.col("epochs") * F.col("_n") + F.col("_more")).select("_row.*"))


SQL = """
WITH q AS (SELECT doc_id, max(quality) q FROM labels GROUP BY doc_id),
d AS (SELECT d.doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) size,
  -ln((('0x' || substr(md5('mix-1|' || coalesce(d.doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
    / CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END k FROM documents d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT source_size, 2.0 * sum(size) cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END w FROM d GROUP BY source),
l AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) lv FROM s),
t AS (SELECT source, source_size, least(cap, (SELECT max(lv) FROM l) * w)::DOUBLE target FROM l),
p AS (SELECT d.*, source_size, target, floor(target / source_size)::BIGINT ep, target - floor(target / source_size) * source_size rest,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) pre
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (ep + CASE WHEN rest > 0 AND pre + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT taken FROM p
"""


@query("op5_source_mix", SQL)
def op5_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, table(spark, sf_dir, "labels"))
