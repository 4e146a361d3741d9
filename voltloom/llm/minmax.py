"""Near-duplicate documents by min-max hashing.

Each permutation of the word shingles gives two signature values, its minimum and its
maximum, so a signature costs half the hash evaluations of plain min-hashing.  Minima
and maxima go to separate bands (within a band all values come from different
permutations).  Texts with equal shingle sets are one class before anything else, so
exact copies never meet each other.  Classes that share a band are compared on their
full sets:

1. every class of a bucket against the bucket's leader, the class that shares most
   buckets, then those outside the leader's component against a second leader;
2. then the pairs of a bucket that still lie in two components, found by what they
   share outside the leader's set (``_open_pairs``).

So a bucket of near copies costs its size and not its square, yet no link that could
join two components goes untested.  With ``BANDS`` bands of ``ROWS`` values a pair of
similarity 0.75 shares no band with probability (1 - 0.75**5)**50, about 1e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.scratch import materialise, passing
from voltloom.llm.base import packed, query, table
from voltloom.llm.graph import components

WIDTH = 5
PERCENT = 75
ROWS = 5
BANDS = 50           # half from minima, half from maxima
CACHE_WORDS = 300_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    """Word to 64-bit hash, kept for at most ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, cache: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, no words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(width, len(w))
    s = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        s = _mixed(s * _STEP + w[j:len(w) - k + 1 + j])
    return np.unique(s)


def _families() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = ROWS * BANDS // 2
    return rng.integers(0, 2**32, n, dtype=np.uint32), rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def min_max(s: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the shingles under every permutation of 32-bit numbers."""
    x32 = (s >> np.uint64(32)).astype(np.uint32)
    lo, hi = np.full(len(masks), 2**32 - 1, np.uint32), np.zeros(len(masks), np.uint32)
    for i in range(0, len(x32), 1024):
        x = (x32[None, i:i + 1024] ^ masks[:, None]) * factors[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(lo, x.min(axis=1), out=lo)
        np.maximum(hi, x.max(axis=1), out=hi)
    return lo, hi


def band_keys(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    values = np.concatenate([lo, hi]).reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = _mixed(key * _STEP + values[:, r])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache, (masks, factors) = _WordHashes(), _families()
    for b in batches:
        size, print_, keys, at = [], [], [], [0]
        for t in b.column("text"):
            s = shingle_set(t.as_py(), cache)
            size.append(len(s))
            if len(s):
                keys.append(band_keys(*min_max(s, masks, factors)))
            print_.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            at.append(at[-1] + (BANDS if len(s) else 0))
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        yield pa.record_batch({"doc_id": b.column("doc_id"), "text_hash": b.column("text_hash"), "n_shingles": pa.array(size, pa.int64()),
                               "set_print": pa.array(print_, pa.binary()), "bands": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _WordHashes()
    for b in batches:
        parts = [shingle_set(t.as_py(), cache).view(np.int64) for t in b.column("text")]
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        yield pa.record_batch({"node": b.column("node"), "items": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))})


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("_y")), "b")
    two = one.join(sets.select(F.col("node").alias("a"), F.col("items").alias("_x")), "a")
    same = F.size(F.array_intersect("_x", "_y"))
    return two.where(100 * same >= PERCENT * (F.size("_x") + F.size("_y") - same)).select("a", "b")


def _sized(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _pair(met: DataFrame) -> DataFrame:
    return met.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()


def _several_roots(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the groups whose members lie in more than one component."""
    mixed = rows.groupBy(*keys).agg(F.min("root").alias("_r1"), F.max("root").alias("_r2")).where("_r1 < _r2").select(*keys)
    return rows.join(mixed, keys, "left_semi")


def _partner(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(*more, F.col("node").alias("p"), F.col("n").alias("pn"), F.col("root").alias("pr"))


def _open_pairs(members: DataFrame, leaders: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of a bucket in two components that could still be similar, found without listing the others.

    With leader C of the bucket, a pair A, B either shares a shingle outside C, which a
    join on the rarest such shingles finds (as many as the size of the sets asks for),
    or A and B meet inside C only.  Then their common part
    is at most the smaller of |A in C| and |B in C|, which is enough only for texts that
    lie almost wholly inside a longer C; those few look for partners in their bucket.
    """
    mm = members.join(leaders, "key").where("node <> lead")
    mm = materialise(_several_roots(mm, ["key"]))
    met = mm.select("lead", "node", "n", "root").distinct()
    met = met.join(sets.select("node", "items"), "node").join(sets.select(F.col("node").alias("lead"), F.col("items").alias("_c")), "lead")
    met = materialise(met.select("lead", "node", "n", "root", F.size(F.array_intersect("items", "_c")).alias("inside"), F.array_except("items", "_c").alias("rest")))

    # of the shingles outside C a pair needs so many in common that one lies among the rarest |rest| - need + 1 of both
    least = met.groupBy("lead").agg(F.min("n").alias("_min"))
    smallest = F.greatest(F.ceil(F.col("n") * PERCENT / 100), F.col("_min"))
    need = F.greatest(F.lit(1), F.ceil((F.col("n") + smallest) * PERCENT / (100 + PERCENT)) - F.col("inside"))
    held_x = met.join(least, "lead").where(F.size("rest") >= need).select("lead", "node", "n", "root", (F.size("rest") - need + 1).alias("first"), F.explode("rest").alias("x"))
    held_x = held_x.join(held_x.groupBy("lead", "x").agg(F.count(F.lit(1)).alias("_f")), ["lead", "x"])
    rank = F.row_number().over(Window.partitionBy("lead", "node").orderBy("_f", "x"))  # one text's shingles
    rare = held_x.withColumn("_k", rank).where(F.col("_k") <= F.col("first")).select("lead", "x", "node", "n", "root")
    apart = materialise(_several_roots(rare, ["lead", "x"]))
    outside = apart.join(_partner(apart, "lead", "x"), ["lead", "x"]).where((F.col("root") < F.col("pr")) & _sized("n", "pn"))

    held = mm.join(met.select("lead", "node", "inside"), ["lead", "node"])
    within = held.where((100 + PERCENT) * F.col("inside") >= 2 * PERCENT * F.col("n"))
    other = held.select("key", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("root").alias("pr"), F.col("inside").alias("pin"))
    enough = (100 + PERCENT) * F.least("inside", "pin") >= PERCENT * (F.col("n") + F.col("pn"))
    inner = within.join(other, "key").where((F.col("root") != F.col("pr")) & (F.col("n") <= F.col("pn")) & enough & _sized("n", "pn"))
    return _pair(outside.select("node", "p")).unionByName(_pair(inner.select("node", "p"))).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, group_id, component_id, kept``, one row per row of ``docs``.

    ``group_id`` numbers the groups within this result (null without words).

    ``component_id`` is the smallest doc_id of all rows linked by chains of similar
    texts; ``kept`` marks rows with that id.  Null, empty and blank texts have an empty
    set, are linked with nothing and are kept.  Null doc_ids are ignored in the minimum;
    a component without any other id has a null component_id and its rows are kept.
    Repeated rows are one class and share the verdict.

    The result is written; bands, buckets, sets and pairs are removed with that.
    """
    with passing(docs.sparkSession) as keep:
        return keep(_verdicts(docs))


def _verdicts(docs: DataFrame) -> DataFrame:
    rows = materialise(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sign, "doc_id bigint, text_hash bigint, n_shingles bigint, set_print binary, bands array<bigint>"))
    classes = rows.where("set_print IS NOT NULL").groupBy("set_print").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()))

    spread = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = materialise(spread.join(shared, "key"))

    want = members.select("node").distinct().join(classes.select("node", "row"), "node").select("node", F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_h"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.join(want, texts["doc_id"].eqNullSafe(want["_id"]) & (texts["text_hash"] == want["_h"]))
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))  # the chosen row may be repeated
    sets = materialise(texts.mapInArrow(_sets, "node bigint, items array<bigint>"))

    # the text that shares most buckets is the likeliest centre of its group
    degree = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("_m")), "key").groupBy("node").agg(F.sum("_m").alias("deg"))
    members = materialise(members.join(degree, "node"))
    central = F.struct("deg", (-F.col("node")).alias("_o"))

    no_pairs = members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    tested, edges, roots, leaders = no_pairs, no_pairs, None, None
    for k in range(3):
        m = members.withColumn("root", F.col("node")) if roots is None else (
            members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        if k == 0:
            leaders = materialise(m.groupBy("key").agg(F.max_by("node", central).alias("lead")))
            lead = members.select("key", "node", "n").join(leaders, "key").where("node = lead").select("key", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("node").alias("pr"))
            pairs = _pair(m.join(lead, "key").where((F.col("root") != F.col("pr")) & _sized("n", "pn")))
        elif k == 1:  # the likeliest centre among the texts outside the leader's component
            of_lead = leaders.join(m.select("key", F.col("node").alias("lead"), F.col("root").alias("_lr")), ["key", "lead"])
            m = materialise(m.join(of_lead.select("key", "_lr"), "key").where(F.col("root") != F.col("_lr")))
            lead = m.groupBy("key").agg(F.max_by(F.struct("node", "n", "root"), central).alias("l")).select("key", F.col("l.node").alias("p"), F.col("l.n").alias("pn"), F.col("l.root").alias("pr"))
            pairs = _pair(m.join(lead, "key").where((F.col("root") != F.col("pr")) & _sized("n", "pn")))
        else:
            pairs = _open_pairs(m.select("key", "node", "n", "root"), leaders, sets)
        pairs = materialise(pairs.join(tested, ["a", "b"], "left_anti"))
        tested = tested.unionByName(pairs)
        new = materialise(_linked(pairs, sets).distinct())
        if new.isEmpty():
            continue
        edges = edges.unionByName(new)
        roots = materialise(components(edges))

    label = classes.select("set_print", "node", "first_id")
    label = label.withColumn("root", F.col("node")) if roots is None else label.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = label.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = materialise(label.join(smallest, "root").select(F.col("set_print").alias("_p"), F.col("root").alias("group_id"), "component_id"))
    out = rows.join(label, F.col("set_print") == F.col("_p"), "left")
    comp = F.when(F.col("set_print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", "group_id", comp.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row kept per group of near duplicates (all rows without words stay)."""
    v = near_duplicates(docs)
    live = v.where(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("group_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("r"), F.count(F.lit(1)).alias("copies"))
    live = materialise(live.select(F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_h"), "copies"))
    blank = F.coalesce(F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")), F.lit(0)) == 0
    t = packed(docs, "doc_id", "text").select("doc", "doc_id", F.xxhash64("text").alias("text_hash"), blank.alias("blank"))
    mine = t.where("NOT blank").join(live, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")))
    once = mine.where("copies = 1").select("doc.*")
    again = mine.where("copies > 1").dropDuplicates(["_id", "_h"]).select("doc.*")
    return once.unionByName(again).unionByName(t.where("blank").select("doc.*"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] END g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
e AS MATERIALIZED (SELECT x.a, x.b FROM (SELECT l.doc_id a, r.doc_id b, count(*) c FROM s l JOIN s r USING (g) WHERE l.doc_id <> r.doc_id GROUP BY ALL) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT doc_id, coalesce(n, 0) n_shingles, c component_id, doc_id = c kept FROM (SELECT doc_id, min(c) c FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op7_minmax_near_duplicates", SQL)
def op7_minmax_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash", "group_id")
