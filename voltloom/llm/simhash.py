"""Near-duplicate documents by SimHash and the generalised pigeonhole principle.

A text's 64-bit fingerprint is the majority vote of the XXH64 values of its word
shingles.  Fingerprints within ``distance`` bits are linked.  The search follows the
generalised pigeonhole principle: the bits lie in ``PARTS`` groups, and if the groups'
thresholds (-1: not probed) sum up to distance - PARTS + 1, then two fingerprints that
close agree within the threshold of at least one group.

1. Bits that rise and fall together go into one group, so that what repeats is held by
   few groups and the others stay selective.  The co-occurrence of bits is counted
   over all distinct fingerprints.
2. Each fingerprint gets its own thresholds.  Histograms of the groups' halves estimate
   how many fingerprints a group would give at each threshold; dynamic programming over
   the groups picks the cheapest thresholds, probes included.
3. Each probe (a group's bits within its threshold) meets the fingerprints with those
   bits; pairs are verified on all bits.
4. A fingerprint whose cheapest thresholds still cost more than ``MOST`` fingerprints
   is linked through its midpoints: two fingerprints at distance 2 share one that is
   at most one bit away from either, and all that share one are linked.  Light ones
   probe all, heavy ones meet at midpoints, so no link is lost and the work of any
   fingerprint is bounded, however many others lie near it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table
from voltloom.llm.graph import components

BITS = 64
WIDTH = 3            # words in a shingle
SEED = 42
DISTANCE = 2
PARTS = 3
MOST = 128           # candidates of a fingerprint beyond which its midpoints are cheaper
HOT_SHARE = 1000     # a fingerprint with over 1/HOT_SHARE of the rows is joined apart; there are fewer than HOT_SHARE of these

_ONES = np.uint64(0x0101010101010101)
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_hashes(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """XXH64 of every word shingle in order, repeats included; a shorter text is one shingle, no words none."""
    words = text.lower().split() if text else []
    if len(words) <= width:
        return np.array([_hash(b" ".join(words))] if words else [], np.uint64)
    grams = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    return np.fromiter(map(_hash, grams), np.uint64, len(words) - width + 1)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Per array the number whose bits are set in over half of its values; zero for an empty one.

    Values are added eight bit counters at a time, in runs of 255 so that none overflows.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.concatenate([hashes[i] for i in full])
    runs = -(-sizes[full] // 255)
    first_run = np.concatenate([[0], np.cumsum(runs)[:-1]])
    start = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    at = np.repeat(start, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first_run, runs))
    for k in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(k)) & _ONES, at)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        high = 2 * counts > sizes[full][:, None]
        for byte in range(8):
            out[full] |= high[:, byte].astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints, held, n = [], [], 0
        for t in pc.cast(b.column("text"), pa.binary()):
            held.append(shingle_hashes(t.as_py()))
            n += len(held[-1])
            if n > 200_000:
                prints.append(majority(held))
                held, n = [], 0
        prints.append(majority(held))
        yield pa.record_batch({"doc_id": b.column("doc_id"), "print": pa.array(np.concatenate(prints).view(np.int64))})


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, print`` per row of ``docs``; the fingerprint as a signed 64-bit number."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print bigint")


# -- groups of bits and estimates -------------------------------------------------------------------

def _bits(x: np.ndarray, places) -> np.ndarray:
    return (x[:, None] >> np.asarray(places, np.uint64)[None, :]) & np.uint64(1)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for b in batches:
        x = b.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(x), 4096):
            s = _bits(x[i:i + 4096], range(BITS)).astype(np.float32)
            total += (s.T @ s).astype(np.int64)
    i, j = np.nonzero(total)
    yield pa.record_batch({"i": pa.array(i), "j": pa.array(j), "n": pa.array(total[i, j])})


def correlated_groups(both: np.ndarray, n: int, parts: int = PARTS) -> list[list[int]]:
    """Bits in groups of equal width; each takes the bit most correlated with what it holds.

    ``both`` counts how often two bits are set together, among ``n`` fingerprints.
    """
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 0))
    corr = np.abs(np.divide(cov, np.outer(sd, sd), out=np.zeros_like(cov), where=np.outer(sd, sd) > 1e-12))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for g in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - g)
        mine = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(mine[0])
        while len(mine) < width:
            mine.append(max(left, key=lambda b: (corr[b, mine].sum(), -b)))
            left.remove(mine[-1])
        groups.append(sorted(mine))
    return groups


def _packed(x: np.ndarray, places: list[int]) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for k, b in enumerate(places):
        out |= ((x >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def _halves(groups: list[list[int]]) -> list[list[int]]:
    return [h for g in groups for h in (g[:len(g) // 2], g[len(g) // 2:])]


def _histogram(halves: list[list[int]]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 << len(h), np.int64) for h in halves]
        for b in batches:
            x = b.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            for t, h in zip(total, halves):
                t += np.bincount(_packed(x, h), minlength=len(t))
        for k, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.record_batch({"half": pa.array(np.full(len(at), k)), "value": pa.array(at), "n": pa.array(t[at])})

    return count


def _spheres(width: int, radius: int) -> list[np.ndarray]:
    """The numbers of ``width`` bits with exactly 0, 1, .. ``radius`` bits set."""
    x = np.arange(1 << width, dtype=np.uint64)
    weight = np.bitwise_count(x)
    return [x[weight == r] for r in range(radius + 1)]


def near_counts(hist: np.ndarray, radius: int) -> np.ndarray:
    """How many lie at distance 0, 1, .. of each value, from a histogram over all values of some bits."""
    x = np.arange(len(hist))
    width = len(hist).bit_length() - 1
    return np.stack([sum((hist[x ^ int(m)] for m in s), np.zeros(len(hist), np.int64)) for s in _spheres(width, radius)], axis=1)


def allocate(cost: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds per row and group with the least total cost, and that cost.

    ``cost[r, g, t + 1]`` is the cost of threshold t = -1, 0, .. in group g; the
    thresholds of a row sum up to distance - groups + 1.  A dynamic programme over the
    groups whose state is what has been spent.
    """
    n, groups, steps = cost.shape
    budget = distance + 1  # thresholds counted from -1
    best = np.full((n, budget + 1), np.inf)
    best[:, 0] = 0
    picked = np.zeros((groups, n, budget + 1), np.int8)
    for g in range(groups):
        new = np.full_like(best, np.inf)
        for spent in range(budget + 1):
            for t in range(min(spent + 1, steps)):
                c = best[:, spent - t] + cost[:, g, t]
                better = c < new[:, spent]
                new[better, spent] = c[better]
                picked[g, better, spent] = t
        best = new
    left, out = np.full(n, budget), np.zeros((n, groups), np.int64)
    for g in reversed(range(groups)):
        out[:, g] = picked[g, np.arange(n), left]
        left = left - out[:, g]
    return out - 1, best[:, budget]


def _probes(groups: list[list[int]], hists: list[np.ndarray], n: int, distance: int):
    """Probes of each fingerprint as (print, part, key); part -1 marks those whose thresholds cost too much."""
    near = [near_counts(h, distance) for h in hists]
    halves = _halves(groups)
    mask = [np.uint64(sum(1 << b for b in g)) for g in groups]
    flips = []  # per group and threshold the changes of a key, in the bits' own places
    for g in groups:
        spheres = [[0], [1 << b for b in g], [(1 << a) | (1 << b) for i, a in enumerate(g) for b in g[:i]]]
        flips.append([np.array(sum(spheres[:t + 1], []), np.uint64) for t in range(distance + 1)])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 8192):
                x = every[at:at + 8192]
                cost = np.zeros((len(x), len(groups), distance + 2))
                for g in range(len(groups)):
                    low, high = (near[2 * g + k][_packed(x, halves[2 * g + k])] for k in (0, 1))
                    for t in range(distance + 1):
                        found = sum(low[:, i] * high[:, : t - i + 1].sum(axis=1) / max(n, 1) for i in range(t + 1))
                        cost[:, g, t + 1] = found + len(flips[g][t])
                radius, total = allocate(cost, distance)
                light = total <= MOST
                out_x, out_p, out_k = [x[~light]], [np.full((~light).sum(), -1)], [x[~light]]
                for g in range(len(groups)):
                    for t in range(distance + 1):
                        mine = x[light & (radius[:, g] == t)]
                        keys = ((mine & mask[g])[:, None] ^ flips[g][t][None, :]).ravel()
                        out_x.append(np.repeat(mine, len(flips[g][t])))
                        out_p.append(np.full(len(keys), g))
                        out_k.append(keys)
                yield pa.record_batch({"print": pa.array(np.concatenate(out_x).view(np.int64)), "part": pa.array(np.concatenate(out_p), pa.int32()),
                                       "key": pa.array(np.concatenate(out_k).view(np.int64))})

    return probe


# -- links ------------------------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(nodes: DataFrame) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``print``) that give the components at ``DISTANCE`` bits.

    Every two linked fingerprints are joined by a chain of edges, and every edge is a
    link; a heavy neighbourhood gives a star and not all its pairs.
    """
    n = nodes.count()
    both = np.zeros((BITS, BITS), np.int64)
    for i, j, c in nodes.select("print").mapInArrow(_together, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n")).collect():  # at most 64 x 64 rows
        both[i, j] = c
    groups = correlated_groups(both, n)
    halves = _halves(groups)
    hists = [np.zeros(1 << len(h), np.int64) for h in halves]
    counted = nodes.select("print").mapInArrow(_histogram(halves), "half bigint, value bigint, n bigint").groupBy("half", "value").agg(F.sum("n"))
    for h, v, c in counted.collect():  # one row per value of at most 11 bits
        hists[h][v] = c

    probes = materialise(nodes.select("print").mapInArrow(_probes(groups, hists, n, DISTANCE), "print bigint, part int, key bigint"))
    masks = [_signed(sum(1 << b for b in g)) for g in groups]
    index = materialise(nodes.select(F.col("print").alias("b"), F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("part", "key")))
    sizes = index.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))

    own = F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), F.col("part") + 1)
    hits = probes.where("part >= 0").join(sizes, ["part", "key"])
    hits = materialise(hits.where((F.col("n") > 1) | (F.col("print").bitwiseAND(own) != F.col("key"))))  # a bucket that holds but the prober gives none
    costly = hits.groupBy("print").agg(F.sum("n").alias("n")).where(F.col("n") > MOST).select("print")
    heavy = materialise(probes.where("part < 0").select("print").unionByName(costly))
    # a bucket that a light fingerprint probes holds at most MOST
    light = hits.where(F.col("n") <= MOST).join(heavy, "print", "left_anti").select("part", "key", F.col("print").alias("a"))
    near = light.join(index, ["part", "key"]).where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)).select("a", "b")

    steps = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)).cast("long") for k in range(BITS)])
    mid = heavy.select("print", F.explode(steps).alias("_s")).select("print", F.col("print").bitwiseXOR(F.col("_s")).alias("mid"))
    met = mid.groupBy("mid").agg(F.min("print").alias("b"), F.collect_list("print").alias("all")).where("size(all) > 1")  # at most 65 lie within one bit
    stars = met.select(F.explode("all").alias("a"), "b").where("a <> b")
    return near.unionByName(stars)


def similar(docs: DataFrame) -> DataFrame:
    """``doc_id, print, component_id`` per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links.  A null, empty or
    blank text has fingerprint zero, which is linked like any other.  Null doc_ids are
    ignored in the minimum; a component without any other id has a null component_id.
    Repeated rows share a fingerprint and keep one row each.  An empty table gives no
    rows; other columns of ``docs`` are not read.
    """
    rows = materialise(fingerprints(docs))
    nodes = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    edges = materialise(links(nodes).distinct())
    label = nodes.withColumn("root", F.col("print"))
    if not edges.isEmpty():
        roots = components(edges).select(F.col("node").alias("print"), F.col("root").alias("_r"))
        label = nodes.join(roots, "print", "left").withColumn("root", F.coalesce("_r", "print"))
    smallest = label.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = materialise(label.join(smallest, "root").select("print", "n", "component_id"))

    often = rows.count() / HOT_SHARE
    hot = F.broadcast(label.where(F.col("n") > often).select("print", F.col("component_id").alias("_c"), F.lit(True).alias("_hot")))  # fewer than HOT_SHARE rows
    parted = rows.join(hot, "print", "left")
    rest = parted.where("_hot IS NULL").select("doc_id", "print").join(label.where(F.col("n") <= often).select("print", "component_id"), "print")
    return parted.where("_hot").select("doc_id", "print", F.col("_c").alias("component_id")).unionByName(rest.select("doc_id", "print", "component_id"))


@query("op11_simhash_components")
def op11_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
