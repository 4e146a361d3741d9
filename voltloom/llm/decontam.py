"""Benchmark decontamination with spaced seeds.

A seed is the hash of the words under the ones of a fixed mask; the words under its
zeros may differ.  Seeds of every window of every text meet the seeds of the
benchmark in one join.  A hit fixes an alignment (text position minus item position);
each distinct alignment is then compared word by word, and a document is contaminated
when some stretch of ``WINDOW`` aligned words (or of the whole item, if shorter)
agrees in ``SHARE`` of its words, so substituted words are tolerated in and around
the hit.  No such stretch is without a seed: for every set of substitutions that
``WINDOW`` and ``SHARE`` accept some mask has its ones on equal words.  Items shorter
than the window have masks for their length, which holds for those in the same way.

All of it is DataFrame expressions.  Only seeds and hits move between tasks, the hits
folded to alignments first; texts are read again for the documents with a hit.
"""

from __future__ import annotations

import functools
import itertools
import math
import random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table, tokens

MASKS = ("11110111", "1110110011", "11010010111")
# Items of so many words, fewer than WINDOW; up to four words no substitution is allowed and all words are the seed.
SHORT_MASKS = {
    12: ("11101011", "11010111", "1110010011"), 11: ("1111011", "110001111", "1101100011"), 10: ("111011", "1101011", "1110011"),
    9: ("1111011", "1101111"), 8: ("111011", "110111"), 7: ("11111", "110111", "111101"), 6: ("1111", "11011"), 5: ("1111", "10111", "11011", "11101"),
    4: ("1111",), 3: ("111",), 2: ("11",), 1: ("1",),
}
WINDOW = 13
SHARE = 0.8
BROADCAST_SEEDS = 500_000  # rows of three numbers, some 30 MB as a hash table; above that the join shuffles


ENUMERATED = 200_000  # substitution sets up to which masks are searched and proved by trying all; beyond, blocks are used


def misses(masks, n: int, allowed: int) -> np.ndarray:
    """The sets of ``allowed`` substituted words among ``n``, as bit sets, that leave no placement of a mask untouched."""
    left = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), allowed)], np.int64)
    for m in masks:
        ones = sum(1 << i for i in _ones(m))
        for shift in range(n - len(m) + 1):
            left = left[(left & (ones << shift)) != 0]
    return left


@functools.cache
def masks_for(n: int, share: float, window: int = WINDOW) -> tuple[str, ...]:
    """Masks without a miss for stretches of ``n`` words of which ``ceil(n * share)`` agree.

    The default rule has the fixed masks.  For others spaced masks of falling weight are
    drawn (the same ones each time) and taken greedily until no substitution set is
    missed, four at most; where there are too many sets to try, or none suffice, the seed
    is a block of n // (allowed + 1) words, one of which is untouched by any set.
    """
    if share == SHARE and n <= WINDOW and window == WINDOW:
        return MASKS if n == WINDOW else SHORT_MASKS[n]
    allowed = n - math.ceil(n * share)
    block = n // (allowed + 1)
    if block == 0:
        raise ValueError(f"no seed finds {n} words of which a share of {share} agrees")
    if allowed == 0 or math.comb(n, allowed) > ENUMERATED or n > 62:
        return ("1" * block,)
    rng = random.Random(n)
    for weight in range(n - allowed, block, -1):
        drawn = [[0, *sorted(rng.sample(range(1, span - 1), weight - 2)), span - 1] for span in range(weight, n) for _ in range(12) if weight >= 2 and span - 2 >= weight - 2]
        options = list(dict.fromkeys("".join("1" if i in o else "0" for i in range(o[-1] + 1)) for o in map(frozenset, drawn) for o in [sorted(o)]))
        taken: list[str] = []
        left = misses((), n, allowed)
        while len(left) and len(taken) < 4 and options:
            def rest(m):
                out, ones = left, sum(1 << i for i in _ones(m))
                for shift in range(n - len(m) + 1):
                    out = out[(out & (ones << shift)) != 0]
                return out

            best = min(options, key=lambda m: len(rest(m)))
            left = rest(best)
            taken.append(best)
        if not len(left):
            return tuple(taken)
    return ("1" * block,)


def _ones(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _seeds(rows: DataFrame, tok: str, of_n: dict[int, tuple[str, ...]]) -> DataFrame:
    """``rows`` with ``pos, lengths, seed`` for every window of every mask in the words ``tok``; ``of_n`` has the masks of each length.

    Masks are data, a row each, so the compiled code stays small however many there are.
    The outer explode keeps Spark from adding a filter on its size, which would make the words twice.
    """
    lengths: dict[str, list[int]] = {}
    for n, masks in of_n.items():
        for m in masks:
            lengths.setdefault(m, []).append(n)
    table = F.array(*[F.struct(F.lit(m).alias("mask"), F.array(*map(F.lit, _ones(m))).alias("ones"), F.lit(len(m)).alias("span"), F.array(*map(F.lit, ns)).alias("lengths"))
                      for m, ns in lengths.items()])
    windows = rows.select("*", F.posexplode_outer(tok).alias("pos", "word")).select("*", F.inline(table)).where(F.col("pos") + F.col("span") <= F.size(tok))
    words = [F.get(tok, F.col("pos") + F.get("ones", F.lit(j))) for j in range(max(m.count("1") for m in lengths))]  # null, which the hash skips, beyond the ones
    return windows.withColumn("seed", F.xxhash64("mask", *words)).drop("word", "mask", "ones", "span")


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct token sequences of the benchmark, numbered, under their smallest item_id; items without a word go."""
    t = benchmark.select("item_id", tokens(F.col("text")).alias("item")).where(F.size("item") > 0)
    return t.groupBy("item").agg(F.min("item_id").alias("item_id")).withColumn("_i", F.monotonically_increasing_id())


def _good(docs: DataFrame, benchmark: DataFrame, window: int, share: float) -> DataFrame:
    """``doc_id, text_hash, item_id`` and the figures of every alignment that holds; a text is known by its id and hash, an item by its number."""
    items = materialise(_items(benchmark))
    short = sorted(r[0] for r in items.where(F.size("item") < window).select(F.size("item")).distinct().collect())
    of_n = {n: masks_for(n, share, window) for n in (window, *short)}
    of_length = F.array_contains("lengths", F.least(F.size("item"), F.lit(window)))
    of_items = materialise(_seeds(items, "item", of_n).where(of_length).select("_i", F.col("pos").alias("ipos"), "seed"))
    small = of_items.count() <= BROADCAST_SEEDS
    known = F.broadcast(of_items) if small else of_items

    toks = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), tokens(F.col("text")).alias("tok"))
    of_docs = _seeds(toks, "tok", of_n).select("doc_id", "text_hash", "pos", "seed")
    found = (of_docs.join(known, "seed").select("doc_id", "text_hash", "_i", (F.col("pos") - F.col("ipos")).alias("at")).distinct()
             .groupBy("doc_id", "text_hash", "_i").agg(F.collect_set("at").alias("ats")))
    found = materialise(found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_h"}))

    n_item = items.select("_i", "item_id", "item", F.size("item").alias("n"))
    cand = found.join(F.broadcast(n_item) if small else n_item, "_i")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    again = texts.join(cand, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")))
    again = again.select("doc_id", "text_hash", "item_id", "item", "n", "ats", tokens(F.col("text")).alias("tok"))
    lo = lambda a: F.greatest(a, F.lit(0))
    hi = lambda a: F.least(a + F.col("n"), F.size("tok"))
    cut = again.select("doc_id", "text_hash", "item_id", "item", "n", F.explode(F.transform("ats", lambda a: F.struct(
        a.alias("at"), F.slice("tok", lo(a) + 1, F.greatest(hi(a) - lo(a), F.lit(0))).alias("part")))).alias("c"))
    cut = cut.select("doc_id", "text_hash", "item_id", "n", "c.at", F.least(F.lit(window), F.col("n")).alias("w"),
                     F.transform("c.part", lambda t, i: (t == F.get("item", i + lo(F.col("c.at")) - F.col("c.at"))).cast("int")).alias("eq"))
    sums = F.transform(F.sequence(F.lit(1), F.size("eq") - F.col("w") + 1), lambda s: F.aggregate(F.slice("eq", s, F.col("w")), F.lit(0), lambda a, x: a + x))
    best = cut.where(F.size("eq") >= F.col("w")).select(
        "doc_id", "text_hash", "item_id", "w", "at", F.array_max(sums).alias("n_equal"), F.aggregate("eq", F.lit(0), lambda a, x: a + x).alias("all_equal"))
    return best.where(F.col("n_equal") >= F.ceil(F.col("w") * share))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, n_equal, n_compared, n_aligned_equal, doc_word``: one row per document and item found in it.

    ``n_equal`` of the ``n_compared`` words of the best stretch agree, ``n_aligned_equal``
    words of the whole alignment; ``doc_word`` is the text's word at which the item's first
    word would lie.  Of equal alignments the first is named.  Items with the same words
    are one item (smallest item_id).  Null or empty texts and items match nothing.
    Rows that share a doc_id, or have none, share a row here, as items without an item_id do;
    ``decontaminate`` judges rows without a doc_id by their texts.
    """
    top = F.max(F.struct("n_equal", "all_equal", (-F.col("at")).alias("back"), "w")).alias("b")
    return _good(docs, benchmark, window, share).groupBy("doc_id", "item_id").agg(top).select(
        "doc_id", "item_id", F.col("b.n_equal").cast("long").alias("n_equal"), F.col("b.w").cast("long").alias("n_compared"),
        F.col("b.all_equal").cast("long").alias("n_aligned_equal"), (-F.col("b.back")).cast("long").alias("doc_word"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found; every text has its own verdict, whatever other rows share its doc_id."""
    bad = materialise(_good(docs, benchmark, WINDOW, SHARE).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_h"]), "left_anti")


def _sql_seed(words: str, mask: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"{words}[p + {o + 1}]" for o in _ones(mask)) + ")"


def _sql_seeds(src: str, key: str, words: str, of_items: bool) -> str:
    """Seeds of MASKS, and of the masks of every shorter length that the benchmark has."""
    lengths = {m: [n for n, ms in SHORT_MASKS.items() if m in ms] for ms in SHORT_MASKS.values() for m in ms}
    parts = []
    for k, m in enumerate(dict.fromkeys([*MASKS, *lengths])):
        of = f"len({words}) IN ({', '.join(map(str, lengths.get(m, [0])))})" + (f" OR len({words}) >= {WINDOW}" if m in MASKS else "")
        use = f"({of})" if of_items else "TRUE" if m in MASKS else f"EXISTS (SELECT 1 FROM i WHERE len(it) IN ({', '.join(map(str, lengths[m]))}))"
        parts.append(f"SELECT {key}, {k} m, p, {_sql_seed(words, m)} seed FROM (SELECT {key}, {words}, unnest(range(0, len({words}) - {len(m) - 1})) p FROM {src} WHERE {use})")
    return "\nUNION ALL ".join(parts)


_SQL_TOKENS = "list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_TOKENS} ws FROM documents),
i AS (SELECT it, min(item_id) item_id FROM (SELECT item_id, {_SQL_TOKENS} it FROM benchmark) WHERE len(it) > 0 GROUP BY it),
ds AS ({_sql_seeds("d", "doc_id", "ws", False)}),
si AS ({_sql_seeds("i", "item_id", "it", True)}),
c AS (SELECT DISTINCT doc_id, item_id, ds.p - si.p doc_word FROM ds JOIN si USING (m, seed)),
e AS (SELECT doc_id, item_id, doc_word, least({WINDOW}, len(it)) w, list_transform(range(greatest(doc_word, 0), least(doc_word + len(it), len(ws))), lambda q: (ws[q + 1] = it[q - doc_word + 1])::INT) eq
    FROM c JOIN d USING (doc_id) JOIN i USING (item_id)),
s AS (SELECT *, list_max(list_transform(range(0, len(eq) - w + 1), lambda q: list_sum(eq[q + 1 : q + w]))) n_equal, list_sum(eq) total FROM e WHERE len(eq) >= w)
SELECT doc_id, item_id, n_equal, w n_compared, total n_aligned_equal, doc_word FROM s WHERE n_equal >= ceil(w * {SHARE})
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, total DESC, doc_word) = 1
"""


@query("op2_benchmark_decontamination", SQL)
def op2_benchmark_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
