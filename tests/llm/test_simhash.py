"""SimHash components against plain Python, on planted neighbours, dense clusters and odd rows."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from voltloom.llm import simhash

DOCS = "doc_id bigint, text string, lang string, print string"


def plain_print(text):
    ws = (text or "").encode().lower().split()
    grams = [b" ".join(ws)] if 0 < len(ws) <= 3 else [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def plain_components(prints):
    """Root per distinct fingerprint, all pairs compared."""
    up = {p: p for p in prints}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    for a, b in itertools.combinations(sorted(up), 2):
        if (a ^ b).bit_count() <= 2:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {p: root(p) for p in up}


def test_texts_match_plain_python(spark):
    rng = random.Random(4)
    words = [f"W{i}é" for i in range(50)]
    base = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 3, 4, 40, 300, 300, 700)]
    texts = base + [t + " end" for t in base[4:]] + [base[7].replace(words[3], words[4], 1), base[5].upper(), None, "", " \t\n", "a  b\nc", "a b c"]
    rows = [(i + 10, t, None, "clash") for i, t in enumerate(texts)] + [(3, base[6], "en", None), (None, base[6], None, None), (10, base[0], None, None)]
    rows.append((500, " ".join(rng.choice(words) for _ in range(30_000)), None, None))
    got = simhash.similar(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    prints = [plain_print(t) for _, t, _, _ in rows]
    roots = plain_components(prints)
    least = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = sorted(((i, p, least.get(roots[p])) for (i, *_), p in zip(rows, prints)), key=repr)
    assert sorted(((r["doc_id"], r["print"] & (2**64 - 1), r["component_id"]) for r in got), key=repr) == want


def cluster(rng, n, spread):
    """Fingerprints of few changed bits around one, correlated bits included."""
    centre = rng.getrandbits(64)
    return {centre ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, spread))) for _ in range(n)}


@pytest.mark.parametrize("most", [128, 6, 0])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MOST", most)
    rng = random.Random(most)
    prints = {0, 1, 3, 2**64 - 1} | {rng.getrandbits(64) for _ in range(300)} | {rng.getrandbits(20) << 44 for _ in range(200)}
    for n, spread in ((400, 4), (150, 8), (80, 2)):
        prints |= cluster(rng, n, spread)
    a = rng.getrandbits(64)
    for k in range(0, 60, 2):  # a chain of links whose ends are far apart
        prints.add(a)
        a ^= 3 << k
    nodes = spark.createDataFrame([(simhash._signed(p),) for p in sorted(prints)], "print bigint")
    edges = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(nodes).distinct().collect()]
    assert all((x ^ y).bit_count() <= 2 for x, y in edges)
    assert len(edges) < 140 * len(prints)
    up = {p: p for p in prints}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    for x, y in edges:
        x, y = sorted((root(x), root(y)))
        up[y] = x
    assert {p: root(p) for p in prints} == plain_components(prints)


def test_allocation_is_the_cheapest(spark):
    rng = np.random.default_rng(1)
    cost = rng.integers(0, 50, (40, 4, 4)).astype(float)
    cost[:, :, 0] = 0
    radius, total = simhash.allocate(cost, 2)
    for r in range(40):
        best = min(sum(cost[r, g, t] for g, t in enumerate(ts)) for ts in itertools.product(range(4), repeat=4) if sum(ts) == 3)
        assert radius[r].sum() == 2 - 4 + 1
        assert total[r] == best == sum(cost[r, g, t + 1] for g, t in enumerate(radius[r]))


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(2)
    driver = rng.integers(0, 2, (5000, 3))
    kind = np.arange(64) % 3
    bits = np.where(rng.random((5000, 64)) < 0.9, driver[:, kind], rng.integers(0, 2, (5000, 64)))
    groups = simhash.correlated_groups(bits.T @ bits, 5000)
    assert sorted(sum(groups, [])) == list(range(64))
    assert all(len({kind[b] for b in g[:]}) <= 2 for g in groups)
    assert sum(max(np.bincount(kind[g])) for g in map(np.array, groups)) >= 60


def test_near_counts_and_fingerprint_function():
    hist = np.random.default_rng(3).integers(0, 9, 16)
    near = simhash.near_counts(hist, 2)
    for v in range(16):
        for d in range(3):
            assert near[v, d] == sum(hist[w] for w in range(16) if (v ^ w).bit_count() == d)
    rng = random.Random(9)
    sets = [np.array([rng.getrandbits(64) for _ in range(n)], np.uint64) for n in (0, 1, 254, 255, 256, 511, 2000, 0, 3)]
    want = [sum(1 << k for k in range(64) if 2 * sum(int(h) >> k & 1 for h in s) > len(s)) for s in sets]
    assert [int(x) for x in simhash.majority(sets)] == want


def test_empty_table_and_spark_hash(spark):
    assert simhash.similar(spark.createDataFrame([], DOCS)).count() == 0
    text = "One two\tTHREE four"
    got = spark.range(1).select(F.xxhash64(F.lit("one two three")), F.xxhash64(F.lit("two three four"))).first()
    assert [int(x) for x in simhash.shingle_hashes(text.encode()).view(np.int64)] == list(got)
