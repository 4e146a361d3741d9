"""Vector codes against plain Python: ties, repeated rows, few rows, huge and negative components, dropped rows."""

import random

import numpy as np
import pytest

from voltloom.llm import vector_codes as V

VECTORS = "vec_id bigint, embedding array<double>, label int, code string, n int"


def plain(rows, parts=4, entries=256, rounds=4):
    """Codes, errors and codebooks by comparing every part with every entry, in Python numbers."""
    kept = [(i, v, lab) for i, v, lab, *_ in rows if v is not None and all(c is not None and abs(c) < float("inf") for c in v)]
    if not kept:
        return [], [[] for _ in range(parts)]

    def last(i):
        return (i is None, i or 0)

    dims = len(min(kept, key=lambda r: (last(r[0]), r[1]))[1])
    kept = [r for r in kept if len(r[1]) == dims and dims % parts == 0]
    w = dims // parts
    whole = [[(int(c) * 1024 if abs(c) > 2**45 else int(c * 1024 // 1)) for c in v] for _, v, _ in kept]
    first = {}
    for (i, v, _), x in zip(kept, whole):
        if i not in first or v < first[i][0]:
            first[i] = (v, x)
    seeds = [first[i][1] for i in sorted(first, key=last)[:entries]]
    books = [[s[p * w:(p + 1) * w] for s in seeds] for p in range(parts)]

    def nearest(x, p):
        d = [sum((a - b) ** 2 for a, b in zip(x[p * w:(p + 1) * w], e)) for e in books[p]]
        return min(range(len(d)), key=d.__getitem__), min(d)

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for x in whole:
                own.setdefault(nearest(x, p)[0], []).append(x[p * w:(p + 1) * w])
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else b for e, b in enumerate(books[p])]
    out = []
    for (i, _, lab), x in zip(kept, whole):
        found = [nearest(x, p) for p in range(parts)]
        err = sum(d for _, d in found)
        out.append((i, lab, "".join(f"{e:02x}" for e, _ in found), err if err < 2**63 else None))
    return out, books


def check(spark, rows, **kw):
    codes, books = V.compress(spark.createDataFrame(rows, VECTORS), **kw)
    got = sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in codes.collect()), key=repr)
    want, want_books = plain(rows, **kw)
    assert got == sorted(want, key=repr)
    assert [[[int(c) for c in e] for e in b] for b in books] == want_books
    return got


def test_random_vectors_ties_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.25, 0.7)) for _ in range(8)], i % 3 or None, "x", 0) for i in range(700)]
    rows += rows[:40] + [(None, [0.1] * 8, None, None, None), (5, [9.0] * 8, 1, None, None), (701, [-0.0003] * 8, 1, None, None)]
    rng.shuffle(rows)
    check(spark, rows, entries=40)


def test_clustered_vectors_with_full_codebooks(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 16)) * 0.2
    check(spark, [(i, v, i % 4, "", 0) for i, v in enumerate(x.tolist())], rounds=2)


def test_dropped_rows_and_odd_lengths(spark):
    ok = [(i, [i / 7, -i / 3, 0.5, 1.0], 1, None, None) for i in range(3, 9)]
    bad = [(0, None, 1, "", 1), (1, [None, 1.0, 1.0, 1.0], 1, "", 1), (2, [float("nan")] * 4, 1, "", 1), (2, [float("inf"), 0.0, 0.0, 0.0], 1, "", 1),
           (9, [1.0] * 8, 1, "", 1), (10, [], None, "", 1)]
    assert len(check(spark, ok + bad)) == 6
    assert check(spark, bad[:4]) == []
    assert check(spark, []) == []
    assert check(spark, [(1, [1.0, 2.0], 1, None, None), (2, [1.0] * 4, 1, None, None)]) == []


def test_huge_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice((0, 6, 9, 20, 38, 300, 308)) for _ in range(4)], 0, None, None) for i in range(120)]
    check(spark, rows, entries=7)
    wide = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice((3, 7)) for _ in range(4)], 0, None, None) for i in range(60)]
    check(spark, wide, entries=5)


def test_label_errors(spark):
    rows = [(1, 0, "", 5), (2, 0, "", 6), (3, None, "", 7), (4, None, "", 1), (5, 2, "", None), (6, 2, "", 3), (7, 3, "", 2**63 - 1), (8, 3, "", 1)]
    got = V.with_label_errors(spark.createDataFrame(rows, "vec_id bigint, label int, code string, error bigint")).collect()
    assert {r["vec_id"]: r["label_error"] for r in got} == {1: 11, 2: 11, 3: 8, 4: 8, 5: None, 6: None, 7: None, 8: None}


@pytest.mark.parametrize("n", [0, 1, 2, 30, 1500])
def test_trees_hold_every_point_once(n):
    rng = np.random.default_rng(n)
    x = rng.integers(-40, 40, (n, 3))
    x[n // 2:] = x[: n - n // 2]  # equal points
    t = V._Tree(x).arrays()
    assert sorted(t["order"].tolist()) == list(range(n))
    for v in range(len(t["radius"])):
        mine = x[t["order"][t["start"][v]:t["stop"][v]]]
        assert len(mine) == t["counts"][v] and (mine.sum(axis=0) == t["sums"][v]).all()
        assert np.sqrt(((mine - t["pivot"][v]) ** 2).sum(axis=1)).max() <= t["radius"][v] + 1e-9
        if t["left"][v] >= 0:
            assert t["counts"][v] == t["counts"][t["left"][v]] + t["counts"][t["right"][v]]
        elif n > V.LEAF:
            assert len(mine) <= V.LEAF or len(np.unique(mine, axis=0)) == 1
    if n == 1500:
        assert len(t["radius"]) > 60


def test_anchors_own_their_nearest_points_and_balls_are_owned_whole():
    x = np.random.default_rng(5).integers(-1000, 1000, (400, 4))
    groups = V.anchors(x, 20)
    assert sorted(np.concatenate(groups).tolist()) == list(range(400)) and len(groups) == 20
    blobs = np.concatenate([x[:50] // 50 + k * 5000 for k in range(8)])
    t = V._Tree(blobs).arrays()
    seen = []
    real, V.squared = V.squared, lambda a, b: (seen.append(len(a)), real(a, b))[1]
    try:
        totals = (np.zeros((8, 4), np.int64), np.zeros(8, np.int64))
        V.owners(t, blobs, np.arange(8)[:, None] * 5000 + np.zeros((8, 4), np.int64), totals)
    finally:
        V.squared = real
    assert totals[1].tolist() == [50] * 8 and sum(seen) < 100  # centres only, no points
