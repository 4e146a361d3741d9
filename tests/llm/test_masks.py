"""Masks for any window and share, and the operator with them."""

import itertools
import math
import random

import pytest

from voltloom.llm import decontam


@pytest.mark.parametrize("n,share", [(13, 0.8), (7, 0.8), (20, 0.8), (13, 0.7), (13, 0.9), (10, 0.75), (16, 0.5), (3, 0.6), (5, 1.0)])
def test_masks_miss_no_accepted_substitution(n, share):
    masks = decontam.masks_for(n, share, n)
    assert all(m[0] == m[-1] == "1" and len(m) <= n for m in masks)
    seeds = [{s + i for i, c in enumerate(m) if c == "1"} for m in masks for s in range(n - len(m) + 1)]
    for changed in itertools.combinations(range(n), n - math.ceil(n * share)):
        assert any(s.isdisjoint(changed) for s in seeds), changed


def test_too_many_sets_fall_back_to_blocks():
    assert decontam.masks_for(60, 0.8, 60) == ("1111",)
    with pytest.raises(ValueError):
        decontam.masks_for(10, 0.0, 10)


@pytest.mark.parametrize("window,share", [(20, 0.8), (13, 0.7)])
def test_other_rules_find_what_they_accept(spark, window, share):
    rng = random.Random(window)
    item = [f"i{k}" for k in range(window)]
    rows = []
    for i in range(200):
        part = list(item)
        for at in rng.sample(range(window), window - math.ceil(window * share) + i % 2):
            part[at] = "z"
        rows.append((i, " ".join([*(f"a{rng.randrange(99)}" for _ in range(9)), *part, "end"])))
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), window, share)
    assert {r["doc_id"] for r in got.collect()} == set(range(0, 200, 2))
