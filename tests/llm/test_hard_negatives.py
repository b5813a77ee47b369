"""Hard negatives against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from seawarden.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v int, score double, anchor_id int"


def row(vec_id, vector, label):
    return (vec_id, vector, label, "x", 1, 0.5, 9)


def brute_force(rows, k=5):
    least = {}
    for vec_id, vector, label, *_ in rows:
        usable = vector is not None and all(x is not None and math.isfinite(x) for x in vector)
        if vec_id is None or label is None or not usable:
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        whole = (label, [math.floor(256 * x) for x in vector])
        least[vec_id] = min(least.get(vec_id, whole), whole)
    out = []
    for anchor, (label, vector) in least.items():
        if anchor % 100:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, v)), i, own == label) for i, (own, v) in least.items() if i != anchor
        )
        for minus, positive, _ in [s for s in scored if s[2]][:k]:
            inside = [(-m, i) for m, i, same in scored if not same and -80 * minus <= -100 * m <= -100 * minus]
            out += [(anchor, positive, n, i, -minus, s) for n, (s, i) in enumerate(inside[:k], 1)]
    return sorted(out)


def mined(spark, rows, **kwargs):
    vectors = hard_negatives.prepare(spark.createDataFrame(rows, SCHEMA).repartition(4))
    return sorted(tuple(r) for r in hard_negatives.mine(vectors, **kwargs).collect())


@pytest.mark.parametrize("seed, shard, block", [(1, 20_000, 20_000), (2, 70, 2), (3, 9, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    pick = random.Random(seed)
    # few values make many ties; a third of the rows has one label
    centre = [[pick.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(6)] for _ in range(4)]

    def near():
        return [x + pick.choice([0, 0, 0, 0.25, -0.5]) for x in pick.choice(centre)]

    rows = [row(i, near(), 0 if i % 3 == 0 else pick.randrange(5)) for i in range(500)]
    rows += [row(600 + i, centre[0], pick.randrange(3)) for i in range(101)]
    got = mined(spark, rows)
    assert got == brute_force(rows) and len(got) > 50


def test_odd_vectors(spark):
    inf, nan = math.inf, math.nan
    rows = [row(0, [1.0, 1.0], 1), row(None, [1.0, 1.0], 1), row(1, None, 1), row(2, [1.0, None], 1), row(3, [nan, 1.0], 1)]
    rows += [row(4, [inf, 1.0], 2), row(5, [1.0, 1.0], None), row(6, [1.0, 0.9], 1), row(8, [1.0], 2), row(9, [], 2)]
    rows += [row(10, [1.0, 0.8], 2), row(10, [1.0, 0.8], 2), row(11, [1.0, 0.7, 9.0], 3), row(11, [1.0, 0.9], 2)]
    rows += [row(100, [0.0, 0.0], 1), row(200, [], 4), row(300, [-1.0, -1.0], 5), row(301, [1.0, 1.0], 5), row(14, [1.0, 0.85], 2)]
    got = mined(spark, rows)
    assert got == brute_force(rows)
    assert {r[0] for r in got} >= {0, 100}
    assert mined(spark, []) == []
    assert mined(spark, [row(0, [1.0], 1)]) == []


def test_large_components_are_added_up_exactly(spark):
    rows = [row(0, [2.0**22, 1.0], 1), row(1, [2.0**22, 3.0], 1), row(2, [2.0**22, 2.0], 2), row(3, [2.0**22, 1.0], 2)]
    rows += [row(100, [2.0**40, 1.0], 3), row(4, [2.0**3, 1.0], 3), row(5, [2.0**3, 0.5], 2)]
    assert mined(spark, rows) == brute_force(rows)
    huge = [row(0, [1e300], 1), row(1, [1e300], 1), row(2, [1e300], 2)]
    top = hard_negatives.LONG[1]
    assert mined(spark, huge) == [(0, 2, 1, 1, top, top)]


def test_search_stops_before_all_rows_are_met():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(20000, 3)) * 256 // 1
    index = hard_negatives.SortedLists(rows)
    anchor = np.asarray([100.0, -50.0, 0.0])
    position, score = index.search(anchor, np.ones(len(rows), bool), [(-1e18, 1e18)], 5)
    assert sorted(score)[-5:] == sorted(rows @ anchor)[-5:] and len(position) < 2000
    usable = rng.random(len(rows)) < 0.5
    position, score = index.search(anchor, usable, [(1e4, 2e4), (5e3, 6e3)], 3)
    every = defaultdict(list)
    for s in (rows @ anchor)[usable]:
        for low, high in ((1e4, 2e4), (5e3, 6e3)):
            if low <= s <= high:
                every[low, high].append(s)
    for (low, high), all_in in every.items():
        assert sorted(s for s in score if low <= s <= high)[-3:] == sorted(all_in)[-3:]
