"""Top-k search and near-duplicates against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from seawarden.llm import jaccard_join, near_dedup, topk
from seawarden.llm.components import components
from tests.llm.conftest import ODD, row

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


@pytest.mark.parametrize("seed, count, width, distinct", [(1, 500, 1, 400), (2, 300, 2, 5), (3, 40, 1, 40), (4, 1, 1, 1)])
def test_segment_search_finds_all_within_the_distance(seed, count, width, distinct):
    rng = np.random.default_rng(seed)
    words = np.unique(rng.integers(0, 2**64, (distinct, width), dtype=np.uint64), axis=0)
    weights = rng.integers(1, 4, len(words))
    index = topk.SegmentIndex(words, weights)
    for wanted in (1, 3, 10, 10**6):
        for query in rng.integers(0, 2**64, (5, width), dtype=np.uint64):
            distance = np.bitwise_count(words ^ query).sum(axis=1)
            order = np.sort(np.repeat(distance, weights))
            reach = order[min(wanted, len(order)) - 1]
            position, found = index.search(query, wanted)
            expected = np.flatnonzero(distance <= reach)
            assert sorted(position) == expected.tolist() and found[np.argsort(position)].tolist() == distance[expected].tolist()


def test_vectors_with_nulls_copies_and_ties(spark, monkeypatch):
    pick = random.Random(4)
    rows = [(i, [pick.choice([-1.0, 1.0, None, float("nan")]) for _ in range(70)], "x", 1) for i in range(60)]
    rows += [(100 + i, rows[0][1], "x", 1) for i in range(40)] + [rows[3], (200, None, "x", 1), (250, [], "x", 1), (None, [1.0], "x", 1)]
    rows += [(300, [1.0, -1.0], "x", 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string, rank int").repartition(4)
    monkeypatch.setattr(topk, "SHARD_CODES", 20)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)

    def bits(v):
        return [x is not None and x > 0 for x in v] + [False] * (70 - len(v))

    known = {i: bits(v) for i, v, *_ in rows if i is not None and v}
    expected = []
    for q in known:
        if q % 50 == 0:
            near = sorted((sum(a != b for a, b in zip(known[q], known[i])), i) for i in known if i != q)
            expected += [(q, n, i, d) for n, (d, i) in enumerate(near[:10], 1)]
    assert sorted(tuple(r) for r in topk.search_vectors(vectors).collect()) == sorted(expected)
    assert topk.search_vectors(vectors.where("vec_id < 0")).count() == 0


def word_sets(rows, size):
    out = []
    for text in rows:
        words = WORD.findall((text or "").translate(LOW))
        runs = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        out.append(runs)
    return out


def expected_groups(rows, size):
    """doc_id, set size and component of every row, by comparing all pairs."""
    found = word_sets([r[1] for r in rows], size)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(found[i] & found[j])
        if common and 100 * common >= 80 * len(found[i] | found[j]):
            root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return sorted((r[0], len(found[i]), least[top(i)] if found[i] else r[0]) for i, r in enumerate(rows))


def family(seed, count, edits, words=120):
    """A text and copies of it with some words changed: neighbours of the text, not always of each other."""
    pick = random.Random(seed)
    first = [f"t{seed}w{pick.randrange(400)}" for _ in range(words)]
    out = [first]
    for _ in range(count):
        copy = list(pick.choice(out[:1] * 3 + out))
        for _ in range(pick.randint(0, edits)):
            copy[pick.randrange(words)] = f"e{pick.randrange(10**6)}"
        out.append(copy)
    return [" ".join(words).capitalize() if pick.random() < 0.5 else " ".join(words) for words in out]


@pytest.mark.parametrize("size, block", [(2, 512), (5, 7)])
def test_groups_equal_all_pairs(spark, odd, monkeypatch, size, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", block)
    made = [text for seed in range(6) for text in family(seed, 40, 9 if size == 2 else 4)]
    order = list(range(1000, 1000 + len(made)))
    random.Random(9).shuffle(order)
    rows = ODD + [row(i, text) for i, text in zip(order, made)]
    got = near_dedup.groups(spark.createDataFrame(rows, odd.schema).repartition(5), size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected_groups(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group_stays(spark, odd, nothing):
    kept = near_dedup.dedup(odd)
    assert kept.dtypes == odd.dtypes
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 10, 12]
    assert near_dedup.groups(nothing).count() == near_dedup.dedup(nothing).count() == 0
    unnamed = spark.createDataFrame([row(None, ODD[0][1]), row(1, ODD[0][1])], odd.schema)
    assert {(r.doc_id, r.component_id) for r in near_dedup.groups(unnamed).collect()} == {(None, None), (1, 1)}
    assert near_dedup.dedup(unnamed).count() == 2


def test_components_of_chains_stars_and_rings(spark):
    pick = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(2000, 2001), (2001, 2002), (2002, 2000)]
    edges += [(3000 + pick.randrange(200), 3000 + pick.randrange(200)) for _ in range(150)]
    pick.shuffle(edges)
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
