"""The Jaccard join against all pairs."""

import random
import weakref

import numpy as np
import pyarrow as pa
import pytest

from seawarden.llm import jaccard_join
from tests.llm.conftest import ODD, PROSE, row
from tests.llm.test_search import expected_groups, family


def found(frame, **kwargs):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.groups(frame, **kwargs).collect())


def passages(seed, count):
    """Texts that share a long passage and differ around it, some by little."""
    pick = random.Random(seed)
    shared = " ".join(f"p{seed}x{k}" for k in range(60))
    return [" ".join([f"own{pick.randrange(10**6)}" for _ in range(pick.choice([0, 3, 8, 14, 40]))] + [shared]) for _ in range(count)]


@pytest.mark.parametrize(
    "least, nodes, size_bytes, split", [(1, 4096, 32 << 20, 5), (2, 7, 32 << 20, 10**6), (10**6, 4096, 40_000, 10**6)]
)
def test_groups_equal_all_pairs(spark, odd, monkeypatch, least, nodes, size_bytes, split):
    monkeypatch.setattr(jaccard_join, "SPLIT_NODES", split)
    monkeypatch.setattr(jaccard_join, "FREQUENT", least)
    monkeypatch.setattr(jaccard_join, "FREQUENT_MEANS", 0)
    monkeypatch.setattr(jaccard_join, "VERY", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", nodes)
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", size_bytes)
    made = [text for seed in range(4) for text in family(seed, 50, 5)] + passages(1, 80)
    made += [" ".join(f"s{k}" for k in range(n)) for n in range(4, 14)] + ["a b c d e f g h", "a b c d e f g h i"]
    order = list(range(1000, 1000 + len(made)))
    random.Random(9).shuffle(order)
    rows = ODD + [row(i, text) for i, text in zip(order, made)]
    assert found(spark.createDataFrame(rows, odd.schema).repartition(5)) == expected_groups(rows, 5)


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_signature(seed):
    """Random pairs of linked sets under random frequencies, near the least similarity."""
    rng = np.random.default_rng(seed)
    cells = rng.choice([1, 5, 40, 900], 1 << jaccard_join.CELL_BITS, p=[[0.1, 0.1, 0.4, 0.4], [0, 0, 1, 0], [0, 0, 0, 1]][seed])
    known = jaccard_join.Frequencies(np.concatenate([cells[:-1], [0]]))
    known.bounds = np.asarray([30.0, 60.0])
    met = 0
    for _ in range(1500):
        n = int(rng.integers(4, rng.choice([8, 20, 70, 300])))
        one = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        out = int(rng.integers(0, max(1, n // 5) + 1))
        two = np.unique(np.concatenate([one[rng.permutation(n)[out:]], rng.integers(0, 2**64, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        common = len(np.intersect1d(one, two))
        if jaccard_join._linked(common, len(one), len(two)) and common < max(len(one), len(two)):
            met += 1
            assert len(np.intersect1d(jaccard_join.signatures(one, known)[0], jaccard_join.signatures(two, known)[0]))
    assert met > 200


def test_counts_by_hash_are_whole(spark, odd, monkeypatch):
    rows = [row(i, f"{PROSE} number {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, odd.schema).repartition(3)
    profiled = jaccard_join.profile(docs, 5).where("block IS NOT NULL")
    cells = jaccard_join.count_cells(profiled)
    tokens = [jaccard_join.sets(*_bytes(r[1]), 5)[0] for r in rows]
    expected = np.zeros(len(cells), np.int64)
    for t in tokens:
        np.add.at(expected, jaccard_join._cell(t), 1)
    assert np.array_equal(cells, expected) and cells.max() == 300


def _bytes(text):
    return jaccard_join.texts.string_bytes(pa.array([text]))


def test_nothing_unnamed_rows_and_documents(spark, odd, nothing, docs):
    assert jaccard_join.groups(nothing).count() == 0
    unnamed = spark.createDataFrame([row(None, PROSE), row(1, PROSE)], odd.schema)
    assert {(r.doc_id, r.component_id) for r in jaccard_join.groups(unnamed).collect()} == {(None, None), (1, 1)}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == expected_groups(rows, 5)


def test_bitmaps_never_part_linked_sets(monkeypatch):
    """Rows that bitmaps leave out are linked with no row of another component, by all pairs; most unlike ones go."""
    rng = np.random.default_rng(5)
    tokens = []
    for n in rng.integers(4, 900, 60):
        one = rng.integers(0, 2**64, n, dtype=np.uint64)
        changed = rng.integers(0, 2**64, max(1, n // 12), dtype=np.uint64)
        tokens += [np.unique(one), np.unique(np.concatenate([one[len(changed) :], changed])), np.unique(one[: n - n // 6])]
        tokens.append(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)))
    label = rng.integers(0, 150, len(tokens))
    sizes = np.asarray([len(t) for t in tokens])
    for most, block in ((jaccard_join.MOST_BITS, np.zeros(len(tokens), int)), (512, rng.integers(3, 5, len(tokens)))):
        monkeypatch.setattr(jaccard_join, "MOST_BITS", most)
        expected = set()
        for i in range(len(tokens)):
            for j in range(i):
                common = len(np.intersect1d(tokens[i], tokens[j]))
                apart = block[i] != block[j] or not block.any()
                if apart and label[i] != label[j] and jaccard_join._linked(common, sizes[i], sizes[j]):
                    expected |= {i, j}
        bits = pa.array([jaccard_join.bitmap(t) for t in tokens], pa.binary())
        columns = {"node": pa.array(range(len(tokens))), "label": pa.array(label), "block": pa.array(block)}
        got = set(jaccard_join._near(pa.table(columns | {"n": pa.array(sizes), "bits": bits}))["node"].to_pylist())
        assert expected <= got and len(expected) > 50
        assert most == 512 or len(got - expected) < 10


def test_memory_of_a_large_group_is_given_back_once_its_work_is_done(monkeypatch):
    """While sets of a group are still held, nothing can be given back, and the worker keeps them until it ends."""
    class Sets(np.ndarray):
        pass

    made, held, real = [], [], np.frombuffer

    def frombuffer(*given):
        tokens = real(*given).view(Sets)
        made.append(weakref.ref(tokens))
        return tokens

    monkeypatch.setattr(jaccard_join.np, "frombuffer", frombuffer)
    monkeypatch.setattr(jaccard_join.texts, "release", lambda: held.append(sum(x() is not None for x in made)))
    count = jaccard_join.RELEASE_NODES + 1
    tokens = pa.array([np.arange(k, k + 9, dtype="<u8").tobytes() for k in range(0, 20 * count, 20)], pa.binary())
    numbers, zeros = pa.array(range(count)), pa.array([0] * count)
    jaccard_join._links(pa.table({"node": numbers, "label": numbers, "block": zeros, "tokens": tokens}))
    assert held == [0] and len(made) == count
