"""Learnt operators: held-out accuracy, an exact language model, and the pipeline."""

import math
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from seawarden.llm import katz, quality_model, queries, texts, toxicity
from tests.llm.conftest import ODD, row

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def fold(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


@pytest.fixture(scope="module")
def insults(spark, odd):
    """Clean and toxic documents; insults are spelled in ways that training does not hold."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(1, 400):
        words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for place in rng.integers(0, 60, 4):
                words[place] = f"zortw{rng.choice(list('uvxyz'))}{rng.integers(100)}"
        rows.append(row(i, " ".join(words)))
        labels.append((i, i % 3 % 2, int(toxic)))
    return spark.createDataFrame(rows, odd.schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_finds_unseen_spellings_in_held_out_documents(insults, odd, nothing, spark):
    docs, labels = insults
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [r for r in got.values() if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got.values())
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.97
    assert sorted(r.doc_id for r in toxicity.score(odd, model).collect()) == sorted(x[0] for x in ODD)
    kept = toxicity.keep_clean(docs, model)
    assert kept.dtypes == docs.dtypes and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.score(nothing, model).count() == toxicity.keep_clean(nothing, model).count() == 0


def test_training_reads_every_window_and_passage(spark, odd, monkeypatch):
    ids = [i for i in range(1, 30) if fold(i, 3) != 1][:4]
    text = " ".join(f"w{k}" for k in range(6000))
    docs = spark.createDataFrame([row(i, text) for i in ids], odd.schema)
    labels = spark.createDataFrame([(i, k % 2, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda grams, sizes, owner, labels: (owner, labels))
    owner, toxic = toxicity.fit(docs, labels)
    assert sorted(toxic) == [0, 0, 1, 1] and np.bincount(owner).tolist() == [1000] * 4
    monkeypatch.setattr(quality_model, "train", lambda features, document, labels: (document, labels))
    document, good = quality_model.fit(docs, labels)
    assert sorted(good) == [0, 0, 1, 1] and np.bincount(document).tolist() == [125] * 4


def test_the_sample_is_bounded_by_rows_and_bytes(spark, odd):
    ids = [i for i in range(1, 200) if fold(i, 3) != 1]
    docs = spark.createDataFrame([row(i, "x" * (2000 if i == ids[0] else 10)) for i in ids] + [row(ids[1], None)], odd.schema)
    labels = spark.createDataFrame([(i, 0, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    def chosen(most, most_bytes):
        return [r.doc_id for r in texts.labelled(docs, labels, "toxic", most, most_bytes).collect()]

    assert sorted(chosen(1000, 1 << 20)) == sorted([*ids, ids[1]])
    assert sorted(chosen(1000, 20_000)) == sorted([*ids[1:], ids[1]])
    assert len(chosen(5, 1 << 20)) == 10
    few = chosen(1000, 200)
    assert 40 <= len(few) <= 41 and set(few) <= set(ids)


def plain_toxicity(model, text):
    """The most toxic window, from n-grams of single words."""
    words = [w.encode() for w in WORD.findall((text or "").translate(LOW))]
    scores = []
    for at in range(0, len(words), toxicity.WINDOW_WORDS):
        weights = []
        for word in words[at : at + toxicity.WINDOW_WORDS]:
            edged = b" " + word + b" "
            for size in toxicity.SIZES:
                for k in range(len(edged) - size + 1):
                    rolled = edged[k]
                    for byte in edged[k + 1 : k + size]:
                        rolled = (rolled * 0x01000193 + byte + 1) % 2**32
                    mixed = rolled * 0x9E3779B1 % 2**32
                    mixed ^= mixed >> 15
                    weights.append(float(model.weights[(mixed * 0x85EBCA77 % 2**32) >> (32 - toxicity.BUCKET_BITS)]))
        scores.append(sum(weights) / len(weights))
    return 1 / (1 + math.exp(-(max(scores, default=0.0) + model.bias)))


def test_toxicity_equals_a_plain_loop_over_windows(insults, odd):
    docs, labels = insults
    model = toxicity.fit(docs, labels)
    for given in (docs.limit(50), odd.where("doc_id != 7")):
        text_of = {r.doc_id: r.text for r in given.collect()}
        for r in toxicity.score(given, model).collect():
            assert abs(r.score - plain_toxicity(model, text_of[r.doc_id])) < 1e-6


def plain_quality(model, text):
    """The score by the definition: one passage after the other."""
    raw = (text or "").encode()
    spans = [m.span() for m in re.finditer(WORD.pattern.encode(), raw)]
    size = quality_model.PASSAGE_WORDS
    parts = [spans[k : k + size] for k in range(0, len(spans), size)] or [[]]
    w, h, e = model.weights, [], []
    for k, part in enumerate(parts):
        begin = 0 if k == 0 else part[0][0]
        end = len(raw) if k == len(parts) - 1 else parts[k + 1][0][0]
        words = [raw[a:b] for a, b in part]
        before = [raw[a:b] for a, b in [*(parts[k - 1][-1:] if k else []), *part]]
        length, some = max(end - begin, 1), max(len(words), 1)
        f = [sum(byte in kind for byte in raw[begin:end]) / length for kind in quality_model.CLASSES]
        f += [len(set(words)) / some, sum(a == b for a, b in zip(before, before[1:])) / some]
        f += [sum(map(len, words)) / some / 10, sum(len(x) == 1 for x in words) / some]
        f += [math.log1p(len(words)) / math.log1p(size), math.log1p(len(spans)) / 10]
        encoded = np.tanh((np.asarray(f) - model.mean) / model.spread @ w["encode"] + w["encode_bias"])
        h.append(encoded)
        e.append(math.exp(np.tanh(encoded @ w["look"]) / (1 + np.exp(-(encoded @ w["gate"]))) @ w["attend"]))
    z = sum(a * x for a, x in zip(e, h)) / sum(e)
    return 1 / (1 + math.exp(-(z @ w["score"] + w["score_bias"])))


def test_quality_equals_a_plain_loop_over_passages(docs, labels, odd):
    model = quality_model.fit(docs, labels)
    for given in (docs.limit(60), odd.where("doc_id != 7")):
        text_of = {r.doc_id: r.text for r in given.collect()}
        for r in quality_model.score(given, model).collect():
            assert abs(r.score - plain_quality(model, text_of[r.doc_id])) < 1e-6


def test_a_document_without_id_is_not_held_out(spark, insults, odd):
    docs, labels = insults
    given = spark.createDataFrame([row(None, "a b c")], odd.schema)
    assert [r.held_out for r in toxicity.score(given, toxicity.fit(docs, labels)).collect()] == [False]
    assert [r.held_out for r in quality_model.score(given, quality_model.fit(docs, labels)).collect()] == [False]


def test_rows_of_counts_follow_the_text_not_the_partitions(docs):
    rows = texts.ids_and_texts(docs, (texts.remainder(7) == 2).alias("held_out")).coalesce(1)
    known = katz.vocabulary(katz.word_counts(rows), 300)
    assert katz.count_table(rows, known, 10).count() == 10
    assert katz.count_table(rows, known, 10**7).count() <= known.total


def test_without_labels_all_scores_are_alike(insults, spark, nothing):
    docs, labels = insults
    broken = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 7, 7)], labels.schema)
    for given in (labels.limit(0), broken):
        assert len({r.score for r in toxicity.score(docs, toxicity.fit(docs, given)).collect()}) == 1
        model = quality_model.fit(docs, given)
        assert len({round(r.score, 9) for r in quality_model.score(docs, model).collect()}) == 1
    assert toxicity.fit(nothing, labels).bias == 0.0


def test_windows_cover_every_word_and_stay_in_their_document():
    raw = "abc de".encode() + "".encode() + " x\n y ".encode() + ("w " * 13).encode()
    buckets, begins, document, sizes = toxicity.windows(np.frombuffer(raw, np.uint8), np.asarray([0, 6, 6, 12, len(raw)]))
    assert document.tolist() == [0, 2, 3, 3, 3] and sizes.sum() == len(buckets)
    alone = toxicity.windows(np.frombuffer(b"abc de", np.uint8), np.asarray([0, 6]))
    assert sorted(alone[0]) == sorted(buckets[: sizes[0]])


def test_quality_learns_from_document_labels(docs, labels, odd, nothing):
    model = quality_model.fit(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_model.score(docs, model).collect()
    judged = [r for r in got if r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in judged) / len(judged) > 0.95
    assert len(quality_model.score(odd, model).collect()) == len(ODD) and quality_model.score(nothing, model).count() == 0


def test_attention_gradient_points_downhill():
    """Training lowers the loss on bags whose label hangs on one passage of many."""
    rng = np.random.default_rng(1)
    features = rng.normal(0, 1, (400, quality_model.FEATURES))
    document = np.repeat(np.arange(80), 5)
    labels = (np.arange(80) % 2).astype(float)
    features[::5, 0] += 6 * labels
    model = quality_model.train(features, document, labels)
    found = model.forward(features, np.arange(0, 400, 5))
    assert ((found["p"] > 0.5) == (labels == 1)).mean() > 0.95
    assert np.allclose(np.add.reduceat(found["a"], np.arange(0, 400, 5)), 1)


def plain_katz(rows, size):
    """Scores by the definition, and the probability of every class after a few contexts."""
    tokens = [WORD.findall((text or "").translate(LOW)) + [None] for _, text in rows]
    train = [t for (i, _), t in zip(rows, tokens) if fold(i, 7) != 2]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    ranked = [w for w, _ in c.most_common() if w is not None]
    frequent = {None, *ranked[: size - 1]} if v > size else set(c)
    of = lambda w: w if w in frequent else "<rare>"
    pairs, classes = Counter(), Counter()
    for t in train:
        s = ["<s>", *map(of, t)]
        pairs.update(zip(s, s[1:]))
        classes.update(s[1:])
    shape = Counter(pairs.values())
    factors = katz.good_turing([shape[r] for r in range(katz.GT_MAX + 3)])
    d = lambda r: factors[min(r, katz.GT_MAX + 1)]
    known = [*frequent, "<rare>"]
    p1 = {w: (classes[w] + 1) / (sum(classes.values()) + len(known)) for w in known}
    after = defaultdict(dict)
    for (a, b), r in pairs.items():
        after[a][b] = r

    def bigram(a, b):
        seen = after.get(a)
        if not seen:
            return p1[b]
        total, mass, left = sum(seen.values()), sum(r * d(r) for r in seen.values()), 1 - sum(p1[w] for w in seen)
        divisor = mass if left < 1e-9 else total if total - mass > 1e-9 else mass + 1
        return seen[b] * d(seen[b]) / divisor if b in seen else (1 - mass / divisor) / left * p1[b]

    rare = n - sum(c[w] for w in frequent) + v - len(frequent) + 1
    out = []
    for (i, _), t in zip(rows, tokens):
        s = ["<s>", *map(of, t)]
        logs = [math.log10(bigram(a, b)) for a, b in zip(s, s[1:])]
        logs += [math.log10((c[w] + 1) / rare) for w in t if w not in frequent]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        out.append((i, fold(i, 7) == 2, len(t), sum(c[w] > 0 for w in t), n, base, sum(logs)))
    sums = [sum(bigram(a, b) for b in known) for a in [*list(after)[:5], "<s>"]]
    return sorted(out), sums


def untied(rows, least):
    """A vocabulary size at which no count is tied."""
    c = Counter(w for i, text in rows if fold(i, 7) != 2 for w in WORD.findall((text or "").translate(LOW)))
    counts = [n for _, n in c.most_common()]
    return next((k + 1 for k in range(least, len(counts)) if counts[k - 1] > counts[k]), len(counts) + 10)


@pytest.mark.parametrize("which, least, part_tokens", [("docs", 300, 5000), ("odd", 40, 50), ("few", 5, 10**6)])
def test_katz_equals_the_definition(spark, docs, odd, which, least, part_tokens):
    few = [row(i, f"a b c a b {'d' * (i % 3)} e") for i in range(30)]
    given = {"docs": docs, "odd": odd, "few": spark.createDataFrame(few, odd.schema)}[which]
    rows = [(r.doc_id, r.text) for r in given.collect()]
    size = untied(rows, least)
    expected, sums = plain_katz(rows, size)
    got = sorted(tuple(r) for r in katz.score(given, size, part_tokens).collect())
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9, atol=1e-9)
    assert np.allclose(sums, 1)


@pytest.mark.parametrize("which, frequent, part_tokens", [("docs", 300, 5000), ("odd", 5, 50), ("few", 2, 10**6), ("docs", 65_000, 10**6)])
def test_katz_counts_the_bigrams_of_every_word(spark, docs, odd, which, frequent, part_tokens):
    few = [row(i, f"a b c a b {'d' * (i % 3)} e x{i % 5} y{i % 4} z{i}") for i in range(30)]
    given = {"docs": docs, "odd": odd, "few": spark.createDataFrame(few, odd.schema)}[which]
    expected, sums = plain_katz([(r.doc_id, r.text) for r in given.collect()], 10**9)
    got = sorted(tuple(r) for r in katz.score(given, part_tokens=part_tokens, frequent=frequent).collect())
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9, atol=1e-9)
    assert np.allclose(sums, 1)


def test_katz_without_training_texts(spark, odd, nothing):
    held = next(i for i in range(100) if fold(i, 7) == 2)
    got = katz.score(spark.createDataFrame([row(held, "a b"), row(held, None)], odd.schema)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 0, 0, 0, 0), (3, 0, 0, 0, 0)]
    assert katz.score(nothing).count() == 0


def test_words_by_bytes_equal_the_pattern():
    values = ["", "a b", "\x0b\x0c x \x1cy\x85 é ", "\n\n", "A" * 3000, "q " * 700, "x"]
    raw, offsets = texts.string_bytes(pa.array(values))
    words = texts.Words(raw, offsets)
    found = [raw[a:b].tobytes().decode() for a, b in zip(words.start, words.end)]
    assert found == [w for v in values for w in WORD.findall(v)]
    assert np.diff(words.bounds).tolist() == [len(WORD.findall(v)) for v in values]
    alone = [texts.Words(*texts.string_bytes(pa.array([w]))).hashes()[0] for w in found]
    assert words.hashes().tolist() == [int(h) for h in alone] and len(set(alone)) == len(set(found))


def test_pipeline_stages(spark, odd, nothing, labels, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near-dedup", "packing"]
    for given, ids in ((odd, {7}), (nothing, set())):
        docs = given
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            kept = stage(spark, docs, folder)
            assert kept.dtypes == docs.dtypes
            docs = kept
        assert {r.doc_id for r in docs.collect()} == ids
        assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()} == ids


def test_pipeline_runs_and_queries_are_registered(spark, folder):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    packed = corpus_pipeline.run(spark, folder)
    all_docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = packed.select("doc_id").distinct()
    assert 0 < ids.count() < all_docs.count() and ids.join(all_docs, "doc_id", "left_anti").count() == 0


def test_toxicity_gives_the_drivers_memory_back(docs, labels, monkeypatch):
    made, held, train = [], [], toxicity.train

    def watched(grams, *more):
        made.append(weakref.ref(grams))
        return train(grams, *more)

    monkeypatch.setattr(toxicity, "train", watched)
    monkeypatch.setattr(toxicity.texts, "release", lambda: held.append([x() is not None for x in made]))
    toxicity.fit(docs, labels, 20)
    assert held == [[False]]
