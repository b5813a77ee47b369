"""Toxicity from character n-grams: averaged subword embeddings under a linear softmax, trained in numpy.

A window of words is the mean of the vectors of its character n-grams, and a two-class softmax reads that mean;
vectors and softmax are trained together. Unseen spellings share n-grams with seen ones. A document scores as
its most toxic window, since a few words in a long text suffice. Training looks at windows too: it starts with
each window under its document's label, then keeps, of a toxic document, only the windows that it finds toxic.

The model is fitted on every window of a bounded sample of labelled documents (``SAMPLE`` of each label, with
``SAMPLE_BYTES`` of text at most). Scoring reads every window of every text.

Defined cases: a null or empty text scores as a window without n-grams does; only labels 0 and 1 are learnt
from, and without any of one of them every score is that of the bias; repeated rows score alike; a null doc_id
is not held out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.session import ship_package

SIZES = (3, 4, 5)
BUCKET_BITS = 18
WIDTH = 8
WINDOW_WORDS = 6
#: Rounds of training on deciding windows, and the step of the gradient.
TURNS, RATE = 12, 0.02
#: Labelled documents of each label that the model is fitted on at most, and bytes of their texts.
SAMPLE, SAMPLE_BYTES = 800, 8 << 20
THRESHOLD = 0.7


def windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some documents, the first n-gram of each window, and each document's windows.

    Returns (buckets, where each window's n-grams begin, the document of each window, n-grams per window).
    """
    count = len(offsets) - 1
    spaced = np.insert(texts.LOWER[raw], np.append(offsets, len(raw))[:-1], 0x20)
    spaced = np.append(spaced, np.uint8(0x20))
    blank = texts.SPACE[spaced]
    spaced[blank] = 0x20
    word_start = np.flatnonzero(blank[:-1] & ~blank[1:])
    borders = offsets + np.arange(count + 1)
    first = np.searchsorted(word_start, borders)
    words = np.diff(first)
    per_document = -(-words // WINDOW_WORDS)
    document = np.repeat(np.arange(count), per_document)
    nth = np.arange(len(document)) - np.repeat(np.cumsum(per_document) - per_document, per_document)
    opens = word_start[first[document] + nth * WINDOW_WORDS] if len(document) else np.zeros(0, np.int64)

    found, places = [], []
    code = spaced.astype(np.uint32)
    base = np.uint32(0x01000193)
    rolled, free = code, np.ones(len(code), bool)
    for size in range(2, max(SIZES) + 1):
        if len(rolled) < 2:
            break
        rolled = rolled[:-1] * base + code[size - 1 :] + np.uint32(1)
        if size > 2:
            free = free[:-1] & ~blank[size - 2 : len(blank) - 1]
        else:
            free = free[:-1]
        if size in SIZES:
            at = np.flatnonzero(free)
            mixed = rolled[at] * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            found.append((mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKET_BITS))
            places.append(at)
    window_of = [np.searchsorted(opens, at, "right") - 1 for at in places]
    order = np.argsort(np.concatenate([*window_of, np.zeros(0, np.int64)]), kind="stable")
    window = np.concatenate([*window_of, np.zeros(0, np.int64)])[order]
    buckets = np.concatenate([*found, np.zeros(0, np.uint32)])[order]
    return buckets, np.searchsorted(window, np.arange(len(opens))), document, np.bincount(window, minlength=len(opens))


@dataclass
class Model:
    """What scoring needs: a number for each bucket, the bias, and the score of an empty window."""

    weights: np.ndarray
    bias: float

    def window_scores(self, buckets: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        means = np.zeros(len(begins))
        for at in range(0, len(begins), 8192):  # bounds what is held at once
            some = slice(at, at + 8192)
            first, ends = begins[some][0], begins[some] + sizes[some]
            sums = np.concatenate([[0.0], np.cumsum(self.weights[buckets[first : ends.max()]], dtype=np.float64)])
            means[some] = (sums[ends - first] - sums[begins[some] - first]) / np.maximum(sizes[some], 1)
        return 1 / (1 + np.exp(-(means + self.bias)))

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The score of each document: that of its most toxic window."""
        out = np.full(len(offsets) - 1, 1 / (1 + np.exp(-self.bias)))
        most = np.zeros(len(out))
        for first, last in texts.chunks(offsets, texts.CHUNK // 4):  # n-grams take a multiple of the text
            part = raw[offsets[first] : offsets[last]]
            buckets, begins, document, sizes = windows(part, offsets[first : last + 1] - offsets[first])
            np.maximum.at(most, document + first, self.window_scores(buckets, begins, sizes))
        return np.where(most > 0, most, out)


def train(grams: np.ndarray, sizes: np.ndarray, owner: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Fit vectors and softmax on the n-grams of windows in a row, each window's size and document.

    Each turn fades the vectors a little, so that what a turn does not confirm is forgotten, and takes the
    deciding windows of toxic documents, the most toxic windows of clean documents and some others.
    """
    rng = np.random.default_rng(seed)
    filled = sizes > 0
    owner, target = owner[filled], labels[owner[filled]]
    if len(set(target.tolist())) < 2:
        bias = 0.0 if not len(target) else 6.0 * float(target[0]) - 3.0
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), bias)
    begins, sizes = (np.cumsum(sizes) - sizes)[filled], sizes[filled]
    vectors = rng.normal(0, 0.01, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 0.7, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)

    def current() -> Model:
        return Model(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))

    def epoch(chosen: np.ndarray) -> None:
        nonlocal softmax, bias
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), 64):
            rows = chosen[at : at + 64]
            size = sizes[rows]
            ends = np.cumsum(size)
            own = grams[np.repeat(begins[rows] - (ends - size), size) + np.arange(ends[-1])]
            mean = np.add.reduceat(vectors[own], ends - size, axis=0) / size[:, None]
            logits = mean @ softmax + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), target[rows]] -= 1
            p = p.astype(np.float32)
            back = p @ softmax.T
            softmax -= 0.02 * RATE * (mean.T @ p)
            bias -= 0.02 * RATE * p.sum(axis=0)
            np.add.at(vectors, own, -RATE * np.repeat(back, size, axis=0))

    toxic, clean = np.flatnonzero(target == 1), np.flatnonzero(target == 0)
    epoch(np.arange(len(sizes)))
    pairs = min(len(set(owner[toxic])), len(set(owner[clean])))
    share = min(1.0, pairs / 600)  # fewer documents take more and gentler turns
    for _ in range(round(TURNS / max(share, 0.1))):
        scores = current().window_scores(grams, begins, sizes)
        top = np.zeros(len(labels))
        np.maximum.at(top, owner, scores)
        deciding = toxic[scores[toxic] >= 0.9 * top[owner[toxic]]]
        hardest = clean[np.argsort(-scores[clean], kind="stable")[: 8 * pairs]]
        vectors *= 0.9**share
        epoch(np.concatenate([deciding, deciding, hardest, rng.permutation(clean)[: 8 * pairs]]))
    return current()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on documents of the folds that are not held out; the sample is the first by hash of each label."""
    model = _fitted(docs, labels, sample)
    texts.release()  # the driver lives on, too
    return model


def _fitted(docs: DataFrame, labels: DataFrame, sample: int) -> Model:
    rows = texts.labelled(docs, labels, "toxic", sample, SAMPLE_BYTES)

    def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = texts.string_bytes(batch["text"])
        ids, label, lists = batch["doc_id"].to_pylist(), batch["label"].to_pylist(), []
        for k in range(len(ids)):
            part = raw[offsets[k] : offsets[k + 1]]
            buckets, begins, _, sizes = windows(part, np.asarray([0, len(part)]))
            lists.append([buckets[first : first + size].astype(np.int32) for first, size in zip(begins, sizes, strict=True)])
        return texts.table(
            None,
            {
                "doc_id": pa.array(ids, pa.int64()),
                "label": pa.array(label, pa.int32()),
                "windows": pa.array(lists, pa.list_(pa.list_(pa.int32()))),
            },
        )

    found = texts.per_batch(rows, grams, "doc_id long, label int, windows array<array<int>>").toArrow()
    found = found.sort_by([("doc_id", "ascending")])
    lists = found["windows"].combine_chunks()
    per_document = lists.value_lengths().to_numpy(zero_copy_only=False)
    inner = lists.flatten()
    sizes = inner.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(lists)), per_document)
    return train(inner.flatten().to_numpy(), sizes, owner, found["label"].to_numpy().astype(int))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and verdict of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = model.scores(*texts.string_bytes(batch["text"]))
        columns = {
            "doc_id": batch["doc_id"],
            "held_out": batch["held_out"],
            "score": pa.array(points, pa.float64()),
            "predicted": pa.array((points >= threshold).astype(np.int32)),
        }
        return texts.table(None, columns)

    rows = texts.ids_and_texts(docs, F.coalesce(texts.remainder(3) == 1, F.lit(False)).alias("held_out"))
    return texts.per_batch(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that score below the threshold."""

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            points = model.scores(*texts.string_bytes(text.cast(pa.string())))
            yield batch.filter(pa.array(points < threshold))
        texts.release()

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
