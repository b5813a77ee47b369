"""Quality by attention-based multiple-instance learning, trained in numpy.

A document is a bag of passages. Each passage is encoded from its byte and word statistics, gated attention
(tanh times sigmoid) weighs the passages, and the weighted mean of the encodings gives the score. All weights
are learnt from labels of whole documents. Scoring reads every passage of every text.

The model is fitted on every passage of a bounded sample: ``SAMPLE`` documents of each label, with
``SAMPLE_BYTES`` of text at most.

Defined cases: a null or empty text is one passage without words; only labels 0 and 1 are learnt from, and
without any of one of them all scores are alike; repeated rows score alike; a null doc_id is not held out; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawarden.llm import texts

PASSAGE_WORDS = 48
SAMPLE, SAMPLE_BYTES = 1500, 16 << 20
HIDDEN, GATE = 16, 8
STEPS, BATCH, RATE = 600, 128, 0.01
THRESHOLD = 0.5

#: Byte classes whose share of a passage is a feature.
CLASSES = [
    bytes(range(65, 91)),
    bytes(range(97, 123)),
    b"0123456789",
    b"!?",
    b".",
    b",;:",
    b"|",
    b"#*$%&<>",
    b"\n",
    b"\"'()[]{}-_/\\@=+~^`",
    bytes(range(128, 256)),
]
_CLASS = np.full(256, len(CLASSES), np.int64)
for _k, _bytes in enumerate(CLASSES):
    _CLASS[list(_bytes)] = _k
FEATURES = len(CLASSES) + 6


def passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some documents, and the document of each passage."""
    count = len(offsets) - 1
    words = texts.Words(raw, offsets)
    per_document = np.maximum(-(-np.diff(words.bounds) // PASSAGE_WORDS), 1)
    document = np.repeat(np.arange(count), per_document)
    nth = np.arange(len(document)) - np.repeat(np.cumsum(per_document) - per_document, per_document)
    first = words.bounds[document] + nth * PASSAGE_WORDS
    last = np.minimum(first + PASSAGE_WORDS, words.bounds[document + 1])
    starts = np.append(words.start, len(raw))
    begin = np.where(nth == 0, offsets[document], starts[np.minimum(first, len(words))])
    is_last = nth == per_document[document] - 1
    end = np.where(is_last, offsets[document + 1], starts[np.minimum(last, len(words))])

    features = np.zeros((len(document), FEATURES))
    length = np.maximum(end - begin, 1)
    kinds = _CLASS[raw]
    for k in range(len(CLASSES)):
        sums = np.concatenate([[0], np.cumsum(kinds == k)])
        features[:, k] = (sums[end] - sums[begin]) / length
    hashes = words.hashes()
    size = last - first
    passage = np.repeat(np.arange(len(document)), size)
    distinct = np.unique(texts.mix(hashes ^ texts.mix(passage.astype(np.uint64))), return_index=True)[1]
    same = np.concatenate([[0], hashes[1:] == hashes[:-1]]) if len(hashes) else np.zeros(0)
    some = np.maximum(size, 1)
    lengths = words.end - words.start
    at = len(CLASSES)
    features[:, at] = np.bincount(passage[distinct], minlength=len(document)) / some
    features[:, at + 1] = np.bincount(passage, same, len(document)) / some
    features[:, at + 2] = np.bincount(passage, lengths, len(document)) / some / 10
    features[:, at + 3] = np.bincount(passage, lengths == 1, len(document)) / some
    features[:, at + 4] = np.log1p(size) / np.log1p(PASSAGE_WORDS)
    features[:, at + 5] = np.log1p(np.diff(words.bounds))[document] / 10
    return features, document


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags of passages in a row, with what the gradient needs."""
        w = self.weights
        x = (features - self.mean) / self.spread
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, s = np.tanh(h @ w["look"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * s) @ w["attend"]
        sizes = np.diff(np.append(begins, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), sizes))
        a = e / np.repeat(np.add.reduceat(e, begins), sizes)
        z = np.add.reduceat(a[:, None] * h, begins)
        p = 1 / (1 + np.exp(-np.clip(z @ w["score"] + w["score_bias"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "p": p, "sizes": sizes}

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = []
        for first, last in texts.chunks(offsets):
            part = raw[offsets[first] : offsets[last]]
            features, document = passages(part, offsets[first : last + 1] - offsets[first])
            out.append(self.forward(features, np.searchsorted(document, np.arange(last - first)))["p"])
        return np.concatenate(out) if out else np.zeros(0)


def train(features: np.ndarray, document: np.ndarray, labels: np.ndarray, seed: int = 11) -> Model:
    """Fit encoder, attention and score together by Adam on the labels of documents."""
    rng = np.random.default_rng(seed)
    shapes = {
        "encode": (FEATURES, HIDDEN),
        "encode_bias": (HIDDEN,),
        "look": (HIDDEN, GATE),
        "gate": (HIDDEN, GATE),
        "attend": (GATE,),
        "score": (HIDDEN,),
        "score_bias": (),
    }
    weights = {name: np.asarray(rng.normal(0, 0.3, shape)) for name, shape in shapes.items()}
    spread = features.std(axis=0) if len(features) else np.ones(FEATURES)
    mean = features.mean(axis=0) if len(features) else np.zeros(FEATURES)
    model = Model(mean, np.where(spread > 1e-6, spread, 1.0), weights)
    if len(set(labels.tolist())) < 2:
        weights["score"] = np.zeros(HIDDEN)
        weights["score_bias"] = np.asarray(0.0 if not len(labels) else 6.0 * labels[0] - 3.0)
        return model
    begins = np.searchsorted(document, np.arange(len(labels)))
    ends = np.append(begins[1:], len(document))
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    moments = {name: [np.zeros(shape), np.zeros(shape)] for name, shape in shapes.items()}
    for step in range(1, STEPS + 1):
        bags = rng.choice(len(labels), min(BATCH, len(labels)), replace=False)
        rows = np.concatenate([np.arange(begins[b], ends[b]) for b in bags])
        sizes = ends[bags] - begins[bags]
        f = model.forward(features[rows], np.cumsum(sizes) - sizes)
        d = balance[bags] * (f["p"] - labels[bags]) / len(bags)
        dz = d[:, None] * weights["score"]
        row_dz = np.repeat(dz, sizes, axis=0)
        da = (row_dz * f["h"]).sum(axis=1)
        starts = np.cumsum(sizes) - sizes
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), sizes))
        du = de[:, None] * weights["attend"]
        dt, ds = du * f["s"] * (1 - f["t"] ** 2), du * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * row_dz + dt @ weights["look"].T + ds @ weights["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        gradients = {
            "encode": f["x"].T @ dx,
            "encode_bias": dx.sum(axis=0),
            "look": f["h"].T @ dt,
            "gate": f["h"].T @ ds,
            "attend": (f["t"] * f["s"]).T @ de,
            "score": f["z"].T @ d,
            "score_bias": d.sum(),
        }
        for name, gradient in gradients.items():
            first, second = moments[name]
            gradient = gradient + 1e-4 * weights[name]
            first[...] = 0.9 * first + 0.1 * gradient
            second[...] = 0.999 * second + 0.001 * gradient**2
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * (1 - 0.9 * step / STEPS)
            weights[name] = weights[name] - rate * first / (np.sqrt(second) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on documents of the folds that are not held out; the sample is the first by hash of each label."""
    rows = texts.labelled(docs, labels, "quality", sample, SAMPLE_BYTES)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = texts.string_bytes(batch["text"])
        lists = []
        for k in range(batch.num_rows):
            features, _ = passages(raw[offsets[k] : offsets[k + 1]], np.asarray([0, offsets[k + 1] - offsets[k]]))
            lists.append(features.ravel())
        columns = {"doc_id": batch["doc_id"], "label": batch["label"], "features": pa.array(lists, pa.list_(pa.float64()))}
        return texts.table(None, columns)

    found = texts.per_batch(rows, run, "doc_id long, label int, features array<double>").toArrow()
    found = found.sort_by([("doc_id", "ascending")])
    lists = found["features"].combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False) // FEATURES
    features = lists.flatten().to_numpy().reshape(-1, FEATURES)
    return train(features, np.repeat(np.arange(len(sizes)), sizes), found["label"].to_numpy().astype(float))


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
