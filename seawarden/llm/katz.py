"""Katz backoff language model: training and scoring as two shuffles of n-gram counts.

Tokens are words with A-Z lower-cased, then one end token per text. Every training word counts, as context and as
target; words that training does not hold share one add-one count. The bigram is Katz: counts up to ``GT_MAX`` are
discounted by Good-Turing, and what the discounts leave of a context goes to the words never seen after it, in
proportion to their unigram probability. The backoff weight of a context is its left mass over the unigram mass of
those words, so every context sums to one.

Three passes over the texts, none of which gathers a group in one task or a vocabulary on the driver:

1. Training counts of all words (pre-aggregated in each task). The ``VOCABULARY`` most frequent get a number and are
   broadcast; all others are rare and known by hash.
2. Bigram counts by hash partition, stored as one table of arrays: by both numbers if both words are frequent, by the
   target if it is rare, else by the rare context. From it come the counts of counts, and for each frequent context
   its total and backoff weight. Bigrams with a share of at least 1 / ``HOT`` of all tokens (at most ``HOT`` of them)
   are broadcast. Bigrams of two rare words then go on, with their target's count, to the context's partition, which
   has all that follows a rare context and so its total and backoff weight.
3. Each text's hot bigrams and frequent words are scored where the text is read. The other tokens travel to the
   partitions that hold their counts, where they become sums per text, which are added up. A block of text sends
   rows only to partitions it has tokens for, so rows and sums never outnumber tokens.

Rare words and their bigrams are known by 64-bit hash, bigrams of frequent words by a pair of numbers.

With a given ``size``, all words but the ``size`` most frequent share one class, and bigrams are those of classes:

    P(word | previous) = P(class(word) | class(previous)) * P(word | class(word))

Defined cases: a null or empty text is the end token alone; without training texts every probability is 1;
repeated rows each count and each get a score; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.session import shared_folder, ship_package

#: Words that are broadcast with a number; numbers fit 16 bits.
VOCABULARY = 65_000
GT_MAX = 5
HOT = 100_000
#: Tokens in a partition of the count tables, and bytes of text worked on at once, about.
PART_TOKENS, PART_BYTES = 3_000_000, 8 << 20
END = np.uint64(0x454E44)
#: Bigrams with a rare word in the count table: the hash they are dealt by, the other word, and their count.
RARE_PAIRS = {
    "to_rare": ("to_words", "to_classes", "to_counts"),
    "from_rare": ("from_words", "from_classes", "from_counts"),
    "both_rare": ("both_words", "both_contexts", "both_counts"),
}
U64 = np.uint64


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of some documents in a row, each ending with the end token, and where each begins."""
    words, counts = [], []
    for first, last in texts.chunks(offsets):
        part = texts.Words(
            texts.LOWER[raw[offsets[first] : offsets[last]]], offsets[first : last + 1] - offsets[first]
        )
        words.append(np.insert(part.hashes(), part.bounds[1:], END))
        counts.append(np.diff(part.bounds) + 1)
    counts = np.concatenate([np.zeros(1, np.int64), *counts])
    return np.concatenate([*words, np.zeros(0, U64)]), np.cumsum(counts)


@dataclass
class Vocabulary:
    """Sorted hashes of the frequent words with their training counts, and the totals of the training texts.

    ``shared`` says that all other words are one class; else each is its own.
    """

    words: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    shared: bool = False

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def opening(self) -> int:
        return len(self.words) + 1

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, self.rare)

    def pairs(self, hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Context and class of each token as one number of 32 bits."""
        own = self.classes(hashes)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[begins] = self.opening
        return (before << 16 | own).astype(np.uint32)

    def unigrams(self) -> np.ndarray:
        """Add-one probability of each class; the last is that of rare words, or of one unknown word."""
        if not self.shared:
            return (np.append(self.counts, 0) + 1) / self.divisor
        counts = np.append(self.counts, self.total - self.counts.sum())
        return (counts + 1) / (counts.sum() + len(counts))

    @property
    def divisor(self) -> int:
        """What an add-one count is divided by to give a word's unigram probability."""
        return self.total + self.distinct + 1

    def rare_words(self) -> float:
        """What an add-one count is divided by to give a rare word's share of its class."""
        return float(self.total - self.counts.sum() + self.distinct - len(self.words) + 1)


def _bigram(word: np.ndarray, other: np.ndarray) -> np.ndarray:
    """One 64-bit key for two words, given by hash or number."""
    return texts.mix(word.astype(U64) * U64(3) + texts.mix(other.astype(U64)))


def _partition(keys: np.ndarray, parts: int) -> np.ndarray:
    return (texts.mix(keys.astype(U64)) % U64(parts)).astype(np.int64)


def _split(part: np.ndarray, wanted: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """For each wanted partition, its number and the columns' rows."""
    order = np.argsort(part, kind="stable")
    begins, ends = (np.searchsorted(part[order], wanted, side) for side in ("left", "right"))
    columns = tuple(column[order] for column in columns)
    for p, first, last in zip(wanted.tolist(), begins, ends, strict=True):
        yield p, *(column[first:last] for column in columns)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind, safe=False))


def _flat(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _batches(docs: DataFrame, function, schema: str) -> DataFrame:
    """Apply ``function`` (raw, offsets, doc ids, held-out flags, number) to parts of the texts a task reads."""

    def run(batches):
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 24
        for batch in batches:
            raw, offsets = texts.string_bytes(batch["text"])
            held = batch["held_out"].to_numpy(zero_copy_only=False).astype(bool)
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for first, last in texts.chunks(offsets, PART_BYTES):
                part, own = raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                out = function(part, own, ids[first:last], held[first:last], number)
                number += 1
                if out.num_rows:
                    yield out
                del out
                texts.release()

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash) and c: its count in the training texts."""

    def run(raw, offsets, ids, held, number):
        hashes, begins = tokens(raw, offsets)
        learnt = np.repeat(~held, np.diff(begins))
        words, counts = np.unique(hashes[learnt], return_counts=True)
        return texts.table(None, {"word": pa.array(words.view(np.int64)), "c": pa.array(counts)})

    return _batches(docs, run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, size: int = VOCABULARY, shared: bool = False) -> Vocabulary:
    """The most frequent words (the end token always, ties by hash) and the totals."""
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    is_end = (F.col("word") == int(END)).desc()
    top = counts.orderBy(is_end, F.col("c").desc(), "word").limit(size).toArrow()
    words = top["word"].to_numpy().view(U64)
    order = np.argsort(words)
    return Vocabulary(words[order], top["c"].to_numpy()[order], int(sums[0] or 0), int(sums[1]), shared)


_RARE_TABLE = ", ".join(f"{name} array<long>" for names in RARE_PAIRS.values() for name in names)
TABLE = f"p long, words array<long>, word_counts array<long>, pairs array<long>, pair_counts array<long>, {_RARE_TABLE}"


def count_table(docs: DataFrame, known: Vocabulary, parts: int) -> DataFrame:
    """The training counts: one row per partition with bigrams and their counts.

    Bigrams of frequent words (of classes, if rare words share one) are sorted, as are rare words, which are counted
    apart only if they share a class: else they are the targets of their bigrams.
    """
    kinds = {"words": pa.int64(), "word_counts": pa.int32(), "pairs": pa.int32(), "pair_counts": pa.int32()}
    for name in (name for names in RARE_PAIRS.values() for name in names):
        kinds[name] = pa.int32() if name.endswith(("_classes", "_counts")) else pa.int64()

    def run(raw, offsets, ids, held, number):
        hashes, begins = tokens(raw, offsets)
        learnt = np.repeat(~held, np.diff(begins))
        all_pairs = known.pairs(hashes, begins[:-1])
        before, own = (all_pairs >> np.uint32(16)).astype(np.int64), (all_pairs & np.uint32(0xFFFF)).astype(np.int64)
        to_rare, from_rare = own == known.rare, before == known.rare
        rare = hashes[learnt & to_rare & known.shared]
        words, word_counts = np.unique(rare, return_counts=True)
        numbered = learnt if known.shared else learnt & ~to_rare & ~from_rare
        pairs, pair_counts = np.unique(all_pairs[numbered], return_counts=True)
        dealt = {
            ("words", "word_counts"): (words, (words.view(np.int64), word_counts)),
            ("pairs", "pair_counts"): (pairs, (pairs.view(np.int32), pair_counts)),
        }
        context = np.roll(hashes, 1)
        alone = learnt & (not known.shared)
        found = {
            "to_rare": (alone & to_rare & ~from_rare, hashes, before),
            "from_rare": (alone & from_rare & ~to_rare, context, own),
            "both_rare": (alone & from_rare & to_rare, hashes, context.view(np.int64)),
        }
        for kind, (at, by, other) in found.items():
            by, other = by[at], other[at]
            _, first, counts = np.unique(_bigram(by, other), return_index=True, return_counts=True)
            dealt[RARE_PAIRS[kind]] = (by[first], (by[first].view(np.int64), other[first], counts))
        of_key = {names: _partition(by, parts) for names, (by, _) in dealt.items()}
        wanted = np.unique(np.concatenate(list(of_key.values())))
        columns = {"p": pa.array(wanted)}
        for names, (_, values) in dealt.items():
            split = list(_split(of_key[names], wanted, *values))
            for k, name in enumerate(names, 1):
                columns[name] = _lists([row[k] for row in split], kinds[name])
        return texts.table(None, columns)

    sent = "p long"
    for name, kind in kinds.items():
        sent += f", {name} array<{'int' if kind == pa.int32() else 'long'}>"

    def merge(group: pa.Table) -> pa.Table:
        texts.release()
        columns = {"p": pa.array([group["p"][0].as_py()], pa.int64())}
        for name, count in (("words", "word_counts"), ("pairs", "pair_counts")):
            keys = _flat(group[name], np.int64)
            keys = keys.view(U64) if name == "words" else (keys & 0xFFFFFFFF).view(U64)
            distinct, place = np.unique(keys, return_inverse=True)
            sums = np.bincount(place, _flat(group[count], np.float64), len(distinct)).astype(np.int64)
            columns[name] = _lists([distinct.view(np.int64)], pa.int64())
            columns[count] = _lists([sums], pa.int64())
        for word, other, count in RARE_PAIRS.values():
            dealt, others = _flat(group[word], np.int64), _flat(group[other], np.int64)
            distinct, first, place = np.unique(_bigram(dealt, others), return_index=True, return_inverse=True)
            sums = np.bincount(place, _flat(group[count], np.float64), len(distinct)).astype(np.int64)
            for name, values in ((word, dealt[first]), (other, others[first]), (count, sums)):
                columns[name] = _lists([values], pa.int64())
        return pa.table(columns)

    return _batches(docs, run, sent).groupBy("p").applyInArrow(merge, TABLE)


def _rare_words(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of a partition's rare words and their counts: those counted apart and the targets of bigrams."""
    words = [_flat(table[name], np.int64) for name in ("words", "to_words", "both_words")]
    counts = [_flat(table[name], np.float64) for name in ("word_counts", "to_counts", "both_counts")]
    distinct, place = np.unique(np.concatenate(words).view(U64), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


MOVED = "moved_words array<long>, moved_targets array<long>, moved_counts array<long>, moved_target_counts array<long>"


def at_contexts(counts: DataFrame, parts: int) -> DataFrame:
    """The bigrams of two rare words for the partitions of their contexts, with the counts of their targets."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            words, word_counts = _rare_words(row)
            target, context, count = (_flat(row[name], np.int64) for name in RARE_PAIRS["both_rare"])
            of_target = _look_up(words, word_counts, target.view(U64))
            part = _partition(context.view(U64), parts)
            rows += _split(part, np.unique(part), context, target, count, of_target)
        columns = {"p": pa.array([row[0] for row in rows], pa.int64())}
        for k, name in enumerate((part.split()[0] for part in MOVED.split(", ")), 1):
            columns[name] = _lists([row[k] for row in rows], pa.int64())
        return texts.table(None, columns)

    narrow = counts.select("words", "word_counts", "to_words", "to_counts", *RARE_PAIRS["both_rare"])
    return texts.per_batch(narrow, run, f"p long, {MOVED}")


@dataclass
class Model:
    """What scoring needs besides the count table: all of bounded size."""

    known: Vocabulary
    discounts: np.ndarray
    totals: np.ndarray
    log_backoff: np.ndarray
    hot_pairs: np.ndarray
    hot_counts: np.ndarray

    def log_pairs(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of the class probability of each bigram, given its training count."""
        context, own = pairs >> 16, pairs & 0xFFFF
        discounted = counts * self.discounts[np.minimum(counts, GT_MAX + 1)]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log10(discounted) - np.log10(self.totals[context])
            unseen = self.log_backoff[context] + np.log10(self.known.unigrams())[own]
        return np.where(counts > 0, seen, unseen)


def good_turing(counts_of_counts: np.ndarray, most: int = GT_MAX) -> np.ndarray:
    """The factor for each count from 0 to most + 1; counts above ``most`` keep 1.

    Katz's form, which keeps the total. Where the counts of counts are too few for factors between 0 and 1,
    half a count is taken off instead.
    """
    n = np.asarray(counts_of_counts, float)
    factors = np.ones(most + 2)
    r = np.arange(1, most + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        tail = (most + 1) * n[most + 1] / n[1]
        found = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
    usable = np.all(np.isfinite(found)) and np.all((found > 0) & (found < 1))
    factors[1 : most + 1] = found if usable else (r - 0.5) / r
    return factors


def backoff(totals: np.ndarray, masses: np.ndarray, unigram_masses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context, what discounted counts are divided by, and log10 of its backoff weight.

    Without any discount one count is set aside for unseen classes. If no class is unseen, nothing is.
    """
    left = np.maximum(1 - unigram_masses, 0)
    nothing_unseen = left < 1e-9
    divisor = np.where(totals - masses > 1e-9, totals, masses + 1)
    divisor = np.where(nothing_unseen, masses, divisor)
    divisor = np.where(totals > 0, divisor, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.log10((1 - masses / divisor) / np.where(nothing_unseen, 1, left))
    return divisor, np.where(totals > 0, weight, 0.0)


def fit(counts: DataFrame, known: Vocabulary) -> Model:
    """Discounts, backoff weights and hot bigrams from the count table."""

    def shape(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = np.concatenate([_flat(column, np.int64) for column in batch.columns])
        found = np.bincount(np.minimum(counted, GT_MAX + 2), minlength=GT_MAX + 3)
        return texts.table(None, {"r": pa.array(range(len(found)), pa.int64()), "n": pa.array(found)})

    narrow = counts.select("pair_counts", *(names[2] for names in RARE_PAIRS.values()))
    found = texts.per_batch(narrow, shape, "r long, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()
    counts_of_counts = np.zeros(GT_MAX + 3)
    for row in found:
        counts_of_counts[row["r"]] = row["n"]
    discounts, unigrams, total, contexts = good_turing(counts_of_counts), known.unigrams(), known.total, known.rare + 2

    def sums(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs, counted = _flat(batch["pairs"], np.int64), _flat(batch["pair_counts"], np.int64)
        context = pairs >> 16
        kept = counted * discounts[np.minimum(counted, GT_MAX + 1)]
        # without any pair, bincount gives whole numbers even for weights
        columns = [np.bincount(context, w, contexts).astype(float) for w in (counted, kept, unigrams[pairs & 0xFFFF])]
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            words, word_counts = _rare_words(row)
            target, before, n = (_flat(row[name], np.int64) for name in RARE_PAIRS["to_rare"])
            single = (_look_up(words, word_counts, target.view(U64)) + 1) / known.divisor
            for column, w in zip(columns, (n, n * discounts[np.minimum(n, GT_MAX + 1)], single), strict=True):
                column += np.bincount(before, w, contexts)
        at = np.flatnonzero(columns[0])
        hot = counted * HOT >= total
        empty, none = np.zeros(hot.sum()), np.full(len(at), 0)
        return texts.table(
            None,
            {
                "context": pa.array(np.append(at, pairs[hot])),
                "hot": pa.array(np.append(none, counted[hot])),
                "c": pa.array(np.append(columns[0][at], empty)),
                "mass": pa.array(np.append(columns[1][at], empty)),
                "unigram": pa.array(np.append(columns[2][at], empty)),
            },
        )

    schema = "context long, hot long, c double, mass double, unigram double"
    summed = texts.per_batch(counts.drop(*RARE_PAIRS["from_rare"], "both_contexts"), sums, schema).groupBy("context", "hot")
    rows = summed.agg(*(F.sum(name).alias(name) for name in ("c", "mass", "unigram"))).toArrow()
    of_pair = rows["hot"].to_numpy() > 0
    context = rows["context"].to_numpy()
    dense = []
    for name in ("c", "mass", "unigram"):
        column = np.zeros(contexts)
        column[context[~of_pair]] = rows[name].to_numpy()[~of_pair]
        dense.append(column)
    totals, log_backoff = backoff(*dense)
    order = np.argsort(context[of_pair])
    hot_pairs, hot_counts = context[of_pair][order], rows["hot"].to_numpy()[of_pair][order]
    return Model(known, discounts, totals, log_backoff, hot_pairs, hot_counts)


def _look_up(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of the wanted keys in a sorted table, 0 where there are none."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


def score(
    docs: DataFrame, size: int | None = None, part_tokens: int = PART_TOKENS, frequent: int = VOCABULARY
) -> DataFrame:
    """Tokens, known tokens, base score and model score of every document; train on those not held out.

    Every word is its own class, unless ``size`` says how many are; ``frequent`` words at most are broadcast.
    """
    spark = docs.sparkSession
    work = shared_folder(spark, "katz")
    rows = texts.ids_and_texts(docs, F.coalesce(texts.remainder(7) == 2, F.lit(False)).alias("held_out"))
    word_counts(rows).write.parquet(f"{work}/words")
    known = vocabulary(spark.read.parquet(f"{work}/words"), size or frequent, size is not None)
    parts = max(1, -(-known.total // part_tokens))
    count_table(rows, known, parts).write.parquet(f"{work}/counts")
    counts = spark.read.parquet(f"{work}/counts")
    shared = spark.sparkContext.broadcast(fit(counts, known))

    def send(raw, offsets, ids, held, number):
        return _sent(shared.value, raw, offsets, ids, held, number, parts)

    def add(events: pa.Table, table: pa.Table) -> pa.Table:
        texts.release()
        return _added(shared.value, events, table)

    ship_package(spark)
    events = _batches(rows, send, SENT)
    table = counts.unionByName(at_contexts(counts, parts), allowMissingColumns=True)
    added = events.groupBy("p").cogroup(table.groupBy("p")).applyInArrow(add, ADDED)
    return added.groupBy("number").applyInArrow(_summed, SCORED)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
LOCAL = (
    "number long, doc_ids array<long>, held_out array<boolean>, n_tokens array<long>, train_tokens long, "
    "n_known array<long>, base array<double>, score array<double>"
)
SENT = (
    "p long, words array<long>, word_docs array<short>, before array<int>, next array<int>, next_words array<long>, "
    f"pairs array<int>, pair_docs array<short>, {LOCAL}"
)
#: The sums of a partition are those of the texts at ``places`` only.
ADDED = f"{LOCAL}, places array<short>"


def _sent(model: Model, raw, offsets, ids, held, number: int, parts: int) -> pa.RecordBatch:
    """What is known of some texts where they are read, and the events for the partitions that know the rest."""
    known = model.known
    hashes, begins = tokens(raw, offsets)
    size = len(ids)
    document = np.repeat(np.arange(size), np.diff(begins))
    pairs = known.pairs(hashes, begins[:-1])
    own = (pairs & np.uint32(0xFFFF)).astype(np.int64)
    before = (pairs >> np.uint32(16)).astype(np.int64)
    rare = own == known.rare
    after_rare = (before == known.rare) & (not known.shared)
    single = np.log10((np.append(known.counts, 0) + 1) / known.divisor)
    base = np.bincount(document[~rare], single[own[~rare]], size).astype(float)
    hot_counts = _look_up(model.hot_pairs, model.hot_counts, pairs.astype(np.int64))
    hot = hot_counts > 0
    score = np.bincount(document[hot], model.log_pairs(pairs[hot].astype(np.int64), hot_counts[hot]), size).astype(float)
    # after a rare word the partition of that word adds what the bigram makes of the unigram probability
    here = after_rare & ~rare
    score += np.bincount(document[here], single[own[here]], size)
    cold_pair = ~hot if known.shared else ~(hot | rare | after_rare)
    next_class, next_word = np.roll(own, -1), np.roll(hashes, -1)

    rows = []
    for first in range(0, max(size, 1), 32_000):
        last = min(first + 32_000, size)
        at = slice(begins[first], begins[last])
        places = (document[at] - first).astype(np.int16)
        is_rare, cold = rare[at], cold_pair[at]
        words, cold_pairs = hashes[at][is_rare], pairs[at][cold]
        follows = next_class[at][is_rare]
        both = follows == known.rare
        of_word, of_pair = _partition(words, parts), _partition(cold_pairs, parts)
        mine = number * 64 + first // 32_000
        home = mine % parts
        wanted = np.unique(np.concatenate([of_word, of_pair, [home]]))
        by_word = _split(of_word, wanted, words.view(np.int64), places[is_rare], before[at][is_rare], follows)
        by_next = _split(of_word[both], wanted, next_word[at][is_rare][both].view(np.int64))
        by_pair = _split(of_pair, wanted, cold_pairs.view(np.int32), places[cold])
        local = (ids[first:last], held[first:last], np.diff(begins[first : last + 1]))
        local += (np.bincount(places[~is_rare], minlength=last - first), base[first:last], score[first:last])
        none = [np.zeros(0)] * len(local)
        for word, following, pair in zip(by_word, by_next, by_pair, strict=True):
            rows.append((word[0], mine, *word[1:], *following[1:], *pair[1:], *(local if word[0] == home else none)))
    kinds = [pa.int64(), pa.int16(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int16(), pa.int64()]
    kinds += [pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["words", "word_docs", "before", "next", "next_words", "pairs", "pair_docs"]
    names += ["doc_ids", "held_out", "n_tokens", "n_known", "base", "score"]
    columns = {"p": pa.array([row[0] for row in rows], pa.int64())}
    found = {n: _lists([row[k] for row in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds, strict=True), 2)}
    found["number"] = pa.array([row[1] for row in rows], pa.int64())
    found["train_tokens"] = pa.array([known.total] * len(rows), pa.int64())
    columns |= {name: found[name] for name in (part.split()[0] for part in SENT.split(", ")) if name != "p"}
    return texts.table(None, columns)


@dataclass
class _RareBigrams:
    """What a partition knows of bigrams with a rare word: counts by target, and all that follows a rare context."""

    model: Model
    table: pa.Table

    def __post_init__(self):
        known, discounts = self.model.known, self.model.discounts
        word, before, counts = (_flat(self.table[name], np.int64) for name in RARE_PAIRS["to_rare"])
        self.to_rare, self.to_counts = _sorted(_bigram(word, before), counts)
        context, target, n = (_flat(self.table[name], np.int64) for name in RARE_PAIRS["from_rare"])
        moved = [_flat(self.table[part.split()[0]], np.int64) for part in MOVED.split(", ")]
        context = np.concatenate([context, moved[0]]).view(U64)
        of_target = np.concatenate([np.append(known.counts, 0)[target], moved[3]])
        target = np.concatenate([np.append(known.words, U64(0))[target], moved[1].view(U64)])
        n = np.concatenate([n, moved[2]])
        kept, single = n * discounts[np.minimum(n, GT_MAX + 1)], (of_target + 1) / known.divisor
        self.contexts, place = np.unique(context, return_inverse=True)
        totals, self.log_backoff = backoff(*(np.bincount(place, w, len(self.contexts)) for w in (n, kept, single)))
        gains = np.log10(kept) - np.log10(totals[place]) - np.log10(single)
        self.from_rare, self.gains = _sorted(_bigram(context, target), gains)

    def log_own(self, words: np.ndarray, before: np.ndarray, single: np.ndarray) -> np.ndarray:
        """log10 of a rare word's probability after a frequent word; after a rare one, of its unigram probability."""
        counts = _look_up(self.to_rare, self.to_counts, _bigram(words, before))
        kept = counts * self.model.discounts[np.minimum(counts, GT_MAX + 1)]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log10(kept) - np.log10(self.model.totals[before])
        unseen = single + np.where(before == self.model.known.rare, 0, self.model.log_backoff[before])
        return np.where(counts > 0, seen, unseen)

    def log_next(self, words: np.ndarray, following: np.ndarray) -> np.ndarray:
        """What a rare word as context adds to log10 of the unigram probability of the word that follows."""
        keys = _bigram(words, following)
        if not len(self.from_rare):
            return np.zeros(len(words))
        at = np.minimum(np.searchsorted(self.from_rare, keys), len(self.from_rare) - 1)
        unseen = _look_up(self.contexts, self.log_backoff, words)
        return np.where(self.from_rare[at] == keys, self.gains[at], unseen)


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]


def _added(model: Model, events: pa.Table, table: pa.Table) -> pa.Table:
    """Sums per text of a partition's events, with the counts of that partition."""
    known = model.known
    words, word_counts = _rare_words(table)
    bigrams = None if known.shared else _RareBigrams(model, table)
    pairs, pair_counts = _flat(table["pairs"], np.int64), _flat(table["pair_counts"], np.int64)
    rare_words, frequent_words = known.rare_words(), np.append(known.words, U64(0))
    sums: dict[str, list] = {"n_known": [], "base": [], "score": [], "places": []}
    for batch in events.to_batches():
        for k in range(batch.num_rows):
            cell = {name: batch[name][k].values.to_numpy(zero_copy_only=False) for name in batch.schema.names if name not in ("p", "number", "train_tokens")}
            word_docs, pair_docs = cell["word_docs"].astype(np.int64), cell["pair_docs"].astype(np.int64)
            long = max(len(cell["doc_ids"]), int(word_docs.max(initial=-1)) + 1, int(pair_docs.max(initial=-1)) + 1)
            places = np.unique(np.concatenate([word_docs, pair_docs, np.arange(len(cell["doc_ids"]))]))
            sums["places"].append(places)
            wanted_words = cell["words"].view(U64)
            c = _look_up(words, word_counts, wanted_words)
            single = np.log10((c + 1) / known.divisor)
            if known.shared:
                of_words = np.log10((c + 1) / rare_words)
            else:
                follows = cell["next"].astype(np.int64)
                following = frequent_words[follows]
                following[follows == known.rare] = cell["next_words"].view(U64)
                of_words = bigrams.log_own(wanted_words, cell["before"].astype(np.int64), single)
                of_words += bigrams.log_next(wanted_words, following)
            wanted = cell["pairs"].view(np.uint32).astype(np.int64)
            logs = model.log_pairs(wanted, _look_up(pairs, pair_counts, wanted))
            found = {
                "n_known": np.bincount(word_docs, c > 0, long),
                "base": np.bincount(word_docs, single, long),
                "score": np.bincount(word_docs, of_words, long) + np.bincount(pair_docs, logs, long),
            }
            for name, values in found.items():
                values = values.astype(float)
                values[: len(cell[name])] += cell[name]
                sums[name].append(values[places])
    columns = {name: events[name] for name in ("number", "doc_ids", "held_out", "n_tokens", "train_tokens")}
    columns["n_known"] = _lists(sums["n_known"], pa.int64())
    columns |= {name: _lists(sums[name], pa.float64()) for name in ("base", "score")}
    columns["places"] = _lists(sums["places"], pa.int16())
    return pa.table(columns)


def _summed(group: pa.Table) -> pa.Table:
    """The texts of one number, with the sums of all partitions added up."""
    group = group.combine_chunks()
    home = int(np.argmax(group["doc_ids"].combine_chunks().value_lengths().to_numpy()))
    ids = group["doc_ids"][home].values
    places = _flat(group["places"], np.int64)
    total = {name: np.bincount(places, _flat(group[name], np.float64), len(ids)) for name in ("n_known", "base", "score")}
    return pa.table(
        {
            "doc_id": ids,
            "held_out": group["held_out"][home].values,
            "n_tokens": group["n_tokens"][home].values,
            "n_known": pa.array(total["n_known"].astype(np.int64)),
            "train_tokens": pa.array([group["train_tokens"][home].as_py()] * len(ids), pa.int64()),
            "base_score": pa.array(total["base"]),
            "score": pa.array(total["score"]),
        }
    )
