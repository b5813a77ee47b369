"""Packing of token pieces into fixed windows by best-fit decreasing.

Documents are cut into full windows and one remainder. Best-fit decreasing treats pieces of one length alike, so
it is run once over the *histogram* of lengths, which has at most ``window`` entries whatever the input: a
segment tree over remaining capacities finds the tightest open windows, and whole runs of equal pieces go into
whole runs of equal windows. The result is a short list of rules (length, ranks, windows, offset). Every piece
then finds its window from its rank among the pieces of its length: its number in its task, which tasks give while
they cut, plus the pieces of that length in the tasks before, which is counted from the lengths alone. So ids are
written once, where they are made, and neither shuffled nor sorted. Pieces keep them, so a sequence is its pieces'
ids at their offsets, and padding after the last.

Defined cases: a null or empty text is the single closing id; repeated rows are packed as often as they occur;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import weakref
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.session import shared_folder, ship_package

WINDOW = 4096
CLOSING_ID = 2
#: Words whose ids a worker remembers, in each of two generations.
REMEMBERED = 150_000
#: Longest word that is remembered, in characters.
LONGEST_REMEMBERED = 64
#: Documents and bytes of text that are cut at once.
PART_ROWS, PART_BYTES = 10_000, 8 << 20
#: Words whose ids are put in a row at once; longer texts are taken whole.
WORDS_AT_ONCE = 1 << 18

#: Letters and numbers up to U+017F, where lower case and composition need no table; white space among them.
_LATIN, _DIGITS, _WHITE = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
_LATIN_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[{_DIGITS}]|[^{_WHITE}{_DIGITS}{_LATIN}]+")
_BEYOND_LATIN = re.compile("[^\x00-ſ]")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[ \t-\r]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {byte: chr(byte) for byte in printable}, 256
    for byte in range(256):
        if byte not in letters:
            letters[byte], spare = chr(spare), spare + 1
    return [letters[byte] for byte in range(256)]


_TO_LETTERS = dict(enumerate(byte_letters()))


def in_letters(piece: str) -> str:
    """A text with each byte of its UTF-8 form as its letter."""
    return piece.encode().decode("latin-1").translate(_TO_LETTERS)


class _Memory(dict):
    """Values by key, worked out when first asked for. Two generations bound it: keys in use outlive the rest."""

    def __init__(self, work, most: int | None = None):
        super().__init__()
        self.work, self.most = work, most
        self.older = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= (self.most or REMEMBERED):
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokenizer:
    """Ids of whole texts by a tokenizer file that drops white space, remembered word by word.

    White space parts tokens, and normalising does not look across it, so a text's ids are its words' ids in
    a row. A word takes the file's own normaliser, pre-tokenizer and merges.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        special = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)").search
        me = weakref.proxy(self)  # no cycle: a tokenizer that is let go of is freed at once
        self.pieces = _Memory(lambda piece: me.piece(piece), REMEMBERED // 3)
        self.words = _Memory(lambda word: me.word(word))

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token, given as byte letters."""
        return self.packed([token.id for token in self.whole.model.tokenize(piece)])

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            # a word of a-z is its own only pre-token, so both are remembered in one place
            return self.piece(word) if word.islower() else self.words[word.lower()]
        if self.special(word):
            return self.packed(self.whole.encode(word, add_special_tokens=False).ids)
        known, words = self.pieces, self.words
        if word.isascii() and word.isprintable():
            found = _LATIN_PIECES.findall(word.lower())
            return b"".join([words[piece] if piece.isalpha() else known[piece] for piece in found])
        if not _BEYOND_LATIN.search(word):
            return b"".join([known[in_letters(piece)] for piece in _LATIN_PIECES.findall(word.lower())])
        plain = self.whole.normalizer.normalize_str(word)
        return b"".join([known[piece] for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(plain)])

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        words = _BLANKS.split(text) if _ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))


_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


PIECES = (
    "doc_id long, start long, length long, ids array<int>, doc_tokens long, ids_crc32 long, task int, nth long"
)
PACKED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


def encode(
    texts_: pa.Array, known: WordTokenizer, closing: int, at_once: int = WORDS_AT_ONCE
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of the texts, first and last, with their ids, each text's followed by the closing id, and where they end.

    Every distinct word is looked up once; those that come again are remembered for later texts. A range has about
    ``at_once`` words, so that only few of the ids are in memory at a time.
    """
    split = pc.ascii_split_whitespace(texts_)
    borders = split.offsets.to_numpy()
    words = split.flatten().dictionary_encode()
    split = None
    place = words.indices.to_numpy()
    distinct = words.dictionary.to_pylist()
    often = np.bincount(place, minlength=len(distinct)) > 1
    look, work = known.words.__getitem__, known.word
    found = [
        look(w) if again and len(w) <= LONGEST_REMEMBERED else work(w)
        for w, again in zip(distinct, often.tolist(), strict=True)
    ]
    found.append(np.asarray([closing], "<u4").tobytes())
    last_word = len(distinct)
    distinct = often = None
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), "<i4")
    found = None
    opens = np.cumsum(sizes) - sizes
    borders = borders.astype(np.int64) - borders[0]
    for first, last in texts.chunks(borders, at_once):
        ends = borders[first + 1 : last + 1] - borders[first]
        own = np.insert(place[borders[first] : borders[last]], ends, last_word)
        many = sizes[own]
        total = np.cumsum(many)
        kind = np.int32 if max(total[-1], len(flat)) < 1 << 31 else np.int64
        at = np.repeat((opens[own] - (total - many)).astype(kind), many)
        at += np.arange(total[-1], dtype=kind)
        yield first, last, flat[at], total[ends + np.arange(len(ends))]


def _numbers(lengths: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Each piece's number among those of its length, counted on from ``met``, which is brought up to date."""
    order = np.argsort(lengths, kind="stable")
    run = lengths[order]
    opens = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    sizes = np.diff(np.append(opens, len(run)))
    out = np.empty(len(lengths), np.int64)
    out[order] = np.arange(len(run)) - np.repeat(opens - met[run[opens]], sizes)
    met[run[opens]] += sizes
    return out


def pieces(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, closing: int = CLOSING_ID, part_rows: int = PART_ROWS
) -> DataFrame:
    """Full windows and the remainder of each document, in the order of its ids, numbered by task and length."""

    def cut(batches):
        known, task = _tokenizer(tokenizer), TaskContext.get().partitionId()
        met = np.zeros(window + 1, np.int64)
        for batch in batches:
            column = batch["text"].fill_null("")
            for first, last in texts.chunks(texts.string_bytes(column)[1], PART_BYTES):
                for a in range(first, last, part_rows):
                    some = column[a : min(a + part_rows, last)]
                    for one, two, ids, ends in encode(some, known, closing):
                        counts = np.diff(ends, prepend=0)
                        many = -(-counts // window)
                        doc = np.repeat(np.arange(len(counts)), many)
                        nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                        start = nth * window
                        lengths = np.minimum(window, counts[doc] - start)
                        stops = np.cumsum(lengths)
                        raw = memoryview(ids).cast("B")
                        sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(stops.tolist(), lengths.tolist(), strict=True)]
                        columns = {
                            "doc_id": batch["doc_id"][a + one : a + two].take(pa.array(doc)),
                            "start": pa.array(start),
                            "length": pa.array(lengths),
                            "ids": pa.ListArray.from_arrays(pa.array(np.append(0, stops).astype(np.int32)), pa.array(ids)),
                            "doc_tokens": pa.array(counts[doc]),
                            "ids_crc32": pa.array(sums, pa.int64()),
                            "task": pa.array(np.full(len(doc), task, np.int32)),
                            "nth": pa.array(_numbers(lengths, met)),
                        }
                        yield texts.table(None, columns)
        # workers live on, and share an executor's memory with later stages
        known = batch = column = some = ids = raw = columns = None
        _tokenizers.clear()
        texts.release()

    ship_package(docs.sparkSession)
    return texts.ids_and_texts(docs).mapInArrow(cut, PIECES)


class _Capacities:
    """A segment tree over remaining capacities: the smallest one at or above a length that has open windows."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.open = [False] * (2 * self.size)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = self.size + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = self.size + least
        if self.open[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_rules(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of so many pieces of each length, as rules for runs of equal pieces.

    A rule (length, rank, count, first, each, offset): the pieces of that length with ranks rank .. rank+count-1
    go to the windows from ``first`` on, ``each`` to a window, from ``offset`` in it.
    """
    tree, open_runs = _Capacities(window), [[] for _ in range(window + 1)]
    rules, windows = [], 0

    def keep(capacity: int, first: int, count: int) -> None:
        if count and capacity:
            if not open_runs[capacity]:
                tree.mark(capacity, True)
            open_runs[capacity].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, count = window, windows, -(-left // (window // length))
                windows += count
            else:
                first, count = open_runs[capacity].pop()
                if not open_runs[capacity]:
                    tree.mark(capacity, False)
            each = capacity // length
            full = min(count, left // each)
            if full:
                rules.append((length, rank, full * each, first, each, window - capacity))
                rank, left = rank + full * each, left - full * each
                keep(capacity - each * length, first, full)
            if left and full < count:
                rules.append((length, rank, left, first + full, left, window - capacity))
                keep(capacity - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            keep(capacity, first + full, count - full)
    return rules


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, part_rows: int = PART_ROWS) -> DataFrame:
    """Every piece of every document with its sequence and offset, its ids and their crc32."""
    spark = docs.sparkSession
    with texts.small_batches(spark, PART_BYTES):
        cut = texts.stored(pieces(docs, tokenizer, window, part_rows=part_rows), shared_folder(spark, "packing"))
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("rows"))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("rows").alias("n")).collect()}
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"))
    placed = cut.join(before, ["length", "task"])
    place = _placing(best_fit_rules(histogram, window))
    placed = placed.withColumn("place", place("length", F.col("before") + F.col("nth")))
    placed = placed.withColumns({"sequence_id": F.col("place.sequence_id"), "offset": F.col("place.offset")})
    return placed.select(*PACKED)


def _placing(rules: list[tuple]):
    """Sequence and offset of a piece by its length and rank, from rules, of which there are few for a given window."""
    table = np.asarray(sorted(rules), np.int64).reshape(-1, 6)
    step = np.int64(1) << np.int64(46)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, nth = length.to_numpy(), rank.to_numpy()
        rule = table[np.searchsorted(table[:, 0] * step + table[:, 1], size * step + nth, "right") - 1]
        nth = nth - rule[:, 1]
        return pd.DataFrame({"sequence_id": rule[:, 3] + nth // rule[:, 4], "offset": rule[:, 5] + nth % rule[:, 4] * size})

    return place
