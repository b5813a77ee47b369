"""Texts as bytes: words, hashes and shingles of whole Arrow batches, without a Python object per word."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seawarden.session import ship_package

U64 = np.uint64
#: Bytes of `[\x20\x09-\x0D]`, which part words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that are hashed at once; longer texts are taken whole.
CHUNK = 1 << 19
#: Bytes of whole texts that a task's Python worker is given at once, and the setting for it.
BATCH_BYTES, BATCH_LIMIT = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Words longer than this are hashed one by one.
LONG_WORD = 512
#: Masks of the first 0 to 8 bytes of a little-endian 64-bit integer.
_FIRST_BYTES = np.asarray([(1 << 8 * k) - 1 for k in range(9)], U64)
_BY_LENGTH = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``most`` bytes; a longer document is a range of its own."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


class Words:
    """Where the words of some documents are: byte ranges, and each document's range of words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACE):
        """``parts`` marks the bytes between words. A word never spans two documents."""
        self.raw = raw
        inside = ~parts[raw]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        borders = offsets[1:-1]
        borders = borders[borders < len(raw)]
        opens[borders] = inside[borders]
        self.start = np.flatnonzero(opens)
        shut = inside.copy()
        shut[:-1] &= ~inside[1:]
        ends = borders[borders > 0] - 1
        shut[ends] = inside[ends]
        self.end = np.flatnonzero(shut) + 1
        self.bounds = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: its length and its bytes, eight at a time, each mixed into what came before.

        Words of up to eight bytes that are equally long never share a hash; others do by chance only, whatever
        the order of their letters.
        """
        size = self.end - self.start
        if not len(size):
            return np.zeros(0, U64)
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eights = np.lib.stride_tricks.as_strided(padded, (len(self.raw) + 1, 8), (1, 1))

        def piece(start: np.ndarray, left: np.ndarray) -> np.ndarray:
            taken = np.ascontiguousarray(eights[start]).view("<u8")[:, 0]
            return taken & _FIRST_BYTES[np.minimum(left, 8)]

        out = mix(piece(self.start, size) + size.astype(U64) * _BY_LENGTH)
        more, at = np.flatnonzero(size > 8), 8
        while len(more):
            long = size[more] > LONG_WORD
            for k in more[long].tolist():
                digest = hashlib.blake2b(self.raw[self.start[k] : self.end[k]].tobytes(), digest_size=8).digest()
                out[k] = int.from_bytes(digest, "little")
            more = more[~long]
            out[more] = mix(out[more] * U64(3) + piece(self.start[more] + at, size[more] - at))
            at += 8
            more = more[size[more] > at]
        return out

    def document(self) -> np.ndarray:
        """The number of each word's document."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; fewer words make one run, none make none."""
    if not len(words):
        return np.zeros(0, U64)
    if len(words) < size:
        folded = U64(0)
        with np.errstate(over="ignore"):
            for word in words:
                folded = mix(np.asarray([folded * U64(3) + word], U64))[0]
        return np.asarray([folded ^ U64(len(words))], U64)
    count = len(words) - size + 1
    runs = np.zeros(count, U64)
    for k in range(size):
        runs = mix(runs * U64(3) + words[k : k + count])
    return np.unique(runs)


def table(batch: pa.RecordBatch | None, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def release() -> None:
    """Give memory that was freed back to the system: Python workers live on and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """What runs meanwhile gets Arrow batches of ``most`` bytes, unless the session itself has a limit."""
    own = spark.conf.get(BATCH_LIMIT, None)
    if own is None:
        spark.conf.set(BATCH_LIMIT, str(most))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(BATCH_LIMIT)


def per_batch(docs: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``function`` to Arrow batches inside the tasks that read ``docs``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield function(batch)
        release()

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def stored(frame: DataFrame, path: str) -> DataFrame:
    """The rows written to a folder and read back, which cuts the lineage."""
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of the frame has it in any case."""
    taken, out = {column.lower() for column in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ids_and_texts(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator reads, cast to fixed types; other columns never leave the scan."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more
    )


def remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``: the fold of a document."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def labelled(docs: DataFrame, labels: DataFrame, column: str, most: int, most_bytes: int) -> DataFrame:
    """doc_id, text and label (0 or 1) of documents to learn from: of each label, the first ``most`` by hash.

    Rows of the held-out fold are left out. Nulls and other labels are not learnt from. Texts are whole and hold
    ``most_bytes`` of each label at most: those above a sixteenth of that are not chosen, nor those after which the
    first by hash would hold more.
    """
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(3) != 1))
    known = known.select(F.col("doc_id").cast("long").alias("l_id"), F.col(column).cast("int").alias("label")).distinct()
    order = [F.xxhash64("l_id"), "l_id"]
    chosen = known.where("label = 1").orderBy(*order).limit(most)
    chosen = chosen.unionByName(known.where("label = 0").orderBy(*order).limit(most))
    rows = ids_and_texts(docs, F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("size"))
    rows = rows.where(F.col("size") <= most_bytes // 16)
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    first = Window.partitionBy("label").orderBy(*order, "text")
    rows = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most)
    rows = rows.withColumn("total", F.sum(F.col("size").cast("long")).over(first.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where(F.col("total") <= most_bytes).select("doc_id", "text", "label")
