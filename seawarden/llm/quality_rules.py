"""Quality rules: counts of words, symbols and repetition, and lines that recur across a host's documents.

Lines are normalised (A-Z lower-cased, words parted by one blank) and hashed. For each host the distinct
documents that hold a line are counted, where copies of one text count once. Lines above the limit are removed;
a document that keeps less than a given share of its words is depleted and rejected.

Lines above the limit stay rows, and are joined to the lines of documents by host and line.

Defined cases: a null or empty text has no words and fails the base rules; a null host is a host of its own;
rows with one doc_id and one text count as one document but each gets its result; an empty table gives no rows;
other columns are kept by ``clean`` and not read by ``judge``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.session import shared_folder, ship_package

MIN_WORDS = 50
#: Percent of words in repeated three-word windows above which a text fails.
MOST_REPEATED = 50
#: A line is above the limit if more than two distinct documents of a host hold it, and more than the smaller of a
#: share of them and a fixed count: the share acts in small hosts, the count in large ones.
LINE_DOCUMENTS, LINE_SHARE, LINE_COUNT = 2, 0.1, 200
#: A document is depleted if less than this share of its words is left.
LEFT = 0.3

#: Lines that are broadcast at most (16 MB with their keys); more are joined by a shuffle.
BROADCAST_LINES = 500_000

NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: Bytes that begin a code point.
LEADING = (np.arange(256) & 0xC0) != 0x80
U64 = np.uint64


def _total(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags)])


def base_counts(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules for each document."""
    words = texts.Words(raw, offsets)
    hashes, document = words.hashes(), words.document()
    leading = _total(LEADING[raw])
    in_word = _total(leading[words.end] - leading[words.start])
    symbols = _total(SYMBOL[raw])
    lines = texts.Words(raw, offsets, NEWLINE)
    wordy = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    line_key = texts.mix(lines.hashes() ^ texts.mix(lines.document().astype(U64)))[wordy]
    line_doc = lines.document()[wordy]
    _, first = np.unique(line_key, return_index=True)
    again = np.ones(len(line_key), bool)
    again[first] = False
    count = len(offsets) - 1
    repeated = np.zeros(len(hashes), bool)
    if len(hashes) >= 3:
        windows = texts.mix(texts.mix(hashes[:-2] * U64(3) + hashes[1:-1]) * U64(3) + hashes[2:])
        whole = document[:-2] == document[2:]
        keys = texts.mix(windows ^ texts.mix(document[:-2].astype(U64)))[whole]
        _, place, found = np.unique(keys, return_inverse=True, return_counts=True)
        at = np.flatnonzero(whole)[found[place] > 1]
        for k in range(3):
            repeated[at + k] = True
    repeats = _total(repeated)
    return {
        "n_words": np.diff(words.bounds),
        "word_chars": in_word[words.bounds[1:]] - in_word[words.bounds[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(line_doc[again], minlength=count),
        "n_repeat_words": repeats[words.bounds[1:]] - repeats[words.bounds[:-1]],
    }


def normal_lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[texts.Words, np.ndarray, np.ndarray]:
    """Lines, the hash of each one's words, and how many words each has; blank lines have none."""
    lowered = texts.LOWER[raw]
    words = texts.Words(lowered, offsets)
    lines = texts.Words(raw, offsets, NEWLINE)
    first = np.searchsorted(words.start, lines.start)
    last = np.searchsorted(words.start, lines.end)
    line = np.repeat(np.arange(len(first)), last - first)
    nth = np.arange(len(line)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    terms = texts.mix(words.hashes() + (nth.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(terms, dtype=U64)])
    return lines, texts.mix(sums[last] - sums[first]).view(np.int64), last - first


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def profile(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, host, base counts, and the distinct normalised lines of each document with their words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = texts.string_bytes(batch["text"])
        counts: list[dict] = []
        hashes, sizes, per_document = [], [], []
        for first, last in texts.chunks(offsets):
            part, own = raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            counts.append(base_counts(part, own))
            lines, line_hash, line_words = normal_lines(part, own)
            document = lines.document()
            order = np.lexsort((line_hash, document))
            order = order[line_words[order] > 0]
            key, doc = line_hash[order], document[order]
            new = np.ones(len(order), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            hashes.append(key[new])
            at = np.flatnonzero(new)
            sizes.append(np.add.reduceat(line_words[order], at) if len(at) else np.zeros(0, np.int64))
            per_document.append(np.bincount(doc[new], minlength=last - first))
        ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(per_document))]).astype(np.int32))
        columns = {"doc_id": batch["doc_id"], "host": batch["host"], "content": batch["content"]}
        for name in counts[0]:
            columns[name] = pa.array(np.concatenate([c[name] for c in counts]).astype(np.int64))
        columns["lines"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(hashes)))
        columns["line_words"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sizes).astype(np.int64)))
        return texts.table(None, columns)

    rows = texts.ids_and_texts(docs, _host().alias("host"), F.xxhash64("text").alias("content"))
    schema = f"doc_id long, host string, content long, {COUNTS}, lines array<long>, line_words array<long>"
    return texts.per_batch(rows, run, schema)


def _host():
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def frequent_lines(
    profiles: DataFrame, documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE, count: int = LINE_COUNT
) -> DataFrame:
    """f_host and f_line of every line above the limit."""
    each = profiles.select("host", "content", F.explode("lines").alias("line"))
    counted = each.groupBy("host", "line").agg(F.count_distinct("content").alias("n")).where(F.col("n") > documents)
    hosts = profiles.groupBy(F.col("host").alias("h_host")).agg(F.count_distinct("content").alias("n_host"))
    above = counted.join(hosts, F.col("host") == F.col("h_host"))
    above = above.where(F.col("n") > F.least(share * F.col("n_host"), F.lit(float(count))))
    return above.select(F.col("host").alias("f_host"), F.col("line").alias("f_line"))


def _stored(found: DataFrame, path: str, lines: Column) -> DataFrame:
    """The table, stored; broadcast if it holds few lines, so that what it is joined to stays where it is."""
    found.write.parquet(path)
    stored = found.sparkSession.read.parquet(path)
    return F.broadcast(stored) if (stored.agg(F.sum(lines)).first()[0] or 0) <= BROADCAST_LINES else stored


def hits(profiles: DataFrame, folder: str) -> DataFrame:
    """r_host, r_content, removed_words and removed (line hashes) of each text of a host that holds lines above the limit."""
    frequent = _stored(frequent_lines(profiles), f"{folder}/frequent", F.lit(1))
    texts_once = profiles.dropDuplicates(["host", "content"])
    each = texts_once.select("host", "content", F.explode(F.arrays_zip("lines", "line_words")).alias("one"))
    each = each.select("host", "content", F.col("one.lines").alias("line"), F.col("one.line_words").alias("n"))
    met = each.join(frequent, (F.col("host") == F.col("f_host")) & (F.col("line") == F.col("f_line")))
    found = met.groupBy(F.col("host").alias("r_host"), F.col("content").alias("r_content")).agg(
        F.sum("n").alias("removed_words"), F.collect_set("line").alias("removed")
    )
    return _stored(found, f"{folder}/hits", F.size("removed"))


def verdicts(profiles: DataFrame, removed: DataFrame, left: float = LEFT) -> DataFrame:
    """Base verdict, words left and verdict of each profile."""
    same = (F.col("host") == F.col("r_host")) & (F.col("content") == F.col("r_content"))
    joined = profiles.join(removed, same, "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    gone = F.coalesce("removed_words", F.lit(0).cast("long"))
    judged = joined.withColumns({"removed_words": gone, "base_failed": failed})
    depleted = F.col("n_words") - F.col("removed_words") < left * F.col("n_words")
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    stored = shared_folder(docs.sparkSession, "quality-rules")
    profile(docs).write.parquet(f"{stored}/profiles")
    profiles = docs.sparkSession.read.parquet(f"{stored}/profiles")
    return verdicts(profiles, hits(profiles, stored).drop("removed")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "removed_words",
    )


def clean(docs: DataFrame, left: float = LEFT) -> DataFrame:
    """The kept documents, with all their columns, without the lines above the limit."""
    stored = shared_folder(docs.sparkSession, "quality-rules")
    profile(docs).select("host", "content", "lines", "line_words").write.parquet(f"{stored}/profiles")
    profiles = docs.sparkSession.read.parquet(f"{stored}/profiles")
    host, content, above = texts.free_names(docs, "r_host", "r_content", "removed")
    removed = hits(profiles, stored).select("r_host", "r_content", "removed").toDF(host, content, above)
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    joined = docs.join(removed, (_host() == F.col(host)) & (own == F.col(content)), "left")
    names = docs.columns

    def run(batches):
        for batch in batches:
            text = batch["text"].cast(pa.string())
            raw, offsets = texts.string_bytes(text)
            out, kept = [], []
            for first, last in texts.chunks(offsets):
                part, own = raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                counts = base_counts(part, own)
                lines, hashes, sizes = normal_lines(part, own)
                for k in range(last - first):
                    words = int(counts["n_words"][k])
                    passed = words >= MIN_WORDS and 100 * counts["n_repeat_words"][k] <= MOST_REPEATED * words
                    value = text[first + k].as_py()
                    found = batch[above][first + k]
                    if passed and found.is_valid:
                        at = slice(lines.bounds[k], lines.bounds[k + 1])
                        gone = np.isin(hashes[at], found.values.to_numpy()) & (sizes[at] > 0)
                        passed = words - sizes[at][gone].sum() >= left * words
                        if passed and gone.any():
                            value = _without(part[own[k] : own[k + 1]].tobytes(), lines, at, gone, int(own[k]))
                    kept.append(bool(passed))
                    out.append(value)
            columns = {name: batch[name] for name in names}
            columns["text"] = pa.array(out, pa.string())
            if "n_chars" in columns:
                same = [a if a is None else len(a) for a in out]
                columns["n_chars"] = pa.array(same, pa.int64()).cast(columns["n_chars"].type)
            yield texts.table(None, columns).filter(pa.array(kept, pa.bool_()))
        texts.release()

    ship_package(docs.sparkSession)
    rows = joined.select(*names, above)
    return rows.mapInArrow(run, docs.schema)


def _without(raw: bytes, lines: texts.Words, at: slice, gone: np.ndarray, base: int) -> str:
    """A text without some of its lines and their line ends."""
    out, place = [], 0
    for start, end, drop in zip(lines.start[at] - base, lines.end[at] - base, gone, strict=True):
        if drop:
            out.append(raw[place:start])
            place = end + 1 if raw[end : end + 1] == b"\n" else end
    return (b"".join(out) + raw[place:]).decode()
