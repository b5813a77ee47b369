"""How the sources of a language differ in their words, with copied texts counted but not read again.

Identical texts of a language are collapsed to one row that knows how often each source holds it; that row is
tokenised once, and its document frequencies and counts are weighted by the copies. Terms held by enough documents
of a language are kept. A group (language and source) gives each kept term a smoothed share in billionths; two
sources are compared by the sum of the differences over all kept terms, and a source with its language term by term.

Pairs are evaluated sparsely, in buckets of terms: what a source's own terms add against another's share of an
unseen term follows from its sorted shares, terms that neither holds are counted, and only terms held by both are
met one by one. All arithmetic is on whole numbers.

Defined cases: null text, language and source are empty strings, and the empty string is a language and a source of
its own; a text without terms leaves its group in the result; without kept terms all differences are 0; a language
of one source has no pairs; repeated rows count as often as they occur; ties go to the smaller item by its UTF-8
bytes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.session import shared_folder, ship_package

#: A kept term is held by at least so many documents of its language.
LEAST_DOCUMENTS = 30
#: Shares are whole billionths; so much is added to every count.
BILLION, ADDED = 1_000_000_000, 5
#: Ranks of terms that are reported.
TOP_TERMS = 50
#: Counts of one language that a task compares at once, about.
BUCKET_ROWS = 400_000
#: Sources of one text in a row; a text of more sources takes several rows.
SOURCES_IN_ROW = 1000
#: Bytes of text that are counted together.
CHUNK = 4 << 20
#: Pairs of sources that hold one term, looked at together.
PAIRS_AT_ONCE = 2_000_000

#: Bytes that part terms: all of ASCII but letters.
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def collapse(docs: DataFrame) -> DataFrame:
    """lang, text, sources and copies (a list of each) of every distinct text of a language."""

    def read(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    rows = docs.select(read("lang"), read("source"), read("text")).withColumn("content", F.md5("text"))
    held = rows.groupBy("lang", "content", "source").agg(F.count("*").alias("copies"))
    most = F.count("*").over(Window.partitionBy("lang", "content"))
    held = held.withColumn("part", F.pmod(F.xxhash64("source"), F.ceil(most / SOURCES_IN_ROW)))
    lists = held.groupBy("lang", "content", "part").agg(F.collect_list(F.struct("source", "copies")).alias("held"))
    once = rows.groupBy("lang", "content").agg(F.first("text").alias("text"))
    joined = once.join(lists, ["lang", "content"])
    return joined.select("lang", "text", F.col("held.source").alias("sources"), F.col("held.copies").alias("copies"))


def _strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges as an array of strings."""
    ends = np.concatenate([[0], np.cumsum(end - start)])
    at = np.repeat(start - ends[:-1], end - start) + np.arange(ends[-1])
    data = pa.py_buffer(np.ascontiguousarray(raw[at]))
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int32)), data)


def _added(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], *(np.add.reduceat(v[order], first) if len(key) else v for v in values)


def _count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    raw, offsets = texts.string_bytes(batch["text"])
    raw = texts.LOWER[raw]
    sources = batch["sources"].flatten().dictionary_encode()
    langs = batch["lang"].dictionary_encode()
    copies = batch["copies"].flatten().to_numpy()
    many = np.diff(batch["copies"].offsets.to_numpy())
    slot = np.cumsum(many) - many
    per_lang = max(1, len(sources.dictionary))
    group = np.repeat(langs.indices.to_numpy().astype(np.int64), many) * per_lang + sources.indices.to_numpy()
    for first, last in texts.chunks(offsets, CHUNK):
        base = offsets[first]
        words = texts.Words(raw[base : offsets[last]], offsets[first : last + 1] - base, NOT_LETTER)
        if not len(words):
            continue
        _, example, term = np.unique(words.hashes(), return_index=True, return_inverse=True)
        held, count = np.unique(words.document() * len(example) + term, return_counts=True)
        doc, term = first + held // len(example), held % len(example)
        times = many[doc]
        at = np.repeat(np.arange(len(doc)), times)
        place = slot[doc[at]] + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        weight = copies[place]
        key, n, df = _added(group[place] * len(example) + term[at], count[at] * weight, weight)
        terms = _strings(words.raw, words.start[example], words.end[example])
        owner = key // len(example)
        columns = {
            "lang": langs.dictionary.take(pa.array(owner // per_lang)),
            "source": sources.dictionary.take(pa.array(owner % per_lang)),
            "term": terms.take(pa.array(key % len(example))),
            "n": pa.array(n),
            "df": pa.array(df),
        }
        yield texts.table(None, columns)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and df (documents) of every term of every group."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _count(batch)
        pa.default_memory_pool().release_unused()

    ship_package(docs.sparkSession)
    counted = collapse(docs).mapInArrow(run, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: str, total: str, terms: str):
    """A count's smoothed share in whole billionths plus one; 1 where there is nothing to share."""
    above = f"{BILLION}BD * cast({count} + {ADDED} AS decimal(19,0))"
    below = f"(cast({total} AS decimal(20,0)) + {ADDED}BD * cast({terms} AS decimal(19,0)))"
    return F.expr(f"1L + if({below} = 0, 0L, ({above}) div {below})")


def _compare(table: pa.Table) -> pa.Table:
    """Sums of differences of all pairs of sources over one bucket of terms of a language.

    Rows without a term name the language's sources, with the share of an unseen term; the others hold the shares of
    the bucket's terms.
    """
    named = table.filter(pa.compute.is_null(table["term"]))
    held = table.filter(pa.compute.is_valid(table["term"]))
    names = named["source"].combine_chunks()
    order = np.asarray(pa.compute.sort_indices(names))
    names, base = names.take(pa.array(order)), named["p"].to_numpy()[order]
    size = len(names)
    owner = pa.compute.index_in(held["source"], names).to_numpy()
    term = held["term"].combine_chunks().dictionary_encode()
    kinds, term = len(term.dictionary), term.indices.to_numpy()
    p = held["p"].to_numpy()

    own = np.zeros((size, size), np.int64)  # own[i, j]: over the terms of i, its shares against an unseen term of j
    by_owner = np.lexsort((p, owner))
    bounds = np.searchsorted(owner[by_owner], np.arange(size + 1))
    for i in range(size):
        shares = p[by_owner[bounds[i] : bounds[i + 1]]]
        sums = np.concatenate([[0], np.cumsum(shares)])
        below = np.searchsorted(shares, base)
        own[i] = base * below - sums[below] + (sums[-1] - sums[below]) - base * (len(shares) - below)
    many = np.diff(bounds)
    apart = np.abs(base[:, None] - base[None, :])
    total = own + own.T + (kinds - many[:, None] - many[None, :]) * apart

    order = np.argsort(term, kind="stable")
    owner, p, per_term = owner[order], p[order], np.bincount(term, minlength=kinds)
    ends = np.cumsum(per_term)
    reach = ends[term[order]]  # where the run of each entry's term ends
    later = reach - np.arange(len(order)) - 1  # entries of the same term after it
    cut = np.concatenate([[0], np.cumsum(later)])
    at = 0
    while at < len(order):
        stop = max(at + 1, int(np.searchsorted(cut, cut[at] + PAIRS_AT_ONCE, "right")) - 1)
        one = np.repeat(np.arange(at, stop), later[at:stop])
        two = one + 1 + np.arange(len(one)) - np.repeat(cut[at:stop] - cut[at], later[at:stop])
        i, j = owner[one], owner[two]
        both = np.abs(p[one] - p[two]) - np.abs(p[one] - base[j]) - np.abs(p[two] - base[i]) + apart[i, j]
        np.add.at(total, (np.minimum(i, j), np.maximum(i, j)), both)
        at = stop
    i, j = np.triu_indices(size, 1)
    columns = {
        "lang": pa.array([table["lang"][0].as_py()] * len(i), pa.string()),
        "one": names.take(pa.array(i)),
        "two": names.take(pa.array(j)),
        "value": pa.array(total[i, j], pa.int64()),
    }
    return pa.table(columns)


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: see the module's text."""
    spark = docs.sparkSession
    work = shared_folder(spark, "divergence")
    counts = texts.stored(term_counts(docs), f"{work}/counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("df").alias("df"))
    kept = texts.stored(kept.where(F.col("df") >= LEAST_DOCUMENTS).drop("df"), f"{work}/kept")
    held = counts.drop("df").join(kept, ["lang", "term"])
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    per_group = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("n_held"))

    def read(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    groups = docs.select(read("lang"), read("source")).distinct().join(per_group, ["lang", "source"], "left")
    groups = groups.join(per_lang, "lang", "left").fillna(0, ["total", "n_held", "terms", "total_lang"])
    buckets = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("n_held").over(Window.partitionBy("lang")) / BUCKET_ROWS))
    groups = texts.stored(groups.withColumn("buckets", buckets), f"{work}/groups")

    shares = held.join(groups, ["lang", "source"]).withColumns(
        {"p": share("n", "total", "terms"), "q": share("n_lang", "total_lang", "terms")}
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    above = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP_TERMS)

    dealt = shares.select("lang", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"), "source", "term", "p")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket")
    unseen = share("0", "total", "terms").alias("p")
    bases = groups.select("lang", every, "source", F.lit(None).cast("string").alias("term"), unseen)
    ship_package(spark)
    compared = dealt.unionByName(bases).groupBy("lang", "bucket").applyInArrow(
        _compare, "lang string, one string, two string, value long"
    )
    pairs = texts.stored(compared.groupBy("lang", "one", "two").agg(F.sum("value").alias("value")), f"{work}/pairs")
    both = pairs.select("lang", F.col("one").alias("source"), F.col("two").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("two").alias("source"), F.col("one").alias("item"), "value")
    )
    ranked = both.withColumn("rank", F.row_number().over(by_value))

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(ranked, "pair").unionByName(part(terms, "term"))
