"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds the hashes of its word shingles. Two permutations make all signature coordinates: the
first scatters shingles over slots, the second orders the slots and is shifted circularly by k places for
coordinate k, so a coordinate is the least value of one table read at another offset.

Documents with equal sets are one node from then on. Nodes that agree in all rows of a band share a bucket, and
the nodes of a bucket meet at its first node. All nodes that meet at one node are compared in blocks of bounded size,
once however many buckets brought them there: first by bitmaps of their sets, which leave out only what cannot be
linked, then on full sets, and links that join components come out. So no link between nodes of one bucket is lost,
and none is listed that joins nothing.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; fewer
words than a shingle make one shingle; rows without doc_id are linked with nothing and have no component;
repeated rows are linked with each other; an empty table gives no rows; other columns are kept by ``dedup`` and
not read by ``groups``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.llm.components import components
from seawarden.llm.jaccard_join import bitmap, hub_links, sets
from seawarden.session import shared_folder

SHINGLE_WORDS = 5
#: At the least similarity, a link shares no band with probability (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS = 32, 5
SLOTS = 1 << 21
#: Ids that are broadcast at most (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
U64 = np.uint64

_order = np.random.default_rng(4021).permutation(SLOTS).astype(np.uint32)
_SHIFTED = sliding_window_view(np.concatenate([_order, _order[: BANDS * ROWS]]), BANDS * ROWS)


def signature(shingles: np.ndarray) -> bytes:
    """One byte for each coordinate: a hash of the least value, so that unequal values agree once in 256."""
    slots = (texts.mix(shingles ^ U64(0x5851F42D4C957F2D)) >> U64(64 - 21)).astype(np.int64)
    least = np.full(BANDS * ROWS, SLOTS, np.uint32)
    for at in range(0, len(slots), 2048):
        np.minimum(least, _SHIFTED[slots[at : at + 2048]].min(axis=0), out=least)
    return (texts.mix(least.astype(U64) + U64(1)) & U64(255)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, content (a hash of the text), n_shingles, node (a hash of the set), signature and bitmap of each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = sets(*texts.string_bytes(batch["text"]), size)
        with np.errstate(over="ignore"):
            nodes = [texts.mix(np.asarray([texts.mix(s).sum(dtype=U64) ^ U64(len(s))]))[0] for s in found]
        columns = {
            "doc_id": batch["doc_id"],
            "content": batch["content"],
            "n_shingles": pa.array([len(s) for s in found], pa.int64()),
            "node": pa.array(np.asarray(nodes, U64).view(np.int64)),
            "signature": pa.array([signature(s) if len(s) else None for s in found], pa.binary()),
            "bits": pa.array([bitmap(s) for s in found], pa.binary()),
        }
        return texts.table(None, columns)

    rows = texts.ids_and_texts(docs, F.xxhash64("text").alias("content"))
    schema = "doc_id long, content long, n_shingles long, node long, signature binary, bits binary"
    return texts.per_batch(rows, run, schema)


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def groups(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, content, n_shingles, component_id (the smallest doc_id reachable) and kept of every row."""
    spark = docs.sparkSession
    work = shared_folder(spark, "near-dedup")
    signed = _stored(signatures(docs, size), f"{work}/signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = usable.groupBy("node", F.col("n_shingles").alias("n")).agg(
        F.min(F.struct("doc_id", "content")).alias("first"), F.first(F.struct("signature", "bits")).alias("of_set")
    )
    nodes = nodes.select("node", "n", "first.doc_id", "first.content", "of_set.signature", "of_set.bits")
    nodes = _stored(nodes, f"{work}/nodes")

    bands = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    own_key = F.xxhash64("band", F.substring("signature", F.col("band") * ROWS + 1, F.lit(ROWS)))
    keyed = bands.select(own_key.alias("key"), "node")
    buckets = keyed.groupBy(F.col("key").alias("b_key")).agg(F.min("node").alias("pivot"), F.count("*").alias("size"))
    shared = keyed.join(buckets.where("size > 1"), F.col("key") == F.col("b_key")).select("key", "node", "pivot")
    shared = _stored(shared, f"{work}/buckets")

    members = shared.select(F.col("pivot").alias("hub"), "node").distinct().join(nodes.select("node", "n"), "node")
    members = _stored(members, f"{work}/members")

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        return _stored(_whole_sets(_contents(docs, wanted, nodes), size), f"{work}/{name}")

    labels = components(hub_links(members, nodes.select("node", "bits"), sets_of, work))

    named = labels.join(nodes.select("node", "doc_id"), "node")
    smallest = named.groupBy(F.col("label").alias("s_label")).agg(F.min("doc_id").alias("smallest"))
    linked = labels.join(smallest, F.col("label") == F.col("s_label")).select(F.col("node").alias("l_node"), "smallest")
    component = F.coalesce("smallest", "first_id")
    first = nodes.select(F.col("node").alias("n_node"), F.col("n").alias("n_n"), F.col("doc_id").alias("first_id"))
    first = first.join(linked, F.col("n_node") == F.col("l_node"), "left").select(
        "n_node", "n_n", component.alias("found")
    )
    same = (F.col("node") == F.col("n_node")) & (F.col("n_shingles") == F.col("n_n")) & F.col("doc_id").isNotNull()
    judged = signed.drop("signature", "bits").join(first, same, "left")
    judged = judged.withColumn("component_id", F.coalesce("found", "doc_id"))
    return judged.select(
        "doc_id",
        "content",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _whole_sets(contents: DataFrame, size: int) -> DataFrame:
    """node and its set, as sorted 64-bit hashes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [s.astype("<u8").tobytes() for s in sets(*texts.string_bytes(batch["text"]), size)]
        return texts.table(None, {"node": batch["node"], "tokens": pa.array(found, pa.binary())})

    return texts.per_batch(contents, run, "node long, tokens binary")


def _contents(docs: DataFrame, wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the first document of each wanted node."""
    wanted = wanted.select("node").distinct().join(nodes, "node")
    wanted = wanted.select("node", F.col("doc_id").alias("w_id"), F.col("content").alias("w_content"))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    rows = texts.ids_and_texts(docs).withColumn("content", F.xxhash64("text"))
    same = (F.col("doc_id") == F.col("w_id")) & (F.col("content") == F.col("w_content"))
    return rows.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def dedup(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest doc_id."""
    spark = docs.sparkSession
    judged = _stored(groups(docs, size), f"{shared_folder(spark, 'dedup')}/judged")
    g_id, g_content, nth = texts.free_names(docs, "g_id", "g_content", "nth")
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias(g_id), F.col("content").alias(g_content))
    gone = gone.distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    content = F.xxhash64(F.col("text").cast("string"))
    kept = docs.join(gone, (F.col("doc_id") == F.col(g_id)) & (content == F.col(g_content)), "left_anti")
    some = judged.where("kept AND doc_id IS NOT NULL AND n_shingles > 0")
    repeated = some.groupBy("doc_id", "content").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    ordered = [F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind]  # maps have no order
    once = Window.partitionBy("doc_id", content).orderBy(*ordered)
    alone = F.col("doc_id").isNull() | (F.row_number().over(once) == 1)
    return kept.withColumn(nth, alone).where(nth).select(*docs.columns)
