"""Exact top-k search in Hamming space by incremental multi-index hashing.

A vector's code holds one sign bit per dimension. Codes are split into segments, and each segment indexes the
codes by its value. A query probes its own segment values first, then all values at one flipped bit, and so on,
segment by segment. After segment j at radius r, every code within Hamming distance segments * r + j has been
met in some segment, so the search of a query ends as soon as its k-th best verified distance is covered.

Codes are spread over shards of bounded size and queries over blocks of bounded size; each shard searches each
block and returns k rows a query, which are merged. Equal codes are one entry that knows its k + 1 smallest ids,
the most that any query can return of them, so thousands of copies cost what one does.

Defined cases: null or empty vectors are neither indexed nor searched; null components count as not positive;
a shorter vector has 0 bits at its end; ties go to the smaller id; repeated rows count once; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.session import shared_folder, ship_package

K = 10
#: Codes in a shard and queries in a block, about.
SHARD_CODES, BLOCK_QUERIES = 1_000_000, 100_000
#: Longest segment: its values address a table directly.
SEGMENT_BITS = 20


def codes(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id and code: bit i is set where component i is positive, lowest bit first, without zero bytes at the end."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch["v"]
        offsets = lists.offsets.to_numpy()
        values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore"):
            bits = values > 0
        out = [
            np.packbits(bits[a:b], bitorder="little").tobytes().rstrip(b"\0")
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        return texts.table(None, {"id": batch["id"], "code": pa.array(out, pa.binary())})

    given = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    return texts.per_batch(given.where(F.col("id").isNotNull() & (F.size("v") > 0)), run, "id long, code binary")


@cache
def _flips(bits: int, radius: int) -> np.ndarray:
    """All values of so many bits with ``radius`` of them set."""
    sets = combinations([1 << b for b in range(bits)], radius)
    return np.fromiter((sum(chosen) for chosen in sets), np.int64)


class SegmentIndex:
    """Codes by the value of each of their segments."""

    def __init__(self, words: np.ndarray, weights: np.ndarray):
        """``words``: one row of 64-bit words per code; ``weights``: ids that stand for each code."""
        self.words, self.weights = words, weights
        count, width = words.shape
        per_word = int(np.clip(round(64 / max(np.log2(max(count, 2)), 1)), -(-64 // SEGMENT_BITS), 16))
        edges = [round(64 * k / per_word) for k in range(per_word + 1)]
        self.segments = [(w, a, b - a) for w in range(width) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.tables = []
        for segment in self.segments:
            values = self.values(words, segment)
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << segment[2]) + 1))
            self.tables.append((order, starts))

    @staticmethod
    def values(words: np.ndarray, segment: tuple[int, int, int]) -> np.ndarray:
        word, first, bits = segment
        shifted = words[..., word] >> np.uint64(first)
        return (shifted & np.uint64((1 << bits) - 1)).astype(np.int64)

    def search(self, query: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of all codes up to the distance that holds the ``wanted`` nearest ids."""
        met = np.zeros(len(self.words), bool)
        found, distances = [], []
        per_distance = np.zeros(64 * self.words.shape[1] + 1, np.int64)
        longest = max(bits for _, _, bits in self.segments)
        for radius in range(longest + 1):
            for number, (segment, (order, starts)) in enumerate(zip(self.segments, self.tables, strict=True)):
                if radius <= segment[2]:
                    probes = self.values(query, segment) ^ _flips(segment[2], radius)
                    begins, sizes = starts[probes], starts[probes + 1] - starts[probes]
                    total = int(sizes.sum())
                    if total:
                        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
                        new = order[at]
                        new = new[~met[new]]
                        met[new] = True
                        distance = np.bitwise_count(self.words[new] ^ query).sum(axis=1, dtype=np.int64)
                        found.append(new)
                        distances.append(distance)
                        per_distance += np.bincount(distance, self.weights[new], len(per_distance)).astype(np.int64)
                covered = len(self.segments) * radius + number
                if per_distance[: covered + 1].sum() >= wanted:
                    break
            else:
                continue
            break
        position = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
        distance = np.concatenate([*distances, np.zeros(0, np.int64)]).astype(np.int64)
        reach = int(np.searchsorted(np.cumsum(per_distance), wanted))
        near = distance <= reach
        return position[near], distance[near]


def _words(column: pa.ChunkedArray, width: int) -> np.ndarray:
    padded = b"".join(code.ljust(8 * width, b"\0") for code in column.to_pylist())
    return np.frombuffer(padded, "<u8").reshape(-1, width)


def search(queries: DataFrame, indexed: DataFrame, k: int = K) -> DataFrame:
    """The k nearest other ids of each query: query_id, rank, neighbor_id, distance. Inputs as from ``codes``."""
    spark = indexed.sparkSession
    work = shared_folder(spark, "topk")
    first = Window.partitionBy("code").orderBy("id")
    distinct = indexed.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    entries = distinct.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries.write.parquet(f"{work}/entries")
    entries = spark.read.parquet(f"{work}/entries")
    queries.distinct().write.parquet(f"{work}/queries")
    asked = spark.read.parquet(f"{work}/queries")

    size = entries.agg(F.count("*").alias("n"), F.max(F.octet_length("code")).alias("bytes")).first()
    widest = max(size["bytes"] or 0, asked.agg(F.max(F.octet_length("code"))).first()[0] or 0, 1)
    width = -(-widest // 8)
    sought = asked.select("code").distinct()
    shards, blocks = -(-size["n"] // SHARD_CODES), -(-sought.count() // BLOCK_QUERIES)

    def spread(rows: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        numbered = rows.withColumn(own, F.pmod(F.xxhash64("code"), F.lit(max(own_count, 1))))
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(other_count, 1) - 1))))

    left = spread(entries, "shard", shards, "block", blocks)
    right = spread(sought, "block", blocks, "shard", shards)

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        rows: list[list] = [[], [], []]
        if len(shard) and len(block):
            ids = shard["ids"].to_pylist()
            index = SegmentIndex(_words(shard["code"], width), np.asarray([len(x) for x in ids]))
            for code, query in zip(block["code"].to_pylist(), _words(block["code"], width), strict=True):
                position, distance = index.search(query, k + 1)
                near = sorted((d, i) for p, d in zip(position.tolist(), distance.tolist(), strict=True) for i in ids[p])
                for d, i in near[: k + 1]:
                    for column, value in zip(rows, (code, i, d), strict=True):
                        column.append(value)
        kinds = (pa.binary(), pa.int64(), pa.int64())
        names = ("code", "neighbor_id", "distance")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, rows, kinds, strict=True)})

    ship_package(spark)
    keys = ["shard", "block"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "code binary, neighbor_id long, distance long"
    )
    pairs = asked.withColumnRenamed("id", "query_id").join(near, "code").where("query_id != neighbor_id")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "neighbor_id", "distance")


def search_vectors(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """Search all vectors for the neighbours of those whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    stored = f"{shared_folder(spark, 'codes')}/codes"
    codes(vectors).write.parquet(stored)
    coded = spark.read.parquet(stored)
    return search(coded.where(F.col("id") % every == 0), coded, k)
