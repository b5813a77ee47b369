"""Shards along a Hilbert curve over several metadata dimensions.

Source, language and size are quantised to a few bits each, by the share of rows that precede a value, so that
frequent values take several steps and few values spread over the whole grid. The cells are numbered along a Hilbert
curve, rows are sorted by that number and cut into runs, so that a shard covers a compact region. ``write`` stores
the documents by shard in the order of the curve, with a table of the least and greatest value of each dimension in each
shard, by which ``read`` skips whole shards. Built-in functions only; ``shard`` leaves texts in the scan.

Defined cases: a null text has size 1 and checksum 0; a null source or language counts as empty; rows that are equal
in doc_id, text, source and language are dealt out as often as they occur; an empty table gives no rows;
other columns are not read by ``shard`` and kept by ``write``, which leaves out a column named ``shard``.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seawarden.session import shared_folder

#: Rows that one task numbers, about: a cell with more rows is dealt over several tasks.
PART_ROWS = 500_000
BITS = 4
#: Dimensions that are texts; the size is the third.
TEXTS = ("source", "lang")
#: Values of a dimension that are broadcast at most; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a point on the Hilbert curve through a grid with 2^bits steps in each dimension.

    Walks from the coarsest to the finest level. ``entry`` and ``axis`` say where the curve enters the current
    sub-cube and along which axis it leaves it; they turn the sub-cube's corner into its rank on the curve.
    """
    n = len(point)
    full = (1 << n) - 1

    def turn(value: int, by: int) -> int:
        by %= n
        return ((value >> by) | (value << (n - by))) & full

    entry = axis = index = 0
    for level in range(bits - 1, -1, -1):
        corner = sum(((point[k] >> level) & 1) << k for k in range(n))
        gray = turn(corner ^ entry, axis + 1)
        rank = gray
        shift = gray >> 1
        while shift:
            rank ^= shift
            shift >>= 1
        index = (index << n) | rank
        before = 2 * ((rank - 1) // 2) if rank else 0
        inner = before ^ (before >> 1)
        ones = rank if rank % 2 else max(rank - 1, 0)
        along = (~ones & (ones + 1)).bit_length() - 1
        entry ^= turn(inner, n - axis - 1)
        axis = (axis + along + 1) % n
    return index


def _keys() -> dict[str, Column]:
    """What sharding needs of each document: id, size, checksum, source and language."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return {
        "doc_id": F.col("doc_id").cast("long"),
        "size": (F.octet_length(text) + 1).cast("long"),
        "text_crc32": F.crc32(text.cast("binary")),
        **{name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in TEXTS},
    }


def metadata(docs: DataFrame) -> DataFrame:
    return docs.select(*(value.alias(name) for name, value in _keys().items()))


def text_steps(rows: DataFrame, name: str, steps: int, path: str) -> DataFrame:
    """value and step of each distinct value of a text column: the share of rows before the middle of the value's rows.

    Distinct values are dealt by range and sorted within their part; only the sums of parts are brought together.
    """
    spark = rows.sparkSession
    values = rows.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("held"))
    values.repartitionByRange("value").withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/parts")
    values = spark.read.parquet(f"{path}/parts")
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = values.groupBy("part").agg(F.sum("held").alias("part_rows")).select(
        "part",
        F.coalesce(F.sum("part_rows").over(along), F.lit(0)).alias("before_part"),
        F.sum("part_rows").over(Window.partitionBy()).alias("total"),
    )
    own = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before_part") + F.coalesce(F.sum("held").over(own), F.lit(0))
    middle = values.join(F.broadcast(ahead), "part").withColumn("middle", 2 * before + F.col("held"))
    middle.select("value", F.expr(f"CAST(middle * {steps} DIV (2 * total) AS INT)").alias("step")).write.parquet(f"{path}/steps")
    return spark.read.parquet(f"{path}/steps")


def _steps(rows: DataFrame, bits: int, path: str) -> DataFrame:
    """Rows with a step of each dimension: d0 and d1 of source and language, d2 of size."""
    for k, name in enumerate(TEXTS):
        found = text_steps(rows, name, 1 << bits, f"{path}/{name}").select(F.col("value").alias(f"v{k}"), F.col("step").alias(f"d{k}"))
        if (found.agg(F.sum(F.octet_length(f"v{k}") + 16)).first()[0] or 0) <= BROADCAST_BYTES:
            found = F.broadcast(found)
        rows = rows.join(found, F.col(name) == F.col(f"v{k}"))
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = rows.agg(F.percentile_approx("size", cuts, 10_000)).first()[0] or []
    step = F.lit(0)
    for bound in bounds:  # a size that is several bounds takes as many steps at once
        step = step + (F.col("size") >= bound).cast("int")
    return rows.withColumn("d2", step)


def shard(docs: DataFrame, shards: int = 16, bits: int = BITS, part_rows: int = PART_ROWS) -> DataFrame:
    """Every document's shard and its slot in it; counts of shards differ by one row at most.

    Three steps that no hot value makes uneven: cells of the grid take their place on the curve (a table of
    8^bits rows), rows of a cell are dealt over as many parts as its count asks for, and each part is numbered
    on its own. The place of a row is the sum of what precedes its cell, its part and itself.
    """
    spark = docs.sparkSession
    stored = shared_folder(spark, "sharding")
    metadata(docs).write.parquet(f"{stored}/rows")
    rows = _steps(spark.read.parquet(f"{stored}/rows"), bits, stored)
    grid = product(range(1 << bits), repeat=3)
    curve = spark.createDataFrame(
        [(*point, hilbert_index(point, bits)) for point in grid], "d0 int, d1 int, d2 int, place int"
    )
    placed = rows.join(F.broadcast(curve), ["d0", "d1", "d2"]).select("doc_id", "size", "text_crc32", *TEXTS, "place")

    cells = placed.groupBy("place").agg(F.count("*").alias("cell_rows"))
    along = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "place",
        F.coalesce(F.sum("cell_rows").over(along), F.lit(0)).alias("before_cell"),
        F.sum("cell_rows").over(Window.partitionBy()).alias("total"),
        F.ceil(F.col("cell_rows") / part_rows).alias("parts"),
    )
    dealt = placed.join(F.broadcast(cells), "place").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("parts"))
    )
    ahead = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("place", "part").agg(F.count("*").alias("part_rows")).select(
        F.col("place").alias("p_place"),
        F.col("part").alias("p_part"),
        F.coalesce(F.sum("part_rows").over(ahead), F.lit(0)).alias("before_part"),
    )
    own = Window.partitionBy("place", "part").orderBy("doc_id", "text_crc32", "size", *TEXTS)
    numbered = dealt.withColumn("before_row", F.row_number().over(own) - 1)
    matched = (F.col("place") == F.col("p_place")) & (F.col("part") == F.col("p_part"))
    rank = F.col("before_cell") + F.col("before_part") + F.col("before_row")
    ranked = numbered.join(parts, matched).withColumn("rank", rank)
    exact = F.expr(f"CAST(rank * {shards} DIV total AS INT)")
    first = F.expr(f"(shard * total + {shards - 1}) DIV {shards}")
    return ranked.withColumn("shard", exact).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("place").alias("curve_place"),
        *TEXTS,
    )


def write(docs: DataFrame, path: str, shards: int = 16) -> DataFrame:
    """Store the documents by shard, in the order of the curve, and return the ranges of the shards, as stored with them.

    Ranges: shard, its rows, and least and greatest value of each dimension.
    """
    spark = docs.sparkSession
    work = shared_folder(spark, "shard-writer")
    shard(docs, shards).select("doc_id", "size", "text_crc32", *TEXTS, "shard", "slot").write.parquet(work)
    dealt = spark.read.parquet(work)
    key = ["doc_id", "size", "text_crc32", *TEXTS]
    names = [name for name in docs.columns if name.lower() != "shard"]
    given = docs.select(F.struct(*names).alias("given"), *(value.alias(name) for name, value in _keys().items()))
    if not dealt.groupBy(*key).count().where("count > 1").isEmpty():  # equal rows are told apart by a number
        dealt = dealt.withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy("shard", "slot")))
        given = given.withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("given"))))
        key = [*key, "copy"]
    dealt = dealt.select(*(F.col(name).alias(f"k_{name}") for name in key), "shard", "slot")
    same = [F.col(name).eqNullSafe(F.col(f"k_{name}")) for name in key]
    placed = given.join(dealt, same).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    placed.select("given.*", "shard").write.partitionBy("shard").parquet(f"{path}/rows")
    dimensions = ("size", *TEXTS)
    ends = [f(name).alias(f"{end}_{name}") for name in dimensions for f, end in ((F.min, "least"), (F.max, "greatest"))]
    spark.read.parquet(work).groupBy("shard").agg(F.count("*").alias("rows"), *ends).write.parquet(f"{path}/ranges")
    return spark.read.parquet(f"{path}/ranges")


def read(spark: SparkSession, path: str, dimension: str, low, high) -> DataFrame:
    """Stored documents whose source, language or size lies between two values; shards without any are not opened.

    Rows have the columns that were written, and shard.
    """
    ranges = spark.read.parquet(f"{path}/ranges")
    met = (F.col(f"greatest_{dimension}") >= F.lit(low)) & (F.col(f"least_{dimension}") <= F.lit(high))
    wanted = [row["shard"] for row in ranges.where(met).select("shard").toLocalIterator()]
    return spark.read.parquet(f"{path}/rows").where(F.col("shard").isin(wanted) & _keys()[dimension].between(low, high))
