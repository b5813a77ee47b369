"""Hard negatives by Fagin's threshold algorithm.

Vectors are made whole numbers, and a row's score is its inner product with the anchor. Each shard of rows keeps one
list per dimension, sorted by that component. An anchor reads the lists of its non-zero dimensions from the end that
its sign favours, all to the same depth; every row met is scored in full (random access). No row not yet met can
score above the threshold, the score of an imaginary row made of the last components read. A search ends once the
threshold is strictly below the k-th score of each window, so that ties are complete, or below the window itself.

Two searches: the k best rows of the anchor's label are its positives; each positive opens a window from 80 to 100
percent of its score, in which the k best rows of other labels are its hard negatives. Shards of bounded size meet
blocks of anchors of bounded size and return k rows a window, which are merged.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; a shorter
vector has zeros at its end; an empty vector scores 0; ties go to the smaller id; of repeated rows of one id only the
least by label and vector counts; scores beyond 64 bits count as the nearest long; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawarden.llm.texts import stored
from seawarden.session import shared_folder, ship_package

K = 5
#: Percent of the positive's score that a negative reaches at least.
LEAST_PERCENT = 80
SCALE = 256
#: Rows in a shard and anchors in a block, about.
SHARD_ROWS, BLOCK_ANCHORS = 20_000, 20_000
#: Rows read from each list in the first step; every further step reads as many as all before it.
FIRST_DEPTH = 16
LONG = (1 - (1 << 63), (1 << 63) - 1)


def prepare(vectors: DataFrame, shift_every: int = 7, labels: int = 10) -> DataFrame:
    """id, label and v of the rows that take part: v in whole numbers; the label moved on where the id says so."""
    moved = F.when(F.col("id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    whole = F.transform("v", lambda x: F.floor(x * float(SCALE)).cast("long"))
    rows = rows.select("id", moved.alias("label"), whole.alias("v"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, zeros after the end of shorter ones."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = lists.flatten().to_numpy()
    return out


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest type that adds up their products without rounding."""

    def largest(x: np.ndarray) -> int:
        return max(int(x.max(initial=0)), -int(x.min(initial=0)))

    most = largest(rows) * largest(anchors) * rows.shape[1]
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object
    return rows.astype(kind), anchors.astype(kind)


class SortedLists:
    """Rows with one list per dimension, sorted by that component."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32)

    def search(self, anchor: np.ndarray, usable: np.ndarray, windows: Sequence[tuple], k: int) -> tuple[np.ndarray, list]:
        """Positions and scores of usable rows that hold, for each window (least, greatest), its k best and their ties."""
        count = len(self.rows)
        upward, downward = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(count, bool)
        positions, scores = [np.zeros(0, np.int64)], [np.zeros(0, self.rows.dtype)]
        low = min(least for least, _ in windows)
        best = [np.zeros(0, self.rows.dtype)] * len(windows)
        depth = 0
        while depth < count:
            last, depth = depth, min(count, max(FIRST_DEPTH, 2 * depth))
            if len(upward) + len(downward):
                high = self.order[count - depth : count - last, upward]
                down = self.order[last:depth, downward]
                new = np.unique(np.concatenate([high.ravel(), down.ravel()]))
                new = new[~met[new]]
            else:  # every score is 0
                depth, new = count, np.arange(count)
            met[new] = True
            new = new[usable[new]]
            score = self.rows[new] @ anchor
            if score.dtype == object:
                score = np.clip(score, *LONG)
            held = score >= low
            positions.append(new[held])
            scores.append(score[held])
            threshold = anchor[upward] @ self.rows[self.order[count - depth, upward], upward]
            threshold += anchor[downward] @ self.rows[self.order[depth - 1, downward], downward]
            done = True
            for n, (least, greatest) in enumerate(windows):
                inside = score[(score >= least) & (score <= greatest)]
                best[n] = np.sort(np.concatenate([best[n], inside]))[::-1][:k]
                full = len(best[n]) == k and threshold < best[n][-1]
                done = done and bool(full or threshold < least)
            if done:
                break
        return np.concatenate(positions), np.concatenate(scores)


FOUND = "anchor_id long, least long, greatest long, found_id long, score long"


def _search(rows: DataFrame, anchors: DataFrame, width: int, k: int, same_label: bool) -> DataFrame:
    """The k best rows of each window of each anchor: of the anchor's label, or of all others.

    ``rows``: id, label, v; ``anchors``: the same and windows, a list of (least, greatest).
    """
    spark = rows.sparkSession
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))

    def spread(frame: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        numbered = frame.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(own_count)))
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_count - 1))))

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if len(shard) and len(block):
            matrix, asked = _exact(_matrix(shard["v"], width), _matrix(block["v"], width))
            ids, labels = shard["id"].to_numpy(), shard["label"].to_numpy()
            lists: dict = {}
            every = np.arange(len(ids))
            for at, (anchor_id, label, windows) in enumerate(
                zip(block["id"].to_pylist(), block["label"].to_pylist(), block["windows"].to_pylist(), strict=True)
            ):
                key = label if same_label else None
                if key not in lists:
                    members = every[labels == label] if same_label else every
                    lists[key] = (members, SortedLists(matrix[members]))
                members, index = lists[key]
                usable = ids[members] != anchor_id if same_label else labels[members] != label
                bounds = sorted({(w["least"], w["greatest"]) for w in windows})
                position, score = index.search(asked[at], usable, bounds, k)
                found = ids[members][position]
                for least, greatest in bounds:
                    inside = np.flatnonzero((score >= least) & (score <= greatest))
                    near = sorted((-int(score[i]), int(found[i])) for i in _top(score, inside, k))[:k]
                    for minus, other in near:
                        for column, item in zip(out, (anchor_id, least, greatest, other, -minus), strict=True):
                            column.append(item)
        names = [part.split()[0] for part in FOUND.split(", ")]
        return pa.table({name: pa.array(column, pa.int64()) for name, column in zip(names, out, strict=True)})

    ship_package(spark)
    keys = ["shard", "block"]
    left = spread(rows, "shard", shards, "block", blocks).groupBy(*keys)
    right = spread(anchors, "block", blocks, "shard", shards).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(run, FOUND)
    order = Window.partitionBy("anchor_id", "least", "greatest").orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _top(score: np.ndarray, inside: np.ndarray, k: int) -> np.ndarray:
    """Of some positions, those with the k greatest scores, and all that tie with the last."""
    if len(inside) <= k:
        return inside
    kth = np.sort(score[inside])[-k]
    return inside[score[inside] >= kth]


def mine(rows: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """Positives and hard negatives of the rows whose id is divisible by ``every``. ``rows`` as from ``prepare``."""
    spark = rows.sparkSession
    work = shared_folder(spark, "hard-negatives")
    rows = stored(rows, f"{work}/rows")
    anchors = stored(rows.where(F.col("id") % every == 0), f"{work}/anchors")
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)

    anything = f"array(named_struct('least', -{LONG[1]}L, 'greatest', {LONG[1]}L))"
    positives = _search(rows, anchors.withColumn("windows", F.expr(anything)), width, k, same_label=True)
    # 80 p <= 100 n <= 100 p for whole n: from the ceiling of 0.8 p, written as p less the floor of 0.2 p, to p
    least = F.col("score") - F.floor(F.col("score").cast("decimal(20,0)") * (100 - LEAST_PERCENT) / 100).cast("long")
    positives = positives.select(
        "anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"), least.alias("least")
    )
    positives = stored(positives, f"{work}/positives")

    window = F.struct("least", F.col("positive_score").alias("greatest"))
    opened = positives.where("least <= positive_score").groupBy(F.col("anchor_id").alias("id"))
    asked = anchors.join(opened.agg(F.collect_set(window).alias("windows")), "id")
    negatives = _search(rows, asked, width, k, same_label=False)
    negatives = negatives.select(
        F.col("anchor_id").alias("n_anchor"),
        F.col("greatest").alias("n_window"),
        "rank",
        F.col("found_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    same = (F.col("anchor_id") == F.col("n_anchor")) & (F.col("positive_score") == F.col("n_window"))
    return positives.join(negatives, same).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
