"""Jaccard join of documents by prefixes of token combinations.

A document's tokens are its word shingles. Tokens fall into three classes by how many documents hold them: rare
ones, frequent ones, very frequent ones. In one order of all tokens, rare classes first, a document's prefix is as
long as it takes to be sure: two linked sets share a rare token of their prefixes, or two frequent or three very
frequent ones of one group. Classes are dealt into groups by hash, so many that only a few tokens of a prefix meet
in one; a class of k-token combinations may miss k - 1 tokens in each group, and the prefix is extended by as many.
So single tokens are indexed where they are rare, and k-token combinations where single ones would list too many.

Frequencies come from one table of counts by token hash, added up over all documents. It only orders tokens: any
order gives the same links. Equal sets are one node. The nodes of an index entry meet at the entry's most typical
node, its hub; hubs are few, and the sets of all nodes of a hub are compared in full by counting their common
tokens, in blocks of bounded size. Before sets are sent, nodes of a block are compared by bitmaps of their tokens, a
bit or two a token, which bound from above how many tokens two sets share; only nodes that a bitmap lets be linked
send their sets. Hubs too large for one block first link their nodes with the hub itself, and are
searched further only if several components are left. Each block returns links that join components, no more.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; fewer words
than a shingle make one shingle; rows without doc_id are linked with nothing and have no component; repeated rows
are linked with each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.llm.components import components
from seawarden.llm.texts import stored
from seawarden.session import shared_folder, ship_package

U64 = np.uint64
SHINGLE_WORDS = 5
#: Percent of the union that two sets must share.
SIMILARITY = 80
#: Counts by token hash: 8 million cells, sent on in blocks.
CELL_BITS, BLOCK_BITS = 23, 13
#: A token is frequent if its cell counts more than this, and more than this many times the mean cell.
FREQUENT, FREQUENT_MEANS = 16, 4
#: A token is very frequent if its cell counts this many times more.
VERY = 16
#: Groups of a class: one for each so many tokens of the smallest set of a level. Sizes of a level differ fourfold.
GROUP_TOKENS, LEVEL = 10, 4
#: Nodes and bytes of sets in a block, and common tokens counted at once.
BLOCK_NODES, BLOCK_BYTES, AT_ONCE = 4096, 32 << 20, 4_000_000
#: Nodes of a group after which memory is given back to the system.
RELEASE_NODES = 256
#: Bits of the smallest and the largest bitmap of a set; between them there are two to four bits a token.
LEAST_BITS, MOST_BITS = 256, 1 << 20
#: Nodes of one signature in a part, about.
SPLIT_NODES = 1_000_000
#: Ids that are broadcast at most (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000


def sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The shingle set of each document: sorted hashes over words with A-Z lower-cased."""
    out = []
    for first, last in texts.chunks(offsets):
        part = texts.LOWER[raw[offsets[first] : offsets[last]]]
        words = texts.Words(part, offsets[first : last + 1] - offsets[first])
        hashes = words.hashes()
        out += [texts.shingles(hashes[a:b], size) for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
    return out


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U64(64 - CELL_BITS)).astype(np.int64)


def bitmap(tokens: np.ndarray) -> bytes:
    """A set's tokens dealt over bits by hash; the half of it with the high numbers laid over the other is a smaller one."""
    bits = LEAST_BITS
    while bits < 2 * len(tokens) and bits < MOST_BITS:
        bits *= 2
    flags = np.zeros(bits, bool)
    flags[(texts.mix(tokens) & U64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags).tobytes()


def profile(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, content (a hash of the text), n_shingles, node (a hash of the set) and bits (its bitmap) of each row.

    Each task adds rows of its own at its end: blocks of its counts by token hash. Equal sets of a batch count once.
    """

    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            found = sets(*texts.string_bytes(batch["text"]), size)
            sums = [texts.mix(s).sum(dtype=U64) + U64(len(s)) for s in found]
            nodes = texts.mix(np.asarray(sums, U64)).view(np.int64)
            for k in np.unique(nodes, return_index=True)[1]:
                np.add.at(cells, _cell(found[k]), np.uint32(1))
            columns = {
                "doc_id": batch["doc_id"],
                "content": batch["content"],
                "n_shingles": pa.array([len(s) for s in found], pa.int64()),
                "node": pa.array(nodes),
                "bits": pa.array([bitmap(s) for s in found], pa.binary()),
                "block": pa.nulls(batch.num_rows, pa.int32()),
                "cells": pa.nulls(batch.num_rows, pa.binary()),
            }
            yield texts.table(None, columns)
        blocks = cells.reshape(-1, 1 << BLOCK_BITS)
        filled = np.flatnonzero(blocks.any(axis=1))
        packed = [row.astype(np.uint8 if row.max() < 256 else np.uint32).tobytes() for row in blocks[filled]]
        empty = {name: pa.nulls(len(filled), pa.int64()) for name in ("doc_id", "content", "n_shingles", "node")}
        empty["bits"] = pa.nulls(len(filled), pa.binary())
        more = {"block": pa.array(filled.astype(np.int32)), "cells": pa.array(packed, pa.binary())}
        yield texts.table(None, empty | more)
        texts.release()

    ship_package(docs.sparkSession)
    rows = texts.ids_and_texts(docs, F.xxhash64("text").alias("content"))
    return rows.mapInArrow(run, "doc_id long, content long, n_shingles long, node long, bits binary, block int, cells binary")


class Frequencies:
    """The class of each token hash and its place in the order of tokens, as one byte: 8 steps for each doubling."""

    def __init__(self, cells: np.ndarray):
        self.order = np.empty(len(cells), np.uint8)
        for at in range(0, len(cells), 1 << 16):  # in stretches, as it is worked out on the driver
            some = slice(at, at + (1 << 16))
            self.order[some] = np.minimum(np.rint(8 * np.log2(cells[some] + 1.0)), 255)
        least = max(FREQUENT, FREQUENT_MEANS * float(cells.mean(dtype=np.float64)))
        self.bounds = np.rint(8 * np.log2(np.asarray([least, least * VERY]) + 1.0))

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = self.order[_cell(tokens)]
        return order, 1 + np.searchsorted(self.bounds, order, "left")


def count_cells(blocks: DataFrame) -> np.ndarray:
    """The counts of all tasks added up; as many cells whatever the input. Large ones are rounded to 24 bits."""

    def add_up(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK_BITS, np.int64)
        for cells in table["cells"]:
            data = cells.as_buffer()
            total += np.frombuffer(data, np.uint8 if data.size == total.size else np.uint32)
        return pa.table({"block": table["block"][:1], "total": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((1 << CELL_BITS - BLOCK_BITS, 1 << BLOCK_BITS), np.float32)
    for row in blocks.groupBy("block").applyInArrow(add_up, "block int, total binary").toLocalIterator():
        out[row["block"]] = np.frombuffer(row["total"], np.int64)
    return out.ravel()


def signatures(tokens: np.ndarray, frequencies: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """Single tokens and token combinations of a set's prefix: two linked sets have one in common.

    With each, the place of its rarest token in the order, which says how many sets can have it.

    Of n tokens a linked set lacks at most n - ceil(0.8 n). A prefix that counts one more, where a group of a class
    counts all its tokens but k - 1, therefore holds a token or a combination that the other set's prefix holds too.
    Sets of less than four tokens are linked with equal sets only, which are one node.
    """
    n = len(tokens)
    if n < 4:
        return np.zeros(0, U64), np.zeros(0, np.uint8)
    needed = n - -(-SIMILARITY * n // 100) + 1
    order, kind = frequencies.of(tokens)
    rare = np.flatnonzero(kind == 1)
    if len(rare) >= needed:
        rare = rare[np.lexsort((tokens[rare], order[rare]))[:needed]]
        return tokens[rare], order[rare]
    needed -= len(rare)
    others = np.flatnonzero(kind > 1)
    others = others[np.lexsort((tokens[others], order[others], kind[others]))]
    out, places = [tokens[rare]], [order[rare]]
    for level in _levels(n):
        groups = max(1, LEVEL**level // GROUP_TOKENS)
        met: dict[tuple, list] = {}
        counted = 0
        for token, k, at in zip(tokens[others].tolist(), kind[others].tolist(), others.tolist(), strict=True):
            group = met.setdefault((k, token % groups), [])
            group.append(at)
            counted += len(group) >= k
            if counted >= needed:
                break
        for (k, _), group in met.items():
            picked = np.asarray(list(combinations(sorted(group), k)), np.int64).reshape(-1, k)
            folded = np.full(len(picked), level * 4 + k, U64)
            for column in picked.T:
                folded = texts.mix(folded * U64(3) + tokens[column])
            out.append(folded)
            places.append(order[picked].min(axis=1, initial=255))
    return np.concatenate(out), np.concatenate(places)


def _levels(n: int) -> list[int]:
    """Levels of size at which a set of n tokens is indexed: its own, and that of any size it can be linked with."""

    def level(size: int) -> int:
        found = 0
        while LEVEL ** (found + 1) <= size:
            found += 1
        return found

    return sorted({level(-(-SIMILARITY * n // 100)), level(n), level(100 * n // SIMILARITY)})


def index(reps: DataFrame, frequencies: Frequencies, size: int) -> DataFrame:
    """sig, part, typical (greater for sets of more frequent tokens) and node of every signature of every node.

    A signature that very many sets can have is dealt over parts.
    """
    shared, split = reps.sparkSession.sparkContext.broadcast(frequencies), SPLIT_NODES

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        nodes = batch["node"].to_numpy()
        found, places, typical = [], [], []
        for tokens in sets(*texts.string_bytes(batch["text"]), size):
            sigs, place = signatures(tokens, known)
            found.append(sigs)
            places.append(place)
            typical.append(int(256 * known.of(tokens)[0].mean()) if len(tokens) else 0)
        many = [len(s) for s in found]
        node = np.repeat(nodes, many)
        parts = 1 + (np.exp2(np.concatenate(places) / 8.0) / split).astype(np.int64)
        columns = {
            "sig": pa.array(np.concatenate(found).view(np.int64)),
            "part": pa.array(np.where(parts > 1, 1 + node % parts, 0).astype(np.int32)),
            "typical": pa.array(np.repeat(np.asarray(typical, np.int32), many)),
            "node": pa.array(node),
        }
        return texts.table(None, columns)

    return texts.per_batch(reps.select("node", "text"), run, "sig long, part int, typical int, node long")


def hubs(indexed: DataFrame) -> DataFrame:
    """Distinct (sig, hub, node): the nodes of each signature with its hub, the most typical of them.

    Signatures are dealt by hash and sorted, and pass by in a stream. Each part of a signature has a hub of its own;
    only such rows name the signature, so that its parts can be brought together.
    """

    def run(batches):
        last = (None, None, None)
        for batch in batches:
            sig, part, node = (batch[name].to_numpy() for name in ("sig", "part", "node"))
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (part[1:] != part[:-1])
            hub = node[np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))]
            if len(sig) and last[:2] == (sig[0], part[0]):
                hub[: np.argmax(new[1:]) + 1 if new[1:].any() else len(hub)] = last[2]
            if len(sig):
                last = (sig[-1], part[-1], hub[-1])
            listed = (hub != node) | (part > 0)
            columns = {
                "sig": pa.array(sig[listed], mask=part[listed] == 0),
                "hub": pa.array(hub[listed]),
                "node": pa.array(node[listed]),
            }
            yield texts.table(None, columns)

    sorted_rows = indexed.repartition("sig", "part").sortWithinPartitions("sig", "part", F.desc("typical"), "node")
    return sorted_rows.mapInArrow(run, "sig long, hub long, node long").distinct()


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text of the rows (doc_id, content) that stand for wanted nodes; a repeated row more than once."""
    wanted = wanted.select("node", F.col("doc_id").alias("w_id"), F.col("content").alias("w_content"))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    rows = texts.ids_and_texts(docs).withColumn("content", F.xxhash64("text"))
    return rows.join(wanted, (F.col("doc_id") == F.col("w_id")) & (F.col("content") == F.col("w_content"))).select("node", "text")


def comparable(members: DataFrame) -> DataFrame:
    """Of (hub, node, n), without the nodes whose size is too far from that of every other node of the hub.

    Sizes fall into steps of a tenth, and linked sets lie three steps apart at most.
    """
    step = F.floor(F.log("n") / float(np.log(1.1))).cast("int")
    reach = int(np.ceil(np.log(100 / SIMILARITY) / np.log(1.1)))
    sized = members.withColumn("step", step)
    held = sized.groupBy("hub", "step").agg(F.count("*").alias("held"))
    around = F.explode(F.sequence(F.col("step") - reach, F.col("step") + reach)).alias("step")
    around = held.select("hub", around, "held").groupBy("hub", "step").agg(F.sum("held").alias("held"))
    return sized.join(around.where("held > 1").drop("held"), ["hub", "step"]).drop("step")


def _linked(common: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return 100 * common >= SIMILARITY * (one + two - common)


def star_links(members: DataFrame, whole: DataFrame) -> DataFrame:
    """Of (hub, node), those whose sets are linked, as (a, b)."""
    one = whole.select(F.col("node").alias("hub"), F.col("tokens").alias("t_hub"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch["t_hub"].to_pylist(), batch["tokens"].to_pylist(), strict=True)
        near = []
        for a, b in pairs:
            a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
            near.append(bool(_linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))))
        return pa.RecordBatch.from_arrays([batch["hub"], batch["node"]], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    joined = members.where("hub <> node").join(whole, "node").join(one, "hub").select("hub", "node", "tokens", "t_hub")
    return texts.per_batch(joined, run, "a long, b long")


def _sides(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the two blocks that a table holds, and whether it is one block with itself."""
    if block.min() == block.max():
        return np.arange(len(block)), np.arange(len(block)), True
    return np.flatnonzero(block == block.min()), np.flatnonzero(block != block.min()), False


def _released(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """Gives memory back after a large group, when what the work on it had made is gone."""

    @wraps(work)
    def run(table: pa.Table) -> pa.Table:
        found = work(table)
        if table.num_rows > RELEASE_NODES:
            texts.release()
        return found

    return run


def _folded(maps: list[np.ndarray], rows: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of the rows, of this many words or twice as many, as one column of words after the other."""
    out = np.empty((words, len(rows)), np.uint64)
    for k, row in enumerate(rows):
        own = maps[row]
        out[:, k] = own if len(own) == words else own[:words] | own[words:]
    return out


@_released
def _near(table: pa.Table) -> pa.Table:
    """Rows whose bitmap lets their set be linked with that of a row of the other block and another component.

    Of n tokens whose bitmap has b bits, c of them in another bitmap too, at most n - b + c are in the other set. Sizes
    of linked sets lie so close that their bitmaps have the same width, or one has twice that of the other.
    """
    n, label = table["n"].to_numpy(), table["label"].to_numpy()
    maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["bits"]]
    width = np.asarray([len(x) for x in maps])
    left, right, alone = _sides(table["block"].to_numpy())
    left, right = left[np.argsort(n[left], kind="stable")], right[np.argsort(n[right], kind="stable")]
    near = np.zeros(len(n), bool)
    for words in np.unique(width).tolist():
        for one, two in [(1, 1), (1, 2)] + ([] if alone else [(2, 1)]):
            a, b = left[width[left] == one * words], right[width[right] == two * words]
            if not len(a) or not len(b):
                continue
            a_maps, b_maps = _folded(maps, a, words), _folded(maps, b, words)
            a_lost = n[a] - np.bitwise_count(a_maps).sum(axis=0, dtype=np.int64)
            b_lost = n[b] - np.bitwise_count(b_maps).sum(axis=0, dtype=np.int64)
            many = max(1, AT_ONCE // 8 // len(b))
            for at in range(0, len(a), many):
                some = slice(at, at + many)
                sizes = n[a[some]]
                low = np.searchsorted(n[b], SIMILARITY * sizes[0] // 100, "left")
                high = np.searchsorted(n[b], 100 * sizes[-1] // SIMILARITY + 1, "right")
                if low >= high:
                    continue
                common = np.zeros((len(sizes), high - low), np.int32)
                for x, y in zip(a_maps[:, some], b_maps[:, low:high], strict=True):
                    common += np.bitwise_count(x[:, None] & y[None, :])
                most = common + np.minimum(a_lost[some][:, None], b_lost[low:high][None, :])
                met = _linked(most, sizes[:, None], n[b[low:high]][None, :])
                met &= label[a[some]][:, None] != label[b[low:high]][None, :]
                near[a[some]] |= met.any(axis=1)
                near[b[low:high]] |= met.any(axis=0)
    return table.drop_columns(["n", "bits"]).filter(pa.array(near, pa.bool_()))


@_released
def _links(table: pa.Table) -> pa.Table:
    """Links that join the components of two blocks of a hub, or of one block with itself."""
    node, label = table["node"].to_numpy(), table["label"].to_numpy()
    tokens = [np.frombuffer(x.as_buffer(), "<u8") for x in table["tokens"]]
    sizes = np.asarray([len(t) for t in tokens])
    left, right, _ = _sides(table["block"].to_numpy())
    values = np.concatenate([tokens[i] for i in right])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    by_value = np.argsort(values, kind="stable")
    owner = owner[by_value]
    known, first, held = np.unique(values[by_value], return_index=True, return_counts=True)
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    a, b, at = [], [], 0
    while at < len(left):
        stop, asked, work = at, [], 0
        while stop < len(left) and (stop == at or work < AT_ONCE and (stop - at) * len(right) < AT_ONCE):
            own = tokens[left[stop]]
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            asked.append(place[known[place] == own])
            work += int(held[asked[-1]].sum())
            stop += 1
        place = np.concatenate(asked)
        who = np.repeat(np.arange(stop - at), [len(x) for x in asked])
        many = held[place]
        found = np.repeat(first[place] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        pairs = np.repeat(who, many) * len(right) + owner[found]
        common = np.bincount(pairs, minlength=(stop - at) * len(right)).reshape(stop - at, len(right))
        some = left[at:stop]
        near = _linked(common, sizes[some][:, None], sizes[right][None, :])
        near &= label[some][:, None] != label[right][None, :]
        for i, j in zip(*np.nonzero(near), strict=True):
            one, two = top(int(label[some[i]])), top(int(label[right[j]]))
            if one != two:
                above[max(one, two)] = min(one, two)
                a.append(int(node[some[i]]))
                b.append(int(node[right[j]]))
        at = stop
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def hub_links(members: DataFrame, maps: DataFrame, sets_of: Callable[[DataFrame, str], DataFrame], work: str) -> DataFrame:
    """Links (a, b) that connect all linked nodes that share a hub.

    ``members``: distinct hub, node and n; ``maps``: node and its bits; ``sets_of``: stores the nodes' sets under a name.
    """
    size = members.groupBy("hub").agg(F.count("*").alias("nodes"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES))
    size = stored(size.select("hub", blocks.alias("blocks")), f"{work}/hubs")
    members = members.join(size, "hub").withColumn("label", F.col("node"))
    first = None
    large = members.where("blocks > 1")
    if not size.where("blocks > 1").isEmpty():
        whole = sets_of(large.select("node"), "hub_sets")
        first = stored(star_links(large.select("hub", "node"), whole), f"{work}/stars")
        named = components(first).select(F.col("node").alias("l_node"), F.col("label").alias("l_label"))
        members = members.join(named, F.col("node") == F.col("l_node"), "left")
        members = members.withColumn("label", F.coalesce("l_label", "label")).drop("l_node", "l_label")
        mixed = members.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        members = members.join(mixed.where("low < high").select("hub"), "hub")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = members.select("hub", "node", "n", "label", own.alias("block"), other)
    dealt = dealt.select(
        "hub", "node", "n", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    ship_package(members.sparkSession)
    schema = "node long, hub long, label long, block long, low long, high long"
    dealt = dealt.join(maps, "node").select("node", "hub", "n", "label", "block", "low", "high", "bits")
    near = stored(dealt.groupBy("hub", "low", "high").applyInArrow(_near, schema), f"{work}/near")
    whole = sets_of(near.select("node"), "sets")
    found = near.join(whole, "node").groupBy("hub", "low", "high").applyInArrow(_links, "a long, b long")
    found = stored(found, f"{work}/links")
    return found if first is None else found.union(first)


def groups(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    spark = docs.sparkSession
    work = shared_folder(spark, "jaccard-join")
    with texts.small_batches(spark):
        profiled = stored(profile(docs, size), f"{work}/profiles")
    mapped = profiled.where("block IS NULL").drop("block", "cells")
    signed = mapped.drop("bits")
    frequencies = Frequencies(count_cells(profiled.where("block IS NOT NULL").select("block", "cells")))
    nodes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("node", F.col("n_shingles").alias("n"))
    nodes = nodes.agg(F.min("doc_id").alias("doc_id"), F.min_by("content", "doc_id").alias("content"))
    nodes = stored(nodes, f"{work}/nodes")

    with texts.small_batches(spark):
        met = stored(hubs(index(_texts_of(docs, nodes), frequencies, size)), f"{work}/listed")
    split = met.where("sig IS NOT NULL")
    top = split.groupBy(F.col("sig").alias("h_sig")).agg(F.max("hub").alias("top"))
    split = split.join(top, F.col("sig") == F.col("h_sig")).select(F.col("top").alias("hub"), "node")
    met = met.where("sig IS NULL").select("hub", "node").union(split).where("hub <> node").distinct()
    met = stored(met, f"{work}/met")
    members = met.union(met.select("hub", F.col("hub").alias("node")).distinct())
    members = stored(comparable(members.join(nodes.select("node", "n"), "node")), f"{work}/members")

    repeated = not signed.groupBy("doc_id", "content").count().where("count > 1 AND doc_id IS NOT NULL").isEmpty()

    def once(found: DataFrame) -> DataFrame:
        return found.dropDuplicates(["node"]) if repeated else found  # a repeated row stands for its node more than once

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [s.astype("<u8").tobytes() for s in sets(*texts.string_bytes(batch["text"]), size)]
        return texts.table(None, {"node": batch["node"], "tokens": pa.array(found, pa.binary())})

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        rows = _texts_of(docs, nodes.join(wanted.distinct(), "node"))
        with texts.small_batches(spark):
            return stored(once(texts.per_batch(rows, run, "node long, tokens binary")), f"{work}/{name}")

    first = nodes.join(members.select("node").distinct(), "node").select("node", "doc_id", "content")
    maps = mapped.select("doc_id", "content", "bits").join(first, ["doc_id", "content"]).select("node", "bits")
    labels = components(hub_links(members, once(maps), sets_of, work))

    named = labels.join(nodes.select("node", "doc_id"), "node")
    smallest = named.groupBy(F.col("label").alias("s_label")).agg(F.min("doc_id").alias("smallest"))
    linked = labels.join(smallest, F.col("label") == F.col("s_label")).select(F.col("node").alias("l_node"), "smallest")
    first = nodes.select(F.col("node").alias("n_node"), F.col("n").alias("n_n"), F.col("doc_id").alias("first_id"))
    first = first.join(linked, F.col("n_node") == F.col("l_node"), "left")
    first = first.select("n_node", "n_n", F.coalesce("smallest", "first_id").alias("found"))
    same = (F.col("node") == F.col("n_node")) & (F.col("n_shingles") == F.col("n_n")) & F.col("doc_id").isNotNull()
    judged = signed.join(first, same, "left")
    return judged.select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
