"""Sharding by a k-d tree: shards of nearly equal bytes whose documents are alike in their metadata.

The tree starts with all documents and the shards they have to fill. A node that has to fill more than one is cut in two along the
dimension in which its documents spread most, at the weighted quantile that gives either side its part of the bytes. Rows are written once and
never moved or marked: a task finds the node of a row by walking down the tree as it is so far, which is a few arrays. Quantiles are found from
histograms: a pass sums bytes per node and bin, for all nodes of a level at once, and the next pass looks closer at the one bin that holds the cut.
One grouped task a node finds that bin, so the driver sees one row a node.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import numbered, stored

VALUE_BITS, TIE_BITS = 31, 31
# Bins of a node and dimension, and bins of all nodes together that one pass may shuffle.
BINS = 1 << 16
PASS_ROWS = 1 << 22
# A cut is close enough when its bin holds at most this part of a shard.
TOLERANCE = 0.001

DIMENSIONS = ["source", "lang", "size"]


@dataclass
class Tree:
    """Nodes by number, the root first: dimension and key of the cut (-1: none yet), and the number of the left child, which the right one follows."""

    first: list[int]
    shards: list[int]
    dim: list[int]
    cut: list[int]
    left: list[int]

    @classmethod
    def of(cls, shards: int) -> Tree:
        return cls([0], [shards], [0], [-1], [0])

    def split(self, node: int, dim: int, cut: int) -> list[int]:
        half = self.shards[node] // 2
        self.dim[node], self.cut[node], self.left[node] = dim, cut, len(self.first)
        for first, shards in ((self.first[node], half), (self.first[node] + half, self.shards[node] - half)):
            for column, value in ((self.first, first), (self.shards, shards), (self.dim, 0), (self.cut, -1), (self.left, 0)):
                column.append(value)
        return [self.left[node], self.left[node] + 1]


def _walker(tree: Tree):
    """A function from keys (a row a document, a column a dimension) to nodes without a cut."""
    dim, cut, left = (np.array(x, np.int64) for x in (tree.dim, tree.cut, tree.left))

    def walk(keys: np.ndarray) -> np.ndarray:
        node = np.zeros(len(keys), np.int64)
        moving = np.flatnonzero(cut[node] >= 0)
        while len(moving):
            at = node[moving]
            node[moving] = left[at] + (keys[moving, dim[at]] >= cut[at])
            moving = moving[cut[node[moving]] >= 0]
        return node

    return walk


def _keys(dims: pa.Array, tie: pa.Array) -> np.ndarray:
    values = dims.flatten().to_numpy(zero_copy_only=False).reshape(len(tie), -1)
    return (values << TIE_BITS) + tie.to_numpy(zero_copy_only=False)[:, None]


def _ranked(values: DataFrame) -> DataFrame:
    """Rows (value, rank) of distinct strings: their places from 1 in byte order. Ranges of them are counted in their own tasks.

    The driver sees one count a range.
    """
    ordered = values.sort("value").withColumn("at", F.monotonically_increasing_id())
    ordered = stored(ordered.select("value", F.shiftright("at", 33).alias("range"), F.col("at").bitwiseAND((1 << 33) - 1).alias("inside")), "ranks")
    before, first = 1, []
    for r in sorted(ordered.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()):
        first.append((r.range, before))
        before += r.n
    listed = ordered.sparkSession.createDataFrame(first, "range long, first long")
    return ordered.join(F.broadcast(listed), "range").select("value", (F.col("first") + F.col("inside")).alias("rank"))


def _numbered(rows: DataFrame, dimensions: list[str], kinds: dict[str, str]) -> DataFrame:
    """Dimensions as whole numbers that keep their order: strings by their rank among all values, nulls first."""
    for i, name in enumerate(dimensions):
        if kinds[name] == "string":
            ranks = _ranked(rows.select(F.col(f"_{i}").alias("value")).filter("value IS NOT NULL").distinct())
            rows = rows.join(ranks, rows[f"_{i}"] == ranks["value"], "left").drop("value", f"_{i}").withColumn(
                f"_{i}", F.coalesce("rank", F.lit(0).cast("long"))).drop("rank")
        else:
            rows = rows.withColumn(f"_{i}", F.coalesce(F.col(f"_{i}").cast("long"), F.lit(-1).cast("long")))
    return rows


def _placed(docs: DataFrame, dimensions: list[str]) -> DataFrame:
    """Narrow rows: doc_id, size, text_crc32, dims (numbers), tie."""
    kinds = dict(docs.dtypes) | {"size": "bigint"}
    unknown = [d for d in dimensions if d not in kinds]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("size", F.octet_length(text).cast("long") + 8)
    rows = rows.select("doc_id", "size", F.crc32(text).alias("text_crc32"), *[F.col(f"`{d}`").alias(f"_{i}") for i, d in enumerate(dimensions)],
                       F.monotonically_increasing_id().alias("row"))
    rows = _numbered(stored(rows, "shard-values"), dimensions, kinds)
    rows = rows.select("doc_id", "size", "text_crc32", F.array(*[F.col(f"_{i}") for i in range(len(dimensions))]).alias("dims"), "row")
    # Ties of a value are cut by text, so copies stay together while they fit; then by id; then by row, for repeated rows.
    tie = (F.pmod(F.xxhash64("text_crc32"), F.lit(1 << 15)) * (1 << 16)
           + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 8)) * (1 << 8) + F.pmod(F.xxhash64("row"), F.lit(1 << 8)))
    return stored(rows.withColumn("tie", tie), "shard-rows")


def _scaled(rows: DataFrame, count: int) -> tuple[DataFrame, list[int], int]:
    """Dimensions counted from their smallest value, in at most VALUE_BITS bits; the largest of each, and the sum of sizes."""
    spans = rows.agg(F.sum("size").alias("total"), *[F.min(F.get("dims", F.lit(i))).alias(f"low{i}") for i in range(count)],
                     *[F.max(F.get("dims", F.lit(i))).alias(f"high{i}") for i in range(count)]).first()
    top = (1 << VALUE_BITS) - 1
    scaled, most = [], []
    for i in range(count):
        low, high = spans[f"low{i}"] or 0, spans[f"high{i}"] or 0
        value = F.get("dims", F.lit(i)) - F.lit(low)
        if high - low > top:
            value = F.floor(value.cast("double") / F.lit(float(high - low)) * top)
        scaled.append(value.cast("long"))
        most.append(min(high - low, top))
    return rows.withColumn("dims", F.array(*scaled)), most, spans.total or 0


HISTOGRAM = "node long, dim int, bin long, bytes long, least long, most long"


def _summed(rows: DataFrame, tree: Tree, ranges: dict[int, tuple[int, list[int], list[int], list[int]]]) -> DataFrame:
    """Bytes by (node, dim, bin) of the rows whose key lies in a range of their node, with the smallest and largest key there.

    ``ranges`` gives for each node that is looked at its dimensions, and low, high and step of the bins in each.
    """
    walk = _walker(tree)
    count = max(len(dims) for dims, *_ in ranges.values())
    table = np.zeros((len(tree.first), count, 4), np.int64)
    table[:, :, 3] = 1
    for node, (dims, lows, highs, steps) in ranges.items():
        table[node, :len(dims)] = np.stack([dims, lows, highs, steps], axis=1)

    def count_up(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, sizes = _keys(batch.column(0), batch.column(1)), batch.column(2).to_numpy()
            nodes = walk(keys)
            for i in range(count):
                dim, low, high, step = table[nodes, i].T
                key = keys[np.arange(len(keys)), dim]
                inside = (key >= low) & (key < high)
                if not inside.any():
                    continue
                node, dim, key, bins = nodes[inside], dim[inside], key[inside], (key[inside] - low[inside]) // step[inside]
                order = np.lexsort((bins, node))
                node, bins, key = node[order], bins[order], key[order]
                new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (bins[1:] != bins[:-1])]))
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array(node[new]), "dim": pa.array(dim[order][new].astype(np.int32)), "bin": pa.array(bins[new]),
                    "bytes": pa.array(np.add.reduceat(sizes[inside][order], new)),
                    "least": pa.array(np.minimum.reduceat(key, new)), "most": pa.array(np.maximum.reduceat(key, new))})

    sums = rows.select("dims", "tie", "size").mapInArrow(count_up, HISTOGRAM)
    return sums.groupBy("node", "dim", "bin").agg(F.sum("bytes").alias("bytes"), F.min("least").alias("least"), F.max("most").alias("most"))


CROSSED = "node long, dim int, bin long, bytes long, below long, total long"


def _crossed(sums: DataFrame, tree: Tree, most: list[int], targets: dict[int, float]) -> dict[int, tuple]:
    """For each node (dim, bin, bytes in it, bytes below it, bytes of all): the bin that its cut lies in, in the widest dimension.

    ``targets`` holds the bytes that are to lie left of a cut; a node that is not in it wants the part of its bytes that its left shards are.
    """
    shards = tree.shards

    def find(table: pa.Table) -> pa.Table:
        node = table["node"][0].as_py()
        columns = {c: table[c].to_numpy() for c in ("dim", "bin", "bytes", "least", "most")}
        spread = {}
        for d in sorted(set(columns["dim"].tolist())):
            of = columns["dim"] == d
            spread[d] = ((columns["most"][of].max() >> TIE_BITS) - (columns["least"][of].min() >> TIE_BITS)) / max(1, most[d])
        dim = max(spread, key=lambda d: (spread[d], -d))
        of = np.flatnonzero(columns["dim"] == dim)
        of = of[np.argsort(columns["bin"][of])]
        sizes = columns["bytes"][of]
        sums, total = np.cumsum(sizes), int(sizes.sum())
        target = targets.get(node, total * (shards[node] // 2) / shards[node])
        at = min(int(np.searchsorted(sums, target)), len(sums) - 1)
        return pa.table({"node": pa.array([node], pa.int64()), "dim": pa.array([dim], pa.int32()), "bin": pa.array([columns["bin"][of][at]], pa.int64()),
                         "bytes": pa.array([sizes[at]], pa.int64()), "below": pa.array([sums[at] - sizes[at]], pa.int64()), "total": pa.array([total], pa.int64())})

    return {r.node: (r.dim, r.bin, r.bytes, r.below, r.total) for r in sums.groupBy("node").applyInArrow(find, CROSSED).collect()}


def _cut_level(rows: DataFrame, tree: Tree, level: list[int], most: list[int], shard_bytes: float) -> list[int]:
    """Cut all nodes of a level; returns their children. Nodes without rows are left as they are."""
    bins = max(16, min(BINS, PASS_ROWS // (len(level) * len(most))))
    dims = list(range(len(most)))
    highs = [(m + 1) << TIE_BITS for m in most]
    ranges = {n: (dims, [0] * len(dims), highs, [-(-h // bins) for h in highs]) for n in level}
    targets: dict[int, float] = {}
    children: list[int] = []
    cuts: dict[int, tuple[int, int]] = {}
    while ranges:
        found = _crossed(_summed(rows, tree, ranges), tree, most, targets)
        narrowed = {}
        for node, (dim, at, size, below, total) in found.items():
            listed, lows, tops, steps = ranges[node]
            i = listed.index(dim)
            target = targets.get(node, total * (tree.shards[node] // 2) / tree.shards[node])
            low, high = lows[i] + at * steps[i], min(lows[i] + (at + 1) * steps[i], tops[i])
            if steps[i] <= 1 or size <= TOLERANCE * shard_bytes:
                cuts[node] = dim, high if below + size - target <= target - below else low
            else:
                targets[node] = target - below
                narrowed[node] = [dim], [low], [high], [-(-(high - low) // bins)]
        ranges = narrowed
        bins = max(16, min(BINS, PASS_ROWS // max(1, len(ranges))))
    for node, (dim, cut) in sorted(cuts.items()):
        children += tree.split(node, dim, cut)
    return children


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, dimensions: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard (from 0), slot (gapless from 0 in each shard).

    ``docs`` needs doc_id, text and the dimensions (default source, lang, and size, which is always there); text, number and date columns
    will do. A text dimension counts by the rank of its whole value among all. Size is the UTF-8 length of the text plus 8; a null text counts as an empty one. Either the number of shards is given, or the bytes a
    shard is to reach. Sizes of shards differ by single documents and a small part of a shard. Copies that are alike in the dimensions keep
    together unless a cut falls into their group; copies whose metadata differ are cut apart like any other rows. Null dimensions come first. Documents with equal ids, and
    repeated rows, each come out. An empty table has no rows.
    """
    dimensions = dimensions or DIMENSIONS
    rows, most, total = _scaled(_placed(docs, dimensions), len(dimensions))
    if n_shards is None:
        if not target_bytes:
            raise ValueError("give n_shards or target_bytes")
        n_shards = max(1, -(-total // target_bytes))
    tree = Tree.of(n_shards)
    level = [0] if n_shards > 1 and total else []
    while level:
        level = [n for n in _cut_level(rows, tree, level, most, total / n_shards) if tree.shards[n] > 1]
    walk, first = _walker(tree), np.array(tree.first, np.int64)

    @F.arrow_udf("long")
    def shard(dims: pa.Array, tie: pa.Array) -> pa.Array:
        return pa.array(first[walk(_keys(dims, tie))])

    placed = rows.select("doc_id", "size", "text_crc32", shard("dims", "tie").alias("shard"), "row")
    out = numbered(placed, "slot", within=["shard"], order=["doc_id", "text_crc32", "row"])
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")
