"""Gradient-boosted regression trees whose result does not depend on how rows are laid out.

The trees are a table of nodes. Node 1 is a tree's root, the children of node n are
2 n (values up to the threshold, and nulls) and 2 n + 1. Tree 0 is one leaf, the mean label.
A row's prediction is the sum, over all trees, of the value of the leaf it comes to.

Rows are held as blocks, in bins of two bytes a feature. Level by level, each block sums
residuals and rows by (node, feature, bin); the sums, whose size depends on nodes and bins
alone, are added up and give the splits. Three things make the trees the same for every
number of blocks and order of rows:

- labels, predictions and leaf values are whole multiples of one power of two, chosen so that
  any sum of residuals is exact: addition in any order gives the same bits;
- whether a tree sees a row follows from the row's key, the tree and the seed;
- columns are drawn once a tree, from the seed.

Up to ``ROWS_PER_TASK`` rows are one block, and one task grows all trees: a job a level
would cost more than its work. More rows are blocks of an RDD, with a job a level.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.functions import literal_frame
from tripdemand.session import checkpoint_dir, on_workers

NODES = "tree int, node int, feature string, threshold double, value double, gain double, row_count long"
ROWS_PER_TASK = 250_000
#: Sums of more tasks are added up in two steps.
MANY_TASKS = 32
CHECKPOINT_TREES = 25
#: Leaf values are multiples of 2 ** -FINEST at the finest.
FINEST = 20
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def number(column: str) -> Column:
    """A feature as a double; nan is null."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def thresholds(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """For each feature, at most ``max_bins - 1`` thresholds, between neighbouring values.

    All gaps between different values if they are few enough, else those at equal shares of
    rows. (feature, value) pairs are counted first, so a task sees the different values of a
    feature (calendar, zones, weather as measured: some thousands), not its rows; what
    reaches the driver is bounded by features x bins.
    """
    pairs = rows.select(F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(c).alias("v")) for i, c in enumerate(features)))).alias("p"))
    counts = pairs.select("p.*").where("v is not null").groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    by_value, whole = Window.partitionBy("f").orderBy("v"), Window.partitionBy("f")
    ranked = counts.select(
        "f", "v", F.lead("v").over(by_value).alias("next"), F.count(F.lit(1)).over(whole).alias("values"),
        F.floor(F.sum("n").over(by_value) * (max_bins - 1) / F.sum("n").over(whole)).alias("share"),
    )
    ranked = ranked.withColumn("ends", (F.col("values") <= max_bins) | (F.col("share") != F.lag("share", 1, 0).over(by_value)))
    cuts: list[list[float]] = [[] for _ in features]
    for r in ranked.where("ends and next is not null").select("f", ((F.col("v") + F.col("next")) / 2).alias("cut")).collect():
        cuts[r.f].append(r.cut)
    return [sorted(c) for c in cuts]


def columns_of(tree: int, n_features: int, share: float, seed: int) -> list[int]:
    """The features that a tree may use."""
    order = np.argsort(scrambled(np.arange(n_features, dtype=np.uint64) + np.uint64((seed * 1_000_003 + tree) * 4099 % 2**64)), kind="stable")
    return sorted(order[: max(1, round(share * n_features))].tolist())


def fit_trees(train: DataFrame, key: Sequence[str], features: Sequence[str], label: str, n_trees: int, max_depth: int,
              learning_rate: float, subsample: float, colsample: float, max_bins: int, seed: int,
              ridge: float = 1.0, tasks: int | None = None) -> DataFrame:
    """The nodes of the fitted trees (``NODES``).

    ``key`` names the columns that tell rows apart. Rows without a label take no part; an empty
    table gives tree 0 with value 0. ``ridge`` is added to every leaf's row count. What one
    task takes is fitted by one task as the plan that is returned; more rows are fitted at once.
    """
    spark = train.sparkSession
    on_workers(spark)
    rows = train.select(
        F.xxhash64(*key).alias("key"), F.col(label).cast("double").alias("label"), *(number(c).alias(c) for c in features)
    ).where("label is not null")
    n, most = rows.agg(F.count(F.lit(1)), F.max(F.abs("label"))).first()
    if not n:
        return literal_frame(spark, [(0, 1, None, None, 0.0, None, 0)], NODES.replace("long", "bigint"))
    unit = 2.0 ** -min(FINEST, 50 - math.ceil(math.log2(max(1.0, n * most))))
    fixed = F.round(F.col("label") / F.lit(unit)).cast("long")
    base = round(int(rows.agg(F.sum(fixed)).first()[0]) / n)
    plan = Plan(thresholds(rows, features, max_bins), n_trees, max_depth, learning_rate, subsample, colsample, seed, ridge)
    dealt = rows.withColumn("label", fixed)
    tasks = tasks or min(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))

    def table(trees: Iterator[Tree]) -> pa.RecordBatch:
        nodes = [(0, 1, None, None, base * unit, None, n)]
        for t in trees:
            for node, f, cut, value, gain, count in t.nodes:
                nodes.append((t.number, node, None if f is None else features[f], None if f is None else plan.cuts[f][cut],
                              value * unit if f is None else None, gain, count))
        types = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes, strict=True), types, strict=True)], [c.split()[0] for c in NODES.split(", ")])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield table(Alone(block_of(batches, plan.cuts, base)).grow(plan))

    if tasks == 1:
        return dealt.coalesce(1).mapInArrow(alone, NODES)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block_of(batches, plan.cuts, base))], pa.binary())], ["block"])

    checkpoint_dir(spark)
    held = dealt.repartition(tasks, "key").mapInArrow(blocks, "block binary").rdd.map(lambda r: pickle.loads(r.block))
    return spark.createDataFrame(table(Together(held).grow(plan)).to_pandas().astype(object).where(lambda x: x.notna(), None), NODES)


class Plan(NamedTuple):
    """The settings of a fit, and each feature's thresholds."""

    cuts: list[list[float]]
    n_trees: int
    max_depth: int
    rate: float
    subsample: float
    colsample: float
    seed: int
    ridge: float


class Tree:
    """A tree that grows level by level from sums over all rows."""

    def __init__(self, number: int, plan: Plan) -> None:
        self.number, self.seed, self.subsample = number, plan.seed, plan.subsample
        self.columns = columns_of(number, len(plan.cuts), plan.colsample, plan.seed)
        self.widths = [len(plan.cuts[f]) + 1 for f in self.columns]
        size = 2 << plan.max_depth
        self.feature, self.split, self.value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.open = np.array([1])
        self.depth = 0
        #: (node, feature, split, value, gain, rows)
        self.nodes: list[tuple[int, int | None, int | None, int | None, float | None, int]] = []

    def leaf_of(self, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The node that each of the rows is in so far."""
        node = np.ones(len(rows), np.int64)
        for _ in range(self.depth):
            f = self.feature[node]
            inner = np.flatnonzero(f >= 0)
            at = node[inner]
            node[inner] = 2 * at + (bins[f[inner], rows[inner]] > self.split[at])
        return node

    def level(self, sums: np.ndarray, plan: Plan) -> bool:
        """Split the open nodes, or close them; whether any is open then."""
        first = slice(0, self.widths[0])
        whole, count = sums[0, :, first].sum(1), sums[1, :, first].sum(1)
        gain, feature, split = self._best(sums, whole, count, plan.ridge)
        if self.depth == plan.max_depth:
            gain[:] = 0
        following = []
        for i, n in enumerate(self.open.tolist()):
            if gain[i] > 0:
                self.feature[n], self.split[n] = feature[i], split[i]
                following += [2 * n, 2 * n + 1]
                self.nodes.append((n, int(feature[i]), int(split[i]), None, float(gain[i]), int(count[i])))
            else:
                self.value[n] = round(plan.rate * int(whole[i]) / (int(count[i]) + plan.ridge))
                self.nodes.append((n, None, None, int(self.value[n]), None, int(count[i])))
        self.open = np.array(following, np.int64)
        self.depth += 1
        return bool(following)

    def _best(self, sums: np.ndarray, whole: np.ndarray, count: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The gain, feature and split of the best split of each open node; gain 0 if there is none."""
        n = len(whole)
        gain, feature, split = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
        without = whole.astype(np.float64) ** 2 / (count + ridge)
        at = 0
        for f, width in zip(self.columns, self.widths, strict=True):
            left = sums[:, :, at : at + width - 1].cumsum(2)
            at += width
            if width == 1:
                continue
            g, h = left[0].astype(np.float64), left[1]
            other, rest = whole[:, None] - g, count[:, None] - h
            with np.errstate(invalid="ignore", divide="ignore"):
                gains = np.where((h > 0) & (rest > 0), g * g / (h + ridge) + other * other / (rest + ridge) - without[:, None], 0.0)
            i = gains.argmax(1)
            best = gains[np.arange(n), i]
            better = best > gain * (1 + 1e-12)
            gain[better], feature[better], split[better] = best[better], f, i[better]
        return gain, feature, split


class Block(NamedTuple):
    """Some of the rows: keys, labels and predictions in units, and a bin for each feature and row."""

    key: np.ndarray
    label: np.ndarray
    bins: np.ndarray
    predicted: np.ndarray

    def sums(self, tree: Tree) -> np.ndarray:
        """(residuals, rows) by open node and bin of each of the tree's columns, the columns side by side."""
        draw = scrambled(self.key ^ scrambled(np.array([tree.seed * 2**32 + tree.number], np.uint64)))
        seen = np.flatnonzero(draw < np.uint64(min(2**64 - 1, int(tree.subsample * 2**64))))
        place_of = np.full(len(tree.feature), -1)
        place_of[tree.open] = np.arange(len(tree.open))
        place = place_of[tree.leaf_of(self.bins, seen)]
        seen, place = seen[place >= 0], place[place >= 0]
        residual = (self.label[seen] - self.predicted[seen]).astype(np.float64)  # whole numbers, and so are their sums
        out = []
        for f, width in zip(tree.columns, tree.widths, strict=True):
            code, size = place * width + self.bins[f, seen], len(tree.open) * width
            out.append(np.stack([np.bincount(code, residual, size).astype(np.int64), np.bincount(code, minlength=size)]).reshape(2, -1, width))
        return np.concatenate(out, axis=2)

    def advanced(self, tree: Tree) -> Block:
        """The same rows, predicted with the tree too."""
        return self._replace(predicted=self.predicted + tree.value[tree.leaf_of(self.bins, np.arange(len(self.key)))])


def block_of(batches: Iterator[pa.RecordBatch], cuts: list[list[float]], base: int) -> Block:
    keys, labels, bins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((len(cuts), 0), np.uint16)]
    for b in batches:
        keys.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        labels.append(b.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
        # nulls arrive as nan; they belong to the first bin
        values = [b.column(2 + f).to_numpy(zero_copy_only=False).astype(np.float64) for f in range(len(cuts))]
        bins.append(np.array([np.searchsorted(c, np.where(np.isnan(v), -np.inf, v), "left") for c, v in zip(cuts, values, strict=True)], np.uint16))
    label = np.concatenate(labels)
    return Block(np.concatenate(keys), label, np.concatenate(bins, axis=1), np.full(len(label), base, np.int64))


class Alone:
    """All rows in one block."""

    def __init__(self, block: Block) -> None:
        self.block = block

    def sums(self, tree: Tree) -> np.ndarray:
        return self.block.sums(tree)

    def advance(self, tree: Tree) -> None:
        self.block = self.block.advanced(tree)

    def grow(self, plan: Plan) -> Iterator[Tree]:
        for number in range(1, plan.n_trees + 1):
            tree = Tree(number, plan)
            while tree.level(self.sums(tree), plan):
                pass
            self.advance(tree)
            yield tree


class Together(Alone):
    """Blocks of many tasks: a job adds up the sums of a level, and predictions advance with each tree."""

    def __init__(self, blocks: RDD) -> None:
        self.blocks, self.old = blocks.persist(StorageLevel.MEMORY_AND_DISK), None

    def sums(self, tree: Tree) -> np.ndarray:
        depth = 2 if self.blocks.getNumPartitions() > MANY_TASKS else 1
        total = self.blocks.map(lambda b: b.sums(tree)).treeReduce(np.add, depth)
        if self.old is not None:  # the blocks of the tree before have been read
            self.old.unpersist()
            self.old = None
        return total

    def advance(self, tree: Tree) -> None:
        self.old = self.blocks
        self.blocks = self.old.map(lambda b: b.advanced(tree)).persist(StorageLevel.MEMORY_AND_DISK)
        if tree.number % CHECKPOINT_TREES == 0:  # what a lost executor held is made again from here
            self.blocks.checkpoint()


def score_trees(rows: DataFrame, nodes: DataFrame, output: str = "prediction") -> DataFrame:
    """``rows`` with the sum of the leaf values that each row comes to.

    Each row meets each tree once and goes down it by one join a level with the node table,
    which is bounded by the trees (at most 2 ** (depth + 1) nodes each) and broadcast. Leaf
    values are multiples of a power of two, so their sum is exact in any order. A tree of
    an unseen value goes on by the threshold, nulls go left.
    """
    features = [r.feature for r in nodes.where("feature is not null").select("feature").distinct().orderBy("feature").collect()]
    deepest = nodes.agg(F.max("node")).first()[0] or 1
    last = nodes.agg(F.max("tree")).first()[0]
    own = [F.col(f"`{c}`") for c in rows.columns]
    splits = nodes.where("feature is not null").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("feature").alias("_f"), F.col("threshold").alias("_cut"))
    leaves = nodes.where("feature is null").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("value").alias("_value"))
    # a small table's rows are all in one task, and hundreds of trees take far longer than a shuffle
    dealt = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    met = dealt.withColumn("_row", F.monotonically_increasing_id()).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("_tree")).withColumn("_node", F.lit(1))
    here = (F.col("_tree") == F.col("_t")) & (F.col("_node") == F.col("_n"))
    value = F.lit(None).cast("double")
    for f in features:
        value = F.when(F.col("_f") == f, number(f)).otherwise(value)
    right = (value > F.col("_cut")).cast("int")
    for _ in range(int(math.log2(deepest))):
        step = F.when(F.col("_f").isNull(), F.col("_node")).otherwise(2 * F.col("_node") + F.coalesce(right, F.lit(0)))
        met = met.join(F.broadcast(splits), here, "left").select(*own, "_row", "_tree", step.alias("_node"))
    summed = met.join(F.broadcast(leaves), here).groupBy("_row", *own).agg(F.sum("_value").alias(output))
    return summed.drop("_row")


def gains(nodes: DataFrame) -> DataFrame:
    """(feature, splits, gain): how often a feature splits, and the mean gain of its splits."""
    return nodes.where("feature is not null").groupBy("feature").agg(F.count(F.lit(1)).alias("splits"), F.avg("gain").alias("gain"))
