"""Regression trees on binned features, grown level by level from sums by node, feature and bin.

All trees that do not need each other grow together. A level is one aggregation: each task adds up
gradients and weights of its rows, so that what is shuffled are bins, not rows. The best split of each
node is found in Spark too; the driver sees one row for each node. Sums are of whole numbers (gradients
in a unit that suits the table), so that trees do not depend on how rows are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Relative error of the ranks at which features are cut, as one over this.
CUT_ACCURACY = 100_000
#: A split gains more than this.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Growth:
    """How trees grow. A node is split if it weighs ``split_rows`` and both parts ``leaf_rows``.

    ``l1`` and ``l2`` shrink what nodes predict. ``node_columns`` of the features are drawn anew for
    each node; None takes all.
    """

    depth: int = 5
    l1: float = 0.0
    l2: float = 0.0
    leaf_rows: int = 1
    split_rows: int = 2
    node_columns: int | None = None
    seed: int = 42


@dataclass
class Node:
    """A node: what it predicts, and where it is split, values below ``cut`` to the left."""

    value: float
    n_rows: int
    feature: int = -1
    bin: int = -1
    gain: float = 0.0


#: A tree by node number: 1 is the root, the parts of node n are 2n and 2n + 1.
Tree = dict[int, Node]


def cut_points(rows: DataFrame, values: str, n_features: int, bins: int = 256) -> list[list[float]]:
    """For each feature of an array column, the values at which it can be split: its quantiles."""
    shares = [k / bins for k in range(1, bins)]
    row = rows.agg(*[F.percentile_approx(F.get(values, F.lit(k)), shares, CUT_ACCURACY).alias(f"f{k}")
                     for k in range(n_features)]).first()
    return [sorted(set(found or [])) for found in row]


def binned(values: str, cuts: Sequence[Sequence[float]]) -> Column:
    """The bin of each of an array's values: how many of the feature's cut points are not above it."""
    def below(value: Column, points: Column) -> Column:
        # a search by halves: eight steps tell 256 bins apart
        most = max([1, *map(len, cuts)])
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
        return F.aggregate(steps, F.lit(0), lambda n, s: F.when(
            F.get(points, n + s - 1) <= value, n + s).otherwise(n))

    table = F.array(*[F.array(*map(F.lit, points)).cast("array<double>") for points in cuts])
    return F.zip_with(values, table, below)


def _table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    return spark.createDataFrame(pa.table(columns))


def shrunk(g: Column, l1: float) -> Column:
    """A sum of gradients, nearer to 0 by ``l1``."""
    return F.signum(g) * F.greatest(F.abs(g) - l1, F.lit(0.0))


def best_splits(rows: DataFrame, growth: Growth, unit: float) -> DataFrame:
    """For each ``tree, node`` of ``rows`` (these, ``bins, g, w``): ``g, w`` of all its rows and the split of
    the highest gain, ``feature, bin, gain, g_left, w_left``, or nulls.

    Rows of a bin not above ``bin`` go left. Equal gains: the first feature, then the lowest bin.
    """
    sums = rows.select("tree", "node", "w", "g", F.posexplode("bins").alias("feature", "bin")) \
        .groupBy("tree", "node", "feature", "bin") \
        .agg(F.sum("g").alias("g"), F.sum("w").alias("w")).repartition("tree", "node")
    each = Window.partitionBy("tree", "node", "feature")
    below = each.orderBy("bin")
    sums = sums.select(
        "tree", "node", "feature", "bin",
        F.sum("g").over(below).alias("g_left"), F.sum("w").over(below).alias("w_left"),
        F.sum("g").over(each).alias("g"), F.sum("w").over(each).alias("w"))
    drawn = F.lit(True)
    if growth.node_columns is not None:
        key = F.xxhash64(F.lit(growth.seed), "tree", "node", "feature")
        drawn = F.dense_rank().over(Window.partitionBy("tree", "node").orderBy(key, "feature")) \
            <= growth.node_columns

    def score(g: Column, w: Column) -> Column:
        kept = shrunk(g / unit, growth.l1)
        return kept * kept / (w + growth.l2)

    g_right, w_right = F.col("g") - F.col("g_left"), F.col("w") - F.col("w_left")
    gain = score(F.col("g_left"), F.col("w_left")) + score(g_right, w_right) \
        - score(F.col("g"), F.col("w"))
    fits = drawn & (F.col("w") >= growth.split_rows) & (F.col("w_left") >= growth.leaf_rows) \
        & (w_right >= max(growth.leaf_rows, 1))
    split = F.struct("feature", "bin", "gain", "g_left", "w_left")
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    good = F.col("fits") & (F.col("gain") > LEAST_GAIN)
    return sums.withColumn("fits", fits).withColumn("gain", F.when(F.col("fits"), gain)) \
        .groupBy("tree", "node") \
        .agg(F.max("g").alias("g"), F.max("w").alias("w"),
             F.max_by(F.when(good, split), F.when(good, order)).alias("best")) \
        .select("tree", "node", "g", "w", "best.*")


def _constant(numbers: Sequence[float], kind: str = "int") -> Column:
    """Many numbers as one constant array."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast(f"array<{kind}>")


def _arrived(trees: dict[int, Tree], tree: Column, depth: int) -> tuple[Column, list[tuple[int, int]]]:
    """Where rows with ``bins`` are after ``depth`` splits, as a place in a list of all nodes, and that
    list of tree and number. Splits are constants of the plan: a few numbers for each node."""
    order = [(k, number) for k in sorted(trees) for number in sorted(trees[k])]
    place = {key: at for at, key in enumerate(order)}
    nodes = [trees[k][number] for k, number in order]
    feature, last = _constant([n.feature for n in nodes]), _constant([n.bin for n in nodes])
    # the right part comes right behind the left one
    left = _constant([place.get((k, 2 * number), -1) for k, number in order])
    roots = _constant([place.get((k, 1), -1) for k in range(max(trees) + 1)])

    def down(at: Column, _: Column) -> Column:
        f = F.get(feature, at)
        return F.when(f < 0, at).otherwise(
            F.get(left, at) + (F.get("bins", f) > F.get(last, at)).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.get(roots, tree), down), order


def value_by_bins(tree: Tree, depth: int) -> Column:
    """What a tree predicts for a row with ``bins``."""
    at, order = _arrived({0: tree}, F.lit(0), depth)
    return F.get(_constant([tree[number].value for _, number in order], "double"), at)


def grow(rows: DataFrame, growth: Growth, unit: float) -> dict[int, Tree]:
    """Trees by number from ``rows``: ``tree, bins, g, w``; ``g`` is a whole number of ``1 / unit``."""
    trees: dict[int, Tree] = {}

    def leaf(g: int, w: int) -> Node:
        g = g / unit
        kept = math.copysign(max(abs(g) - growth.l1, 0.0), g)
        return Node(-kept / (w + growth.l2), w)

    for level in range(growth.depth):
        node = F.lit(1)
        if level:
            at, order = _arrived(trees, F.col("tree"), level)
            node = F.get(_constant([number for _, number in order]), at)
        here = rows.withColumn("node", node).where(F.col("node") >= 1 << level)  # others are in leaves
        any_split = False
        for r in best_splits(here, growth, unit).collect():  # one row for each node
            tree = trees.setdefault(r["tree"], {})
            node = tree.setdefault(r["node"], leaf(r["g"], r["w"]))
            if r["feature"] is None:
                continue
            any_split = True
            node.feature, node.bin, node.gain = r["feature"], r["bin"], r["gain"]
            tree[2 * r["node"]] = leaf(r["g_left"], r["w_left"])
            tree[2 * r["node"] + 1] = leaf(r["g"] - r["g_left"], r["w"] - r["w_left"])
        if not any_split:
            break
    return trees


_NODE = pa.struct([("feature", pa.int32()), ("cut", pa.float64()), ("left", pa.int32()),
                   ("right", pa.int32()), ("value", pa.float64())])


def packed(tree: Tree, cuts: Sequence[Sequence[float]]) -> list[dict]:
    """A tree's nodes as a list that starts with the root; parts are named by place, from 0."""
    place = {number: k for k, number in enumerate(sorted(tree))}
    return [{"feature": n.feature, "cut": cuts[n.feature][n.bin] if n.feature >= 0 else 0.0,
             "left": place.get(2 * number, -1), "right": place.get(2 * number + 1, -1),
             "value": n.value} for number, n in sorted(tree.items())]


def predicted(rows: DataFrame, trees: Sequence[list[dict]], depth: int, values: Column,
              name: str) -> DataFrame:
    """Add ``name``: the sum of what packed trees predict for an array of feature values.

    The trees are a scalar subquery: made once, not a join.
    """
    table = _table(rows.sparkSession, trees=pa.array([list(trees)], pa.list_(pa.list_(_NODE))))

    def end(tree: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(depth)), F.get(tree, F.lit(0)),
            lambda node, _: F.when(node["feature"] < 0, node).when(
                F.get(values, node["feature"]) < node["cut"], F.get(tree, node["left"]))
            .otherwise(F.get(tree, node["right"])))["value"]

    total = F.aggregate("_forest", F.lit(0.0), lambda total, tree: total + end(tree))
    return rows.withColumn("_forest", table.select("trees").scalar()).withColumn(name, total) \
        .drop("_forest")


@dataclass
class Sums:
    """Number of rows, mean label and the unit of gradients in which sums do not overflow."""

    n_rows: int
    mean: float
    spread: float
    unit: float = field(init=False)

    def __post_init__(self) -> None:
        # gradients reach a few times the labels' spread; 61 bits hold the sum of all rows
        most = max(self.n_rows, 1) * max(8 * self.spread, 1e-9)
        self.unit = 2.0 ** math.floor(61 - math.log2(most))


def label_sums(rows: DataFrame, label: str) -> Sums:
    # the sum of decimals is the same in any order
    row = rows.agg(F.count("*"), F.avg(F.col(label).cast("decimal(28,6)")),
                   F.max(label) - F.min(label)).first()
    return Sums(row[0], float(row[1] or 0.0), float(row[2] or 0.0))
