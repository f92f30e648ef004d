"""Regularised ensembles of regression trees: boosted ones with L1 and L2 terms, and forests with a
minimum split size.

They train on rows with a position, a label and an array or vector of features, as
:func:`signalwatch.plans.models.assembled` makes them. Which rows and columns a tree sees follows from
seeds and positions alone, so a fit is the same on every cluster.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.operators import trees as T
from signalwatch.operators.splits import POSITION
from signalwatch.storage import drop, fresh_path, save


def _values(rows: DataFrame) -> Column:
    """The features as an array, whether they are a vector or one already."""
    kind = rows.schema["features"].dataType.typeName()
    return F.col("features") if kind == "array" else vector_to_array("features")


def _uniform(*parts) -> Column:
    """A number from 0 to below 1 that follows from ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


@dataclass(frozen=True)
class Fitted:
    """An ensemble that predicts ``base`` and a share of each tree."""

    base: float
    share: float
    trees: tuple[T.Tree, ...]
    cuts: tuple[tuple[float, ...], ...]
    depth: int
    mean_gain: bool

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add ``prediction``."""
        packed = [T.packed(tree, self.cuts) for tree in self.trees]
        scored = T.predicted(rows.withColumn("_values", _values(rows)), packed, self.depth,
                             F.col("_values"), "_total")
        return scored.withColumn("prediction", F.lit(self.base) + self.share * F.col("_total")) \
            .drop("_values", "_total")

    @property
    def featureImportances(self) -> np.ndarray:
        """Each feature's gain over all its splits (or their mean), as a share of all features'."""
        gains: list[list[float]] = [[] for _ in self.cuts]
        for tree in self.trees:
            for node in tree.values():
                if node.feature >= 0:
                    gains[node.feature].append(node.gain)
        found = np.array([(np.mean(g) if self.mean_gain else np.sum(g)) if g else 0.0 for g in gains])
        return found / (found.sum() or 1.0)


def _binned(train: DataFrame, bins: int) -> tuple[DataFrame, str, list[list[float]], T.Sums]:
    """Training rows with features as bins, written once, and where they lie."""
    values = train.select(POSITION, F.col(C.LABEL).cast("double").alias(C.LABEL),
                          _values(train).alias("values"))
    about = T.label_sums(values, C.LABEL)
    n_features = values.select(F.max(F.size("values"))).first()[0] or 0
    cuts = T.cut_points(values, "values", n_features, bins)
    path = fresh_path(train.sparkSession, "binned")
    return save(values.select(POSITION, C.LABEL, T.binned("values", cuts).alias("bins")), path), \
        path, cuts, about


@dataclass(frozen=True)
class BoostedTrees:
    """Trees that each learn what the ones before leave, by gradients and second derivatives of the
    squared error. Each sees ``row_share`` of the rows and ``column_share`` of the columns."""

    rounds: int = 400
    rate: float = 0.08
    growth: T.Growth = T.Growth(depth=5, l1=0.1, l2=1.5)
    row_share: float = 0.85
    column_share: float = 0.85
    bins: int = 256
    seed: int = 42

    def fit(self, train: DataFrame) -> Fitted:
        spark = train.sparkSession
        rows, path, cuts, about = _binned(train, self.bins)
        rows = rows.withColumn("residual", F.lit(about.mean) - F.col(C.LABEL))
        chosen = random.Random(self.seed)
        kept = max(1, int(self.column_share * len(cuts)))
        trees: list[T.Tree] = []
        for number in range(self.rounds):
            columns = sorted(chosen.sample(range(len(cuts)), kept))
            seen = rows.where(_uniform(F.lit(self.seed), F.lit(number), POSITION) < self.row_share)
            # columns that are not drawn have one bin
            bins = F.transform("bins", lambda b, k: F.when(
                F.array_contains(F.array(*map(F.lit, columns)), k), b).otherwise(0))
            found = T.grow(seen.select(
                F.lit(0).alias("tree"), F.lit(1).cast("long").alias("w"), bins.alias("bins"),
                F.round(F.col("residual") * about.unit).cast("long").alias("g")),
                self.growth, about.unit).get(0)
            if found is None:  # no row was drawn
                continue
            trees.append(found)
            if number + 1 < self.rounds:
                # each round's rows are written, so that a plan never holds more than one tree
                step = self.rate * T.value_by_bins(found, self.growth.depth)
                before, path = path, fresh_path(spark, "boosted")
                rows = save(rows.withColumn("residual", F.col("residual") + step), path)
                drop(spark, before)
        drop(spark, path)
        return Fitted(about.mean, self.rate, tuple(trees), tuple(map(tuple, cuts)), self.growth.depth,
                      mean_gain=True)


@dataclass(frozen=True)
class Forest:
    """The mean of trees that each see the rows as often as drawn with replacement."""

    trees: int = 300
    growth: T.Growth = T.Growth(depth=15, split_rows=2)
    bins: int = 256
    seed: int = 42

    def fit(self, train: DataFrame) -> Fitted:
        rows, path, cuts, about = _binned(train, self.bins)
        u = _uniform(F.lit(self.seed), "tree", POSITION)
        # how often a row is drawn, by the limit of many rows: shares 1/e, 1/e, 1/2e, 1/6e, ...
        share, total, times = np.exp(-1.0), np.exp(-1.0), F.lit(0)
        for k in range(1, 13):
            times = times + F.when(u >= float(total), 1).otherwise(0)
            share /= k
            total += share
        drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1)))) \
            .withColumn("w", times.cast("long")).where("w > 0")
        g = F.round((F.lit(about.mean) - F.col(C.LABEL)) * about.unit / 4).cast("long") * F.col("w")
        found = T.grow(drawn.select("tree", "w", "bins", g.alias("g")), self.growth, about.unit / 4)
        drop(train.sparkSession, path)
        grown = tuple(found[k] for k in sorted(found))
        return Fitted(about.mean, 1 / max(1, len(grown)), grown, tuple(map(tuple, cuts)),
                      self.growth.depth, mean_gain=False)


def forest_standalone(trees: int = 300, depth: int = 15, n_features: int = len(C.FEATURES),
                      seed: int = 42) -> Forest:
    """The regularised forest: splits of five rows or more, two rows in each part, a root share of
    the columns for each split."""
    return Forest(trees, T.Growth(depth=depth, leaf_rows=2, split_rows=5,
                                  node_columns=max(1, int(n_features ** 0.5)), seed=seed), seed=seed)
