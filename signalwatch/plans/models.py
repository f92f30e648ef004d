"""Chronologically validated tree models on day-level features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.operators.metrics import regression_metrics
from signalwatch.operators.splits import POSITION, fold_ranges, in_time_order
from signalwatch.plans.ensembles import BoostedTrees, forest_standalone
from signalwatch.plans.features import model_rows


#: Partitions of the training rows. MLlib samples rows by partition, so the number is part of a
#: model's definition: it depends neither on the cluster nor on the rows. Raise it for large data.
TRAINING_PARTS = 8
#: Most values of a feature that a split can tell apart; category codes need one each.
BINS = 256


def random_forest(trees: int = 300, depth: int = 15, leaf_rows: int = 1,
                  columns: str = "all", seed: int = 42, bins: int = BINS) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=C.LABEL, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf_rows,
        featureSubsetStrategy=columns, seed=seed, maxBins=bins,
    )


def random_forest_standalone(trees: int = 300, depth: int = 15, seed: int = 42
                             ) -> RandomForestRegressor:
    """MLlib's nearest to the regularised forest: two rows per leaf, a root share of the columns per
    split; it knows no minimum split size."""
    return random_forest(trees, depth, leaf_rows=2, columns="sqrt", seed=seed)


def boosted_trees(rounds: int = 400, depth: int = 5, rate: float = 0.08,
                  row_share: float = 0.85, columns: str = "0.85", seed: int = 42,
                  bins: int = BINS) -> GBTRegressor:
    return GBTRegressor(
        labelCol=C.LABEL, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=row_share, featureSubsetStrategy=columns, seed=seed, maxBins=bins,
    )


def default_models() -> dict[str, Callable]:
    """The forest, and boosted trees with L1 and L2 terms and columns drawn for each tree."""
    return {"random_forest": random_forest, "boosted_trees": BoostedTrees}


def default_models_standalone() -> dict[str, Callable]:
    """A forest whose splits have a minimum size, and the same boosted trees."""
    n_features = len(C.FEATURES_STANDALONE)
    return {"random_forest": lambda: forest_standalone(n_features=n_features),
            "boosted_trees": BoostedTrees}


def linear(seed: int = 42) -> LinearRegression:
    """Least squares, solved exactly: a plain model to hold others against."""
    return LinearRegression(labelCol=C.LABEL, solver="normal")


def assembled(ordered: DataFrame, names: Sequence[str], parts: int = TRAINING_PARTS) -> DataFrame:
    """Position, label and feature vector of each row, in ``parts`` partitions and a fixed order,
    so that row sampling repeats from run to run and from cluster to cluster."""
    vector = VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error")
    rows = vector.transform(ordered.withColumn(C.LABEL, F.col(C.LABEL).cast("double")))
    return (
        rows.select(POSITION, C.LABEL, "features")
        .repartition(parts, POSITION)
        .sortWithinPartitions(POSITION)
    )


@dataclass(frozen=True)
class Evaluation:
    """What comparing the models found."""

    comparison: DataFrame   # one row per model
    folds: DataFrame        # one row per model and fold
    winner: str
    importance: DataFrame   # the winner's features
    model: Model            # the winner, or any with ``transform``, fitted on the train part


def _score(model: Model, rows: DataFrame) -> tuple[float, float]:
    found = regression_metrics(model.transform(rows), C.LABEL, "prediction").first()
    return found["r2"], found["mae"]


def evaluate(features: DataFrame, names: Sequence[str] = C.FEATURES,
             models: dict[str, Callable] | None = None, folds: int = C.FOLDS,
             select_by: str = "r2", parallel: int = 4, parts: int = TRAINING_PARTS) -> Evaluation:
    """Fit each model on the first 80 % of the rows and on every fold's past.

    The numbered rows are stored once; a fold is a filter on the position, not a copy.
    ``select_by`` names the winning score: ``r2`` on the test rows or ``cv_mean``.
    Fits run ``parallel`` at a time, each distributed by Spark; each may hold statistics of tree
    nodes of Spark's default of 256 MB in every task.
    """
    spark = features.sparkSession
    ordered = in_time_order(model_rows(features, tuple(names)))
    n_rows = ordered.count()
    rows = assembled(ordered, names, parts).persist()
    try:
        cut = int(n_rows * C.TRAIN_SHARE)
        position = F.col(POSITION)
        ranges = {"holdout": (cut, n_rows)}
        ranges |= {f: (start, end) for f, start, end in fold_ranges(n_rows, folds)}
        chosen = models or default_models()

        def fit(task: tuple[str, str | int]):
            name, part = task
            start, end = ranges[part]
            train = rows.where(position < start)
            test = rows.where((position >= start) & (position < end))
            model = chosen[name]().fit(train)
            r2, mae = _score(model, test)
            train_r2 = _score(model, train)[0] if part == "holdout" else None
            return name, part, r2, mae, train_r2, model

        tasks = [(name, part) for name in chosen for part in ranges]
        with ThreadPool(parallel) as pool:
            done = pool.map(inheritable_thread_target(spark)(fit), tasks)
    finally:
        rows.unpersist()

    fold_rows = [(name, part, r2) for name, part, r2, *_ in done if part != "holdout"]
    fold_scores = spark.createDataFrame(fold_rows, "model string, fold int, r2 double")
    tests = [
        (place, name, r2, mae, train_r2)
        for place, name in enumerate(chosen)
        for other, part, r2, mae, train_r2, _ in done
        if part == "holdout" and other == name
    ]
    held_out = spark.createDataFrame(
        tests, "model_order int, model string, r2 double, mae double, train_r2 double"
    )
    validated = fold_scores.groupBy("model").agg(
        F.avg("r2").alias("cv_mean"), F.stddev_pop("r2").alias("cv_std")
    )
    gap = F.col("train_r2") - F.col("r2")
    comparison = held_out.join(validated, "model").select(
        "model_order", "model", "r2", "mae", "cv_mean", "cv_std", "train_r2",
        gap.alias("gap"),
        (gap < C.HEALTHY_GAP).alias("healthy"),
        (F.col("r2") >= C.TARGET_R2).alias("meets_target"),
    )
    winner = comparison.orderBy(F.col(select_by).desc(), "model_order").first()["model"]
    model = next(m for name, part, _, _, _, m in done if name == winner and part == "holdout")
    found = getattr(model, "featureImportances", None)  # of trees only
    weights = [] if found is None else [
        (n, float(w)) for n, w in zip(names, found if isinstance(found, np.ndarray) else found.toArray())]
    importance = spark.createDataFrame(weights, "feature string, importance double")
    marked = comparison.withColumn("winner", F.col("model") == F.lit(winner)).drop("model_order")
    return Evaluation(marked, fold_scores, winner, importance, model)
