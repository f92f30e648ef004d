"""Chronological splits: a model never trains on what comes after its test rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.constants import FOLDS, TRAIN_SHARE
from signalwatch.operators.keys import dense_key
from signalwatch.schemas import CATEGORY

POSITION = "position"


def in_time_order(features: DataFrame) -> DataFrame:
    """Number the rows ``0..n-1`` by time, then category."""
    return dense_key(features, POSITION, ["time_sk", CATEGORY]).withColumn(
        POSITION, F.col(POSITION) - 1
    )


def holdout(ordered: DataFrame, n_rows: int, share: float = TRAIN_SHARE) -> DataFrame:
    """Mark the first ``share`` of the rows as train, the rest as test.

    The cut is by row, so the rows of one day may fall on both sides.
    """
    cut = int(n_rows * share)
    return ordered.withColumn(
        "role", F.when(F.col(POSITION) < cut, F.lit("train")).otherwise(F.lit("test"))
    )


def fold_ranges(n_rows: int, folds: int = FOLDS) -> list[tuple[int, int, int]]:
    """``(fold, test_start, test_end)``; a fold trains on all rows before its test."""
    size = n_rows // (folds + 1)
    if size == 0:
        raise ValueError(f"{folds} folds need at least {folds + 1} rows, got {n_rows}")
    return [
        (fold, n_rows - (folds - fold) * size, n_rows - (folds - fold - 1) * size)
        for fold in range(folds)
    ]


def fold_part(ordered: DataFrame, test_start: int, test_end: int) -> tuple[DataFrame, DataFrame]:
    """The train and test rows of one fold."""
    train = ordered.where(F.col(POSITION) < test_start)
    test = ordered.where((F.col(POSITION) >= test_start) & (F.col(POSITION) < test_end))
    return train, test


def ts_folds(ordered: DataFrame, n_rows: int, folds: int = FOLDS) -> DataFrame:
    """One row per row, fold and role: expanding train parts, equal test parts."""
    def role(start: int, end: int):
        return F.when(F.col(POSITION) < start, "train").when(F.col(POSITION) < end, "test")

    parts = F.array(*[
        F.struct(F.lit(fold).alias("fold"), role(start, end).alias("role"))
        for fold, start, end in fold_ranges(n_rows, folds)
    ])
    used = F.filter(parts, lambda part: part["role"].isNotNull())
    return ordered.withColumn("part", F.explode(used)).select(
        *ordered.columns, F.col("part.fold").alias("fold"), F.col("part.role").alias("role")
    )
