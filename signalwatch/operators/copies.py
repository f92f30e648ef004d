"""Equal rows, carried as few rows and a count.

A signal names a category and day once; a file that repeats a row a million times must
still give a million rows, but need not send them all to the task of that category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPY = "copy"
COPIES = "copies"
_BLOCK = 100_000


def counted(df: DataFrame) -> DataFrame:
    """Distinct rows and how often each occurs."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(COPIES))


def few_copies(df: DataFrame) -> DataFrame:
    """Equal rows as at most three: the first, the second, and one for all others.

    Looking back one or two rows gives on these rows what it gives on all of them,
    when they are ordered by their values and then by ``copy``.
    """
    first, second = (F.struct(F.lit(i).alias(COPY), F.lit(1).cast("long").alias(COPIES))
                     for i in (1, 2))
    others = F.struct(F.lit(3).alias(COPY), (F.col("n") - 2).alias(COPIES))
    kept = F.slice(F.array(first, second, others), 1, F.least(F.lit(3), F.col("n")).cast("int"))
    grouped = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return grouped.select(*df.columns, F.inline(kept))


def all_copies(df: DataFrame, spread: bool = True) -> DataFrame:
    """Each row as often as its ``copies`` say.

    Copies are made in blocks; ``spread`` sends the blocks of a row to several tasks
    first.
    """
    columns = [c for c in df.columns if c not in (COPY, COPIES)]
    blocks = df.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"),
                                       F.floor((F.col(COPIES) - 1) / _BLOCK)))
    )
    if spread:
        blocks = blocks.repartition("_block", *columns)
    left = F.least(F.lit(_BLOCK), F.col(COPIES) - F.col("_block") * _BLOCK)
    return blocks.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), left))).select(
        *columns
    )
