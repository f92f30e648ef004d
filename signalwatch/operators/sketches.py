"""Distinct counts that add up: a sketch for each day, united for any period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 ** this registers of a sketch (2 KB); one standard error is about 1.04 over their root, 1.6 %.
PRECISION = 12
#: Four standard errors.
ERROR_BOUND = 4 * 1.04 / 2 ** (PRECISION / 2)


def day_sketches(rows: DataFrame, value: str, by: Sequence[str], precision: int = PRECISION
                 ) -> DataFrame:
    """A sketch of the distinct values for each group of ``by``; nulls do not count."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def distinct_of(sketches: DataFrame, by: Sequence[str], name: str = "estimate") -> DataFrame:
    """About how many distinct values there are in each group of sketches; no row is read again."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
