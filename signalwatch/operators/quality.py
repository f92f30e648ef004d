"""Conforming raw rows to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fits(value: Column, field: T.StructField) -> Column:
    """Whether a text is within the length its field declares, blanks at the end aside."""
    longest = field.metadata.get("max_length")
    return F.lit(True) if longest is None else F.length(F.rtrim(value)) <= longest


def _typed(field: T.StructField, source: T.DataType, strict: bool) -> Column:
    """``field`` converted from ``source``: raise on a bad value, or make it NULL."""
    value = F.col(field.name)
    change = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    if isinstance(field.dataType, T.StringType):
        text = value.cast("string")
        longest = field.metadata.get("max_length")
        if longest is None:
            return text
        bad = (
            F.raise_error(F.concat(F.lit(f"{field.name} is too long: "), text)).cast("string")
            if strict else F.lit(None).cast("string")
        )
        return F.when(text.isNull() | _fits(text, field), F.substring(text, 1, longest)
                      ).otherwise(bad)
    if isinstance(field.dataType, T.IntegerType) and isinstance(source, T.StringType):
        # a whole number may arrive as "3.0"
        return change(F.round(change(value, "decimal(20,6)"), 0), "int")
    return change(value, field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the declared columns in their declared types; fail on a bad value.

    Decimals round half away from zero. Malformed, out-of-range and over-long values
    raise when the rows are used.
    """
    return df.select(*[
        _typed(f, df.schema[f.name].dataType, strict=True).alias(f.name, metadata=f.metadata)
        for f in schema.fields
    ])


def checked(df: DataFrame, schema: T.StructType, corrupt: str = "_corrupt_record") -> DataFrame:
    """Each row as ``typed`` values, its ``problems`` and, if it has any, the ``raw`` row.

    A row whose column ``corrupt`` is set, if there is such a column, has that as its one problem:
    its other values cannot be trusted.
    """
    typed = {f.name: _typed(f, df.schema[f.name].dataType, strict=False) for f in schema.fields}
    problems = F.array_compact(F.array(*[
        F.when(F.col(name).isNotNull() & value.isNull(), F.lit(name))
        for name, value in typed.items()
    ]))
    raw = F.struct(*schema.fieldNames())
    if corrupt in df.columns:
        problems = F.when(F.col(corrupt).isNotNull(), F.array(F.lit(corrupt))).otherwise(problems)
        raw = F.struct(*schema.fieldNames(), corrupt)
    return df.select(
        F.struct(*[value.alias(name) for name, value in typed.items()]).alias("typed"),
        F.when(F.size(problems) > 0, raw).alias("raw"),
        problems.alias("problems"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("problems") == 0).select("typed.*")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("problems") > 0).select("raw.*", "problems")


def quarantine(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split into conformed rows and rejected raw rows naming their bad columns."""
    rows = checked(df, schema)
    return accepted(rows), rejected(rows)


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and how many rows it has."""
    report = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        report = row if report is None else report.unionByName(row)
    return report
