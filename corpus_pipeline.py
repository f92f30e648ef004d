"""From raw documents to packed training sequences: five stages, each written and read again.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.llm import minmax_dedup, packing, secret_forest, spaced_seeds, weak_toxicity
from signalwatch.llm.common import read_table, settle, without

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go."""
    judged = weak_toxicity.toxicity(docs, read_table(spark, sf_dir, "labels"))
    return without(docs, judged.where("predicted = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest doc_id: word
    shingles of five words, similarity of 0.8 or more."""
    found = minmax_dedup.near_duplicates(docs, percent=80, width=5)
    return without(docs, found.where("NOT kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return spaced_seeds.without_overlaps(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced, and n_chars counted anew."""
    return secret_forest.redacted(docs).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
        .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in sequences of 1024 tokens. Documents without a doc_id have got so
    far, but cannot be named in a sequence: they are not packed."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("secrets", secrets), ("packing", packing_stage)]

#: Models, tokenizers and similarity joins on hashes have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``.

    Null and empty texts pass all stages and are packed as the end token alone; a null text stays null
    up to there. Equal rows stay or go together, and each is packed; of one doc_id with several texts,
    all go if one of them does. An empty table gives an empty result, as does a table of which no row
    is left. Other columns are kept up to packing, whatever they are called. Texts are read whole.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
