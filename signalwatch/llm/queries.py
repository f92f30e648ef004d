"""Each operator as a query over its whole table, and as SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalwatch.llm import (
    arrow_tokens,
    crf_quality,
    filter_audit,
    importance,
    lexical_search,
    link_trust,
    minmax_dedup,
    packing,
    secret_forest,
    source_mix,
    spaced_seeds,
    weak_toxicity,
    wrappers,
)
from signalwatch.llm.common import read_table


def op1_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    # which links were looked at depends on the method; what they join does not
    return minmax_dedup.near_duplicates(read_table(spark, folder, "documents")).drop("n_links")


def op2_crf_quality(spark: SparkSession, folder: str) -> DataFrame:
    return crf_quality.quality(read_table(spark, folder, "documents"),
                               read_table(spark, folder, "labels"))


def op3_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(read_table(spark, folder, "documents"),
                               read_table(spark, folder, "labels"))


def op4_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    return secret_forest.findings(read_table(spark, folder, "documents"))


def op5_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return weak_toxicity.toxicity(read_table(spark, folder, "documents"),
                                  read_table(spark, folder, "labels"))


def op6_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return spaced_seeds.overlaps(read_table(spark, folder, "documents"),
                                 read_table(spark, folder, "benchmark"))


def op7_arrow_tokens(spark: SparkSession, folder: str) -> DataFrame:
    files = arrow_tokens.write_sequences(read_table(spark, folder, "documents"))
    return arrow_tokens.read_documents(files)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"))


def op9_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract(read_table(spark, folder, "pages"))


def op10_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return link_trust.judge_urls(read_table(spark, folder, "pages"))


def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.taken(read_table(spark, folder, "documents"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, folder, "documents"),
                              read_table(spark, folder, "labels"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read_table(spark, folder, "documents"),
                                 read_table(spark, folder, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_minmax_dedup, op2_crf_quality, op3_importance, op4_secret_forest, op5_weak_toxicity,
    op6_spaced_seeds, op7_arrow_tokens, op8_packing, op9_wrappers, op10_link_trust,
    op11_source_mix, op12_filter_audit, op13_lexical_search)}
