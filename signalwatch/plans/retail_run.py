"""The whole run: source files to staging, star schema, features, models and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from signalwatch import constants as C
from signalwatch.operators import alerts
from signalwatch.operators.audit import audit_monitor
from signalwatch.operators.daily import daily_from_parts, items_analysed
from signalwatch.operators.quality import conform, load_counts, quarantine
from signalwatch.plans import features, models, reports
from signalwatch.plans.warehouse import (
    Warehouse,
    build,
    insert_sales,
    reopen,
    require_insert_keys,
    with_inserts,
)
from signalwatch.schemas import STAGING
from signalwatch.sources import files, staging
from signalwatch.storage import drop, save, together
from signalwatch.streaming.audit import create_increments, read_log, run_audit


@dataclass(frozen=True)
class Outcome:
    """Tables a run leaves behind, by name."""

    warehouse: Warehouse
    features: DataFrame
    reports: dict[str, DataFrame]


def load(spark: SparkSession, folder: str, target: str,
         names: Mapping[str, str] = staging.SOURCE_FILES, strict: bool = True,
         multiline: bool = False) -> Warehouse:
    """Stage the source files and build the star schema under ``target``.

    Inserts, audit log and checkpoint of an earlier load go: their keys meant other rows.
    """
    staged = staging.stage(spark, folder, f"{target}/staging", names, strict, multiline)
    warehouse = build(spark, staged, f"{target}/star", C.DELIVERED)
    for old in ("increments", "audit_log", "audit_checkpoint"):
        drop(spark, f"{target}/{old}")
    # later inserts arrive here and are audited; the load above is not
    create_increments(spark, f"{target}/increments")
    return with_inserts(spark, warehouse, f"{target}/increments")


def reload(spark: SparkSession, target: str) -> Warehouse:
    """What an earlier load left under ``target``, with all inserts since; fails if these share keys."""
    base = reopen(spark, f"{target}/star")
    require_insert_keys(spark, base["fact_sales"], f"{target}/increments")
    return with_inserts(spark, base, f"{target}/increments")


def insert(warehouse: Warehouse, sales: DataFrame, target: str) -> Warehouse:
    """Insert fact rows without keys; return the tables with them."""
    insert_sales(warehouse["fact_sales"], sales, f"{target}/increments")
    return reload(sales.sparkSession, target)


def audit(spark: SparkSession, target: str) -> DataFrame:
    """Log all inserts that are not logged yet; return the summary of the log."""
    run_audit(spark, f"{target}/increments", f"{target}/audit_log", f"{target}/audit_checkpoint")
    return audit_monitor(read_log(spark, f"{target}/audit_log"))


def _report(analysed: DataFrame, daily: DataFrame, weights: Mapping[str, float],
            found: models.Evaluation, target: str) -> dict[str, DataFrame]:
    ranked = alerts.with_level(alerts.category_alerts(daily, weights))
    tables = {
        "run_summary": reports.run_summary(analysed, daily, found),
        "model_comparison": found.comparison,
        "feature_importance": reports.top_features(found.importance, len(C.FEATURES)),
        "category_alerts": ranked,
        "top_alerts": alerts.top_alerts(ranked),
        "top_growth": alerts.top_mean(daily, "growth_rate"),
        "top_acceleration": alerts.top_mean(daily, "acceleration"),
        "category_series": reports.category_series(daily),
    }
    return together(daily.sparkSession, {
        name: partial(save, df, f"{target}/reports/{name}") for name, df in tables.items()
    })


def analyse(warehouse: Warehouse, target: str, chosen: dict[str, Callable] | None = None
            ) -> Outcome:
    """Features with both signals, models and reports from the star schema alone."""
    w = warehouse
    daily = save(features.features_of_days(
        daily_from_parts(w["day_parts"]), w["dim_time"], w["dim_trend"], w["dim_review"],
        w["category_codes"],
    ), f"{target}/daily_features")
    found = models.evaluate(daily, C.FEATURES, chosen)
    analysed = items_analysed(w["fact_sales"], w["dim_product"], w["dim_trend"], w["dim_review"])
    return Outcome(w, daily, _report(analysed, daily, C.ALERT_WEIGHTS, found, target))


def search_file(spark: SparkSession, path: str, rejected: str | None = None,
                multiline: bool = False) -> DataFrame:
    """The search CSV (plain or zipped), with its period number if it has one.

    Fails on a bad row, or sets bad rows aside under ``rejected`` if that is given.
    """
    columns = STAGING["trends"].fieldNames()
    paths = files.plain_csv(spark, path)
    keyed = "time_sk" in files.csv_columns(spark, paths, multiline)
    raw = files.scan_plain_csv(spark, paths, [*columns, "time_sk"] if keyed else columns, multiline,
                               strict=rejected is None)
    schema = T.StructType([*STAGING["trends"].fields])
    if keyed:
        schema = schema.add("time_sk", T.LongType())
    if rejected is None:
        return conform(raw, schema)
    good, bad = quarantine(raw, schema)
    save(bad, rejected)
    return good


def analyse_standalone(warehouse: Warehouse, trends: DataFrame, target: str,
                       chosen: dict[str, Callable] | None = None) -> Outcome:
    """Features, models and reports from the sales and a search file."""
    w = warehouse
    daily = save(features.features_of_days_standalone(
        daily_from_parts(w["day_parts"]), trends, w["category_codes"]
    ), f"{target}/daily_features")
    chosen = chosen or models.default_models_standalone()
    found = models.evaluate(daily, C.FEATURES_STANDALONE, chosen)
    analysed = items_analysed(w["fact_sales"], w["dim_product"])
    return Outcome(
        w, daily, _report(analysed, daily, C.ALERT_WEIGHTS_STANDALONE, found, target)
    )


def loaded(warehouse: Warehouse) -> DataFrame:
    """How many rows the star schema tables hold."""
    return load_counts({n: warehouse[n] for n in ("fact_sales", "dim_trend", "dim_review")})
