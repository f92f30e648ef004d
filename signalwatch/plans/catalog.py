"""Every operator as a named query over a folder of retail tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalwatch import constants as C
from signalwatch.functions.dates import calendar, iso_text
from signalwatch.functions.scoring import profile_of
from signalwatch.operators import alerts, audit, metrics, quality, series, signals, splits
from signalwatch.operators.copies import all_copies
from signalwatch.operators.daily import daily_from_parts, daily_sales, day_parts, items_analysed
from signalwatch.operators.keys import check_key, dense_key, read_key_range, write_keyed
from signalwatch.operators.sketches import ERROR_BOUND, day_sketches, distinct_of
from signalwatch.operators.trees import Growth
from signalwatch.plans import features, forecast, layers, models, reports, search, star
from signalwatch.plans.ensembles import BoostedTrees, forest_standalone
from signalwatch.plans.warehouse import (
    NATURAL_KEYS,
    Warehouse,
    append_sales,
    build,
    insert_sales,
    with_increments,
    with_inserts,
)
from signalwatch.schemas import CATEGORY, STAGING
from signalwatch.sources import files, retail_tables, staging
from signalwatch.storage import fresh_path, settle
from signalwatch.streaming import audit as audit_stream

Query = Callable[[SparkSession, str], DataFrame]

# profiles for the categories of the retail tables; PROMO and STANDARD are listed twice
TABLE_PROFILES = {
    "verao": ["ECONOMY", "PROMO"],
    "natal": ["PROMO", "STANDARD"],
    "estavel": ["STANDARD", "LARGE"],
}
SERIES_CATEGORY = "PROMO"
LISTED_CATEGORIES = ("ECONOMY", "PROMO", "MEDIUM")
# model sizes for the registered model queries; the library's defaults are far larger
QUERY_MODELS = {
    "random_forest": lambda: models.random_forest(trees=20, depth=8),
    "boosted_trees": lambda: models.boosted_trees(rounds=10),
}

# of the regularised ensembles; a stump is one split, which SQL can find too
REGULARISED_MODELS = {
    "random_forest": lambda: forest_standalone(trees=20, depth=8),
    "boosted_trees": lambda: BoostedTrees(rounds=10),
}
STUMP = BoostedTrees(rounds=1, rate=1.0, growth=Growth(depth=1, l1=0.1, l2=1.5), row_share=1.0,
                     column_share=1.0)
STUMP_FEATURES = ("lag_1", "moving_avg_3", "month", "quarter", "category_code")

#: Ridge regressions that a search draws from; SQL solves those of one and of two features.
SEARCH_SPACE = {
    "features": search.one_of(
        ("moving_avg_3",), ("lag_1",), ("search_volume",), ("moving_avg_3", "lag_1"),
        ("lag_1", "search_volume"), ("moving_avg_3", "search_volume")),
    "strength": search.between(0.01, 100.0),
}
SEARCH_DRAWS = 12

_built: dict[tuple[str, str], Warehouse] = {}
_evaluated: dict[tuple[str, str, str], models.Evaluation] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The stored star schema of ``folder``, built on first use in an application."""
    place = (spark.sparkContext.applicationId, folder)
    if place not in _built:
        staged = retail_tables.staging(spark, folder)
        _built[place] = build(spark, staged, fresh_path(spark, "warehouse"),
                              retail_tables.DELIVERED_STATUS)
    return _built[place]


def shown(df: DataFrame) -> DataFrame:
    """Plain result columns: dates as text, decimals as doubles, doubles to 6 digits."""
    plain = {
        "date": "date_format({0}, 'yyyy-MM-dd') AS {0}",
        "decimal": "CAST({0} AS DOUBLE) + 0D AS {0}",
        "double": "round({0}, 6) + 0D AS {0}",
        "int": "CAST({0} AS BIGINT) AS {0}",
    }
    return df.selectExpr(*[
        plain.get(kind.split("(")[0], "{0}").format(f"`{name}`") for name, kind in df.dtypes
    ])


def _beside(row: DataFrame, *others: DataFrame) -> DataFrame:
    """Tables of one row as one, by scalar subqueries."""
    return row.select("*", *[other.select(name).scalar().alias(name)
                             for other in others for name in other.columns])


# --- features shared by several queries ----------------------------------------------


def _daily_features(spark: SparkSession, folder: str) -> DataFrame:
    w = warehouse(spark, folder)
    return features.features_of_days(
        daily_from_parts(w["day_parts"]), w["dim_time"], w["dim_trend"], w["dim_review"],
        w["category_codes"],
    )


def _search_file(w: Warehouse) -> DataFrame:
    """The search signal with the period number its file carries."""
    return w["staging_trends"].join(w["dim_time"].select("full_date", "time_sk"), "full_date")


def _daily_features_standalone(spark: SparkSession, folder: str) -> DataFrame:
    w = warehouse(spark, folder)
    return features.features_of_days_standalone(
        daily_from_parts(w["day_parts"]), _search_file(w), w["category_codes"]
    )


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.category_alerts(_daily_features(spark, folder))


def _alerts_standalone(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.category_alerts(
        _daily_features_standalone(spark, folder), C.ALERT_WEIGHTS_STANDALONE
    )


def _ordered(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    rows = splits.in_time_order(features.model_rows(_daily_features(spark, folder)))
    return rows, rows.count()


def _analysed(spark: SparkSession, folder: str) -> DataFrame:
    w = warehouse(spark, folder)
    return items_analysed(w["fact_sales"], w["dim_product"], w["dim_trend"], w["dim_review"])


def _evaluation(spark: SparkSession, folder: str, which: str = "mllib") -> models.Evaluation:
    place = (spark.sparkContext.applicationId, folder, which)
    if place not in _evaluated:
        names, chosen = {
            "mllib": (C.FEATURES, QUERY_MODELS), "regularised": (C.FEATURES, REGULARISED_MODELS),
            "stump": (STUMP_FEATURES, {"stump": lambda: STUMP}),
        }[which]
        _evaluated[place] = models.evaluate(_daily_features(spark, folder), names, chosen)
    return _evaluated[place]


# --- star schema ------------------------------------------------------------------------


def dim_time(spark, folder):
    return shown(star.dim_time(retail_tables.orders(spark, folder)))


def dim_product(spark, folder):
    return shown(star.dim_product(retail_tables.products(spark, folder)))


def dim_customer(spark, folder):
    return shown(star.dim_customer(retail_tables.customers(spark, folder)))


def dim_seller(spark, folder):
    return shown(star.dim_seller(retail_tables.sellers(spark, folder)))


def dim_trend(spark, folder):
    w = warehouse(spark, folder)
    return shown(star.dim_trend(w["staging_trends"], w["dim_time"]))


def dim_review(spark, folder):
    w = warehouse(spark, folder)
    return shown(star.dim_review(w["staging_reviews"], w["dim_time"]))


def _sales(spark, folder):
    w = warehouse(spark, folder)
    return star.sales_rows(
        retail_tables.order_items(spark, folder), retail_tables.orders(spark, folder),
        w["dim_time"], w["dim_product"], w["dim_customer"], w["dim_seller"],
        retail_tables.DELIVERED_STATUS,
    )


def fact_sales(spark, folder):
    """The fact without its key, which may follow any order."""
    return shown(_sales(spark, folder))


def fact_sales_numbered(spark, folder):
    """The fact with keys in the order of all its columns."""
    return shown(dense_key(_sales(spark, folder), "sales_sk", star.SALES_ORDER))


def fact_by_key_range(spark, folder):
    """The second quarter of the keys in the order of all columns, by a filter on stored places."""
    path = fresh_path(spark, "ordered")
    rows = _sales(spark, folder)
    write_keyed(rows, path, star.SALES_ORDER)
    n = spark.read.parquet(f"{path}/rows").count()
    return shown(read_key_range(spark, path, "sales_sk", n // 4 + 1, n // 2, rows.schema))


def load_counts(spark, folder):
    staged = {
        "staging_orders": retail_tables.orders(spark, folder),
        "staging_order_items": retail_tables.order_items(spark, folder),
        "staging_products": retail_tables.products(spark, folder),
        "staging_customers": retail_tables.customers(spark, folder),
        "staging_sellers": retail_tables.sellers(spark, folder),
    }
    w = warehouse(spark, folder)
    derived = ("category_codes", "day_parts")
    stored = {name: df for name, df in w.items() if name not in derived}
    return quality.load_counts({**staged, **stored})


def key_checks(spark, folder):
    return warehouse(spark, folder).key_report()


def natural_key_checks(spark, folder):
    return warehouse(spark, folder).key_report(NATURAL_KEYS)


def ml_frame(spark, folder):
    w = warehouse(spark, folder)
    return shown(star.item_signals(
        w["fact_sales"], w["dim_product"], w["dim_time"], w["dim_trend"], w["dim_review"]
    ))


def sales_extract(spark, folder):
    """A query over the registered tables, written in SQL."""
    warehouse(spark, folder).register_views()
    return shown(spark.sql(
        f"SELECT s.price, s.time_sk, p.{CATEGORY} "
        "FROM fact_sales AS s JOIN dim_product AS p ON s.product_sk = p.product_sk"
    ))


# --- signals ------------------------------------------------------------------------------


def category_spine(spark, folder):
    w = warehouse(spark, folder)
    spine = signals.category_spine(w["fact_sales"], w["dim_product"], w["dim_time"])
    return shown(spine.orderBy("full_date", CATEGORY))


def spine_dates(spark, folder):
    w = warehouse(spark, folder)
    spine = signals.category_spine(w["fact_sales"], w["dim_product"], w["dim_time"])
    return shown(spine.select("full_date").distinct().orderBy("full_date"))


def category_profile(spark, folder):
    names = warehouse(spark, folder)["dim_product"].select(CATEGORY).distinct()
    return names.select(
        CATEGORY,
        profile_of(F.col(CATEGORY), TABLE_PROFILES).alias("table_profile"),
        profile_of(F.col(CATEGORY), C.SEARCH_PROFILES).alias("search_profile"),
        profile_of(F.col(CATEGORY), C.REVIEW_PROFILES).alias("review_profile"),
    )


def signal_trend(spark, folder):
    shipped = retail_tables.activity(spark, folder)
    return shown(retail_tables.trends(shipped))


def signal_review(spark, folder):
    shipped = retail_tables.activity(spark, folder)
    return shown(retail_tables.reviews(shipped))


def signal_shift_early(spark, folder):
    signal = warehouse(spark, folder)["staging_trends"]
    return shown(signals.run_ahead(signal, "search_volume", TABLE_PROFILES))


def signal_smooth(spark, folder):
    signal = warehouse(spark, folder)["staging_trends"]
    window = series.by_time("full_date")
    volume = F.col("search_volume").cast("double")
    return shown(signal.select(
        CATEGORY, "full_date",
        series.smoothed(volume, window, 10).alias("smooth_10"),
        series.smoothed(volume, window, 4).alias("smooth_4"),
    ))


def signal_progress(spark, folder):
    signal = warehouse(spark, folder)["staging_trends"]
    return shown(signal.select(
        CATEGORY, "full_date",
        calendar(F.col("full_date"))["month"].alias("month"),
        series.progress(series.by_time("full_date")).alias("progress"),
    ))


def signal_summary(spark, folder):
    w = warehouse(spark, folder)
    trend = signals.signal_summary(w["staging_trends"]).withColumn("signal", F.lit("trends"))
    review = signals.signal_summary(w["staging_reviews"]).withColumn("signal", F.lit("reviews"))
    return shown(trend.unionByName(review))


def signal_stats(spark, folder):
    return shown(signals.search_profile(warehouse(spark, folder)["staging_trends"],
                                        TABLE_PROFILES))


def signal_review_stats(spark, folder):
    return shown(signals.review_profile(warehouse(spark, folder)["staging_reviews"],
                                        TABLE_PROFILES))


def signal_sample(spark, folder):
    listed = signals.for_categories(warehouse(spark, folder)["staging_trends"],
                                    LISTED_CATEGORIES)
    return shown(signals.search_profile(listed, TABLE_PROFILES))


def review_sample(spark, folder):
    listed = signals.for_categories(warehouse(spark, folder)["staging_reviews"],
                                    LISTED_CATEGORIES)
    return shown(signals.review_profile(listed, TABLE_PROFILES))


# --- features and scores ---------------------------------------------------------------------


def daily_sales_query(spark, folder):
    w = warehouse(spark, folder)
    return shown(daily_sales(w["fact_sales"], w["dim_product"]))


def daily_features(spark, folder):
    return shown(_daily_features(spark, folder))


def daily_features_standalone(spark, folder):
    return shown(_daily_features_standalone(spark, folder))


def trend_join_avg(spark, folder):
    """Daily sales with the category's mean search volume, for a file without periods."""
    w = warehouse(spark, folder)
    daily = daily_sales(w["fact_sales"], w["dim_product"])
    return shown(all_copies(features.join_search(daily, w["staging_trends"])))


def category_codes(spark, folder):
    w = warehouse(spark, folder)
    return shown(features.category_codes(daily_sales(w["fact_sales"], w["dim_product"])))


def emergence_score(spark, folder):
    return shown(_daily_features(spark, folder).select(CATEGORY, "time_sk", "emergence_score"))


def emergence_score_standalone(spark, folder):
    return shown(
        _daily_features_standalone(spark, folder).select(CATEGORY, "time_sk", "emergence_score")
    )


def trend_phase(spark, folder):
    return shown(_daily_features(spark, folder).select(CATEGORY, "time_sk", "trend_phase"))


def category_alerts(spark, folder):
    return shown(_alerts(spark, folder))


def category_alerts_standalone(spark, folder):
    return shown(_alerts_standalone(spark, folder))


def top_alerts(spark, folder):
    return shown(alerts.top_alerts(_alerts(spark, folder)))


def top_alerts_standalone(spark, folder):
    return shown(alerts.top_alerts(_alerts_standalone(spark, folder)))


def alert_level(spark, folder):
    leveled = alerts.with_level(_alerts(spark, folder))
    return shown(leveled.select(CATEGORY, "alert", "level", "above_reference"))


def top_growth(spark, folder):
    return shown(alerts.top_mean(_daily_features(spark, folder), "growth_rate"))


def top_acceleration(spark, folder):
    return shown(alerts.top_mean(_daily_features(spark, folder), "acceleration"))


def category_series(spark, folder):
    return shown(reports.category_series(_daily_features(spark, folder), SERIES_CATEGORY))


def data_volume(spark, folder):
    """Items analysed, categories and days with sales."""
    daily = _daily_features(spark, folder)
    n_items = _analysed(spark, folder).scalar()
    return daily.agg(
        F.count_distinct(CATEGORY).alias("categories"),
        F.count_distinct("time_sk").alias("days"),
    ).select(n_items.alias("rows_analysed"), "categories", "days")


def distinct_by_period(spark, folder):
    """Customers who bought in each month and each year (month 0): the exact number, and whether that
    from day sketches is as near as it must be."""
    w = warehouse(spark, folder)
    dated = w["fact_sales"].join(w["dim_time"].select("time_sk", "year", "month"), "time_sk")
    sketches = settle(day_sketches(dated, "customer_sk", ["year", "month", "time_sk"]), "sketches")
    found = distinct_of(sketches, ["year", "month"]).union(
        distinct_of(sketches, ["year"]).select("year", F.lit(0), "estimate"))
    exact = dated.groupBy("year", "month").agg(F.count_distinct("customer_sk").alias("customers")).union(
        dated.groupBy("year").agg(F.count_distinct("customer_sk").alias("n"))
        .select("year", F.lit(0), "n"))
    near = F.abs(F.col("estimate") - F.col("customers")) <= ERROR_BOUND * F.col("customers")
    return shown(exact.join(found, ["year", "month"]).select(
        "year", "month", "customers", near.alias("near")))


# --- validation ---------------------------------------------------------------------------------


def holdout_split(spark, folder):
    rows, n_rows = _ordered(spark, folder)
    marked = splits.holdout(rows, n_rows)
    return shown(marked.select("position", "time_sk", CATEGORY, "sales_volume", "role"))


def ts_folds(spark, folder):
    rows, n_rows = _ordered(spark, folder)
    used = splits.ts_folds(rows.select("position", "time_sk", CATEGORY), n_rows)
    return shown(used.groupBy("fold", "role").agg(
        F.count("*").alias("n_rows"),
        F.min("position").alias("first_position"), F.max("position").alias("last_position"),
        F.min("time_sk").alias("first_time_sk"), F.max("time_sk").alias("last_time_sk"),
    ))


def fold_metrics(spark, folder):
    """Quality of "as many as the recent mean" on each fold."""
    rows, n_rows = _ordered(spark, folder)
    used = splits.ts_folds(rows.select("position", C.LABEL, "moving_avg_3"), n_rows)
    return shown(
        metrics.regression_metrics(used, C.LABEL, "moving_avg_3", ["fold", "role"])
    )


def fold_summary(spark, folder):
    """Mean and population deviation of the test scores over the folds."""
    rows, n_rows = _ordered(spark, folder)
    used = splits.ts_folds(rows.select("position", C.LABEL, "moving_avg_3"), n_rows)
    scored = metrics.regression_metrics(
        used.where(F.col("role") == "test"), C.LABEL, "moving_avg_3", ["fold"]
    )
    return shown(scored.agg(
        F.avg("r2").alias("cv_mean"), F.stddev_pop("r2").alias("cv_std")
    ))


def regression_metrics(spark, folder):
    rows, n_rows = _ordered(spark, folder)
    marked = splits.holdout(rows, n_rows)
    return shown(metrics.regression_metrics(marked, C.LABEL, "moving_avg_3", ["role"]))


def overfit_gap(spark, folder):
    rows, n_rows = _ordered(spark, folder)
    marked = splits.holdout(rows, n_rows)
    found = metrics.regression_metrics(marked, C.LABEL, "moving_avg_3", ["role"]).agg(
        F.max(F.when(F.col("role") == "train", F.col("r2"))).alias("r2_train"),
        F.max(F.when(F.col("role") == "test", F.col("r2"))).alias("r2_test"),
    )
    gap = F.col("r2_train") - F.col("r2_test")
    return shown(found.select(
        "r2_train", "r2_test", gap.alias("gap"), (gap < C.HEALTHY_GAP).alias("healthy")
    ))


# --- models ----------------------------------------------------------------------------------------


def model_comparison(spark, folder):
    return shown(_evaluation(spark, folder).comparison)


def feature_importance(spark, folder):
    return shown(reports.top_features(_evaluation(spark, folder).importance))


def run_summary(spark, folder):
    return shown(reports.run_summary(
        _analysed(spark, folder), _daily_features(spark, folder), _evaluation(spark, folder)
    ))


def linear_comparison(spark, folder):
    """The comparison of a model that SQL can fit too."""
    found = models.evaluate(_daily_features(spark, folder), ("moving_avg_3",),
                            {"linear": models.linear})
    return shown(found.comparison)


def stump_comparison(spark, folder):
    """The comparison of one regularised split."""
    return shown(_evaluation(spark, folder, "stump").comparison)


def stump_importance(spark, folder):
    return shown(reports.top_features(_evaluation(spark, folder, "stump").importance))


def stump_splits(spark, folder):
    """The split that was found on the train part, and what its sides predict."""
    fitted = _evaluation(spark, folder, "stump").model
    root, left, right = (fitted.trees[0][k] for k in (1, 2, 3))
    return shown(spark.createDataFrame(
        [(STUMP_FEATURES[root.feature], fitted.cuts[root.feature][root.bin], root.gain, fitted.base,
          left.value, left.n_rows, right.value, right.n_rows)],
        "feature string, cut double, gain double, base double, left_value double, left_rows long, "
        "right_value double, right_rows long"))


def regularised_comparison(spark, folder):
    return shown(_evaluation(spark, folder, "regularised").comparison)


def search_linear(spark, folder):
    """A random search of ridge regressions: strength and features."""
    rows, n_rows = _ordered(spark, folder)
    tried = search.search_linear(rows, n_rows, search.draw(SEARCH_SPACE, SEARCH_DRAWS))
    return shown(search.table(spark, tried))


def forecast_7(spark, folder):
    """Sales of the next seven days of each category."""
    days = daily_from_parts(warehouse(spark, folder)["day_parts"])
    return shown(forecast.forecast(days, forecast.fit(days)))


def moving_average_6(spark, folder):
    """The wider average: six rows."""
    days = daily_from_parts(warehouse(spark, folder)["day_parts"])
    return shown(days.select(CATEGORY, "time_sk", series.moving_average(
        F.col("sales_volume"), series.by_time(), 6).alias("moving_avg_6")))


def model_checks(spark, folder):
    """What holds for the comparison of any models, whatever their scores."""
    found = _evaluation(spark, folder)
    importance = found.importance.agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("importance_adds_up"),
        (F.min("importance") >= 0).alias("importance_not_negative"))
    compared = found.comparison.agg(
        (F.count_if("winner") == 1).alias("one_winner"),
        (F.max(F.when(F.col("winner"), F.col("r2"))) == F.max("r2")).alias("winner_is_best"),
        F.bool_and(F.abs(F.col("train_r2") - F.col("r2") - F.col("gap")) < 1e-12).alias("gap_agrees"),
        F.bool_and((F.col("gap") < C.HEALTHY_GAP) == F.col("healthy")).alias("healthy_agrees"),
        F.bool_and((F.col("r2") >= C.TARGET_R2) == F.col("meets_target")).alias("target_agrees"))
    scores = found.folds.agg((F.count("*") == 2 * C.FOLDS).alias("all_folds"))
    return _beside(compared, importance, scores)


def run_volumes(spark, folder):
    """The counts of the run summary."""
    counted = _analysed(spark, folder).select("rows_analysed")
    n_categories = _daily_features(spark, folder).agg(F.count_distinct(CATEGORY).alias("categories"))
    return shown(counted.select("rows_analysed", n_categories.scalar().alias("categories")))


# --- audit ------------------------------------------------------------------------------------------


_AUDITED = ["table_name", "operation", "time_sk", "product_sk", "price"]


def audit_inserts(spark, folder):
    """Rows the fact gained since it held the orders of earlier years only."""
    w = warehouse(spark, folder)
    fact, time = w["fact_sales"], w["dim_time"]
    newest = time.agg(F.max("year").alias("year")).scalar()
    earlier_days = time.where(F.col("year") < newest).select("time_sk")
    earlier = fact.join(earlier_days, "time_sk", "left_semi")
    return shown(audit.audit_rows(audit.inserted_rows(fact, earlier, "sales_sk")).select(_AUDITED))


def _streamed_log(spark, folder):
    w = warehouse(spark, folder)
    place = fresh_path(spark, "audit")
    append_sales(w["fact_sales"], f"{place}/increments")
    audit_stream.run_audit(spark, f"{place}/increments", f"{place}/log", f"{place}/checkpoint")
    return audit_stream.read_log(spark, f"{place}/log")


def audit_log(spark, folder):
    """Every fact row inserted while the audit stream ran."""
    return shown(_streamed_log(spark, folder).select(_AUDITED))


def fact_after_insert(spark, folder):
    """The fact and its audit log after the newest day's sales were inserted once more."""
    base = warehouse(spark, folder)["fact_sales"]
    place = fresh_path(spark, "insert")
    audit_stream.create_increments(spark, f"{place}/increments")
    newest = base.where(F.col("time_sk") == base.agg(F.max("time_sk").alias("t")).scalar())
    insert_sales(base, newest.drop("sales_sk"), f"{place}/increments")
    audit_stream.run_audit(spark, f"{place}/increments", f"{place}/log", f"{place}/checkpoint")
    logged = audit_stream.read_log(spark, f"{place}/log").agg(
        F.count("*").alias("n_logged"), F.min("sales_sk").alias("first_logged"))
    fact = with_increments(spark, base, f"{place}/increments")
    return _beside(check_key(fact, "sales_sk"), logged)


def _after_insert(spark: SparkSession, folder: str) -> Warehouse:
    """The star schema when all sales of one category came in by an insert: its codes and sums by day
    were made without them."""
    w = warehouse(spark, folder)
    fact, product = w["fact_sales"], w["dim_product"]
    place = fresh_path(spark, "insert")
    late = product.where(F.col(CATEGORY) == SERIES_CATEGORY).select("product_sk")
    base = fact.join(late, "product_sk", "left_anti").select(*fact.columns)
    days = settle(day_parts(base, product), "days")
    loaded = Warehouse(w | {"fact_sales": base, "day_parts": days,
                            "category_codes": features.category_codes(days)})
    audit_stream.create_increments(spark, f"{place}/increments")
    insert_sales(base, fact.join(late, "product_sk", "left_semi").drop("sales_sk"),
                 f"{place}/increments")
    return with_inserts(spark, loaded, f"{place}/increments")


def daily_sales_after_insert(spark, folder):
    """Sales by day of the load and of an insert, without a look at the loaded rows."""
    return shown(daily_from_parts(_after_insert(spark, folder)["day_parts"]))


def daily_features_after_insert(spark, folder):
    """All features after the first sales of a category were inserted."""
    w = _after_insert(spark, folder)
    return shown(features.features_of_days(
        daily_from_parts(w["day_parts"]), w["dim_time"], w["dim_trend"], w["dim_review"],
        w["category_codes"]))


def audit_log_numbers(spark, folder):
    """Whether the log's running numbers are gapless and unique."""
    return check_key(audit.numbered_log(_streamed_log(spark, folder)), "log_id")


def audit_monitor(spark, folder):
    monitor = audit.audit_monitor(_streamed_log(spark, folder))
    return shown(monitor.select("table_name", "operation", "total_operations"))


def audit_monitor_stream(spark, folder):
    """The monitor as a stream, after two increments of the log."""
    w = warehouse(spark, folder)
    place = fresh_path(spark, "monitor")
    for part in (0, 1):
        append_sales(w["fact_sales"].where(F.col("sales_sk") % 2 == part), f"{place}/increments")
        audit_stream.run_audit(spark, f"{place}/increments", f"{place}/log", f"{place}/checkpoint")
        audit_stream.run_monitor(spark, f"{place}/log", f"{place}/monitor", f"{place}/totals")
    monitor = audit_stream.read_monitor(spark, f"{place}/monitor")
    return shown(monitor.select("table_name", "operation", "total_operations"))


def audit_times(spark, folder):
    """How many rows were logged, and how many without a time or with one before the insert."""
    before = spark.sql("SELECT now()").first()[0]
    log = _streamed_log(spark, folder)
    return log.agg(F.count("*").alias("n_rows"),
                   F.count_if(F.col("created_at").isNull()).alias("n_without"),
                   F.count_if(F.col("created_at") < F.lit(before)).alias("n_early"))


# --- sources and sinks ----------------------------------------------------------------------------------


def csv_roundtrip(spark, folder):
    """The search signal written to CSV, read back as text and conformed."""
    place = f"{fresh_path(spark, 'csv')}/trends.csv"
    columns = ["full_date", "time_sk", CATEGORY, "search_volume"]
    w = warehouse(spark, folder)
    dated = w["staging_trends"].join(w["dim_time"].select("full_date", "time_sk"), "full_date", "left")
    files.write_csv(dated, place, columns)
    raw = files.scan_csv(spark, place, STAGING["trends"].fieldNames())
    return shown(quality.conform(raw, STAGING["trends"]))


def csv_malformed(spark, folder):
    """Sellers as CSV lines, some with a field too many or too few: which are set aside."""
    place = f"{fresh_path(spark, 'csv')}/sellers.csv"
    sellers = retail_tables.staging(spark, folder)["sellers"]
    number = F.col("seller_id").cast("long")
    line = F.when(number % 10 == 0, F.concat_ws(",", *sellers.columns, F.lit("EXTRA"))) \
        .when(number % 10 == 1, F.col("seller_id").cast("string")).otherwise(F.concat_ws(",", *sellers.columns))
    header = ",".join(sellers.columns)
    sellers.select(line.alias(header)).write.option("header", True).option("quote", "") \
        .option("escapeQuotes", False).option("sep", "\t").csv(place)
    raw = files.scan_csv(spark, place, sellers.columns, strict=False)
    text = T.StructType([T.StructField(name, T.StringType()) for name in sellers.columns])
    good, bad = quality.quarantine(raw, text)
    return good.select(F.concat_ws(",", *sellers.columns).alias("line"),
                       F.lit(False).alias("rejected")).unionByName(
        bad.select(F.col(files.CORRUPT).alias("line"), F.lit(True).alias("rejected")))


def json_roundtrip(spark, folder):
    """Review records with day number and profile written to JSON, and read back."""
    w = warehouse(spark, folder)
    place = f"{fresh_path(spark, 'json')}/reviews.jsonl"
    records = w["staging_reviews"].join(
        w["dim_time"].select("full_date", "time_sk"), "full_date", "left").fillna(0, ["time_sk"])
    profile = profile_of(F.col(CATEGORY), TABLE_PROFILES)
    files.write_json(records.withColumn("profile", profile), place)
    schema = T.StructType([*STAGING["reviews"].fields]).add("time_sk", T.LongType()).add(
        "profile", T.StringType())
    return shown(files.scan_json(spark, place, schema, array=False))


def zip_csv_scan(spark, folder):
    """All order items written to CSV, zipped file by file, and read from the archives."""
    place = fresh_path(spark, "zip")
    columns = STAGING["order_items"].fieldNames()
    files.write_csv(retail_tables.order_items(spark, folder), f"{place}/plain", columns)
    files.zip_files(spark, f"{place}/plain/*.csv", f"{place}/order_items.csv.zip")
    raw = files.scan_csv(spark, f"{place}/order_items.csv", columns)
    kept = quality.conform(raw, STAGING["order_items"])
    return shown(kept.select(
        *[F.col(c).cast("long").alias(c) for c in columns[:4]], "price", "freight_value"
    ))


_NARROW_PRICE = T.StructType([
    T.StructField("order_id", T.StringType(), True, {"max_length": 50}),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("price", T.DecimalType(6, 2)),
])


def staging_conform(spark, folder):
    """All order items as text, brought to the declared types."""
    items = retail_tables.order_items(spark, folder)
    text = items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])
    typed = quality.conform(text, STAGING["order_items"])
    return shown(typed.withColumn("order_id", F.col("order_id").cast("long"))
                 .withColumn("product_id", F.col("product_id").cast("long"))
                 .withColumn("seller_id", F.col("seller_id").cast("long")))


def staging_append(spark, folder):
    """All order items as text, appended to a typed staging table in two loads."""
    path = fresh_path(spark, "append")
    items = retail_tables.order_items(spark, folder)
    text = items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])
    for part in (0, 1):
        staging.append(text.where(F.col("order_item_id").cast("int") % 2 == part), path, "order_items")
    stored = spark.read.parquet(path)
    return shown(stored.select(*[F.col(c).cast("long").alias(c) if c.endswith("_id") else F.col(c)
                                 for c in stored.columns]))


def date_texts(spark, folder):
    """Every day of the calendar as text."""
    time = warehouse(spark, folder)["dim_time"]
    return shown(time.select("time_sk", iso_text(F.col("full_date")).alias("day")))


def staging_quarantine(spark, folder):
    """Order items whose price does, and does not, fit NUMERIC(6,2)."""
    items = retail_tables.order_items(spark, folder)
    text = items.select(*[F.col(c).cast("string").alias(c) for c in _NARROW_PRICE.fieldNames()])
    good, bad = quality.quarantine(text, _NARROW_PRICE)
    columns = [F.col("order_id").cast("long").alias("order_id"),
               F.col("order_item_id").cast("long").alias("order_item_id"),
               F.col("price").cast("double").alias("price")]
    return good.select(*columns, F.lit("").alias("problems")).unionByName(
        bad.select(*columns, F.array_join("problems", ",").alias("problems"))
    )


QUERIES: dict[str, Query] = {
    "dim_time": dim_time,
    "dim_product": dim_product,
    "dim_customer": dim_customer,
    "dim_seller": dim_seller,
    "dim_trend": dim_trend,
    "dim_review": dim_review,
    "fact_sales": fact_sales,
    "fact_sales_numbered": fact_sales_numbered,
    "fact_by_key_range": fact_by_key_range,
    "load_counts": load_counts,
    "key_checks": key_checks,
    "natural_key_checks": natural_key_checks,
    "ml_frame": ml_frame,
    "sales_extract": sales_extract,
    "category_spine": category_spine,
    "spine_dates": spine_dates,
    "category_profile": category_profile,
    "signal_trend": signal_trend,
    "signal_review": signal_review,
    "signal_shift_early": signal_shift_early,
    "signal_smooth": signal_smooth,
    "signal_progress": signal_progress,
    "signal_summary": signal_summary,
    "signal_stats": signal_stats,
    "signal_review_stats": signal_review_stats,
    "signal_sample": signal_sample,
    "review_sample": review_sample,
    "daily_sales": daily_sales_query,
    "daily_features": daily_features,
    "daily_features_standalone": daily_features_standalone,
    "trend_join_avg": trend_join_avg,
    "category_codes": category_codes,
    "emergence_score": emergence_score,
    "emergence_score_standalone": emergence_score_standalone,
    "trend_phase": trend_phase,
    "category_alerts": category_alerts,
    "category_alerts_standalone": category_alerts_standalone,
    "top_alerts": top_alerts,
    "top_alerts_standalone": top_alerts_standalone,
    "alert_level": alert_level,
    "top_growth": top_growth,
    "top_acceleration": top_acceleration,
    "category_series": category_series,
    "data_volume": data_volume,
    "distinct_by_period": distinct_by_period,
    "holdout_split": holdout_split,
    "ts_folds": ts_folds,
    "fold_metrics": fold_metrics,
    "fold_summary": fold_summary,
    "regression_metrics": regression_metrics,
    "overfit_gap": overfit_gap,
    "audit_inserts": audit_inserts,
    "fact_after_insert": fact_after_insert,
    "daily_sales_after_insert": daily_sales_after_insert,
    "daily_features_after_insert": daily_features_after_insert,
    "audit_stream": audit_log,
    "audit_log_numbers": audit_log_numbers,
    "audit_monitor": audit_monitor,
    "audit_monitor_stream": audit_monitor_stream,
    "audit_times": audit_times,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "zip_csv_scan": zip_csv_scan,
    "csv_malformed": csv_malformed,
    "staging_conform": staging_conform,
    "staging_append": staging_append,
    "date_texts": date_texts,
    "staging_quarantine": staging_quarantine,
    "model_comparison": model_comparison,
    "feature_importance": feature_importance,
    "run_summary": run_summary,
    "linear_comparison": linear_comparison,
    "stump_comparison": stump_comparison,
    "stump_importance": stump_importance,
    "stump_splits": stump_splits,
    "regularised_comparison": regularised_comparison,
    "search_linear": search_linear,
    "forecast_7": forecast_7,
    "moving_average_6": moving_average_6,
    "model_checks": model_checks,
    "run_volumes": run_volumes,
} | layers.QUERIES
