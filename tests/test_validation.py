import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.operators import alerts, metrics, splits
from signalwatch.plans import features, models, reports
from signalwatch.schemas import CATEGORY


@pytest.fixture(scope="module")
def twenty(spark):
    return spark.range(20).select(
        (F.col("id") / 2).cast("long").alias("time_sk"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias(CATEGORY),
        F.col("id").alias("n"),
    ).repartition(5)


def test_positions_follow_time_then_category(twenty):
    got = splits.in_time_order(twenty).collect()
    assert sorted((r.position, r.n) for r in got) == [(n, n) for n in range(20)]


def test_holdout(twenty):
    marked = splits.holdout(splits.in_time_order(twenty), 20).collect()
    assert sorted(r.position for r in marked if r.role == "train") == list(range(16))
    assert sorted(r.position for r in marked if r.role == "test") == list(range(16, 20))


def test_folds(twenty):
    used = splits.ts_folds(splits.in_time_order(twenty), 20).collect()
    got = {
        fold: tuple(
            sorted(r.position for r in used if r.fold == fold and r.role == role)
            for role in ("train", "test")
        )
        for fold in range(5)
    }
    starts = [5, 8, 11, 14, 17]
    assert got == {
        f: (list(range(start)), list(range(start, start + 3))) for f, start in enumerate(starts)
    }
    train, test = splits.fold_part(splits.in_time_order(twenty), 5, 8)
    assert (train.count(), test.count()) == (5, 3)


@pytest.mark.parametrize("n", [6, 7, 100, 9198])
def test_folds_end_with_the_last_row(n):
    ranges = splits.fold_ranges(n)
    assert ranges[-1][2] == n
    assert all(a[2] == b[1] for a, b in zip(ranges, ranges[1:]))
    assert all(start > 0 and end - start == n // 6 for _, start, end in ranges)


def test_too_few_rows_for_folds():
    with pytest.raises(ValueError):
        splits.fold_ranges(5)


def score(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, p double")
    return metrics.regression_metrics(df, "y", "p").first()


def test_metrics_match_their_definition(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(1e6, 1.0, 500)  # far from 0: a plain sum of squares would lose digits
    p = y + rng.normal(0, 0.3, 500)
    got = score(spark, list(zip(y.tolist(), p.tolist())))
    expected = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert got.r2 == pytest.approx(expected, abs=1e-6)
    assert got.mae == pytest.approx(np.abs(y - p).mean())


def test_metrics_without_spread(spark):
    assert score(spark, [(2.0, 2.0), (2.0, 2.0)]).r2 == 1
    assert score(spark, [(2.0, 2.0), (2.0, 3.0)]).r2 == 0
    assert score(spark, [(2.0, 2.0)]).r2 is None


def feature_rows(spark, rows):
    return spark.createDataFrame(
        rows, f"{CATEGORY} string, search_momentum double, emergence_score double, "
              "acceleration double, sales_volume double",
    )


def test_alerts_scale_each_mean_to_0_100(spark):
    df = feature_rows(spark, [("a", 0.0, 1.0, 5.0, 1.0), ("b", 1.0, 3.0, 5.0, 1.0),
                              ("c", 0.5, 2.0, 5.0, 1.0)])
    got = {r[CATEGORY]: r.alert for r in alerts.category_alerts(df).collect()}
    # equal accelerations add nothing
    assert got == {"a": 0, "b": pytest.approx(75), "c": pytest.approx(37.5)}
    leveled = alerts.with_level(alerts.category_alerts(df)).collect()
    assert {r[CATEGORY]: r.above_reference for r in leveled} == {
        "a": False, "b": True, "c": False,
    }


def test_top_alerts_break_ties_by_name_and_skip_missing(spark):
    df = spark.createDataFrame(
        [(n, v) for n, v in zip("gfedcba", (1.0, None, 9.0, 9.0, 9.0, 2.0, 3.0))],
        f"{CATEGORY} string, alert double",
    )
    assert [r[CATEGORY] for r in alerts.top_alerts(df).collect()] == ["c", "d", "e", "a", "b"]


def series(spark, days=60):
    """Categories a..f are flat; "rising" grows, its searches ahead of its sales."""
    rows = [(c, t, 20, 50.0) for c in "abcdef" for t in range(1, days + 1)]
    rows += [("rising", t, 5 + t * t // 20, 10 * 1.04 ** t) for t in range(1, days + 1)]
    daily = spark.createDataFrame(
        rows, f"{CATEGORY} string, time_sk long, sales_volume long, search_volume double")
    trends = daily.select(CATEGORY, "time_sk", "search_volume")
    fact = daily.select(
        F.explode(F.sequence(F.lit(1), F.col("sales_volume"))).alias("i"), "time_sk",
        F.dense_rank().over(features.series.Window.orderBy(CATEGORY)).cast("long")
        .alias("product_sk"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
    )
    product = daily.select(CATEGORY).distinct().select(
        F.row_number().over(features.series.Window.orderBy(CATEGORY)).cast("long")
        .alias("product_sk"), CATEGORY,
    )
    return fact, product, trends


@pytest.fixture(scope="module")
def planted(spark):
    fact, product, trends = series(spark)
    codes = features.category_codes(product)
    return features.daily_features_standalone(fact, product, trends, codes).cache()


def test_planted_trend_ranks_first(planted):
    ranked = alerts.category_alerts(planted, C.ALERT_WEIGHTS_STANDALONE)
    top = alerts.top_alerts(ranked).collect()
    assert top[0][CATEGORY] == "rising" and top[0].alert == pytest.approx(100)
    assert all(0 <= r.alert <= 100 for r in ranked.collect())
    assert alerts.top_mean(planted, "growth_rate").first()[CATEGORY] == "rising"
    shown = reports.category_series(planted, "rising").collect()
    assert [r.time_sk for r in shown] == list(range(1, 61))


def test_codes_follow_name_order(spark):
    names = spark.createDataFrame([("b",), ("a",), ("b",), ("Z",)], f"{CATEGORY} string")
    got = {r[CATEGORY]: r.category_code for r in features.category_codes(names).collect()}
    assert got == {"Z": 0, "a": 1, "b": 2}


def test_rows_with_a_missing_feature_are_dropped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None), (float("nan"), 1.0)],
                               "x double, sales_volume double")
    assert features.model_rows(df, ("x",)).count() == 1


@pytest.fixture(scope="module")
def found(planted):
    small = {
        "random_forest": lambda: models.random_forest_standalone(trees=5, depth=4),
        "boosted_trees": lambda: models.boosted_trees(rounds=3, depth=3),
    }
    return models.evaluate(planted, C.FEATURES_STANDALONE, small, parallel=4)


def test_models_are_scored_on_rows_after_their_training(found):
    comparison = {r.model: r for r in found.comparison.collect()}
    assert set(comparison) == {"random_forest", "boosted_trees"}
    for row in comparison.values():
        assert all(math.isfinite(row[c]) for c in ("r2", "mae", "cv_mean", "cv_std"))
        assert row.gap == pytest.approx(row.train_r2 - row.r2)
        assert row.healthy == (row.gap < 0.08)
        assert row.meets_target == (row.r2 >= 0.80)
    best = max(comparison.values(), key=lambda r: r.r2)
    assert found.winner == best.model and best.winner


def test_fold_scores(found):
    scores = found.folds.collect()
    assert sorted((r.model, r.fold) for r in scores) == [
        (m, f) for m in ("boosted_trees", "random_forest") for f in range(5)
    ]
    forest = [r.r2 for r in scores if r.model == "random_forest"]
    row = found.comparison.where("model = 'random_forest'").first()
    assert row.cv_mean == pytest.approx(np.mean(forest))
    assert row.cv_std == pytest.approx(np.std(forest))


def test_importances(found):
    weights = {r.feature: r.importance for r in found.importance.collect()}
    assert set(weights) == set(C.FEATURES_STANDALONE)
    assert sum(weights.values()) == pytest.approx(1)
    top = [r.importance for r in reports.top_features(found.importance, 3).collect()]
    assert top == sorted(weights.values(), reverse=True)[:3]


def test_run_summary(planted, found):
    analysed = planted.agg(F.count("*").alias("rows_analysed"))
    row = reports.run_summary(analysed, planted, found).first()
    assert (row.rows_analysed, row.categories, row.model) == (420, 7, found.winner)


def test_default_models_have_the_full_sizes(spark):
    forest, boosted = models.random_forest(), models.boosted_trees()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (300, 15, 42)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (400, 5, 0.08)
    regular = models.random_forest_standalone()
    assert (regular.getMinInstancesPerNode(), regular.getFeatureSubsetStrategy()) == (2, "sqrt")
