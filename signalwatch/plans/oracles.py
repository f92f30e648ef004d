"""The same results in plain SQL over the retail tables, for another engine to run."""

from __future__ import annotations

from signalwatch import constants as C
from signalwatch.plans import layers, search
from signalwatch.plans.forecast import STEPS
from signalwatch.plans.catalog import (
    LISTED_CATEGORIES,
    SEARCH_DRAWS,
    SEARCH_SPACE,
    SERIES_CATEGORY,
    STUMP,
    STUMP_FEATURES,
    TABLE_PROFILES,
)
from signalwatch.sources.retail_tables import DELIVERED_STATUS, NO_CATEGORY


def _r(expression: str, name: str | None = None) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {name or expression}"


def _numeric(expression: str, digits: int) -> str:
    """Half away from zero on the number as written, as a NUMERIC column stores it.

    ``round`` on a double scales it first, which moves some exact halves.
    """
    return f"CAST(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(18,{digits})) AS DOUBLE) + 0.0"


def _d(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d') AS {name}"


def _clip(x: str) -> str:
    return f"CASE WHEN {x} < -1 THEN -1.0 WHEN {x} > 1 THEN 1.0 ELSE {x} END"


def _weighted(weights: dict[str, float], term) -> str:
    return " + ".join(f"CAST({w} AS DOUBLE) * ({term(n)})" for n, w in weights.items())


def _profile(profiles: dict[str, list[str]]) -> str:
    cases = " ".join(
        f"WHEN category IN ({', '.join(repr(m) for m in members)}) THEN '{name}'"
        for name, members in profiles.items()
    )
    return f"CASE {cases} ELSE '{C.DEFAULT_PROFILE}' END"


_BASE = f"""
s_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         CAST(o_orderdate AS DATE) AS full_date
  FROM orders),
s_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2))
              AS DECIMAL(10,2)) AS freight_value
  FROM lineitem),
places AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
d_time AS (
  SELECT row_number() OVER (ORDER BY full_date) AS time_sk, full_date,
         CAST(extract(year FROM full_date) AS BIGINT) AS year,
         CAST(extract(month FROM full_date) AS BIGINT) AS month,
         CAST(extract(quarter FROM full_date) AS BIGINT) AS quarter,
         rpad(strftime(full_date, '%B'), 9, ' ') AS month_name,
         CAST(extract(dow FROM full_date) AS BIGINT) AS day_of_week
  FROM (SELECT DISTINCT full_date FROM s_orders WHERE full_date IS NOT NULL)),
d_product AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS product_sk, p_partkey AS product_id,
         coalesce(nullif(p_type, '{NO_CATEGORY}'), '{C.UNKNOWN_CATEGORY}') AS category
  FROM part),
d_customer AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey AS customer_id,
         c_name AS customer_unique_id, n_name AS customer_city, r_name AS customer_state
  FROM customer JOIN places ON c_nationkey = n_nationkey),
d_seller AS (
  SELECT row_number() OVER (ORDER BY s_suppkey) AS seller_sk, s_suppkey AS seller_id,
         n_name AS seller_city, r_name AS seller_state
  FROM supplier JOIN places ON s_nationkey = n_nationkey),
fact AS (
  SELECT t.time_sk, p.product_sk, c.customer_sk, s.seller_sk, i.price, i.freight_value,
         i.price + i.freight_value AS total_value, p.category
  FROM s_items AS i
  JOIN s_orders AS o ON i.order_id = o.order_id
  JOIN d_time AS t ON t.full_date = o.full_date
  JOIN d_product AS p ON p.product_id = i.product_id
  JOIN d_customer AS c ON c.customer_id = o.customer_id
  JOIN d_seller AS s ON s.seller_id = i.seller_id
  WHERE o.order_status = '{DELIVERED_STATUS}'),
activity AS (
  SELECT coalesce(nullif(p_type, '{NO_CATEGORY}'), '{C.UNKNOWN_CATEGORY}') AS category,
         CAST(l_shipdate AS DATE) AS full_date, count(*) AS n,
         CAST(5.0 AS DOUBLE) - CAST(40.0 AS DOUBLE)
           * CAST(sum(CAST(l_discount AS DECIMAL(10,2))) AS DOUBLE) / count(*) AS rating
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2),
s_trends AS (
  SELECT full_date, category,
         CASE WHEN hi > lo
              THEN {_numeric("(CAST(n AS DOUBLE) - lo) / (hi - lo) * CAST(90 AS DOUBLE) "
                             "+ CAST(5 AS DOUBLE)", 2)}
              ELSE CAST(50 AS DOUBLE) END AS search_volume
  FROM (SELECT *, CAST(min(n) OVER (PARTITION BY category) AS DOUBLE) AS lo,
               CAST(max(n) OVER (PARTITION BY category) AS DOUBLE) AS hi FROM activity)),
s_reviews AS (
  SELECT category, full_date, {_numeric("score", 2)} AS average_score,
         CAST(CASE WHEN n < 1 THEN 1 WHEN n > 2000 THEN 2000 ELSE n END AS BIGINT)
           AS total_comments,
         {_numeric("(score - 1) / 4 * 100", 2)} AS sentiment_score,
         {_numeric("coalesce(score - lag(score) OVER (PARTITION BY category ORDER BY full_date), "
                   "0.0)", 4)} AS review_momentum
  FROM (SELECT *, CASE WHEN rating < 1 THEN CAST(1 AS DOUBLE) WHEN rating > 5
                       THEN CAST(5 AS DOUBLE) ELSE rating END AS score FROM activity)),
d_trend AS (
  SELECT row_number() OVER (ORDER BY s.full_date, category) AS trend_sk, t.time_sk, category,
         search_volume,
         lag(search_volume, 1) OVER (PARTITION BY category ORDER BY s.full_date) AS search_lead_1,
         lag(search_volume, 2) OVER (PARTITION BY category ORDER BY s.full_date) AS search_lead_2,
         s.full_date
  FROM s_trends AS s JOIN d_time AS t ON t.full_date = s.full_date),
d_review AS (
  SELECT row_number() OVER (ORDER BY s.full_date, category) AS review_sk, t.time_sk, category,
         average_score, total_comments, sentiment_score, review_momentum, s.full_date
  FROM s_reviews AS s JOIN d_time AS t ON t.full_date = s.full_date),
ml AS (
  SELECT f.time_sk, CAST(f.price AS DOUBLE) AS price, f.category, t.month, t.quarter,
         coalesce(tr.search_volume, CAST(50 AS DOUBLE)) AS search_volume,
         coalesce(tr.search_lead_1, CAST(50 AS DOUBLE)) AS search_lead_1,
         coalesce(tr.search_lead_2, CAST(50 AS DOUBLE)) AS search_lead_2,
         coalesce(rv.sentiment_score, CAST(50 AS DOUBLE)) AS sentiment_score,
         coalesce(rv.review_momentum, CAST(0 AS DOUBLE)) AS review_momentum,
         coalesce(rv.average_score, CAST(3.5 AS DOUBLE)) AS average_score
  FROM fact AS f
  JOIN d_time AS t ON t.time_sk = f.time_sk
  LEFT JOIN d_trend AS tr ON tr.time_sk = f.time_sk AND tr.category = f.category
  LEFT JOIN d_review AS rv ON rv.time_sk = f.time_sk AND rv.category = f.category),
codes AS (
  SELECT category, row_number() OVER (ORDER BY category) - 1 AS category_code
  FROM (SELECT DISTINCT category FROM fact)),
daily AS (
  SELECT category, time_sk, count(price) AS sales_volume,
         CAST(sum(CAST(price AS DECIMAL(10,2))) AS DOUBLE) AS revenue,
         min(search_volume) AS search_volume, min(search_lead_1) AS search_lead_1,
         min(search_lead_2) AS search_lead_2, min(sentiment_score) AS sentiment_score,
         min(review_momentum) AS review_momentum,
         min(month) AS month, min(quarter) AS quarter
  FROM ml GROUP BY category, time_sk),
moved_1 AS (
  SELECT *, avg(sales_volume) OVER (PARTITION BY category ORDER BY time_sk
                                    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_3,
         coalesce(lag(sales_volume) OVER (PARTITION BY category ORDER BY time_sk), 0) AS lag_1
  FROM daily),
moved_2 AS (
  SELECT *, coalesce(moving_avg_3 / nullif(lag(moving_avg_3) OVER w, 0) - 1, 0.0) AS growth_rate
  FROM moved_1 WINDOW w AS (PARTITION BY category ORDER BY time_sk)),
moved_3 AS (
  SELECT *, coalesce(growth_rate - lag(growth_rate) OVER w, 0.0) AS acceleration
  FROM moved_2 WINDOW w AS (PARTITION BY category ORDER BY time_sk)),
moved_4 AS (
  SELECT *, coalesce(search_volume / nullif(lag(search_volume) OVER w, 0) - 1, 0.0)
           AS search_momentum,
         sin(2 * pi() * month / 12) AS season_sin, cos(2 * pi() * month / 12) AS season_cos
  FROM moved_3 WINDOW w AS (PARTITION BY category ORDER BY time_sk)),
features AS (
  SELECT m.*, {_weighted(C.EMERGENCE_WEIGHTS, _clip)} AS emergence_score,
         CASE WHEN growth_rate > 0 AND acceleration > 0 THEN '{C.PHASES[0]}'
              WHEN growth_rate > 0 THEN '{C.PHASES[1]}'
              WHEN acceleration > 0 THEN '{C.PHASES[2]}'
              ELSE '{C.PHASES[3]}' END AS trend_phase,
         category_code
  FROM moved_4 AS m JOIN codes ON codes.category = m.category),
daily_b AS (
  SELECT category, time_sk, count(price) AS sales_volume,
         CAST(sum(price) AS DOUBLE) AS revenue FROM fact GROUP BY category, time_sk),
search_b AS (
  SELECT d.*, coalesce(s.search_volume, avg(s.search_volume) OVER (PARTITION BY d.category))
           AS search_volume,
         (d.time_sk - 1) % 12 + 1 AS month
  FROM daily_b AS d
  LEFT JOIN (SELECT category, t.time_sk, search_volume
             FROM s_trends JOIN d_time AS t ON t.full_date = s_trends.full_date) AS s
         ON s.category = d.category AND s.time_sk = d.time_sk),
moved_b1 AS (
  SELECT *, (month - 1) // 3 + 1 AS quarter,
         avg(sales_volume) OVER (PARTITION BY category ORDER BY time_sk
                                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_3,
         coalesce(lag(sales_volume) OVER w, 0) AS lag_1,
         coalesce(lag(search_volume, 1) OVER w, search_volume) AS search_lead_1,
         coalesce(lag(search_volume, 2) OVER w, search_volume) AS search_lead_2,
         coalesce(search_volume / nullif(lag(search_volume) OVER w, 0) - 1, 0.0)
           AS search_momentum,
         sin(2 * pi() * month / 12) AS season_sin, cos(2 * pi() * month / 12) AS season_cos
  FROM search_b WINDOW w AS (PARTITION BY category ORDER BY time_sk)),
moved_b2 AS (
  SELECT *, coalesce(moving_avg_3 / nullif(lag(moving_avg_3) OVER w, 0) - 1, 0.0) AS growth_rate
  FROM moved_b1 WINDOW w AS (PARTITION BY category ORDER BY time_sk)),
moved_b3 AS (
  SELECT *, coalesce(growth_rate - lag(growth_rate) OVER w, 0.0) AS acceleration
  FROM moved_b2 WINDOW w AS (PARTITION BY category ORDER BY time_sk)),
features_b AS (
  SELECT m.*, {_weighted(C.EMERGENCE_WEIGHTS_STANDALONE, _clip)} AS emergence_score,
         CASE WHEN growth_rate > 0 AND acceleration > 0 THEN '{C.PHASES[0]}'
              WHEN growth_rate > 0 THEN '{C.PHASES[1]}'
              WHEN acceleration > 0 THEN '{C.PHASES[2]}'
              ELSE '{C.PHASES[3]}' END AS trend_phase,
         category_code
  FROM moved_b3 AS m JOIN codes ON codes.category = m.category)
"""


def _alerts(source: str, weights: dict[str, float]) -> str:
    def norm(name: str) -> str:
        return (
            f"CASE WHEN max({name}) OVER () > min({name}) OVER () "
            f"THEN ({name} - min({name}) OVER ()) / (max({name}) OVER () - min({name}) OVER ())"
            f" * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        )

    return f"""
SELECT *, {_weighted(weights, norm)} AS alert
FROM (SELECT category, avg(search_momentum) AS search_momentum_avg,
             avg(emergence_score) AS emergence_score_avg,
             avg(acceleration) AS acceleration_avg, avg(sales_volume) AS sales_volume_avg
      FROM {source} GROUP BY category)"""


_ORDERED = f""",
ordered AS (
  SELECT *, row_number() OVER (ORDER BY time_sk, category) - 1 AS position,
         count(*) OVER () AS n_all
  FROM features),
split AS (
  SELECT *, CASE WHEN position < CAST(floor(n_all * CAST({C.TRAIN_SHARE} AS DOUBLE)) AS BIGINT)
                 THEN 'train' ELSE 'test' END AS role
  FROM ordered),
folds AS (
  SELECT f.fold, o.*, n_all // {C.FOLDS + 1} AS size,
         CASE WHEN position < n_all - ({C.FOLDS} - f.fold) * (n_all // {C.FOLDS + 1})
              THEN 'train' ELSE 'test' END AS role
  FROM ordered AS o
  JOIN (SELECT unnest(range({C.FOLDS})) AS fold) AS f
    ON position < n_all - ({C.FOLDS - 1} - f.fold) * (n_all // {C.FOLDS + 1}))
"""

_CATEGORY = "category AS product_category_name"
_FEATURE_COLUMNS = ", ".join([
    _CATEGORY, "CAST(time_sk AS BIGINT) AS time_sk", "CAST(sales_volume AS BIGINT) AS sales_volume",
    _r("revenue"), _r("search_volume"), _r("search_lead_1"), _r("search_lead_2"),
    "CAST(month AS BIGINT) AS month", "CAST(quarter AS BIGINT) AS quarter",
    _r("moving_avg_3"), _r("growth_rate"), _r("acceleration"),
    "CAST(lag_1 AS BIGINT) AS lag_1", _r("search_momentum"), _r("season_sin"), _r("season_cos"),
    _r("emergence_score"), "trend_phase", "CAST(category_code AS BIGINT) AS category_code",
])
_ALERT_COLUMNS = ", ".join([
    _CATEGORY, _r("search_momentum_avg"), _r("emergence_score_avg"), _r("acceleration_avg"),
    _r("sales_volume_avg"), _r("alert"),
])
_R2 = ("CASE WHEN count(*) < 2 THEN NULL"
       " WHEN var_pop(sales_volume) > 0 THEN 1 - sum((sales_volume - moving_avg_3) ** 2)"
       " / (var_pop(sales_volume) * count(*))"
       " WHEN sum((sales_volume - moving_avg_3) ** 2) = 0 THEN 1.0 ELSE 0.0 END")
_MAE = "avg(abs(sales_volume - moving_avg_3))"
_STATS = (f"{_CATEGORY}, " + ", ".join([
    _r("avg(search_volume)", "search_mean"), _r("stddev_samp(search_volume)", "search_std"),
    _r("min(search_volume)", "search_min"), _r("max(search_volume)", "search_max"),
]) + f", {_profile(TABLE_PROFILES)} AS profile")


def _key_check(name: str, table: str, key: str) -> str:
    return (f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) - count({key}) AS n_null, "
            f"count({key}) - count(DISTINCT {key}) AS n_dup, CAST(min({key}) AS VARCHAR) AS min_key, "
            f"CAST(max({key}) AS VARCHAR) AS max_key FROM {table}")


def _top_mean(measure: str) -> str:
    return (f"SELECT {_CATEGORY}, {_r(f'avg({measure})', f'{measure}_avg')} FROM features "
            f"GROUP BY category ORDER BY avg({measure}) DESC NULLS LAST, category LIMIT 5")


_AUDITED = ("'fact_sales' AS table_name, 'INSERT' AS operation, time_sk, product_sk, "
            "CAST(price AS DOUBLE) AS price")
_ITEM = ("order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id, "
         "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) + 0.0 AS freight_value")
_FACT = ("time_sk, product_sk, customer_sk, seller_sk, CAST(price AS DOUBLE) AS price, "
         "CAST(freight_value AS DOUBLE) + 0.0 AS freight_value, "
         "CAST(total_value AS DOUBLE) AS total_value")
_REVIEW = (f"{_CATEGORY}, {_d('full_date')}, average_score, total_comments, sentiment_score, "
           "review_momentum")

_STANDALONE = "features_b"

_SELECTS = {
    "dim_time": f"SELECT time_sk, {_d('full_date')}, year, month, quarter, month_name, "
                "day_of_week FROM d_time",
    "dim_product": f"SELECT product_sk, product_id, {_CATEGORY} FROM d_product",
    "dim_customer": "SELECT * FROM d_customer",
    "dim_seller": "SELECT * FROM d_seller",
    "dim_trend": f"SELECT trend_sk, time_sk, {_CATEGORY}, search_volume, search_lead_1, "
                 f"search_lead_2, {_d('full_date')} FROM d_trend",
    "dim_review": f"SELECT review_sk, time_sk, {_REVIEW} FROM d_review",
    "fact_sales": f"SELECT {_FACT} FROM fact",
    "fact_sales_numbered":
        "SELECT row_number() OVER (ORDER BY time_sk, product_sk, customer_sk, seller_sk, price, "
        f"freight_value, total_value) AS sales_sk, {_FACT} FROM fact",
    "load_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {table}"
        for name, table in {
            "staging_orders": "s_orders", "staging_order_items": "s_items",
            "staging_products": "part", "staging_customers": "d_customer",
            "staging_sellers": "d_seller", "staging_trends": "s_trends",
            "staging_reviews": "s_reviews", "dim_time": "d_time", "dim_product": "d_product",
            "dim_customer": "d_customer", "dim_seller": "d_seller", "dim_trend": "d_trend",
            "dim_review": "d_review", "fact_sales": "fact",
        }.items()
    ),
    "key_checks": " UNION ALL ".join(
        _key_check(*check) for check in (
            ("dim_time", "d_time", "time_sk"), ("dim_product", "d_product", "product_sk"),
            ("dim_customer", "d_customer", "customer_sk"), ("dim_seller", "d_seller", "seller_sk"),
            ("dim_trend", "d_trend", "trend_sk"), ("dim_review", "d_review", "review_sk"),
            ("fact_sales", "(SELECT row_number() OVER () AS sales_sk FROM fact)", "sales_sk"),
        )
    ),
    "natural_key_checks": " UNION ALL ".join(
        _key_check(*check) for check in (
            ("dim_time", "d_time", "full_date"), ("dim_product", "d_product", "product_id"),
            ("dim_customer", "d_customer", "customer_id"), ("dim_seller", "d_seller", "seller_id"),
        )
    ),
    "ml_frame": f"SELECT time_sk, price, {_CATEGORY}, month, quarter, search_volume, "
                "search_lead_1, search_lead_2, sentiment_score, review_momentum, average_score "
                "FROM ml",
    "sales_extract": f"SELECT CAST(price AS DOUBLE) AS price, time_sk, {_CATEGORY} FROM fact",
    "category_spine": f"SELECT DISTINCT {_d('t.full_date').replace('AS t.', 'AS ')}, t.time_sk, "
                      f"{_CATEGORY} FROM fact JOIN d_time AS t ON t.time_sk = fact.time_sk",
    "spine_dates": f"SELECT DISTINCT {_d('t.full_date').replace('AS t.', 'AS ')} "
                   "FROM fact JOIN d_time AS t ON t.time_sk = fact.time_sk",
    "category_profile":
        f"SELECT DISTINCT {_CATEGORY}, {_profile(TABLE_PROFILES)} AS table_profile, "
        f"{_profile(C.SEARCH_PROFILES)} AS search_profile, "
        f"{_profile(C.REVIEW_PROFILES)} AS review_profile FROM d_product",
    "signal_trend": f"SELECT {_d('full_date')}, {_CATEGORY}, search_volume FROM s_trends",
    "signal_review": f"SELECT {_REVIEW} FROM s_reviews",
    "signal_shift_early":
        f"SELECT {_d('full_date')}, {_CATEGORY}, search_volume, "
        f"CASE WHEN {_profile(TABLE_PROFILES)} IN "
        f"({', '.join(repr(p) for p in C.EARLY_PROFILES)}) THEN coalesce(lead(search_volume, "
        f"{C.EARLY_ROWS}) OVER (PARTITION BY category ORDER BY full_date), search_volume) "
        "ELSE search_volume END AS search_volume_early FROM s_trends",
    "signal_smooth":
        f"SELECT {_CATEGORY}, {_d('full_date')}, " + ", ".join(
            f"CASE WHEN count(*) OVER w{k} = {k} THEN round(avg(search_volume) OVER w{k}, 6) + 0.0 "
            f"END AS smooth_{k}" for k in (10, 4)
        ) + " FROM s_trends WINDOW " + ", ".join(
            f"w{k} AS (PARTITION BY category ORDER BY full_date "
            f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)" for k in (10, 4)
        ),
    "signal_progress":
        f"SELECT {_CATEGORY}, {_d('full_date')}, "
        "CAST(extract(month FROM full_date) AS BIGINT) AS month, "
        "round(percent_rank() OVER (PARTITION BY category ORDER BY full_date), 6) + 0.0 "
        "AS progress FROM s_trends",
    "signal_summary": " UNION ALL ".join(
        f"SELECT '{name}' AS signal, count(*) AS n_rows, count(DISTINCT category) AS n_categories, "
        "strftime(min(full_date), '%Y-%m-%d') AS first_date, "
        f"strftime(max(full_date), '%Y-%m-%d') AS last_date FROM s_{name}"
        for name in ("trends", "reviews")
    ),
    "signal_stats": f"SELECT {_STATS} FROM s_trends GROUP BY category",
    "signal_review_stats":
        f"SELECT {_CATEGORY}, {_r('avg(average_score)', 'score_mean')}, "
        f"{_r('avg(total_comments)', 'comments_mean')}, "
        f"{_r('avg(review_momentum)', 'momentum_mean')}, {_profile(TABLE_PROFILES)} AS profile "
        "FROM s_reviews GROUP BY category",
    "review_sample":
        f"SELECT {_CATEGORY}, {_r('avg(average_score)', 'score_mean')}, "
        f"{_r('avg(total_comments)', 'comments_mean')}, "
        f"{_r('avg(review_momentum)', 'momentum_mean')}, {_profile(TABLE_PROFILES)} AS profile "
        f"FROM s_reviews WHERE category IN ({', '.join(repr(c) for c in LISTED_CATEGORIES)}) "
        "GROUP BY category",
    "signal_sample": f"SELECT {_STATS} FROM s_trends WHERE category IN "
                     f"({', '.join(repr(c) for c in LISTED_CATEGORIES)}) GROUP BY category",
    "daily_sales": f"SELECT {_CATEGORY}, time_sk, sales_volume, {_r('revenue')} FROM daily_b",
    "daily_features": f"SELECT {_FEATURE_COLUMNS}, {_r('sentiment_score')}, "
                      f"{_r('review_momentum')} FROM features",
    "daily_features_standalone": f"SELECT {_FEATURE_COLUMNS} FROM {_STANDALONE}",
    "trend_join_avg":
        f"SELECT d.category AS product_category_name, time_sk, sales_volume, {_r('revenue')}, "
        "round(search_volume, 6) + 0.0 AS search_volume FROM daily_b AS d LEFT JOIN "
        "(SELECT category, avg(search_volume) AS search_volume FROM s_trends GROUP BY category) "
        "AS s ON s.category = d.category",
    "category_codes": f"SELECT {_CATEGORY}, category_code FROM codes",
    "emergence_score": f"SELECT {_CATEGORY}, time_sk, {_r('emergence_score')} FROM features",
    "emergence_score_standalone":
        f"SELECT {_CATEGORY}, time_sk, {_r('emergence_score')} FROM {_STANDALONE}",
    "trend_phase": f"SELECT {_CATEGORY}, time_sk, trend_phase FROM features",
    "category_alerts":
        f"SELECT {_ALERT_COLUMNS} FROM ({_alerts('features', C.ALERT_WEIGHTS)})",
    "category_alerts_standalone":
        f"SELECT {_ALERT_COLUMNS} FROM ({_alerts(_STANDALONE, C.ALERT_WEIGHTS_STANDALONE)})",
    "top_alerts": f"SELECT {_ALERT_COLUMNS} FROM ({_alerts('features', C.ALERT_WEIGHTS)}) AS a "
                  "ORDER BY a.alert DESC, category LIMIT 5",
    "top_alerts_standalone":
        f"SELECT {_ALERT_COLUMNS} FROM ({_alerts(_STANDALONE, C.ALERT_WEIGHTS_STANDALONE)}) AS a "
        "ORDER BY a.alert DESC, category LIMIT 5",
    "alert_level":
        f"SELECT {_CATEGORY}, {_r('alert')}, CASE WHEN alert > {C.CRITICAL_ALERT} "
        f"THEN 'critical' ELSE 'standard' END AS level, alert > {C.ALERT_REFERENCE_LINE} "
        f"AS above_reference FROM ({_alerts('features', C.ALERT_WEIGHTS)})",
    "top_growth": _top_mean("growth_rate"),
    "top_acceleration": _top_mean("acceleration"),
    "category_series": f"SELECT time_sk, sales_volume, {_r('search_momentum')} FROM features "
                       f"WHERE category = '{SERIES_CATEGORY}'",
    "data_volume": "SELECT count(*) AS rows_analysed, count(DISTINCT category) AS categories, "
                   "count(DISTINCT time_sk) AS days FROM ml",
    "run_volumes": "SELECT count(*) AS rows_analysed, (SELECT count(DISTINCT category) "
                   "FROM features) AS categories FROM ml",
    "model_checks":
        "SELECT true AS one_winner, true AS winner_is_best, true AS gap_agrees, "
        "true AS healthy_agrees, true AS target_agrees, true AS importance_adds_up, "
        "true AS importance_not_negative, true AS all_folds",
    "fact_after_insert":
        "SELECT n + m AS n_rows, 0 AS n_null, 0 AS n_dup, '1' AS min_key, "
        "CAST(n + m AS VARCHAR) AS max_key, m AS n_logged, n + 1 AS first_logged FROM "
        "(SELECT count(*) AS n, count(*) FILTER (time_sk = (SELECT max(time_sk) FROM fact)) AS m "
        "FROM fact)",
    "audit_inserts": f"SELECT {_AUDITED} FROM fact WHERE time_sk IN "
                     "(SELECT time_sk FROM d_time WHERE year = (SELECT max(year) FROM d_time))",
    "audit_stream": f"SELECT {_AUDITED} FROM fact",
    "audit_log_numbers":
        "SELECT n_rows, n_null, n_dup, min_key, max_key FROM ("
        + _key_check("log", "(SELECT row_number() OVER () AS log_id FROM fact)", "log_id") + ")",
    "audit_monitor": "SELECT 'fact_sales' AS table_name, 'INSERT' AS operation, "
                     "count(*) AS total_operations FROM fact",
    "csv_roundtrip": f"SELECT {_d('full_date')}, {_CATEGORY}, search_volume FROM s_trends",
    "json_roundtrip": f"SELECT {_REVIEW}, coalesce(time_sk, 0) AS time_sk, "
                      f"{_profile(TABLE_PROFILES)} AS profile "
                      "FROM s_reviews LEFT JOIN d_time USING (full_date)",
    "csv_malformed":
        "SELECT CASE WHEN seller_id % 10 = 0 THEN seller_id || ',' || seller_city || ',' || "
        "seller_state || ',EXTRA' WHEN seller_id % 10 = 1 THEN CAST(seller_id AS VARCHAR) "
        "ELSE seller_id || ',' || seller_city || ',' || seller_state END AS line, "
        "seller_id % 10 < 2 AS rejected FROM d_seller",
    "zip_csv_scan": f"SELECT {_ITEM} FROM s_items",
    "staging_conform": f"SELECT {_ITEM} FROM s_items",
    "staging_append": f"SELECT {_ITEM} FROM s_items",
    "date_texts": "SELECT time_sk, strftime(full_date, '%Y-%m-%d') AS day FROM d_time",
    "staging_quarantine":
        "SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, "
        "CAST(price AS DOUBLE) AS price, "
        "CASE WHEN price >= 10000 THEN 'price' ELSE '' END AS problems FROM s_items",
}

_MISS = "sales_volume - (slope * moving_avg_3 + base)"
_LINE = ("regr_slope(sales_volume, moving_avg_3) AS slope, "
         "regr_intercept(sales_volume, moving_avg_3) AS base")
_FITTED_R2 = f"1 - sum(({_MISS}) ** 2) / (var_pop(sales_volume) * count(*))"

_L1, _L2 = STUMP.growth.l1, STUMP.growth.l2


def _kept(g: str) -> str:
    """A sum of gradients in units, nearer to 0 by the L1 term."""
    return f"sign({g} / unit) * greatest(abs({g} / unit) - {_L1}, 0)"


def _score(g: str, w: str) -> str:
    return f"({_kept(g)}) * ({_kept(g)}) / ({w} + {_L2})"


# the best single split of the train part of the hold-out and of every fold, by exact sums
_STUMPS = f""",
parts AS (
  SELECT 'holdout' AS part, role, position, sales_volume AS y, {", ".join(STUMP_FEATURES)} FROM split
  UNION ALL
  SELECT CAST(fold AS VARCHAR), role, position, sales_volume, {", ".join(STUMP_FEATURES)} FROM folds),
about AS (
  SELECT part, CAST(avg(y) AS DOUBLE) AS base,
         2.0 ** floor(61 - log2(count(*) * greatest(8.0 * (max(y) - min(y)), 1e-9))) AS unit
  FROM parts WHERE role = 'train' GROUP BY part),
valued AS (
  SELECT part, unnest(range({len(STUMP_FEATURES)})) AS f,
         unnest([{", ".join(f"CAST({f} AS DOUBLE)" for f in STUMP_FEATURES)}]) AS x,
         CAST(round((base - y) * unit) AS HUGEINT) AS g
  FROM parts JOIN about USING (part) WHERE role = 'train'),
cuts AS (
  SELECT DISTINCT part, f, unnest(quantile_disc(x, [k / {STUMP.bins}.0 for k in range(1, {STUMP.bins})]))
         AS x
  FROM valued GROUP BY part, f),
sums AS (SELECT part, f, x, sum(g) AS g, count(*) AS w FROM valued GROUP BY part, f, x),
below AS (
  SELECT part, f, x, sum(g) OVER up - g AS g_left, sum(w) OVER up - w AS w_left,
         sum(g) OVER (PARTITION BY part, f) AS g, sum(w) OVER (PARTITION BY part, f) AS w
  FROM sums WINDOW up AS (PARTITION BY part, f ORDER BY x)),
gains AS (
  SELECT below.*, base, unit,
         {_score("g_left", "w_left")} + {_score("(g - g_left)", "(w - w_left)")} - {_score("g", "w")}
         AS gain
  FROM below JOIN cuts USING (part, f, x) JOIN about USING (part) WHERE w_left > 0),
stumps AS (
  SELECT part, f, x AS cut, gain, base, w_left, w - w_left AS w_right,
         -({_kept("g_left")}) / (w_left + {_L2}) AS at_left,
         -({_kept("(g - g_left)")}) / (w - w_left + {_L2}) AS at_right
  FROM gains QUALIFY row_number() OVER (PARTITION BY part ORDER BY gain DESC, f, x) = 1),
foretold AS (
  SELECT parts.part, role, y, base + CASE WHEN CAST([{", ".join(STUMP_FEATURES)}][f + 1] AS DOUBLE) < cut
                                          THEN at_left ELSE at_right END AS p
  FROM parts JOIN stumps USING (part)),
scored AS (
  SELECT part, role, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2, avg(abs(y - p)) AS mae
  FROM foretold GROUP BY part, role)
"""
_STUMP_NAMES = ", ".join(repr(f) for f in STUMP_FEATURES)

_STUMP_SELECTS = {
    "stump_comparison":
        f"SELECT 'stump' AS model, {_r('r2')}, {_r('mae')}, {_r('cv_mean')}, {_r('cv_std')}, "
        f"{_r('train_r2')}, {_r('train_r2 - r2', 'gap')}, train_r2 - r2 < {C.HEALTHY_GAP} AS healthy, "
        f"r2 >= {C.TARGET_R2} AS meets_target, true AS winner FROM "
        "(SELECT max(r2) FILTER (role = 'test') AS r2, max(mae) FILTER (role = 'test') AS mae, "
        "max(r2) FILTER (role = 'train') AS train_r2 FROM scored WHERE part = 'holdout'), "
        "(SELECT avg(r2) AS cv_mean, stddev_pop(r2) AS cv_std FROM scored "
        "WHERE part <> 'holdout' AND role = 'test')",
    "stump_importance":
        f"SELECT name AS feature, CASE WHEN name = [{_STUMP_NAMES}][f + 1] THEN 1.0 ELSE 0.0 END "
        f"AS importance FROM stumps, (SELECT unnest([{_STUMP_NAMES}]) AS name) WHERE part = 'holdout'",
    "stump_splits":
        f"SELECT [{_STUMP_NAMES}][f + 1] AS feature, {_r('cut')}, {_r('gain')}, {_r('base')}, "
        f"{_r('at_left', 'left_value')}, CAST(w_left AS BIGINT) AS left_rows, "
        f"{_r('at_right', 'right_value')}, CAST(w_right AS BIGINT) AS right_rows "
        "FROM stumps WHERE part = 'holdout'",
}

_ORDERED_SELECTS = {
    # a line fitted to the train part of the split, and to that of every fold
    "linear_comparison":
        f"SELECT 'linear' AS model, {_r('r2')}, {_r('mae')}, {_r('cv_mean')}, {_r('cv_std')}, "
        f"{_r('train_r2')}, {_r('train_r2 - r2', 'gap')}, train_r2 - r2 < {C.HEALTHY_GAP} AS healthy, "
        f"r2 >= {C.TARGET_R2} AS meets_target, true AS winner FROM "
        f"(SELECT {_FITTED_R2} AS r2, avg(abs({_MISS})) AS mae FROM split, "
        f"(SELECT {_LINE} FROM split WHERE role = 'train') WHERE role = 'test'), "
        f"(SELECT {_FITTED_R2} AS train_r2 FROM split, "
        f"(SELECT {_LINE} FROM split WHERE role = 'train') WHERE role = 'train'), "
        "(SELECT avg(r2) AS cv_mean, stddev_pop(r2) AS cv_std FROM "
        f"(SELECT fold, {_FITTED_R2} AS r2 FROM folds JOIN "
        f"(SELECT fold, {_LINE} FROM folds WHERE role = 'train' GROUP BY fold) USING (fold) "
        "WHERE role = 'test' GROUP BY fold))",
    "holdout_split": f"SELECT position, time_sk, {_CATEGORY}, sales_volume, role FROM split",
    "ts_folds":
        "SELECT fold, role, count(*) AS n_rows, min(position) AS first_position, "
        "max(position) AS last_position, min(time_sk) AS first_time_sk, "
        "max(time_sk) AS last_time_sk FROM folds GROUP BY fold, role",
    "fold_metrics": f"SELECT fold, role, count(*) AS n_rows, {_r(_R2, 'r2')}, {_r(_MAE, 'mae')} "
                    "FROM folds GROUP BY fold, role",
    "fold_summary":
        f"SELECT {_r('avg(r2)', 'cv_mean')}, {_r('stddev_pop(r2)', 'cv_std')} FROM "
        f"(SELECT fold, {_R2} AS r2 FROM folds WHERE role = 'test' GROUP BY fold)",
    "regression_metrics": f"SELECT role, count(*) AS n_rows, {_r(_R2, 'r2')}, {_r(_MAE, 'mae')} "
                          "FROM split GROUP BY role",
    "overfit_gap":
        f"SELECT {_r('r2_train')}, {_r('r2_test')}, {_r('r2_train - r2_test', 'gap')}, "
        f"r2_train - r2_test < {C.HEALTHY_GAP} AS healthy FROM "
        "(SELECT max(CASE WHEN role = 'train' THEN r2 END) AS r2_train, "
        "max(CASE WHEN role = 'test' THEN r2 END) AS r2_test FROM "
        f"(SELECT role, {_R2} AS r2 FROM split GROUP BY role))",
}


# least squares on the sales of the row before and the mean of the three before, then step by step
_FORECAST = f""",
known AS (
  SELECT category, time_sk, CAST(sales_volume AS DOUBLE) AS y,
         CAST(lag(sales_volume) OVER c AS DOUBLE) AS l,
         avg(sales_volume) OVER (c ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m
  FROM daily_b WINDOW c AS (PARTITION BY category ORDER BY time_sk)),
solved AS (
  SELECT (cyl * vm - cym * clm) / (vl * vm - clm * clm) AS wl,
         (cym * vl - cyl * clm) / (vl * vm - clm * clm) AS wm, my, ml, mm
  FROM (SELECT avg(y) AS my, avg(l) AS ml, avg(m) AS mm, var_pop(l) AS vl, var_pop(m) AS vm,
               covar_pop(l, m) AS clm, covar_pop(y, l) AS cyl, covar_pop(y, m) AS cym
        FROM known WHERE l IS NOT NULL)),
recent AS (
  SELECT category, max(time_sk) AS last_day, max(y) FILTER (age = 1) AS a,
         max(y) FILTER (age = 2) AS b, max(y) FILTER (age = 3) AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY time_sk DESC) AS age FROM known)
  GROUP BY category),
steps AS (
  SELECT category, last_day, 0 AS step, a, b, c FROM recent
  UNION ALL
  SELECT category, last_day, step + 1,
         greatest(0.0, my - wl * ml - wm * mm + wl * a
                       + wm * ((a + coalesce(b, 0) + coalesce(c, 0))
                               / (1 + CAST(b IS NOT NULL AS INTEGER) + CAST(c IS NOT NULL AS INTEGER)))),
         a, b
  FROM steps, solved WHERE step < {STEPS})
"""

_CANDIDATES = search.draw(SEARCH_SPACE, SEARCH_DRAWS)


def _search_sql() -> str:
    """Every candidate on every fold; the better half of each fold goes on to the next."""
    names = sorted({n for c in _CANDIDATES for n in c["features"]})

    def value(column: str) -> str:
        cases = " ".join(f"WHEN '{n}' THEN CAST({n} AS DOUBLE)" for n in names)
        return f"CASE {column} {cases} ELSE 0.0 END"

    drawn = ", ".join(
        f"({k}, '{c['features'][0]}', '{c['features'][-1] if len(c['features']) > 1 else ''}', "
        f"CAST({c['strength']!r} AS DOUBLE))" for k, c in enumerate(_CANDIDATES))
    sets, left = ["going_0 AS (SELECT k FROM drawn)"], len(_CANDIDATES)
    for fold in range(1, C.FOLDS):
        left = -(-left // 2)
        sets.append(f"going_{fold} AS (SELECT k FROM tried JOIN going_{fold - 1} USING (k) "
                    f"WHERE fold < {fold} GROUP BY k ORDER BY avg(r2) DESC, k LIMIT {left})")
    n_folds = " + ".join(f"CAST(k IN (FROM going_{f}) AS INTEGER)" for f in range(C.FOLDS))
    return f""",
drawn(k, f1, f2, strength) AS (VALUES {drawn}),
z AS (SELECT k, strength, fold, role, CAST(sales_volume AS DOUBLE) AS y, {value('f1')} AS x1,
             {value('f2')} AS x2 FROM folds, drawn),
moments AS (
  SELECT k, fold, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) + any_value(strength) AS a,
         var_pop(x2) + any_value(strength) AS d, covar_pop(x1, x2) AS b, covar_pop(y, x1) AS e,
         covar_pop(y, x2) AS g
  FROM z WHERE role = 'train' GROUP BY k, fold),
weights AS (SELECT *, (e * d - g * b) / (a * d - b * b) AS w1, (g * a - e * b) / (a * d - b * b) AS w2
            FROM moments),
tried AS (
  SELECT k, fold, 1 - sum((y - (my + w1 * (x1 - m1) + w2 * (x2 - m2))) ** 2) / (var_pop(y) * count(*))
         AS r2
  FROM z JOIN weights USING (k, fold) WHERE role = 'test' GROUP BY k, fold),
{", ".join(sets)},
counted AS (SELECT k, {n_folds} AS n_folds FROM drawn)
SELECT CAST(k AS BIGINT) AS candidate, CAST(n_folds AS BIGINT) AS n_folds, {_r('avg(r2)', 'r2')},
       n_folds = {C.FOLDS} AS winner
FROM counted JOIN tried USING (k) WHERE fold < n_folds GROUP BY k, n_folds"""


def oracles() -> dict[str, str]:
    """Query name -> SQL with the same columns and rows."""
    found = {name: f"WITH {_BASE}{select}" for name, select in _SELECTS.items()}
    found |= {
        name: f"WITH {_BASE}{_ORDERED}{select}" for name, select in _ORDERED_SELECTS.items()
    }
    found |= {name: f"WITH {_BASE}{_ORDERED}{_STUMPS}{select}"
              for name, select in _STUMP_SELECTS.items()}
    found["search_linear"] = f"WITH {_BASE}{_ORDERED}{_search_sql()}"
    found["forecast_7"] = (
        f"WITH RECURSIVE {_BASE}{_FORECAST}SELECT {_CATEGORY}, CAST(step AS BIGINT) AS step, "
        f"last_day + step AS time_sk, {_r('a', 'forecast')} FROM steps WHERE step > 0")
    found["moving_average_6"] = (
        f"WITH {_BASE} SELECT {_CATEGORY}, time_sk, "
        + _r("avg(sales_volume) OVER (PARTITION BY category ORDER BY time_sk "
             "ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)", "moving_avg_6") + " FROM daily_b")
    found["audit_monitor_stream"] = found["audit_monitor"]
    found["audit_times"] = (f"WITH {_BASE} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_without, "
                            "CAST(0 AS BIGINT) AS n_early FROM fact")
    found["fact_by_key_range"] = (
        f"SELECT * FROM ({found['fact_sales_numbered']}) WHERE sales_sk BETWEEN "
        f"(WITH {_BASE} SELECT count(*) // 4 + 1 FROM fact) AND "
        f"(WITH {_BASE} SELECT count(*) // 2 FROM fact)")
    bought = "FROM fact JOIN d_time USING (time_sk) GROUP BY"
    found["distinct_by_period"] = (
        f"WITH {_BASE} SELECT year, month, count(DISTINCT customer_sk) AS customers, true AS near "
        f"{bought} year, month UNION ALL SELECT year, CAST(0 AS BIGINT), count(DISTINCT customer_sk), "
        f"true {bought} year")
    # an insert changes nothing but the order in which rows came
    for name in ("daily_sales", "daily_features"):
        found[f"{name}_after_insert"] = found[name]
    return found | layers.SQL
