"""Registered ML feature queries (AG-08, AG-14, AG-18, WN-07, PF-05, PF-06, SE-01, SE-02, BX-02, BX-04, BX-13, FN-05)."""

from __future__ import annotations

from ..operators import features as FE
from ..sources import tables as T
from .catalog import register
from . import oracle_rules as R
from .sqltext import CUSTOMER_ORDERS, SALES_AS_OF, whole_days

AS_OF = SALES_AS_OF

# Orders are summed first, and the small domains (months, categories, payments) are counted as distinct rows.
CM_CTE = f"""
recent_lines AS (SELECT * FROM customer_orders WHERE order_date >= DATE '{AS_OF}' - INTERVAL '2 years'),
whole_orders AS (
    SELECT customer_id, order_id, COUNT(*) AS n, SUM(order_value) AS v, MAX(order_value) AS top, SUM(order_time) AS seconds,
           MAX(order_date) AS latest, MIN(order_date) AS earliest, COUNT(*) FILTER (dayofweek(order_date) % 6 = 0) AS weekend
    FROM recent_lines GROUP BY ALL
),
sums AS (
    SELECT customer_id, COUNT(*) AS orders, SUM(n) AS n, SUM(v) AS v, MAX(top) AS top, SUM(seconds) AS seconds,
           {whole_days(AS_OF, 'MAX(latest)')} AS idle, {whole_days(AS_OF, 'MIN(earliest)')} AS age, CAST(SUM(weekend) AS BIGINT) AS weekend
    FROM whole_orders GROUP BY customer_id
),
months AS (SELECT customer_id, COUNT(*) AS k FROM (SELECT DISTINCT customer_id, strftime(order_date, '%Y%m') FROM recent_lines) GROUP BY customer_id),
kinds AS (SELECT customer_id, COUNT(*) AS k FROM (SELECT DISTINCT customer_id, product_category FROM recent_lines WHERE product_category IS NOT NULL) GROUP BY customer_id),
payments AS (SELECT customer_id, COUNT(*) AS k FROM (SELECT DISTINCT customer_id, payment_method FROM recent_lines WHERE payment_method IS NOT NULL) GROUP BY customer_id),
behaviour AS (
    SELECT sums.customer_id, idle AS days_since_last_order, age AS customer_age_days, orders AS total_orders, months.k AS active_months,
           v AS total_spent, v / n AS avg_order_value, top AS max_order_value, coalesce(kinds.k, 0) AS unique_categories,
           coalesce(payments.k, 0) AS payment_methods_used, CAST(floor(seconds / n / 3600) AS INTEGER) AS avg_order_hour,
           weekend AS weekend_orders, v / orders AS revenue_per_order, CAST(floor(orders / months.k) AS BIGINT) AS orders_per_month
    FROM sums JOIN months USING (customer_id) LEFT JOIN kinds USING (customer_id) LEFT JOIN payments USING (customer_id)
)"""

_SOURCES = {"recency_zscore": "days_since_last_order", "frequency_zscore": "total_orders", "monetary_zscore": "total_spent"}

# Mean and deviation are one row; each customer's distance from the mean is divided by the latter.
NORM_CTE = f"""
means AS (SELECT COUNT(*) AS n, {", ".join(f"AVG({src}) AS {z}_mean" for z, src in _SOURCES.items())} FROM behaviour),
deviations AS (
    SELECT {", ".join(f"sqrt(SUM(({src} - {z}_mean) * ({src} - {z}_mean)) / NULLIF(MAX(n) - 1, 0)) AS {z}_sd" for z, src in _SOURCES.items())}
    FROM behaviour, means
),
standard AS (
    SELECT customer_id, {", ".join(f"({src} - {z}_mean) / NULLIF({z}_sd, 0) AS {z}" for z, src in _SOURCES.items())},
           recency_label.label AS recency_category, frequency_label.label AS frequency_category, value_label.label AS value_category
    FROM means, deviations, behaviour
         JOIN {R.RECENCY_LABEL_ROWS} ON days_since_last_order > recency_label.above AND days_since_last_order <= recency_label.upto
         JOIN {R.FREQUENCY_LABEL_ROWS} ON total_orders >= frequency_label.least AND total_orders < frequency_label.below
         JOIN {R.VALUE_LABEL_ROWS} ON total_spent >= value_label.least AND total_spent < value_label.below
)"""

RFM_CTE = f"""
{R.segment_cells(R.ML_SEGMENT_ROWS, "cells")},
placed AS (
    SELECT customer_id, recency_band.score AS recency_score, frequency_band.score AS frequency_score, money_band.score AS monetary_score,
           CAST(100 * recency_band.score + 10 * frequency_band.score + money_band.score AS VARCHAR) AS rfm_string, cells.label AS customer_segment
    FROM behaviour
         JOIN {R.RECENCY_SCORES} ON days_since_last_order > recency_band.above AND days_since_last_order <= recency_band.upto
         JOIN {R.FREQUENCY_SCORES} ON total_orders >= frequency_band.least AND total_orders < frequency_band.below
         JOIN {R.ML_MONEY_SCORES} ON total_spent >= money_band.least AND total_spent < money_band.below
         JOIN cells ON r = recency_band.score AND f = frequency_band.score AND m = money_band.score
)"""

_CM_DOUBLES = ["total_spent", "avg_order_value", "max_order_value", "revenue_per_order"]


def _cm(spark, sf_dir):
    return FE.customer_metrics(T.customer_orders(spark, sf_dir), AS_OF)


@register("ml_customer_metrics", ids=("AG-08", "AG-14", "FN-05", "D2", "D4"), doubles=_CM_DOUBLES,
          sql=f"WITH {CUSTOMER_ORDERS},{CM_CTE}\nSELECT * FROM behaviour")
def q_ml_customer_metrics(spark, sf_dir):
    return _cm(spark, sf_dir)


@register("ml_feature_zscores", ids=("WN-07", "PF-06", "D7"),
          doubles=["recency_zscore", "frequency_zscore", "monetary_zscore"],
          sql=f"WITH {CUSTOMER_ORDERS},{CM_CTE},{NORM_CTE}\nSELECT * FROM standard")
def q_ml_feature_zscores(spark, sf_dir):
    return FE.feature_normalization(_cm(spark, sf_dir))


@register("ml_customer_categories", ids=("PF-06",), sql=f"""
WITH {CUSTOMER_ORDERS},{CM_CTE},{NORM_CTE}
SELECT customer_id, recency_category, frequency_category, value_category FROM standard""")
def q_ml_customer_categories(spark, sf_dir):
    return FE.feature_categories(_cm(spark, sf_dir)).select(
        "customer_id", "recency_category", "frequency_category", "value_category")


@register("ml_features_long", ids=("BX-13", "SE-01", "SE-02", "PF-05"), doubles=["feature_value"], sql=f"""
WITH {CUSTOMER_ORDERS},{CM_CTE},{NORM_CTE}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, feature_name, feature_value, 'numerical' AS feature_type
FROM (UNPIVOT (SELECT customer_id, recency_zscore, frequency_zscore, monetary_zscore FROM standard)
      ON recency_zscore, frequency_zscore, monetary_zscore INTO NAME feature_name VALUE feature_value)""")
def q_ml_features_long(spark, sf_dir):
    return FE.ml_features(T.customer_orders(spark, sf_dir), AS_OF)


@register("ml_rfm_scores", ids=("BX-02", "BX-04", "FN-08"), sql=f"""
WITH {CUSTOMER_ORDERS},{CM_CTE},{RFM_CTE}
SELECT * FROM placed""")
def q_ml_rfm_scores(spark, sf_dir):
    return FE.ml_rfm(_cm(spark, sf_dir))


@register("ml_rfm_segments", ids=("AG-18", "BX-04", "SO-02"), doubles=["avg_recency", "avg_frequency", "avg_monetary"],
          sql=f"""WITH {CUSTOMER_ORDERS},{CM_CTE},{RFM_CTE}
SELECT customer_segment, COUNT(*) AS customer_count, AVG(recency_score) AS avg_recency,
       AVG(frequency_score) AS avg_frequency, AVG(monetary_score) AS avg_monetary
FROM placed GROUP BY customer_segment ORDER BY customer_count DESC, customer_segment""")
def q_ml_rfm_segments(spark, sf_dir):
    return FE.ml_rfm_segments(_cm(spark, sf_dir))
