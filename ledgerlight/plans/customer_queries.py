"""Registered customer queries (AG-07, BX-01, BX-03, BX-05..08, FN-02, FN-08, FN-11, SO-01)."""

from __future__ import annotations

from ..operators import customers as C
from ..sources import tables as T
from .catalog import register
from .sqltext import SALES_AS_OF as AS_OF
from . import oracle_rules as R
from .sqltext import STAGING_SALES, whole_days

# Lines are summed by customer and product first, so products are counted as rows.
ORDERS_CTE = f"""
bought AS (
    SELECT customer_id, product_id, COUNT(*) AS n, SUM(order_value) AS v, SUM(quantity) AS q,
           MAX(order_date) AS latest, MIN(order_date) AS earliest
    FROM staging_sales WHERE order_date >= DATE '{AS_OF}' - INTERVAL '1 year' GROUP BY ALL
),
spending AS (
    SELECT customer_id, CAST(SUM(n) AS BIGINT) AS total_orders, SUM(v) AS total_spent, SUM(v) / SUM(n) AS avg_order_value,
           MAX(latest) AS last_order_date, MIN(earliest) AS first_order_date, CAST(SUM(q) AS BIGINT) AS total_quantity,
           COUNT(*) AS unique_products_purchased
    FROM bought GROUP BY customer_id
)"""

RFM_CTE = f"""
aged AS (SELECT *, {whole_days(AS_OF, "last_order_date")} AS recency_days FROM spending),
points AS (
    SELECT aged.*, total_orders AS frequency, total_spent AS monetary, recency_band.score AS recency_score,
           frequency_band.score AS frequency_score, money_band.score AS monetary_score
    FROM aged JOIN {R.RECENCY_SCORES} ON recency_days > recency_band.above AND recency_days <= recency_band.upto
              JOIN {R.FREQUENCY_SCORES} ON total_orders >= frequency_band.least AND total_orders < frequency_band.below
              JOIN {R.MARKETING_MONEY_SCORES} ON total_spent >= money_band.least AND total_spent < money_band.below
)"""

SEGMENTS_CTE = f"""
{R.segment_cells(R.MARKETING_SEGMENT_ROWS, "cells")},
grouped AS (
    SELECT points.*, CAST(100 * recency_score + 10 * frequency_score + monetary_score AS VARCHAR) AS rfm_score,
           cells.label AS customer_segment, tier_band.label AS value_tier,
           concat(['Occasional', 'Frequent'][1 + CAST(total_orders >= 15 AS INTEGER)],
                  [' Low-Value', ' High-Value'][1 + CAST(avg_order_value >= 500 AS INTEGER)]) AS purchase_behavior
    FROM points JOIN cells ON r = recency_score AND f = frequency_score AND m = monetary_score
                JOIN {R.VALUE_TIER_ROWS} ON total_spent >= tier_band.least AND total_spent < tier_band.below
)"""

CLV_CTE = f"""
worth AS (
    SELECT *, total_spent * age / 365.0 AS estimated_clv, age AS customer_age_days,
           total_orders * 30.0 / GREATEST(age, 30) AS monthly_purchase_frequency
    FROM (SELECT *, {whole_days(AS_OF, "first_order_date")} AS age FROM grouped)
)"""

_METRIC_DOUBLES = ["total_spent", "avg_order_value"]
_RFM_DOUBLES = _METRIC_DOUBLES + ["monetary"]
_CLV_DOUBLES = _RFM_DOUBLES + ["estimated_clv", "monthly_purchase_frequency"]


def _metrics(spark, sf_dir):
    return C.customer_order_metrics(T.staging_sales(spark, sf_dir), AS_OF)


@register("customer_order_metrics", ids=("AG-07", "AG-14"), doubles=_METRIC_DOUBLES,
          sql=f"WITH {STAGING_SALES},{ORDERS_CTE}\nSELECT * FROM spending")
def q_customer_order_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@register("customer_rfm", ids=("BX-01", "FN-02"), doubles=_RFM_DOUBLES,
          sql=f"WITH {STAGING_SALES},{ORDERS_CTE},{RFM_CTE}\nSELECT * FROM points")
def q_customer_rfm(spark, sf_dir):
    return C.rfm_scores(_metrics(spark, sf_dir), AS_OF)


@register("customer_segments", ids=("BX-03", "BX-05", "FN-08"), doubles=_RFM_DOUBLES,
          sql=f"WITH {STAGING_SALES},{ORDERS_CTE},{RFM_CTE},{SEGMENTS_CTE}\nSELECT * FROM grouped")
def q_customer_segments(spark, sf_dir):
    return C.customer_segments(C.rfm_scores(_metrics(spark, sf_dir), AS_OF))


@register("customer_clv", ids=("BX-06", "FN-11"), doubles=_CLV_DOUBLES,
          sql=f"WITH {STAGING_SALES},{ORDERS_CTE},{RFM_CTE},{SEGMENTS_CTE},{CLV_CTE}\n"
              "SELECT * EXCLUDE (age) FROM worth")
def q_customer_clv(spark, sf_dir):
    return C.customer_clv(C.customer_segments(C.rfm_scores(_metrics(spark, sf_dir), AS_OF)), AS_OF)


ANALYSIS_SQL = f"""
WITH {STAGING_SALES},{ORDERS_CTE},{RFM_CTE},{SEGMENTS_CTE},{CLV_CTE}
SELECT customer_id, total_orders, total_spent, avg_order_value, last_order_date, first_order_date, total_quantity,
       unique_products_purchased, recency_days, frequency, monetary, recency_score, frequency_score, monetary_score,
       rfm_score, customer_segment, value_tier, purchase_behavior, estimated_clv, customer_age_days,
       monthly_purchase_frequency, activity_band.label AS activity_status, coalesce(growth.points, 1) AS growth_potential_score
FROM worth JOIN {R.ACTIVITY_ROWS} ON recency_days > activity_band.above AND recency_days <= activity_band.upto
           LEFT JOIN {R.GROWTH_ROWS} ON growth.label = customer_segment
ORDER BY total_spent DESC, last_order_date DESC, customer_id"""


@register("customer_analysis", ids=("BX-08", "BX-07", "PF-08", "PF-09", "SO-01", "FN-07"),
          doubles=_CLV_DOUBLES, sql=ANALYSIS_SQL)
def q_customer_analysis(spark, sf_dir):
    """Full customer analysis chain (24 columns less the wall-clock timestamp)."""
    return C.customer_analysis(T.staging_sales(spark, sf_dir), AS_OF)


@register("recency_days", ids=("FN-02", "D12"), sql=f"""
SELECT o_orderkey, {whole_days(AS_OF, 'o_orderdate')} AS recency_days,
       {whole_days(AS_OF, "o_orderdate + INTERVAL '14 hours'")} AS recency_days_partial
FROM orders""")
def q_recency_days(spark, sf_dir):
    """Whole elapsed days from every order to as_of (and from 14:00 the same day)."""
    from pyspark.sql import functions as F

    from ..functions import dates as D
    o = T.read(spark, sf_dir, "orders")
    return o.select("o_orderkey", D.whole_days(AS_OF, "o_orderdate").alias("recency_days"),
                    D.whole_days(AS_OF, F.col("o_orderdate") + F.expr("INTERVAL 14 HOURS"))
                    .alias("recency_days_partial"))
