"""Customer analysis: order metrics, RFM scores, segments, value tiers, CLV.

Input is ``staging_sales``.  One aggregate (``groupBy(customer_id)``) does all
the heavy work; every later step is a per-row projection on the customer
rows, so the whole chain has a single shuffle plus the final sort.  The only
distinct count (products per customer) is planned by Spark as a two-level
aggregate keyed on ``(customer_id, product_id)`` first, which splits a hot
customer across reducers before the per-customer merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rules import first_match, score_at_least, score_at_most, segment

# RFM score cuts of the reference (score 5 first, 1 otherwise).
RECENCY_DAY_CUTS = (30, 60, 90, 180)           # days since last order, "<="
FREQUENCY_ORDER_CUTS = (20, 15, 10, 5)          # orders, ">="
MONETARY_CUTS_MARKETING = (10000, 5000, 2000, 500)  # spend, ">=" (customer analysis)
MONETARY_CUTS_ML = (1000, 750, 500, 250)        # spend, ">=" (ML feature script)
SCORES = (5, 4, 3, 2)

# Marketing segments (customer analysis), first match wins.
# Each rule is (recency test, frequency test, monetary test, label).
MARKETING_SEGMENTS = [
    ((">=", 4), (">=", 4), (">=", 4), "Champions"),
    ((">=", 3), (">=", 3), (">=", 3), "Loyal Customers"),
    ((">=", 4), ("<=", 2), (">=", 3), "Potential Loyalists"),
    ((">=", 4), ("<=", 2), ("<=", 2), "New Customers"),
    ((">=", 3), (">=", 2), (">=", 3), "Promising"),
    (("<=", 2), (">=", 3), (">=", 3), "Need Attention"),
    (("<=", 2), (">=", 2), (">=", 2), "About to Sleep"),
    (("<=", 2), ("<=", 2), (">=", 2), "At Risk"),
    (("<=", 2), ("<=", 2), ("<=", 2), "Cannot Lose Them"),
]
# ML segments -- a different rule set sharing some label names.
ML_SEGMENTS = [
    ((">=", 4), (">=", 4), (">=", 4), "Champions"),
    ((">=", 3), (">=", 3), (">=", 3), "Loyal Customers"),
    ((">=", 4), ("<=", 2), ("<=", 2), "New Customers"),
    ((">=", 3), (">=", 2), (">=", 2), "Potential Loyalists"),
    ((">=", 2), (">=", 3), (">=", 3), "At Risk"),
    (("<=", 2), (">=", 2), (">=", 2), "Cannot Lose Them"),
    (("<=", 2), ("<=", 2), (">=", 3), "Hibernating"),
    (("<=", 2), ("<=", 2), ("<=", 2), "Lost"),
]
SEGMENT_DEFAULT = "Others"

# Value tiers by spend, purchase behaviour, activity, growth potential.
VALUE_TIERS = [(10000, "Premium"), (5000, "High Value"), (2000, "Medium Value"), (500, "Low Value")]
VALUE_TIER_DEFAULT = "New/Inactive"
BEHAVIOUR_ORDERS_CUT = 15
BEHAVIOUR_AOV_CUT = 500
ACTIVITY = [(30, "Active"), (90, "At Risk"), (180, "Inactive")]
ACTIVITY_DEFAULT = "Lost"
GROWTH_POTENTIAL = [
    (("Champions", "Loyal Customers"), 10),
    (("Potential Loyalists", "Promising"), 8),
    (("Need Attention",), 6),
    (("About to Sleep",), 4),
    (("At Risk",), 2),
]
GROWTH_POTENTIAL_DEFAULT = 1


def recency_score(days: str | Column) -> Column:
    return score_at_most(days, RECENCY_DAY_CUTS, SCORES, 1)


def frequency_score(orders: str | Column) -> Column:
    return score_at_least(orders, FREQUENCY_ORDER_CUTS, SCORES, 1)


def monetary_score(spent: str | Column, cuts=MONETARY_CUTS_MARKETING) -> Column:
    return score_at_least(spent, cuts, SCORES, 1)


def customer_order_metrics(ss: DataFrame, as_of=None, years: int = 1) -> DataFrame:
    """AG-07: per-customer order metrics over the last ``years`` years."""
    return (ss.filter(D.since("order_date", as_of, years, "years"))
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.sum("order_value").alias("total_spent"),
                 F.avg("order_value").alias("avg_order_value"),
                 F.max("order_date").alias("last_order_date"),
                 F.min("order_date").alias("first_order_date"),
                 F.sum("quantity").cast("bigint").alias("total_quantity"),
                 F.count_distinct("product_id").alias("unique_products_purchased")))


def rfm_scores(metrics: DataFrame, as_of=None, monetary_cuts=MONETARY_CUTS_MARKETING,
               last_col: str = "last_order_date", orders_col: str = "total_orders",
               spent_col: str = "total_spent") -> DataFrame:
    """BX-01 / BX-02: recency days, R/F/M scores 1..5 with parameterised money cuts."""
    out = metrics.withColumn("recency_days", D.whole_days(as_of, last_col))
    return out.withColumns({
        "frequency": F.col(orders_col),
        "monetary": F.col(spent_col),
        "recency_score": recency_score("recency_days"),
        "frequency_score": frequency_score(orders_col),
        "monetary_score": monetary_score(spent_col, monetary_cuts),
    })


def rfm_segment(rules=MARKETING_SEGMENTS, r: str = "recency_score", f: str = "frequency_score",
                m: str = "monetary_score") -> Column:
    """BX-03 / BX-04: segment label from an ordered rule list."""
    return segment(F.col(r), F.col(f), F.col(m), rules, SEGMENT_DEFAULT)


def rfm_code(r: str = "recency_score", f: str = "frequency_score", m: str = "monetary_score") -> Column:
    """``CONCAT(r, f, m)``, e.g. '543'."""
    return F.concat(F.col(r).cast("string"), F.col(f).cast("string"), F.col(m).cast("string"))


def customer_segments(rfm: DataFrame) -> DataFrame:
    """BX-03 + BX-05: RFM code, marketing segment, value tier, purchase behaviour."""
    spent, orders, aov = F.col("total_spent"), F.col("total_orders"), F.col("avg_order_value")
    return rfm.withColumns({
        "rfm_score": rfm_code(),
        "customer_segment": rfm_segment(MARKETING_SEGMENTS),
        "value_tier": first_match([(spent >= cut, label) for cut, label in VALUE_TIERS], VALUE_TIER_DEFAULT),
        "purchase_behavior": first_match([
            ((orders >= BEHAVIOUR_ORDERS_CUT) & (aov >= BEHAVIOUR_AOV_CUT), "Frequent High-Value"),
            ((orders >= BEHAVIOUR_ORDERS_CUT) & (aov < BEHAVIOUR_AOV_CUT), "Frequent Low-Value"),
            ((orders < BEHAVIOUR_ORDERS_CUT) & (aov >= BEHAVIOUR_AOV_CUT), "Occasional High-Value"),
        ], "Occasional Low-Value"),
    })


def customer_clv(df: DataFrame, as_of=None) -> DataFrame:
    """BX-06: CLV = AOV x orders x age_days / 365; monthly frequency with a one-month floor."""
    age = D.whole_days(as_of, "first_order_date")
    out = df.withColumn("customer_age_days", age)
    return out.withColumns({
        "estimated_clv": F.col("avg_order_value") * F.col("total_orders") * F.col("customer_age_days") / F.lit(365.0),
        "monthly_purchase_frequency": F.col("total_orders") / F.greatest(
            F.col("customer_age_days") / F.lit(30.0), F.lit(1.0)),
    })


def activity_status(days: str = "recency_days") -> Column:
    return first_match([(F.col(days) <= cut, label) for cut, label in ACTIVITY], ACTIVITY_DEFAULT)


def growth_potential(seg: str = "customer_segment") -> Column:
    return first_match([(F.col(seg).isin(*labels), score) for labels, score in GROWTH_POTENTIAL],
                       GROWTH_POTENTIAL_DEFAULT)


ANALYSIS_COLUMNS = [
    "customer_id", "total_orders", "total_spent", "avg_order_value", "last_order_date",
    "first_order_date", "total_quantity", "unique_products_purchased", "recency_days", "frequency",
    "monetary", "recency_score", "frequency_score", "monetary_score", "rfm_score", "customer_segment",
    "value_tier", "purchase_behavior", "estimated_clv", "customer_age_days", "monthly_purchase_frequency",
]


def customer_analysis(ss: DataFrame, as_of=None, with_timestamp: bool = False) -> DataFrame:
    """BX-08: the full customer analysis chain, biggest spenders first."""
    seg = customer_segments(rfm_scores(customer_order_metrics(ss, as_of), as_of))
    out = customer_clv(seg, as_of).select(*ANALYSIS_COLUMNS)
    out = out.withColumns({"activity_status": activity_status(),
                           "growth_potential_score": growth_potential()})
    if with_timestamp:
        out = out.withColumn("analysis_timestamp", F.current_timestamp())
    return out.orderBy(F.col("total_spent").desc(), F.col("last_order_date").desc(), F.col("customer_id"))
