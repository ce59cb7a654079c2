"""ML feature build: customer metrics, z-scores, categories, long feature table, RFM variant.

Input is ``customer_orders`` (line-item grain with order id, date, time of
day, value, product category and payment method).

Plan shape.  ``customer_metrics`` is one aggregate.  Its only DISTINCT is that of the orders, which Spark plans
as a partial aggregate on ``(customer, order)`` before the one on the customer; months, categories and
payment methods are few values each and are merged as sets.  The z-scores need global mean and stddev: they are
one-row aggregates used as scalar subqueries (Spark merges them into one
job and ships the scalars), never an ``OVER ()`` window that would pull all
customers into one task, and never a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numeric import int_div
from ..functions.rules import first_match
from . import customers as C

# Category labels of the feature script.
RECENCY_CATEGORIES = [(30, "Recent"), (90, "Moderate"), (180, "Distant")]
RECENCY_CATEGORY_DEFAULT = "Very_Distant"
FREQUENCY_CATEGORIES = [(20, "High_Frequency"), (10, "Medium_Frequency"), (5, "Low_Frequency")]
FREQUENCY_CATEGORY_DEFAULT = "Very_Low_Frequency"
VALUE_CATEGORIES = [(1000, "High_Value"), (500, "Medium_Value"), (100, "Low_Value")]
VALUE_CATEGORY_DEFAULT = "Very_Low_Value"
ZSCORE_FEATURES = [("recency_zscore", "days_since_last_order"),
                   ("frequency_zscore", "total_orders"),
                   ("monetary_zscore", "total_spent")]
FEATURE_TYPE = "numerical"


def _set_size(col):
    return F.size(F.collect_set(col)).cast("bigint")


def customer_metrics(orders: DataFrame, as_of=None, years: int = 2) -> DataFrame:
    """AG-08: per-customer recency, frequency, monetary, behavioural and temporal features."""
    month = D.trunc_ts("month", "order_date")
    n_orders = F.count_distinct("order_id")
    # Months, categories and payments come from small domains: sets of them merge in the aggregate, so
    # order_id is its only DISTINCT and no line is copied.
    n_months = _set_size(month)
    spent = F.sum("order_value")
    agg = (orders.filter(D.since("order_date", as_of, years, "years"))
           .groupBy("customer_id")
           .agg(F.max("order_date").alias("_last"),
                F.min("order_date").alias("_first"),
                n_orders.alias("total_orders"),
                n_months.alias("active_months"),
                spent.alias("total_spent"),
                F.avg("order_value").alias("avg_order_value"),
                F.max("order_value").alias("max_order_value"),
                _set_size("product_category").alias("unique_categories"),
                _set_size("payment_method").alias("payment_methods_used"),
                F.floor(F.avg("order_time") / 3600).cast("int").alias("avg_order_hour"),
                F.count(F.when(D.is_weekend("order_date"), 1)).alias("weekend_orders"),
                F.when(n_orders > 0, spent / n_orders).otherwise(F.lit(0.0)).alias("revenue_per_order"),
                F.when(n_months > 0, int_div(n_orders, n_months)).otherwise(F.lit(0).cast("bigint"))
                .alias("orders_per_month")))
    return agg.select("customer_id",
                      D.whole_days(as_of, "_last").alias("days_since_last_order"),
                      D.whole_days(as_of, "_first").alias("customer_age_days"),
                      "total_orders", "active_months", "total_spent", "avg_order_value", "max_order_value",
                      "unique_categories", "payment_methods_used", "avg_order_hour", "weekend_orders",
                      "revenue_per_order", "orders_per_month")


def zscores(cm: DataFrame, features=ZSCORE_FEATURES) -> DataFrame:
    """WN-07: ``(x - mean(x)) / stddev_samp(x)`` over all customers; NULL when stddev is 0 or NULL.

    Lazy: means and deviations are scalar subqueries, merged by Spark into one aggregate.
    """
    stats = cm.agg(*[F.avg(src).alias(f"m_{name}") for name, src in features],
                   *[F.stddev_samp(src).alias(f"s_{name}") for name, src in features])
    cols = {}
    for name, src in features:
        mean = stats.select(f"m_{name}").scalar()
        sd = stats.select(f"s_{name}").scalar()
        cols[name] = F.try_divide(F.col(src) - mean, F.nullif(sd, F.lit(0.0)))
    return cm.withColumns(cols)


def feature_categories(cm: DataFrame) -> DataFrame:
    """PF-06: recency, frequency and value categories (first match wins)."""
    d, o, s = F.col("days_since_last_order"), F.col("total_orders"), F.col("total_spent")
    return cm.withColumns({
        "recency_category": first_match([(d <= c, lab) for c, lab in RECENCY_CATEGORIES], RECENCY_CATEGORY_DEFAULT),
        "frequency_category": first_match([(o >= c, lab) for c, lab in FREQUENCY_CATEGORIES],
                                          FREQUENCY_CATEGORY_DEFAULT),
        "value_category": first_match([(s >= c, lab) for c, lab in VALUE_CATEGORIES], VALUE_CATEGORY_DEFAULT),
    })


def feature_normalization(cm: DataFrame) -> DataFrame:
    """The reference's ``feature_normalization`` step: z-scores and categories per customer."""
    out = feature_categories(zscores(cm))
    return out.select("customer_id", *[n for n, _ in ZSCORE_FEATURES],
                      "recency_category", "frequency_category", "value_category")


def features_long(norm: DataFrame) -> DataFrame:
    """SE-01 / SE-02 / PF-05: wide z-scores to ``(customer_id, feature_name, feature_value, feature_type)``.

    One ``unpivot`` over one scan replaces the reference's three-way
    ``UNION ALL``; NULL z-scores are dropped as its ``IS NOT NULL`` filters do.
    ``customer_id`` becomes text, as the target column is VARCHAR.
    """
    names = [n for n, _ in ZSCORE_FEATURES]
    long = norm.select(F.col("customer_id").cast("string").alias("customer_id"), *names) \
               .unpivot(["customer_id"], names, "feature_name", "feature_value")
    return long.filter(F.col("feature_value").isNotNull()).withColumn("feature_type", F.lit(FEATURE_TYPE))


def ml_features(orders: DataFrame, as_of=None) -> DataFrame:
    """BX-13: metrics, z-scores, categories and the long feature table."""
    return features_long(feature_normalization(customer_metrics(orders, as_of)))


def ml_rfm(cm: DataFrame) -> DataFrame:
    """BX-02 / BX-04: RFM scores with the ML money cuts and the ML segment rules."""
    out = cm.select("customer_id",
                    C.recency_score("days_since_last_order").alias("recency_score"),
                    C.frequency_score("total_orders").alias("frequency_score"),
                    C.monetary_score("total_spent", C.MONETARY_CUTS_ML).alias("monetary_score"))
    return out.withColumns({"rfm_string": C.rfm_code(),
                            "customer_segment": C.rfm_segment(C.ML_SEGMENTS)})


def ml_rfm_segments(cm: DataFrame) -> DataFrame:
    """AG-18: customers and mean scores per ML segment, largest first."""
    return (ml_rfm(cm).groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.avg("recency_score").alias("avg_recency"),
                 F.avg("frequency_score").alias("avg_frequency"),
                 F.avg("monetary_score").alias("avg_monetary"))
            .orderBy(F.col("customer_count").desc(), F.col("customer_segment")))
