"""Logical tables of the analytics model, built from the shared parquet tables.

The reference reads PostgreSQL tables (``staging_sales``, ``customers``,
``products``, ``customer_orders``, ``analytics_data``...).  Here each one is
a lazy DataFrame over the TPC-H-like parquet tables; column mappings are the
adapters documented in FIXTURES.md.  Everything stays lazy: projections and
date predicates written downstream are pushed by Catalyst into the scans.

Scale note: ``staging_sales`` and ``customer_orders`` are the only joins in
the repository.  ``lineitem`` joins ``orders`` on the order key (sort-merge,
both sides hash-partitioned on the key).  When a downstream lookback filter
shrinks ``orders`` below the broadcast threshold, AQE switches to a
broadcast hash join at runtime after measuring the filtered size, so the
big side is never shuffled for short windows.  ``part`` joins on part key
the same way.  In production these would be materialised staging tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ts_literal

# Fixed values (FIXTURES.md): order status letters to the reference's status names.
STATUS_NAMES = {"F": "completed", "O": "pending", "P": "cancelled"}
# Fixed values (FIXTURES.md): price scale so spend lands in the reference's score bands.
SALES_PRICE_SCALE = 0.02
ML_PRICE_SCALE = 0.002
# Fixed values (FIXTURES.md): event type to metric category.
EVENT_CATEGORY = {"purchase": "Financial", "view": "Traffic", "signup": "Marketing"}
EVENT_CATEGORY_DEFAULT = "User Behavior"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _status(col: str):
    expr = None
    for letter, name in STATUS_NAMES.items():
        expr = F.when(F.col(col) == letter, name) if expr is None else expr.when(F.col(col) == letter, name)
    return expr


def staging_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``staging_sales``: one row per line item, with its order's header fields."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                "l_extendedprice", "l_discount")
    od = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    value = F.col("l_extendedprice") * F.lit(SALES_PRICE_SCALE)
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("o_orderdate").alias("order_date"),
                    value.alias("order_value"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    (value * F.col("l_discount")).alias("discount"),
                    _status("o_orderstatus").alias("status")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers`` source projection (contact columns absent in the test data)."""
    c = read(spark, sf_dir, "customer")
    null_s = F.lit(None).cast("string")
    return c.select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("first_name"),
                    null_s.alias("last_name"), null_s.alias("email"), null_s.alias("phone"),
                    null_s.alias("address"), null_s.alias("city"), null_s.alias("state"),
                    null_s.alias("zip_code"),
                    F.lit(None).cast("timestamp_ntz").alias("registration_date"),
                    F.col("c_mktsegment").alias("customer_segment"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``products`` source projection."""
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    F.col("p_size").cast("string").alias("subcategory"),
                    F.col("p_retailprice").alias("price"),
                    F.lit(None).cast("double").alias("cost"),
                    F.col("p_brand").alias("brand"),
                    F.lit(None).cast("bigint").alias("supplier_id"),
                    F.lit(None).cast("timestamp_ntz").alias("created_date"))


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML input ``customer_orders`` at line-item grain, with product category."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    od = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    pt = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
         .join(pt, F.col("l_partkey") == pt.p_partkey, "inner"))
    return j.select(F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderdate").alias("order_date"),
                    ((F.col("o_orderkey") * 7919) % 86400).alias("order_time"),
                    (F.col("l_extendedprice") * F.lit(ML_PRICE_SCALE)).alias("order_value"),
                    F.col("p_type").alias("product_category"),
                    F.col("o_orderpriority").alias("payment_method"))


def event_category(col: str = "event_type"):
    expr = None
    for et, cat in EVENT_CATEGORY.items():
        expr = F.when(F.col(col) == et, cat) if expr is None else expr.when(F.col(col) == et, cat)
    return expr.otherwise(EVENT_CATEGORY_DEFAULT)


def metrics_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``analytics_data_partitioned`` shape from ``events`` (unique ``ts``: total window order)."""
    e = read(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"),
                    F.col("event_type").alias("metric_name"),
                    F.col("value").alias("metric_value"),
                    event_category().alias("category"),
                    F.col("event_type").alias("subcategory"),
                    F.col("props").alias("metadata"),
                    F.col("ts").alias("created_at"),
                    F.col("ts").alias("updated_at"))


def metrics_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows from ``orders`` for monthly trends (many ties on category and date)."""
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    F.lit("order_value").alias("metric_name"),
                    (F.col("o_totalprice") / 100).alias("metric_value"),
                    F.col("o_orderpriority").alias("category"),
                    F.col("o_orderstatus").alias("subcategory"),
                    F.col("o_orderdate").alias("created_at"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events")


def staging_sales_raw(spark: SparkSession, sf_dir: str, first_day: _dt.date | None = None, undated_after: int | None = None) -> DataFrame:
    """``staging_sales`` as landed text, before validation, with defects by the order key.

    Every column is a string (as read from a CSV / API landing zone).  ``order_value`` is the unscaled
    line price; some orders lack a key, or have words, fractions or zeros where numbers and dates belong,
    so every rule has violations to find.  The bounds are those of :func:`recent`.
    """
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                "l_extendedprice", "l_discount")
    od = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    od = recent(od, "o_orderdate", "o_orderkey", first_day, undated_after)
    s = lambda c: F.col(c).cast("string")
    hit = lambda n: F.col("o_orderkey") % n == 0
    quantity = F.col("l_quantity").cast("int").cast("string")
    # A date becomes text once an order, before the join, not once a line: no other field takes as long.
    od = od.withColumn("order_date", F.when(hit(71), F.lit("unknown")).otherwise(s("o_orderdate"))).drop("o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
            .select(F.when(~hit(89), s("o_orderkey")).alias("order_id"),
                    F.when(~hit(97), s("o_custkey")).alias("customer_id"),
                    F.when(~hit(83), s("l_partkey")).alias("product_id"),
                    "order_date",
                    F.when(hit(79), F.lit("n/a")).otherwise(s("l_extendedprice")).alias("order_value"),
                    F.when(hit(73), F.lit("two")).when(hit(67), F.lit("0")).when(hit(61), F.concat(quantity, F.lit(".5")))
                    .otherwise(quantity).alias("quantity"),
                    s("l_discount").alias("discount"),
                    _status("o_orderstatus").alias("status")))


#: Columns of the sales source and their types once validated.
SALES_TYPES = {"order_id": "bigint", "customer_id": "bigint", "product_id": "bigint", "order_date": "timestamp_ntz",
               "order_value": "double", "quantity": "int", "discount": "double", "status": "string"}


def staging_sales_text(spark: SparkSession, sf_dir: str, first_day: _dt.date | None = None, undated_after: int | None = None) -> DataFrame:
    """:func:`staging_sales` as the source lands it: every column text, not yet validated; bounds as for :func:`recent`."""
    ss = recent(staging_sales(spark, sf_dir), "order_date", "order_id", first_day, undated_after)
    return ss.select(*[F.col(c).cast("string").alias(c) for c in ss.columns])


def recent(rows: DataFrame, date: str, key: str, first_day: _dt.date | None, undated_after: int | None) -> DataFrame:
    """Rows from ``first_day`` on (None: all), and those without a date whose ``key`` is above ``undated_after``.

    Both are predicates on source columns, so they reach the scan."""
    if first_day is None:
        return rows
    undated = F.col(date).isNull() & (F.lit(True) if undated_after is None else F.col(key) > F.lit(undated_after))
    return rows.filter((F.col(date) >= ts_literal(first_day)) | undated)


def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML training frame from ``lineitem``: quantity, discount, tax and a planted target.

    ``target = 100 * quantity - 500 * discount + noise`` with noise in
    [-5, 5] from a hash of the row key, so a model has a known signal and an
    R2 floor.
    """
    li = read(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    noise = (F.conv(F.substring(F.md5(key), 9, 4), 16, 10).cast("bigint").cast("double") / F.lit(65535.0)
             - F.lit(0.5)) * F.lit(10.0)
    return li.select(key.alias("row_key"),
                     F.col("l_quantity").alias("quantity"),
                     F.col("l_discount").alias("discount"),
                     F.col("l_tax").alias("tax"),
                     (F.lit(100.0) * F.col("l_quantity") - F.lit(500.0) * F.col("l_discount") + noise).alias("target"))
