"""Registered validation queries (VQ-01..07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import quality as Q
from ..session import scratch_path
from ..sources import tables as T
from .catalog import register
from .etl import daily_etl
from .sqltext import CUSTOMER_ORDERS, SALES_AS_OF
from .feature_queries import CM_CTE, NORM_CTE

RAW_SALES = """
raw_sales AS (
    SELECT if(o.o_orderkey % 89 <> 0, CAST(o.o_orderkey AS VARCHAR), NULL) AS order_id,
           if(o.o_orderkey % 97 <> 0, CAST(o.o_custkey AS VARCHAR), NULL) AS customer_id,
           if(o.o_orderkey % 83 <> 0, CAST(l.l_partkey AS VARCHAR), NULL) AS product_id,
           if(o.o_orderkey % 71 = 0, 'unknown', CAST(o.o_orderdate AS VARCHAR)) AS order_date,
           if(o.o_orderkey % 79 = 0, 'n/a', CAST(l.l_extendedprice AS VARCHAR)) AS order_value,
           CASE WHEN o.o_orderkey % 73 = 0 THEN 'two' WHEN o.o_orderkey % 67 = 0 THEN '0'
                WHEN o.o_orderkey % 61 = 0 THEN CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) || '.5'
                ELSE CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) END AS quantity,
           CAST(l.l_discount AS VARCHAR) AS discount,
           CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                                WHEN 'P' THEN 'cancelled' END AS status
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

CHECKED = """
checked AS (
    SELECT *,
           concat_ws(',',
               CASE WHEN customer_id IS NULL THEN 'null_customer_id' END,
               CASE WHEN order_id IS NULL THEN 'null_order_id' END,
               CASE WHEN product_id IS NULL THEN 'null_product_id' END,
               CASE WHEN order_value IS NOT NULL AND TRY_CAST(order_value AS DOUBLE) IS NULL THEN 'type_order_value' END,
               CASE WHEN quantity IS NOT NULL AND TRY_CAST(if(contains(quantity, '.'), NULL, quantity) AS BIGINT) IS NULL THEN 'type_quantity' END,
               CASE WHEN order_date IS NOT NULL AND TRY_CAST(order_date AS TIMESTAMP) IS NULL THEN 'type_order_date' END,
               CASE WHEN TRY_CAST(order_value AS DOUBLE) IS NOT NULL
                     AND NOT (TRY_CAST(order_value AS DOUBLE) BETWEEN 0 AND 100000) THEN 'range_order_value' END,
               CASE WHEN TRY_CAST(if(contains(quantity, '.'), NULL, quantity) AS BIGINT) IS NOT NULL
                     AND NOT (TRY_CAST(if(contains(quantity, '.'), NULL, quantity) AS BIGINT) BETWEEN 1 AND 1000) THEN 'range_quantity' END
           ) AS dq_reasons
    FROM raw_sales
)"""


def _raw(spark, sf_dir):
    return T.staging_sales_raw(spark, sf_dir)


@register("dq_not_null", ids=("VQ-01",), sql=f"""
WITH {RAW_SALES}
SELECT 'customer_id' AS column_name, COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_count FROM raw_sales
UNION ALL SELECT 'order_id', COUNT(*) FILTER (WHERE order_id IS NULL) FROM raw_sales
UNION ALL SELECT 'product_id', COUNT(*) FILTER (WHERE product_id IS NULL) FROM raw_sales""")
def q_dq_not_null(spark, sf_dir):
    return Q.not_null_report(_raw(spark, sf_dir))


@register("dq_types", ids=("VQ-02",), sql=f"""
WITH {RAW_SALES}
SELECT 'order_value' AS column_name,
       COUNT(*) FILTER (WHERE order_value IS NOT NULL AND TRY_CAST(order_value AS DOUBLE) IS NULL) AS invalid_count,
       'numeric' AS expected_type FROM raw_sales
UNION ALL SELECT 'quantity', COUNT(*) FILTER (WHERE quantity IS NOT NULL AND TRY_CAST(if(contains(quantity, '.'), NULL, quantity) AS BIGINT) IS NULL),
       'integer' FROM raw_sales
UNION ALL SELECT 'order_date', COUNT(*) FILTER (WHERE order_date IS NOT NULL AND TRY_CAST(order_date AS TIMESTAMP) IS NULL),
       'datetime' FROM raw_sales""")
def q_dq_types(spark, sf_dir):
    return Q.type_report(_raw(spark, sf_dir))


@register("dq_range", ids=("VQ-03",), doubles=["min_value", "max_value"], sql=f"""
WITH {RAW_SALES}
SELECT 'order_value' AS column_name,
       COUNT(*) FILTER (WHERE TRY_CAST(order_value AS DOUBLE) IS NOT NULL
                          AND NOT (TRY_CAST(order_value AS DOUBLE) BETWEEN 0 AND 100000)) AS out_of_range_count,
       0.0::DOUBLE AS min_value, 100000.0::DOUBLE AS max_value FROM raw_sales
UNION ALL SELECT 'quantity',
       COUNT(*) FILTER (WHERE TRY_CAST(if(contains(quantity, '.'), NULL, quantity) AS BIGINT) IS NOT NULL
                          AND NOT (TRY_CAST(if(contains(quantity, '.'), NULL, quantity) AS BIGINT) BETWEEN 1 AND 1000)),
       1.0::DOUBLE, 1000.0::DOUBLE FROM raw_sales""")
def q_dq_range(spark, sf_dir):
    return Q.range_report(_raw(spark, sf_dir))


@register("dq_quarantine", ids=("VQ-04",), sql=f"""
WITH {RAW_SALES},{CHECKED}
SELECT order_id, customer_id, product_id, order_date, order_value, quantity, discount, status, dq_reasons
FROM checked WHERE dq_reasons <> ''""")
def q_dq_quarantine(spark, sf_dir):
    """Quarantined rows with the rules they break (the valid side is the complement)."""
    _, bad = Q.split_valid(_raw(spark, sf_dir))
    return bad


#: Two days on which the daily run is made, and the first day that the second one extracts.
RUNS, SECOND_EXTRACT = ("2001-08-02", "2001-08-03"), "2001-07-01"


def _two_runs(spark, sf_dir):
    """The daily run over the defective landing: everything, then the next day's extract."""
    root = scratch_path(spark, "warehouse")
    return [daily_etl(spark, sf_dir, root, day, extract=T.staging_sales_raw) for day in RUNS][-1]


@register("etl_fact_sales", ids=("SK-05", "SC-05"), doubles=["order_value", "discount"], sql=f"""
WITH {RAW_SALES},{CHECKED}
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, CAST(product_id AS BIGINT) AS product_id,
       CAST(order_date AS TIMESTAMP) AS order_date, CAST(order_value AS DOUBLE) AS order_value, CAST(quantity AS INTEGER) AS quantity,
       CAST(discount AS DOUBLE) AS discount, status, strftime(CAST(order_date AS TIMESTAMP), '%Y-%m') AS order_month
FROM checked WHERE dq_reasons = ''""")
def q_etl_fact_sales(spark, sf_dir):
    """fact_sales after two daily runs: every valid row once."""
    return _two_runs(spark, sf_dir).read("fact_sales")


@register("etl_quarantine", ids=("VQ-04", "SC-05"), sql=f"""
WITH {RAW_SALES.replace("SELECT if(", "SELECT o.o_orderdate AS sold, if(", 1)},{CHECKED},
rejected AS (SELECT * EXCLUDE (sold), sold FROM checked WHERE dq_reasons <> '')
SELECT * EXCLUDE (sold), '{RUNS[0]}' AS run_date FROM rejected
UNION ALL SELECT * EXCLUDE (sold), '{RUNS[1]}' FROM rejected WHERE sold >= TIMESTAMP '{SECOND_EXTRACT}'""")
def q_etl_quarantine(spark, sf_dir):
    """Rows that two daily runs rejected, with their reasons: the second looks at its extract only."""
    return _two_runs(spark, sf_dir).quarantine()


@register("dq_score", ids=("VQ-05", "D5"), doubles=["quality_score"], sql=f"""
WITH {RAW_SALES},{CHECKED}
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE dq_reasons = '') AS valid_rows,
       COUNT(*) FILTER (WHERE dq_reasons <> '') AS quarantined_rows,
       AVG(CASE WHEN dq_reasons = '' THEN 1.0 ELSE 0.0 END)::DOUBLE AS quality_score
FROM checked""")
def q_dq_score(spark, sf_dir):
    return Q.quality_score(_raw(spark, sf_dir))


@register("dq_unique", ids=("VQ-06",), sql=f"""
WITH {CUSTOMER_ORDERS},{CM_CTE},{NORM_CTE},
names AS (
    SELECT CAST(customer_id AS VARCHAR) AS customer_id,
           unnest([if(recency_zscore IS NULL, NULL, 'recency_zscore'), if(frequency_zscore IS NULL, NULL, 'frequency_zscore'),
                   if(monetary_zscore IS NULL, NULL, 'monetary_zscore')]) AS feature_name
    FROM standard
)
SELECT customer_id, feature_name, COUNT(*) AS occurrences FROM names WHERE feature_name IS NOT NULL
GROUP BY customer_id, feature_name HAVING COUNT(*) > 1""")
def q_dq_unique(spark, sf_dir):
    """Uniqueness of (customer_id, feature_name) in one feature load (created_at is one value per load)."""
    long = FE.ml_features(T.customer_orders(spark, sf_dir), SALES_AS_OF)
    return Q.duplicate_keys(long, ["customer_id", "feature_name"])


@register("dq_duplicate_lines", ids=("VQ-06",), sql=f"""
WITH {RAW_SALES}
SELECT order_id, product_id, COUNT(*) AS occurrences FROM raw_sales
GROUP BY order_id, product_id HAVING COUNT(*) > 1""")
def q_dq_duplicate_lines(spark, sf_dir):
    """Order lines repeating the same product within an order."""
    return Q.duplicate_keys(_raw(spark, sf_dir), ["order_id", "product_id"])


@register("run_metrics", ids=("VQ-07",))
def q_run_metrics(spark, sf_dir):
    """Rows and throughput of one full pass over staging_sales (timing is not comparable)."""
    return Q.run_metrics(T.staging_sales(spark, sf_dir), "staging_sales")


@register("run_metrics_rows", ids=("VQ-07",), sql="""
SELECT 'lines' AS run, COUNT(*) AS rows, TRUE AS consistent FROM lineitem""")
def q_run_metrics_rows(spark, sf_dir):
    """What is comparable of a run's metrics: its rows, and that throughput is rows over duration."""
    found = Q.run_metrics(T.read(spark, sf_dir, "lineitem"), "lines")
    consistent = (F.col("duration_s") > 0) & (F.abs(F.col("rows_per_s") * F.col("duration_s") - F.col("rows")) < 1e-3 * F.col("rows"))
    return found.select("run", "rows", consistent.alias("consistent"))
