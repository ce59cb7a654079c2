"""Registered source / sink queries (SC-03..10, SK-01..08, SO-03).

Sink queries write a table derived from the given tables into a fresh
folder under the shared checkpoint directory and return what a reader of
that table sees, so the check covers the write path and the read path.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..operators import customers as C
from ..operators import features as FE
from ..operators import sales as S
from ..operators import quality as Q
from ..operators.quality import dataset_report
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import readers as R
from ..sources import tables as T
from .catalog import register
from .customer_queries import ANALYSIS_SQL
from .sales_queries import SUMMARY_SQL, _INSIGHT_DOUBLES
from .feature_queries import CM_CTE, NORM_CTE
from .sqltext import CUSTOMER_ORDERS, METRICS_EVENTS, SALES_AS_OF, STAGING_SALES, rnd

LAST_RUN = "2001-07-01"


@register("src_sales_recent", ids=("SC-05", "PF-02"), doubles=["order_value", "discount"], sql=f"""
WITH {STAGING_SALES}
SELECT order_id, customer_id, product_id, order_date, order_value, quantity, discount, status
FROM staging_sales WHERE order_date >= DATE '{SALES_AS_OF}' - INTERVAL '30 days'""")
def q_src_sales_recent(spark, sf_dir):
    """Sales source query: 8 columns of the last 30 days."""
    from ..functions import dates as D
    ss = T.staging_sales(spark, sf_dir)
    return ss.filter(D.since("order_date", SALES_AS_OF, 30, "days"))


@register("src_customers", ids=("SC-06",), sql="""
SELECT c_custkey AS customer_id, c_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
       CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS address,
       CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip_code,
       CAST(NULL AS TIMESTAMP) AS registration_date, c_mktsegment AS customer_segment
FROM customer""")
def q_src_customers(spark, sf_dir):
    return T.customers(spark, sf_dir)


@register("src_products", ids=("SC-07",), doubles=["price", "cost"], sql="""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_size AS VARCHAR) AS subcategory, p_retailprice AS price, CAST(NULL AS DOUBLE) AS cost,
       p_brand AS brand, CAST(NULL AS BIGINT) AS supplier_id, CAST(NULL AS TIMESTAMP) AS created_date
FROM part""")
def q_src_products(spark, sf_dir):
    return T.products(spark, sf_dir)


@register("src_incremental", ids=("SC-03",), doubles=["o_totalprice"], sql=f"""
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{LAST_RUN} 00:00:00'""")
def q_src_incremental(spark, sf_dir):
    """Rows strictly newer than the last run (filter pushed into the scan)."""
    return R.incremental(T.read(spark, sf_dir, "orders"), "o_orderdate", LAST_RUN)


@register("src_chunked", ids=("SC-04", "D8"), doubles=["o_totalprice"], sql="SELECT * FROM orders")
def q_src_chunked(spark, sf_dir):
    """Whole table in key-range chunks: no row skipped or repeated."""
    return R.chunked(T.read(spark, sf_dir, "orders"), "o_orderkey", 8)


@register("page_rows", ids=("SO-03",), doubles=["o_totalprice"], sql="""
SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000 OFFSET 10000""")
def q_page_rows(spark, sf_dir):
    """Second page of 10,000 rows in key order (paging is the feature)."""
    return R.page(T.read(spark, sf_dir, "orders"), "o_orderkey", 10000, 10000)


@register("page_after_key", ids=("SO-03",), doubles=["o_totalprice"], sql="""
SELECT * FROM orders WHERE o_orderkey > 7000 ORDER BY o_orderkey LIMIT 5000""")
def q_page_after_key(spark, sf_dir):
    """The 5,000 orders after key 7,000 (paging is the feature)."""
    return R.page_after(T.read(spark, sf_dir, "orders"), "o_orderkey", 7000, 5000)


@register("src_csv", ids=("SC-09", "AG-19"), doubles=["c_acctbal"], sql="SELECT * FROM customer")
def q_src_csv(spark, sf_dir):
    """Customer table landed as CSV with a header, read back with its schema."""
    src = T.read(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv-customer")
    src.write.option("header", "true").csv(path)
    return R.load_csv(spark, path, src.schema)


CUSTOMER_RULES = {"not_null": ["c_custkey"], "range": {"c_acctbal": (-900, 9900)}}


def _bad_customer_lines(spark, sf_dir):
    """Customers landed as CSV, in which some lines are cut off, have a word for the balance, or a field too many."""
    src = T.read(spark, sf_dir, "customer")
    path, key = scratch_path(spark, "csv-bad-lines"), F.col("c_custkey")
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.col(c).cast("string"), '"', '\\\\"'), F.lit('"'))
    fields = [F.when((key % 41 == 0) & F.lit(c == "c_acctbal"), F.lit("unknown")).otherwise(quoted(c)) for c in src.columns]
    whole = F.concat_ws(",", *fields)
    line = F.when(key % 37 == 0, F.concat(key.cast("string"), F.lit(',"cut'))).when(key % 43 == 0, F.concat(whole, F.lit(',"more"'))).otherwise(whole)
    src.select(line.alias("value")).write.text(path)
    return Q.split_valid(R.load_csv(spark, path, src.schema, header=False, corrupt=Q.CORRUPT), CUSTOMER_RULES)


@register("src_csv_valid", ids=("SC-09", "VQ-04"), doubles=["c_acctbal"], sql="""
SELECT * FROM customer WHERE c_custkey % 37 <> 0 AND c_custkey % 41 <> 0 AND c_custkey % 43 <> 0 AND c_acctbal BETWEEN -900 AND 9900""")
def q_src_csv_valid(spark, sf_dir):
    """Lines of a CSV landing that can be read and keep the rules."""
    return _bad_customer_lines(spark, sf_dir)[0]


@register("src_csv_quarantine", ids=("SC-09", "VQ-04"), sql="""
SELECT c_custkey, CASE WHEN c_custkey % 37 = 0 OR c_custkey % 41 = 0 OR c_custkey % 43 = 0 THEN 'malformed_record' ELSE 'range_c_acctbal' END AS dq_reasons,
       c_custkey % 37 = 0 AS cut_off
FROM customer WHERE c_custkey % 37 = 0 OR c_custkey % 41 = 0 OR c_custkey % 43 = 0 OR NOT c_acctbal BETWEEN -900 AND 9900""")
def q_src_csv_quarantine(spark, sf_dir):
    """The other lines, with the reason; a malformed one by the key and the end found in its text."""
    _, bad = _bad_customer_lines(spark, sf_dir)
    text = F.col(Q.CORRUPT)
    key = F.coalesce(F.regexp_extract(text, r'^"?(\d+)', 1).cast("bigint"), "c_custkey")
    return bad.select(key.alias("c_custkey"), "dq_reasons", F.coalesce(F.endswith(text, F.lit('"cut')), F.lit(False)).alias("cut_off"))


EVENT_SCHEMA = T_.StructType([
    T_.StructField("event_id", T_.LongType()), T_.StructField("ts", T_.TimestampNTZType()),
    T_.StructField("user_id", T_.LongType()), T_.StructField("event_type", T_.StringType()),
    T_.StructField("value", T_.DoubleType()), T_.StructField("props", T_.StringType()),
    T_.StructField("_corrupt_record", T_.StringType())])


@register("src_json_landed", ids=("SC-08",), doubles=["value"], sql="SELECT * FROM events")
def q_src_json_landed(spark, sf_dir):
    """Events landed as JSON lines, read back whole."""
    src = T.read(spark, sf_dir, "events")
    path = scratch_path(spark, "json-events")
    src.write.option("timestampNTZFormat", R.JSON_TS_FORMAT).json(path)
    return R.load_json_landed(spark, path, EVENT_SCHEMA).drop("_corrupt_record")


@register("src_json_quarantine", ids=("SC-08", "VQ-04"), sql="""
SELECT event_id, 'malformed_record' AS dq_reasons, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY event_id
UNION ALL SELECT event_id, 'range_value', COUNT(*) FROM events WHERE NOT value BETWEEN 0 AND 400 GROUP BY event_id""")
def q_src_json_quarantine(spark, sf_dir):
    """Events landed as JSON lines, each error event also cut off half-way: what is quarantined, counted by event."""
    path = scratch_path(spark, "json-bad-lines")
    messages = T.read(spark, sf_dir, "events").select("event_type", F.to_json(F.struct("*"), {"timestampNTZFormat": R.JSON_TS_FORMAT}).alias("value"))
    broken = messages.filter("event_type = 'error'").select(F.expr("substring(value, 1, length(value) div 2)").alias("value"))
    messages.select("value").unionByName(broken).write.text(path)
    _, bad = Q.split_valid(R.load_json_landed(spark, path, EVENT_SCHEMA), {"not_null": ["event_id"], "range": {"value": (0, 400)}})
    event = F.coalesce("event_id", F.regexp_extract(Q.CORRUPT, r'"event_id":(\d+)', 1).cast("bigint"))
    return bad.groupBy(event.alias("event_id"), "dq_reasons").agg(F.count("*").alias("n"))


@register("dataset_report", ids=("AG-19",), sql="""
SELECT COUNT(*) AS total_records,
       ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'] AS columns,
       TIMESTAMP '2001-08-02 00:00:00' AS generated_at
FROM orders""")
def q_dataset_report(spark, sf_dir):
    """Row count, column list and generation time (pinned here) of a loaded table."""
    return dataset_report(T.read(spark, sf_dir, "orders"), _dt.datetime(2001, 8, 2))


@register("sink_partitioned_month", ids=("SK-02",), doubles=["metric_value"], sql=f"""
WITH {METRICS_EVENTS}
SELECT id, metric_name, metric_value, category, subcategory, metadata, created_at, updated_at,
       strftime(created_at, '%Y-%m') AS created_month
FROM metrics_events""")
def q_sink_partitioned_month(spark, sf_dir):
    """Metric table written by month partition, all rows read back."""
    path = scratch_path(spark, "metrics-by-month")
    W.write_month_partitioned(T.metrics_events(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("read_month_range", ids=("SK-02",), doubles=["metric_value"], sql=f"""
WITH {METRICS_EVENTS}
SELECT *, strftime(created_at, '%Y-%m') AS created_month FROM metrics_events
WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""")
def q_read_month_range(spark, sf_dir):
    """A range of two weeks, the feature of the read side: only its month is listed and scanned."""
    path = scratch_path(spark, "metrics-by-month")
    W.write_month_partitioned(T.metrics_events(spark, sf_dir), path)
    return W.read_month_range(spark, path, _dt.date(2024, 1, 8), _dt.date(2024, 1, 22))


@register("load_fact_sales", ids=("SK-05",), doubles=["order_value", "discount"], sql=f"""
WITH {STAGING_SALES}
SELECT *, strftime(order_date, '%Y-%m') AS order_month FROM staging_sales""")
def q_load_fact_sales(spark, sf_dir):
    """fact_sales load (dynamic month partitions), read back."""
    path = scratch_path(spark, "fact-sales")
    W.load_fact_sales(T.staging_sales(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("load_dim_customers", ids=("SK-06",), sql="""
WITH sightings AS (
    SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS customer_segment, o_orderdate AS registration_date,
           o_orderkey AS order_key, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k
    FROM customer JOIN orders ON o_custkey = c_custkey
)
SELECT customer_id, first_name, customer_segment, registration_date, order_key FROM sightings WHERE k = 1""")
def q_load_dim_customers(spark, sf_dir):
    """dim_customers from several versions of a customer (one an order): the newest by date, then by order, wins."""
    c = T.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = T.read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    versions = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("customer_segment"),
        F.col("o_orderdate").alias("registration_date"), F.col("o_orderkey").alias("order_key"))
    path = scratch_path(spark, "dim-customers")
    W.load_dimension(versions, ["customer_id"], ["registration_date", "order_key"], path)
    return spark.read.parquet(path)


@register("load_dim_products", ids=("SK-06",), doubles=["price"], sql="""
WITH versions AS (
    SELECT l.l_partkey AS product_id, p.p_name AS product_name, p.p_type AS category, p.p_brand AS brand,
           p.p_retailprice AS price, l.l_shipdate AS seen_at, l.l_orderkey AS order_key,
           l.l_linenumber AS line_number
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)
SELECT product_id, arg_max(product_name, (seen_at, order_key, line_number)) AS product_name,
       arg_max(category, (seen_at, order_key, line_number)) AS category,
       arg_max(brand, (seen_at, order_key, line_number)) AS brand,
       arg_max(price, (seen_at, order_key, line_number)) AS price,
       MAX(seen_at) AS seen_at, arg_max(order_key, (seen_at, order_key, line_number)) AS order_key,
       arg_max(line_number, (seen_at, order_key, line_number)) AS line_number
FROM versions GROUP BY product_id""")
def q_load_dim_products(spark, sf_dir):
    """dim_products from product sightings in line items: newest sighting per product wins."""
    li = T.read(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber")
    p = T.read(spark, sf_dir, "part")
    versions = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"), F.col("l_shipdate").alias("seen_at"),
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"))
    path = scratch_path(spark, "dim-products")
    W.load_dimension(versions, ["product_id"], ["seen_at", "order_key", "line_number"], path)
    return spark.read.parquet(path)


@register("load_daily_reports", ids=("SK-07",), doubles=_INSIGHT_DOUBLES, sql=f"""
SELECT *, strftime(sales_date, '%Y-%m-%d') AS report_date FROM ({SUMMARY_SQL}) AS s""")
def q_load_daily_reports(spark, sf_dir):
    """daily_reports load (dynamic day partitions), read back."""
    path = scratch_path(spark, "daily-reports")
    summary = S.sales_summary(T.staging_sales(spark, sf_dir), SALES_AS_OF)
    W.load_daily_reports(summary, path)
    return W.read_daily_reports(spark, path, summary.schema)


def _money(c: str) -> str:
    return f"'$' || format('{{:,.2f}}', {rnd(c, 2)})"


def _pct(c: str) -> str:
    return f"format('{{:,.2f}}', {rnd(c, 2)}) || '%'"


@register("report_daily_sales", ids=("SK-08",), sql=f"""
SELECT strftime(sales_date, '%Y-%m-%d') AS sales_date, total_orders,
       {_money('total_revenue')} AS total_revenue, {_money('avg_order_value')} AS avg_order_value,
       {_money('net_revenue')} AS net_revenue, unique_customers,
       {_pct('completion_rate')} AS completion_rate, {_pct('high_value_rate')} AS high_value_rate,
       revenue_performance, performance_score
FROM ({SUMMARY_SQL}) AS s""")
def q_report_daily_sales(spark, sf_dir):
    return W.daily_sales_report(S.sales_summary(T.staging_sales(spark, sf_dir), SALES_AS_OF))


@register("report_customer_analysis", ids=("SK-08",), sql=f"""
SELECT customer_id, customer_segment, value_tier, total_orders,
       {_money('total_spent')} AS total_spent, {_money('estimated_clv')} AS estimated_clv,
       strftime(last_order_date, '%Y-%m-%d') AS last_order_date, activity_status
FROM ({ANALYSIS_SQL}) AS a""")
def q_report_customer_analysis(spark, sf_dir):
    return W.customer_analysis_report(C.customer_analysis(T.staging_sales(spark, sf_dir), SALES_AS_OF))


@register("sink_ml_features", ids=("SK-01", "SK-03"), doubles=["feature_value"], sql=f"""
WITH {CUSTOMER_ORDERS},{CM_CTE},{NORM_CTE}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, feature_name, CAST(CAST(feature_value AS DECIMAL(15, 6)) AS DOUBLE) AS feature_value,
       'numerical' AS feature_type, TIMESTAMP '2001-08-02 00:00:00' AS created_at
FROM (UNPIVOT (SELECT customer_id, recency_zscore, frequency_zscore, monetary_zscore FROM standard)
      ON recency_zscore, frequency_zscore, monetary_zscore INTO NAME feature_name VALUE feature_value)""")
def q_sink_ml_features(spark, sf_dir):
    """Feature rows appended to the typed ml_features table (created if missing), read back without the surrogate key."""
    path = scratch_path(spark, "ml-features")
    name = "ml_features_" + path.rsplit("-", 1)[-1]
    W.create_typed_table(spark, W.ML_FEATURES_DDL, name=name, location=path)
    W.append_features(FE.ml_features(T.customer_orders(spark, sf_dir), SALES_AS_OF), name,
                      _dt.datetime(2001, 8, 2))
    return spark.table(name).drop("id").withColumn("feature_value", F.col("feature_value").cast("double"))


