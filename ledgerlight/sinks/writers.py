"""Sinks: typed tables, feature appends, month partitions, facts, dimensions, reports.

All writes are idempotent or append-only so a failed job can be re-run:
facts and daily reports overwrite only the partitions they touch
(``partitionOverwriteMode=dynamic``); dimensions are rebuilt newest-row-per-key
and overwritten (Parquet tables reject MERGE).  The daily run replaces its tables
through ``versioned`` instead, so that readers see all of a run or nothing of it.  The reference's load batch
of 5,000 rows maps to JDBC ``batchsize`` when the target is a database.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numeric import round_half_away

# Fixed values from the reference's configuration.
LOAD_BATCH_SIZE = 5000
CURRENCY_PREFIX = "$"
DATE_PATTERN = "yyyy-MM-dd"
REPORT_FILE_PATTERNS = {"daily_sales_report": "daily_sales_report_{date}",
                        "customer_analysis_report": "customer_analysis_report_{date}"}

ML_FEATURES_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
    id BIGINT,
    customer_id VARCHAR(50) NOT NULL,
    feature_name VARCHAR(100) NOT NULL,
    feature_value DECIMAL(15,6),
    feature_type VARCHAR(50),
    created_at TIMESTAMP_NTZ DEFAULT CAST(current_timestamp() AS TIMESTAMP_NTZ)
) USING parquet LOCATION '{location}'"""


def create_or_replace_view(df: DataFrame, name: str) -> DataFrame:
    """SK-04: ``CREATE OR REPLACE VIEW name AS <plan>``; returns the view as a table."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_typed_table(spark: SparkSession, ddl: str, **fmt) -> None:
    """SK-03: ``CREATE TABLE IF NOT EXISTS`` from DDL text (idempotent)."""
    spark.sql(ddl.format(**fmt))


def append_features(long: DataFrame, table: str, created_at: _dt.datetime | None = None) -> None:
    """SK-01: append a long feature frame to the typed feature table.

    ``created_at`` defaults to the load time (the table's DEFAULT); ``id`` is
    a hash of the unique key, since Parquet tables have no identity column.
    Rows whose key (customer, feature, time) the table holds already are left
    out, so a failed load can be repeated with the same ``created_at``.
    """
    ts = D.ts_literal(created_at) if created_at else F.current_timestamp().cast("timestamp_ntz")
    out = long.select(
        F.xxhash64("customer_id", "feature_name", ts).alias("id"),
        F.col("customer_id").cast("varchar(50)").alias("customer_id"),
        F.col("feature_name").cast("varchar(100)").alias("feature_name"),
        F.col("feature_value").cast("decimal(15,6)").alias("feature_value"),
        F.col("feature_type").cast("varchar(50)").alias("feature_type"),
        ts.alias("created_at"))
    if created_at:
        held = long.sparkSession.table(table).filter(F.col("created_at") == ts).select("customer_id", "feature_name")
        out = out.join(held, ["customer_id", "feature_name"], "left_anti").select(out.columns)
    out.write.insertInto(table)


MONTH_PATTERN = "yyyy-MM"


def month_key(col: str):
    """Partition value of a month: ``'yyyy-MM'`` text (sorts like the month itself)."""
    return F.date_format(F.col(col), MONTH_PATTERN)


def month_of_day(col: str):
    """:func:`month_key` of a date column, put together from its numbers: a formatter takes several times as long."""
    year = F.year(col)
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(F.month(col).cast("string"), 2, "0"))
    return F.when(year.between(1, 9999), text).otherwise(month_key(col))


def write_month_partitioned(df: DataFrame, path: str, ts_col: str = "created_at",
                            part_col: str = "created_month", mode: str = "overwrite") -> None:
    """SK-02: range partitioning by month, as a derived ``created_month='yyyy-MM'`` directory column."""
    (df.withColumn(part_col, month_key(ts_col))
       .hint("rebalance", part_col)
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(part_col).parquet(path))


def read_month_range(spark: SparkSession, path: str, start: _dt.date, end: _dt.date,
                     ts_col: str = "created_at", part_col: str = "created_month") -> DataFrame:
    """SK-02 read side: rows with ``start <= ts < end``.

    Adds the matching predicate on the partition column so only the months
    concerned are listed and scanned (partition pruning), beside the row
    predicate that Parquet statistics push down.
    """
    df = spark.read.parquet(path)
    first, last = start.strftime("%Y-%m"), end.strftime("%Y-%m")
    return df.filter((F.col(part_col) >= F.lit(first)) & (F.col(part_col) <= F.lit(last))
                     & (F.col(ts_col) >= D.ts_literal(start)) & (F.col(ts_col) < D.ts_literal(end)))


def load_fact_sales(ss: DataFrame, path: str) -> None:
    """SK-05: fact_sales partitioned by order month; re-loading a month replaces only it.

    A ``rebalance`` hint on the month hashes rows to writers by month (a
    month lands in few, large files instead of one small file per input
    task) and lets AQE split a month holding a third of the data over many
    writers and merge small months -- without a sampling pass over the input.
    """
    (ss.withColumn("order_month", month_key("order_date"))
       .hint("rebalance", "order_month")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("order_month").parquet(path))


def newest_order(df: DataFrame, date_col: str) -> list[str]:
    """``date_col``, then all other columns in order of their names: a total order up to equal rows."""
    return [date_col, *sorted(c for c in df.columns if c != date_col)]


def newest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """SK-06 core: the newest row per key.

    ``max_by(struct(row), struct(order))`` is a mergeable aggregate, so a key
    with a huge number of versions is reduced map-side instead of being
    sorted in one task as a ``row_number()`` window would.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def load_dimension(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], path: str) -> None:
    """SK-06: rebuild a dimension (newest row per key) and overwrite it."""
    newest_per_key(df, keys, order_cols).write.mode("overwrite").parquet(path)


def load_daily_reports(summary: DataFrame, path: str) -> None:
    """SK-07: daily report rows partitioned by day (``report_date='yyyy-MM-dd'``);
    a re-run overwrites those days only."""
    (summary.withColumn("report_date", F.date_format("sales_date", DATE_PATTERN))
       .hint("rebalance", "report_date")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("report_date").parquet(path))


def read_daily_reports(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read daily reports with the writer's schema, keeping ``report_date`` as text."""
    from pyspark.sql import types as T
    full = T.StructType(list(schema.fields) + [T.StructField("report_date", T.StringType())])
    return spark.read.schema(full).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **conn) -> None:
    """Write to a database table in batches of ``LOAD_BATCH_SIZE`` rows per round trip."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(LOAD_BATCH_SIZE)))
    for k, v in conn.items():
        w = w.option(k, v)
    w.mode(mode).save()


def currency(col: str):
    """``$#,##0.00``."""
    return F.concat(F.lit(CURRENCY_PREFIX), F.format_number(round_half_away(col, 2), 2))


def percent(col: str):
    """``0.00%`` for a value already expressed in percent."""
    return F.concat(F.format_number(round_half_away(col, 2), 2), F.lit("%"))


def daily_sales_report(summary: DataFrame) -> DataFrame:
    """SK-08: formatted daily sales report rows."""
    return summary.select(
        F.date_format("sales_date", DATE_PATTERN).alias("sales_date"),
        F.col("total_orders"),
        currency("total_revenue").alias("total_revenue"),
        currency("avg_order_value").alias("avg_order_value"),
        currency("net_revenue").alias("net_revenue"),
        F.col("unique_customers"),
        percent("completion_rate").alias("completion_rate"),
        percent("high_value_rate").alias("high_value_rate"),
        F.col("revenue_performance"),
        F.col("performance_score"))


def customer_analysis_report(analysis: DataFrame) -> DataFrame:
    """SK-08: formatted customer analysis report rows."""
    return analysis.select(
        F.col("customer_id"),
        F.col("customer_segment"),
        F.col("value_tier"),
        F.col("total_orders"),
        currency("total_spent").alias("total_spent"),
        currency("estimated_clv").alias("estimated_clv"),
        F.date_format("last_order_date", DATE_PATTERN).alias("last_order_date"),
        F.col("activity_status"))


def write_report(report: DataFrame, out_dir: str, name: str, as_of) -> str:
    """Write a report as CSV with a header under ``<out_dir>/<name>_<yyyy-mm-dd>``."""
    target = f"{out_dir}/{REPORT_FILE_PATTERNS.get(name, name + '_{date}').format(date=D.to_date(as_of).isoformat())}"
    report.write.mode("overwrite").option("header", "true").csv(target)
    return target
