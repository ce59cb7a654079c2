"""The configured daily run: extract, validate, stage, transform, load, report.

The reference declares this flow in configuration (sources, validation rules, transform scripts, load targets, dated
report files) without code to run it.  ``daily_etl`` runs it as a sequence of Spark jobs:

1. extract the sales source as landed text: at first everything, then the last ``EXTRACT_DAYS`` days from the first day of the
   month they begin in, so every month the extract touches is whole, and the undated rows that came after the last run's
   high-water mark.  Both bounds are predicates on source columns, pushed into the scan;
2. validate it and write it in one pass, dealt by validity and month: valid rows typed, rejected ones as they landed with
   their reasons.  Row counts and the new high-water mark are observed by that write, months are the folders it leaves;
3. transform the sales as they will be: customer analysis, sales summary, product performance, each from the months that it
   looks back on;
4. dimensions (newest row per key) and daily reports (by day);
5. commit all of it, and the mark, by one manifest (``sinks.versioned``), then write the dated report files.

A run that fails or is killed before step 5 changes nothing that readers see, and a repeated run gives the same tables.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import customers as C
from ..operators import quality as Q
from ..operators import sales as S
from ..sinks import versioned as V
from ..sinks import writers as W
from ..sources import tables as T

# Fixed value: days of the configured extract.
EXTRACT_DAYS = 30
#: Gives the landed text of (spark, source folder, first day or None, order key after which undated rows are new or None).
Extract = Callable[[SparkSession, str, "_dt.date | None", "int | None"], DataFrame]
MARK, UNDATED = "order_id", "undated"
MONTH = re.compile(r"\d{4}-\d\d")


class Warehouse(NamedTuple):
    """What a run has left: the tables of its manifest, and the folder of the dated reports."""
    spark: SparkSession
    root: str
    manifest: V.Manifest

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    def read(self, table: str, keys: Callable[[str], bool] = lambda key: True) -> DataFrame:
        return V.read(self.spark, self.root, self.manifest, table, keys)

    def quarantine(self) -> DataFrame:
        """Rejected rows as they landed, with their reasons and the day of the run."""
        return self.read("quarantine").select("rejected.*", "run_date")


def first_day_of(today: _dt.date) -> _dt.date:
    """The first day of the month in which the extract begins."""
    return (today - _dt.timedelta(days=EXTRACT_DAYS)).replace(day=1)


def dealt_sales(landed: DataFrame, rules: dict = Q.DEFAULT_RULES) -> DataFrame:
    """Every landed row once: typed if valid, else whole in ``rejected``.  ``_month`` is the month of a valid row, ``undated`` of
    any row without a date, ``dated`` of other rejected rows."""
    texts = {c for c, kind in landed.dtypes if kind == "string"}
    parsed = [c for c, kind in rules.get("types", {}).items() if c in texts and Q.TYPE_TARGETS[kind] == T.SALES_TYPES.get(c)]
    tagged, valid = Q.with_reasons(landed, rules, parsed), F.col("is_valid")
    # The day and its month in steps of their own, so that each is worked out once a row.
    dated = tagged.withColumn("_day", F.when(valid, F.col("order_date").cast("timestamp")).cast("date"))
    dated = dated.withColumn("order_month", W.month_of_day("_day"))
    month = F.when(F.col("order_date").isNull(), UNDATED).when(valid, F.col("order_month")).otherwise("dated")
    value = {c: F.col(f"_dq_{c}") if c in parsed else F.col(c).try_cast(kind) for c, kind in T.SALES_TYPES.items()}
    return dated.select(*[F.when(valid, v).alias(c) for c, v in value.items()], "order_month",
                        F.when(~valid, F.struct(*landed.columns, "dq_reasons")).alias("rejected"),
                        valid.alias("_valid"), month.alias("_month"))


def months_since(first: _dt.date) -> Callable[[str], bool]:
    """Keys of ``fact_sales`` that can hold a row from ``first`` on: all but earlier months.  The month of a time with an offset may
    be that of the day before; a key that is no month of four digits is kept."""
    month = (first - _dt.timedelta(days=1)).strftime("%Y-%m")
    return lambda key: key >= month or not MONTH.fullmatch(key)


def daily_etl(spark: SparkSession, source_dir: str, target_dir: str, as_of=None, rules: dict = Q.DEFAULT_RULES,
              extract: Extract = T.staging_sales_text) -> Warehouse:
    """Run the daily ETL from the parquet sources in ``source_dir`` into the tables of ``target_dir``."""
    today = D.to_date(as_of)
    day, before = today.isoformat(), V.current(spark, target_dir)
    run = V.new_run(day)
    first = first_day_of(today) if "fact_sales" in before.schemas else None

    # 1, 2. extract, validate, write once
    dealt = dealt_sales(extract(spark, source_dir, first, before.marks.get(MARK)), rules)
    dealt = dealt.withColumn("run_date", F.when(~F.col("_valid"), F.lit(day)))
    mark = F.coalesce(MARK, F.col(f"rejected.{MARK}").try_cast("bigint"))
    keys, facts = V.write_keyed(dealt, target_dir, f"{run}/sales", {"_valid": F.col("_valid"), "_month": F.col("_month")}, {
        "total": F.count(F.lit(1)), "valid": F.count_if("_valid"), "mark": F.max(mark)})
    marks = [m for m in (before.marks.get(MARK), facts["mark"]) if m is not None]
    pending = before.marking(**{MARK: max(marks)} if marks else {})
    sales = {(f"{UNDATED} {day}" if k["_month"] == UNDATED else k["_month"]): k["folder"] for k in keys if k["_valid"] == "true"}
    # Undated rows come once; a month of the extract that has no row left goes.
    stale = (lambda key: True) if first is None else (lambda key: not key.startswith(UNDATED) and key >= first.strftime("%Y-%m"))
    pending = pending.replacing("fact_sales", sales, dealt.select(*T.SALES_TYPES, "order_month").schema, stale)
    rejects = {(f"{day} {UNDATED}" if k["_month"] == UNDATED else day): k["folder"] for k in keys if k["_valid"] == "false"}
    pending = pending.replacing("quarantine", rejects, dealt.select("rejected", "run_date").schema, lambda key: key == day)

    def keep(df: DataFrame, table: str, key: str = day) -> DataFrame:
        """Write a table's rows of one key to this run's folder, and read them back from there."""
        nonlocal pending
        df.write.parquet(f"{target_dir}/{run}/{table}")
        pending = pending.replacing(table, {key: f"{run}/{table}"}, df.schema)
        return spark.read.schema(df.schema).parquet(f"{target_dir}/{run}/{table}")

    score = facts["valid"] / facts["total"] if facts["total"] else None
    keep(spark.createDataFrame([(facts["total"], facts["valid"], facts["total"] - facts["valid"], score, day)],
                               "total_rows bigint, valid_rows bigint, quarantined_rows bigint, quality_score double, run_date string"), "quality")

    # 3. transforms
    def staged(n: int, unit: str) -> DataFrame:
        """The sales of the months that a look back over ``n`` units touches."""
        return V.read(spark, target_dir, pending, "fact_sales", months_since(D.lookback_start(today, n, unit))).drop("order_month")

    analysis = keep(C.customer_analysis(staged(1, "years"), as_of), "customer_analysis")
    summary = keep(S.sales_summary(staged(90, "days"), as_of), "sales_summary")
    keep(S.product_performance(staged(30, "days"), as_of), "product_performance")

    # 4. loads; ties of the date go to the row that sorts last
    customers, products = T.customers(spark, source_dir), T.products(spark, source_dir)
    keep(W.newest_per_key(customers, ["customer_id"], W.newest_order(customers, "registration_date")), "dim_customers", "all")
    keep(W.newest_per_key(products, ["product_id"], W.newest_order(products, "created_date")), "dim_products", "all")
    reported = summary.withColumn("report_date", F.date_format("sales_date", W.DATE_PATTERN))
    days, _ = V.write_keyed(reported, target_dir, f"{run}/daily_reports", {"_day": F.col("report_date")})
    pending = pending.replacing("daily_reports", {k["_day"]: k["folder"] for k in days}, reported.schema)

    # 5. all at once, then the report files
    done = Warehouse(spark, target_dir, V.commit(spark, target_dir, pending))
    W.write_report(W.daily_sales_report(summary), done.reports, "daily_sales_report", as_of)
    W.write_report(W.customer_analysis_report(analysis), done.reports, "customer_analysis_report", as_of)
    return done
