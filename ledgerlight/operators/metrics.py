"""Metric analytics: summaries, statistics, trends, category performance, KPIs, feeds.

Input tables have the ``analytics_data`` shape: ``metric_name,
metric_value, category, [subcategory, metadata], created_at``.

Scale notes.  Categories are few, so a category can hold a third of all
rows.  Count / sum / avg / min / max / stddev / variance are mergeable and
partially aggregated before the shuffle.  Exact percentiles and the
LAG / LEAD trend columns use the operators of ``ordered``, so no task ever
has to hold a whole hot category.  Windows over
*aggregated* rows (one row per category, or per period) are bounded by
the number of categories or periods and run in one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rules import first_match
from .ordered import exact_percentiles, neighbors, tie_slice, value_cell

# Volatility label cuts of the reference.
VOLATILITY_LABELS = [(100, "Low Volatility"), (500, "Medium Volatility")]
VOLATILITY_DEFAULT = "High Volatility"


def metric_summary(df: DataFrame) -> DataFrame:
    """AG-01 / PF-04: count, avg, max, min, sum per category over non-NULL values."""
    v = F.col("metric_value")
    return (df.filter(v.isNotNull())
            .groupBy("category")
            .agg(F.count(F.lit(1)).alias("metric_count"),
                 F.avg(v).alias("avg_value"),
                 F.max(v).alias("max_value"),
                 F.min(v).alias("min_value"),
                 F.sum(v).alias("total_value")))


def recent_metrics(df: DataFrame, as_of=None, days: int = 7,
                   columns=("metric_name", "metric_value", "category", "created_at"),
                   tiebreak: str | None = "id") -> DataFrame:
    """PF-01: rows of the last ``days`` days, newest first.

    The sort is range-partitioned; a unique ``tiebreak`` column (when the
    table has one) makes the key total, so rows sharing one timestamp can
    still be split across partitions instead of landing in one.
    """
    order = [F.col("created_at").desc()]
    if tiebreak and tiebreak in df.columns:
        order.append(F.col(tiebreak).desc())
    return (df.filter(D.since("created_at", as_of, days, "days"))
            .orderBy(*order)
            .select(*columns))


def metric_summary_advanced(df: DataFrame) -> DataFrame:
    """AG-09 + WN-01..03: the reference's ``analytics_summary_advanced`` view, as written.

    The view groups by ``(category, subcategory, metric_value, created_at)``,
    so each group holds copies of one value: its median and p95 *are* that
    value (exact, no percentile machinery needed), and stddev / variance are
    NULL for one row and 0 otherwise.  LAG / LEAD run per category over the
    grouped rows, ordered by ``created_at`` with ``subcategory, metric_value``
    as tie-breakers (the reference leaves ties to chance).
    """
    v = F.col("metric_value")
    keys = ["category", "subcategory", "metric_value", "created_at"]
    grouped = (df.filter(v.isNotNull())
               .groupBy(*keys)
               .agg(F.count(F.lit(1)).alias("metric_count"),
                    F.avg(v).alias("avg_value"),
                    F.max(v).alias("max_value"),
                    F.min(v).alias("min_value"),
                    F.sum(v).alias("total_value"),
                    F.stddev_samp(v).alias("std_deviation"),
                    F.var_samp(v).alias("variance"))
               .withColumns({"median_value": v.cast("double"), "p95_value": v.cast("double")}))
    nb = neighbors(grouped, ["category"], ["created_at", "subcategory", "metric_value"],
                   tie_slice("created_at", F.col("subcategory").alias("subcategory"), value_cell("metric_value").alias("cell")), "metric_value")
    prev = F.col("prev_value")
    nb = nb.withColumn("growth_rate_percent", F.when(prev > 0, (v - prev) / prev * 100))
    return nb.select("category", "subcategory", "metric_count", "avg_value", "median_value", "p95_value",
                     "max_value", "min_value", "total_value", "std_deviation", "variance",
                     "prev_value", "next_value", "growth_rate_percent", "created_at", "metric_value")


def metric_stats(df: DataFrame, group_cols=("category", "subcategory")) -> DataFrame:
    """AG-10..12: the same statistics at a grain where they mean something.

    Exact interpolated median and p95 (``PERCENTILE_CONT``) come from
    ``exact_percentiles``, which takes the other statistics from the same frequencies.
    """
    g = list(group_cols)
    moments = {"avg": "avg_value", "max": "max_value", "min": "min_value", "sum": "total_value", "stddev": "std_deviation", "variance": "variance"}
    out = exact_percentiles(df, g, "metric_value", {"median_value": 0.5, "p95_value": 0.95}, moments)
    out = out.withColumnRenamed("n", "metric_count")
    return out.select(*g, "metric_count", "avg_value", "median_value", "p95_value", "max_value",
                      "min_value", "total_value", "std_deviation", "variance")


def monthly_trends(df: DataFrame, as_of=None, months: int = 12) -> DataFrame:
    """AG-15: monthly mean and count per category over the last ``months`` months."""
    return (df.filter(D.since("created_at", as_of, months, "months"))
            .groupBy(D.trunc_ts("month", "created_at").alias("month"), "category")
            .agg(F.avg("metric_value").alias("avg_monthly_value"),
                 F.count(F.lit(1)).alias("monthly_count")))


def volatility_label(col: str = "volatility"):
    """``< 100`` Low, ``< 500`` Medium, else High -- a NULL volatility falls to High, as in SQL."""
    return first_match([(F.col(col) < cut, label) for cut, label in VOLATILITY_LABELS], VOLATILITY_DEFAULT)


def category_performance(df: DataFrame, as_of=None, months: int = 12) -> DataFrame:
    """BX-14 / AG-16 / WN-08: mean and volatility of monthly means, ranked.

    The rank window runs over one row per category (bounded by the number
    of categories).
    """
    mt = monthly_trends(df, as_of, months)
    cp = mt.groupBy("category").agg(F.avg("avg_monthly_value").alias("overall_avg"),
                                    F.stddev_samp("avg_monthly_value").alias("volatility"),
                                    F.count_distinct("month").alias("active_months"))
    return (cp.withColumns({
        "performance_rank": F.rank().over(Window.orderBy(F.col("overall_avg").desc())).cast("bigint"),
        "volatility_category": volatility_label(),
    }).orderBy(F.col("overall_avg").desc(), F.col("category")))


def category_report(df: DataFrame, category: str = "Financial", as_of=None, days: int = 30) -> DataFrame:
    """AG-17 / PF-03: mean and count per metric for one category, last ``days`` days."""
    return (df.filter(D.since("created_at", as_of, days, "days") & (F.col("category") == category))
            .groupBy("metric_name")
            .agg(F.avg("metric_value").alias("avg_value"), F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.col("avg_value").desc(), F.col("metric_name")))


def metadata_lookup(df: DataFrame, key: str, col: str = "metadata", cast: str | None = None) -> DataFrame:
    """FN-15: look up one key of a JSON metadata column (``metadata ->> key``).

    With ``cast``, a value that isn't of that type becomes NULL.
    """
    val = F.get_json_object(F.col(col), f"$.{key}")
    if cast:
        val = val.try_cast(cast)
    return df.withColumn(f"meta_{key}", val)


def period_change(df: DataFrame, ts_col: str, period: str, value_aggs: dict, kpi_col: str = "kpi") -> DataFrame:
    """BX-15 building block: one value per (kpi, period) and its change vs the previous period.

    ``value_aggs`` maps a KPI name to an aggregate Column.  Each KPI is a
    conditional aggregate in one pass (``groupBy(period)``), unpivoted to
    long form; the lag runs per KPI over its period rows (bounded by the
    number of periods in the data).
    """
    per = df.groupBy(D.trunc_ts(period, ts_col).alias("period_start")).agg(
        *[agg.alias(name) for name, agg in value_aggs.items()])
    long = per.unpivot(["period_start"], list(value_aggs), kpi_col, "value") \
              .withColumn("value", F.col("value").cast("double"))
    w = Window.partitionBy(kpi_col).orderBy("period_start")
    prev = F.lag("value").over(w)
    long = long.withColumn("prev_value", prev)
    return long.withColumns({
        "period": F.lit(period),
        "change_pct": F.when(F.col("prev_value") > 0,
                             (F.col("value") - F.col("prev_value")) / F.col("prev_value") * 100),
    })


def user_days(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Events reduced to one row per (user, day): purchases and page views that day.

    Shared by every event KPI, so the event table is scanned and shuffled
    once (the identical exchange is reused by each rollup).
    """
    return (events.groupBy("user_id", D.trunc_ts("day", ts_col).alias("day"))
            .agg(F.count_if(F.col("event_type") == "purchase").alias("purchases"),
                 F.count_if(F.col("event_type") == "view").alias("views")))


def _with_change(long: DataFrame, kpi_col: str = "kpi") -> DataFrame:
    """Previous period's value and the change in percent, per KPI (rows bounded by the periods)."""
    w = Window.partitionBy(kpi_col).orderBy("period_start")
    long = long.withColumn("prev_value", F.lag("value").over(w))
    return long.withColumn("change_pct", F.when(F.col("prev_value") > 0,
                                                (F.col("value") - F.col("prev_value")) / F.col("prev_value") * 100))


def event_kpis(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Conversion rate by month, active users and page views by week, in one pass over events.

    Each (user, day) row is placed in its month and its week (grouping sets
    written out), aggregated once, and unpivoted to KPI rows; a single plan
    branch means a single scan and shuffle of the event table.
    """
    ud = user_days(events, ts_col)
    periods = F.array(
        F.struct(F.lit("month").alias("period"), D.trunc_ts("month", "day").alias("period_start")),
        F.struct(F.lit("week").alias("period"), D.trunc_ts("week", "day").alias("period_start")))
    both = ud.select("user_id", "purchases", "views", F.explode(periods).alias("p")) \
             .select("user_id", "purchases", "views", "p.period", "p.period_start")
    per = both.groupBy("period", "period_start").agg(
        (F.count_distinct(F.when(F.col("purchases") > 0, F.col("user_id")))
         / F.count_distinct("user_id") * 100).alias("conversion"),
        F.count_distinct("user_id").cast("double").alias("users"),
        F.sum("views").cast("double").alias("views"))
    kv = F.when(F.col("period") == "month",
                F.array(F.struct(F.lit("Conversion Rate").alias("kpi"), F.col("conversion").alias("value")))) \
          .otherwise(F.array(F.struct(F.lit("Active Users").alias("kpi"), F.col("users").alias("value")),
                             F.struct(F.lit("Page Views").alias("kpi"), F.col("views").alias("value"))))
    long = per.select("period", "period_start", F.explode(kv).alias("kv")) \
              .select("kv.kpi", "period", "period_start", "kv.value")
    return _with_change(long)


def kpi_cards(sales: DataFrame, events: DataFrame) -> DataFrame:
    """BX-15: the dashboard's four cards with period-over-period change.

    Revenue by month (``staging_sales``); conversion rate by month, active
    users and page views by week (``events``, one pass).  Conversion rate is
    the share of active users who purchased in the period, in percent.
    """
    rev = period_change(sales, "order_date", "month", {"Total Revenue": F.sum("order_value")})
    cols = ["kpi", "period", "period_start", "value", "prev_value", "change_pct"]
    return rev.select(*cols).unionByName(event_kpis(events).select(*cols))


def feed_line(df: DataFrame, ts_col: str = "created_at", value_col: str = "metric_value") -> DataFrame:
    """AG-20 line chart feed: value total and point count per day."""
    return (df.groupBy(D.trunc_ts("day", ts_col).alias("day"))
            .agg(F.sum(value_col).alias("total_value"), F.count(F.lit(1)).alias("points")))


def feed_bar(df: DataFrame, label_col: str = "category", value_col: str = "metric_value") -> DataFrame:
    """AG-20 bar chart feed: value total per label."""
    return df.groupBy(label_col).agg(F.sum(value_col).alias("total_value"),
                                     F.count(F.lit(1)).alias("points"))


def feed_pie(df: DataFrame, label_col: str = "category", value_col: str = "metric_value") -> DataFrame:
    """AG-20 pie chart feed: share of the grand total per label.

    The grand total is a window over the per-label rows (one row per label).
    """
    bar = feed_bar(df, label_col, value_col)
    return bar.withColumn("share", F.col("total_value") / F.sum("total_value").over(Window.partitionBy()))
