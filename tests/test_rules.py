"""Unit goldens for thresholds, calendar semantics and rule order (FIXTURES.md section 7)."""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.functions.numeric import int_div, round_half_away
from ledgerlight.operators import customers as C
from ledgerlight.operators import metrics as M
from ledgerlight.operators import sales as S


def col_values(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_recency_score_edges(spark):
    days = [30, 31, 60, 61, 90, 91, 180, 181]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    assert col_values(df.select(C.recency_score("d").alias("s")), "s") == [5, 4, 4, 3, 3, 2, 2, 1]


def test_frequency_score_edges(spark):
    orders = [4, 5, 9, 10, 14, 15, 19, 20]
    df = spark.createDataFrame([(o,) for o in orders], "o long").select(C.frequency_score("o").alias("s"))
    assert col_values(df, "s") == [1, 2, 2, 3, 3, 4, 4, 5]


def test_monetary_score_edges_both_cut_sets(spark):
    mk = [499.99, 500, 1999.99, 2000, 4999.99, 5000, 9999.99, 10000]
    df = spark.createDataFrame([(float(v),) for v in mk], "v double").select(C.monetary_score("v").alias("s"))
    assert col_values(df, "s") == [1, 2, 2, 3, 3, 4, 4, 5]
    ml = [249.99, 250, 499.99, 500, 749.99, 750, 999.99, 1000]
    df = spark.createDataFrame([(float(v),) for v in ml], "v double") \
        .select(C.monetary_score("v", C.MONETARY_CUTS_ML).alias("s"))
    assert col_values(df, "s") == [1, 2, 2, 3, 3, 4, 4, 5]


def _segment_counts(spark, rules):
    cells = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(cells, "r int, f int, m int")
    out = df.select(C.rfm_segment(rules, "r", "f", "m").alias("seg")).groupBy("seg").count().collect()
    return {r["seg"]: r["count"] for r in out}


def test_marketing_segment_truth_table(spark):
    assert _segment_counts(spark, C.MARKETING_SEGMENTS) == {
        "Champions": 8, "Loyal Customers": 19, "Potential Loyalists": 12, "New Customers": 8, "Promising": 3,
        "Need Attention": 18, "About to Sleep": 14, "At Risk": 8, "Cannot Lose Them": 4, "Others": 31}


def test_ml_segment_truth_table(spark):
    assert _segment_counts(spark, C.ML_SEGMENTS) == {
        "Champions": 8, "Loyal Customers": 19, "New Customers": 8, "Potential Loyalists": 19, "At Risk": 9,
        "Cannot Lose Them": 23, "Hibernating": 6, "Lost": 6, "Others": 27}


def test_whole_days_is_not_datediff(spark):
    as_of = dt.date(2001, 8, 2)
    ts = dt.datetime(2001, 6, 3, 10, 0)   # 59 days 14 hours before
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    row = df.select(D.whole_days(as_of, "t").alias("w"), F.datediff(F.lit(as_of), F.to_date("t")).alias("d")).first()
    assert (row["w"], row["d"]) == (59, 60)


def test_day_of_week_and_weekend(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7),), (dt.datetime(2024, 1, 6),), (dt.datetime(2024, 1, 8),)],
                               "t timestamp_ntz")
    rows = df.select(D.dow_sunday0("t").alias("d"), D.day_type("t").alias("k")).collect()
    assert [(r.d, r.k) for r in rows] == [(0, "Weekend"), (6, "Weekend"), (1, "Weekday")]


def test_season_including_february_fall(spark):
    months = [1, 2, 3, 6, 10, 11]
    df = spark.createDataFrame([(dt.datetime(2024, m, 15),) for m in months], "t timestamp_ntz")
    assert col_values(df.select(D.season("t").alias("s")), "s") == \
        ["Holiday Season", "Fall", "Spring", "Summer", "Fall", "Holiday Season"]


def test_growth_integer_division(spark):
    df = spark.createDataFrame([(10, 25), (10, 3), (10, 10), (-7, 0)], "prev long, cur long")
    out = df.select(int_div(F.col("cur") - F.col("prev"), F.col("prev")).alias("q")).collect()
    assert [r.q for r in out][:3] == [1, 0, 0]
    assert df.select(int_div(F.lit(-7), F.lit(2)).alias("q")).first().q == -3


def test_orders_growth_pct_previous_zero_is_null(spark):
    rows = [(dt.datetime(2024, 1, d), n, float(n), 0.0) for d, n in [(1, 0), (2, 10), (3, 25), (4, 3)]]
    daily = spark.createDataFrame(rows, "sales_date timestamp_ntz, total_orders long, total_revenue double, x double")
    daily = daily.withColumns({"completed_orders": F.lit(0), "high_value_orders": F.lit(0),
                               "unique_customers": F.lit(1)})
    ins = S.sales_insights(S.sales_trends(daily)).orderBy("sales_date").select("orders_growth_pct").collect()
    assert [r[0] for r in ins] == [None, None, 100.0, 0.0]  # 25 -> 3: -22 div 25 = 0


def test_round_half_away_ties(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.675,), (1.005,)], "x double")
    assert col_values(df.select(round_half_away("x", 2).alias("r")), "r") == [0.13, -0.13, 2.68, 1.01]


def test_volatility_labels(spark):
    df = spark.createDataFrame([(99.9,), (100.0,), (499.9,), (500.0,), (None,)], "volatility double")
    assert col_values(df.select(M.volatility_label().alias("v")), "v") == \
        ["Low Volatility", "Medium Volatility", "Medium Volatility", "High Volatility", "High Volatility"]


def test_performance_score_branches(spark):
    pairs = [("Above Average", "Above Average"), ("Above Average", "Average"), ("Average", "Average"),
             ("Below Average", "Average"), ("Average", "Below Average")]
    df = spark.createDataFrame(pairs, "revenue_performance string, orders_performance string")
    assert col_values(df.select(S.performance_score().alias("s")), "s") == [10, 8, 6, 4, 4]


def test_lookback_month_clips_to_month_end():
    assert D.lookback_start("2001-03-31", 1, "months") == dt.date(2001, 2, 28)
    assert D.lookback_start("2004-02-29", 1, "years") == dt.date(2003, 2, 28)
    assert D.lookback_start("2001-08-02", 12, "weeks") == dt.date(2001, 5, 10)


def test_rank_ties_share_with_gaps(spark):
    rows = [("a", 5.0), ("b", 5.0), ("c", 3.0)]
    df = spark.createDataFrame(rows, "category string, avg_monthly_value double")
    df = df.withColumn("month", F.lit(dt.datetime(2001, 7, 1)).cast("timestamp_ntz")) \
           .withColumn("created_at", F.col("month")).withColumn("metric_value", F.col("avg_monthly_value"))
    out = M.category_performance(df.select("category", "metric_value", "created_at"), "2001-08-02")
    assert sorted((r.category, r.performance_rank) for r in out.collect()) == [("a", 1), ("b", 1), ("c", 3)]


def test_sales_summary_contract(spark):
    """30 measures + 7 calendar / score columns (+ timestamp), total_discount carried (D1), newest first."""
    from conftest import SMALL
    from ledgerlight.sources import tables as T
    out = S.sales_summary(T.staging_sales(spark, SMALL), "2001-08-02", with_timestamp=True)
    cols = out.columns
    assert cols[:30] == S.SUMMARY_COLUMNS and "total_discount" in cols
    assert cols[30:] == ["day_of_week", "month", "quarter", "year", "day_type", "season",
                         "performance_score", "analysis_timestamp"]
    dates = [r.sales_date for r in out.select("sales_date").collect()]
    assert dates == sorted(dates, reverse=True) and len(dates) <= 91
    assert out.filter(F.col("total_discount").isNull()).count() == 0


def test_customer_analysis_contract(spark):
    from conftest import SMALL
    from ledgerlight.sources import tables as T
    out = C.customer_analysis(T.staging_sales(spark, SMALL), "2001-08-02", with_timestamp=True)
    assert out.columns == C.ANALYSIS_COLUMNS + ["activity_status", "growth_potential_score", "analysis_timestamp"]
    r = out.first()
    assert r.rfm_score == f"{r.recency_score}{r.frequency_score}{r.monetary_score}"


def test_kpi_conversion_change_over_two_months(spark):
    """FIXTURES.md: events cover one month, so the month-over-month change needs a two-month golden."""
    ev = [(1, dt.datetime(2024, 1, 3), "purchase"), (2, dt.datetime(2024, 1, 4), "view"),
          (3, dt.datetime(2024, 1, 5), "view"), (4, dt.datetime(2024, 1, 6), "view"),
          (1, dt.datetime(2024, 2, 3), "purchase"), (2, dt.datetime(2024, 2, 3), "purchase")]
    events = spark.createDataFrame(ev, "user_id long, ts timestamp_ntz, event_type string")
    out = M.event_kpis(events).filter(F.col("kpi") == "Conversion Rate").orderBy("period_start").collect()
    assert [(r.value, r.prev_value, r.change_pct) for r in out] == [(25.0, None, None), (100.0, 25.0, 300.0)]
    views = M.event_kpis(events).filter(F.col("kpi") == "Page Views").agg(F.sum("value")).first()[0]
    assert views == 3.0
