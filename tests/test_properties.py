"""Property checks: rollups add up, and the sliced operators equal brute force on random data."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import MEDIUM
from ledgerlight.functions import dates as D
from ledgerlight.operators import sales as S
from ledgerlight.operators.ordered import exact_percentiles, neighbors
from ledgerlight.sources import tables as T


def test_daily_rollup_sums_to_window_total(spark):
    ss = T.staging_sales(spark, MEDIUM)
    daily = S.daily_sales(ss, "2001-08-02").agg(F.sum("total_orders").alias("n"), F.sum("total_revenue").alias("r"),
                                                F.sum("completed_orders").alias("c"),
                                                F.sum("pending_orders").alias("p"),
                                                F.sum("cancelled_orders").alias("x")).first()
    win = ss.filter(D.since("order_date", "2001-08-02", 90, "days")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("order_value").alias("r")).first()
    assert daily.n == win.n and daily.r == pytest.approx(win.r, rel=1e-12)
    assert daily.c + daily.p + daily.x == daily.n


def test_weekly_and_monthly_cover_their_windows(spark):
    ss = T.staging_sales(spark, MEDIUM)
    for fn, n, unit in ((S.weekly_sales, 12, "weeks"), (S.monthly_sales, 12, "months")):
        got = fn(ss, "2001-08-02").agg(F.sum("total_orders")).first()[0]
        assert got == ss.filter(D.since("order_date", "2001-08-02", n, unit)).count()


rows = st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot"]),
                          st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4))),
                min_size=1, max_size=120)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, p=st.sampled_from([0.0, 0.1, 0.5, 0.95, 1.0]))
def test_sliced_percentile_equals_builtin(spark, data, p):
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.q for r in exact_percentiles(df, ["g"], "v", {"q": p}).collect()}
    want = {r.g: r.q for r in df.filter(F.col("v").isNotNull()).groupBy("g")
            .agg(F.percentile("v", p).alias("q")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, bits=st.integers(0, 7))
def test_sliced_lag_lead_equals_window(spark, data, bits):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id long, g string, v double")
    got = neighbors(df, ["g"], ["id"], F.shiftright("id", bits), "v", "p", "n")
    w = Window.partitionBy("g").orderBy("id")
    want = df.select("id", F.lag("v").over(w).alias("wp"), F.lead("v").over(w).alias("wn"))
    bad = got.join(want, "id").filter(~F.col("p").eqNullSafe(F.col("wp")) | ~F.col("n").eqNullSafe(F.col("wn")))
    assert bad.count() == 0 and got.count() == len(data)
