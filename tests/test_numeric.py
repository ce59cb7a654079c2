"""Rounding and snapping pass every kind of DOUBLE."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions.numeric import round_half_away, settle_doubles
from ledgerlight.operators import customers as C


@pytest.mark.parametrize("x,want", [(1.0049999999, 1.0), (2.6749999999, 2.67), (2.675, 2.68), (-2.675, -2.68), (1.005, 1.01), (1e13 + 0.126, 1e13 + 0.13),
                                    (3e30, 3e30), (float("inf"), float("inf")), (0.0, 0.0), (None, None)])
def test_round_half_away(spark, x, want):
    got = spark.createDataFrame([(x,)], "x double").select(round_half_away("x", 2).alias("y")).first().y
    assert got == want


def test_snapping_passes_large_and_special_values(spark):
    values = [1e13, 5e14, -1e13, 1e300, float("inf"), float("-inf"), 0.25, -3.0]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "x double")
    got = [r.x for r in settle_doubles(df).collect()]
    assert got[:-1] == values and math.isnan(got[-1])
    near = spark.createDataFrame([(0.1 + 0.2,), (0.3,)], "x double")
    assert settle_doubles(near).distinct().count() == 1


# The labels of all 125 score cells, written out; a row is a recency score and a frequency
# score, its letters are the labels of money scores 1 to 5.
MARKETING = {"C": "Champions", "L": "Loyal Customers", "P": "Potential Loyalists", "N": "New Customers", "M": "Promising", "A": "Need Attention",
             "S": "About to Sleep", "R": "At Risk", "X": "Cannot Lose Them", "-": "Others"}
MARKETING_CELLS = {
    (1, 1): "XRRRR", (1, 2): "XSSSS", (1, 3): "-SAAA", (1, 4): "-SAAA", (1, 5): "-SAAA",
    (2, 1): "XRRRR", (2, 2): "XSSSS", (2, 3): "-SAAA", (2, 4): "-SAAA", (2, 5): "-SAAA",
    (3, 1): "-----", (3, 2): "--MMM", (3, 3): "--LLL", (3, 4): "--LLL", (3, 5): "--LLL",
    (4, 1): "NNPPP", (4, 2): "NNPPP", (4, 3): "--LLL", (4, 4): "--LCC", (4, 5): "--LCC",
    (5, 1): "NNPPP", (5, 2): "NNPPP", (5, 3): "--LLL", (5, 4): "--LCC", (5, 5): "--LCC"}
ML = {"C": "Champions", "L": "Loyal Customers", "N": "New Customers", "P": "Potential Loyalists", "R": "At Risk", "X": "Cannot Lose Them",
      "H": "Hibernating", "D": "Lost", "-": "Others"}
ML_CELLS = {
    (1, 1): "DDHHH", (1, 2): "DXXXX", (1, 3): "-XXXX", (1, 4): "-XXXX", (1, 5): "-XXXX",
    (2, 1): "DDHHH", (2, 2): "DXXXX", (2, 3): "-XRRR", (2, 4): "-XRRR", (2, 5): "-XRRR",
    (3, 1): "-----", (3, 2): "-PPPP", (3, 3): "-PLLL", (3, 4): "-PLLL", (3, 5): "-PLLL",
    (4, 1): "NN---", (4, 2): "NNPPP", (4, 3): "-PLLL", (4, 4): "-PLCC", (4, 5): "-PLCC",
    (5, 1): "NN---", (5, 2): "NNPPP", (5, 3): "-PLLL", (5, 4): "-PLCC", (5, 5): "-PLCC"}


@pytest.mark.parametrize("rules,labels,cells", [(C.MARKETING_SEGMENTS, MARKETING, MARKETING_CELLS), (C.ML_SEGMENTS, ML, ML_CELLS)])
def test_segments_of_all_score_cells(spark, rules, labels, cells):
    want = {(r, f, m): labels[c] for (r, f), row in cells.items() for m, c in enumerate(row, 1)}
    df = spark.createDataFrame(list(want), "recency_score int, frequency_score int, monetary_score int")
    got = {tuple(x)[:3]: x.label for x in df.withColumn("label", C.rfm_segment(rules)).collect()}
    assert got == want


def test_tiers_behaviour_activity_and_growth(spark):
    rows = [(9999.99, 14, 499.99, 30), (10000.0, 15, 500.0, 31), (5000.0, 15, 499.0, 90), (2000.0, 14, 500.0, 91), (500.0, 1, 1.0, 180), (499.99, 1, 1.0, 181)]
    df = spark.createDataFrame(rows, "total_spent double, total_orders int, avg_order_value double, recency_days int").withColumns(
        {"recency_score": F.lit(1), "frequency_score": F.lit(1), "monetary_score": F.lit(1)})
    got = C.customer_segments(df).withColumn("activity", C.activity_status()).orderBy(F.col("recency_days")).collect()
    assert [r.value_tier for r in got] == ["High Value", "Premium", "High Value", "Medium Value", "Low Value", "New/Inactive"]
    assert [r.purchase_behavior for r in got] == ["Occasional Low-Value", "Frequent High-Value", "Frequent Low-Value", "Occasional High-Value",
                                                  "Occasional Low-Value", "Occasional Low-Value"]
    assert [r.activity for r in got] == ["Active", "At Risk", "At Risk", "Inactive", "Inactive", "Lost"]
    labels = spark.createDataFrame([(x,) for x in MARKETING.values()], "customer_segment string")
    assert {r.customer_segment: r.g for r in labels.withColumn("g", C.growth_potential()).collect()} == {
        "Champions": 10, "Loyal Customers": 10, "Potential Loyalists": 8, "Promising": 8, "Need Attention": 6, "About to Sleep": 4, "At Risk": 2,
        "New Customers": 1, "Cannot Lose Them": 1, "Others": 1}
