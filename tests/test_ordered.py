"""Range-sliced order operators against brute force (Spark's own single-task forms)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.operators.ordered import exact_percentiles, neighbors, running_max


def skewed_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot group with about a third of the rows, many ties, some NULLs
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 9)}"
        v = None if rnd.random() < 0.02 else float(rnd.randint(0, 200)) / 4
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_exact_percentiles_match_builtin(spark):
    df = skewed_frame(spark)
    got = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0})
    want = df.groupBy("g").agg(F.count("v").alias("n"),
                               F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.95).alias("p95"),
                               F.min("v").alias("p0"), F.max("v").alias("p100"))
    g = {r.g: r for r in got.collect()}
    w = {r.g: r for r in want.collect()}
    assert g.keys() == w.keys()
    for k in w:
        assert g[k].n == w[k].n
        for c in ("p50", "p95", "p0", "p100"):
            assert g[k][c] == pytest.approx(w[k][c], abs=1e-9), (k, c)


def test_exact_percentiles_null_group_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    got = {r.g: r.p50 for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()}
    assert got == {None: 2.0, "a": 2.0}


@pytest.mark.parametrize("bits", [0, 5, 40])
def test_neighbors_match_window(spark, bits):
    df = skewed_frame(spark).fillna({"v": -1.0})
    got = neighbors(df, ["g"], ["id"], F.shiftright("id", bits), "v", "p", "n")
    w = Window.partitionBy("g").orderBy("id")
    want = df.select("id", F.lag("v").over(w).alias("wp"), F.lead("v").over(w).alias("wn"))
    bad = got.join(want, "id").filter(~F.col("p").eqNullSafe(F.col("wp")) | ~F.col("n").eqNullSafe(F.col("wn")))
    assert bad.count() == 0
    assert got.count() == df.count()


def test_running_max_matches_window(spark):
    df = skewed_frame(spark).withColumn("s", F.when(F.col("id") % 7 == 0, F.col("id")))
    got = running_max(df, ["g"], ["id"], F.shiftright("id", 5), "s", "rm")
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.max("s").over(w).alias("wm"))
    bad = got.join(want, "id").filter(~F.col("rm").eqNullSafe(F.col("wm")))
    assert bad.count() == 0


def test_neighbors_keep_null_values_at_slice_edges(spark):
    df = spark.createDataFrame([(i, "a", None if i % 3 == 0 else float(i)) for i in range(60)], "id long, g string, v double")
    got = neighbors(df, ["g"], ["id"], F.shiftright("id", 2), "v", "p", "n")
    assert {r.id: (r.p, r.n) for r in got.collect()} == {
        i: (None if i == 0 or (i - 1) % 3 == 0 else float(i - 1), None if i == 59 or (i + 1) % 3 == 0 else float(i + 1)) for i in range(60)}


def test_percentiles_of_extreme_values(spark):
    values = [-1e300, -1.0, -1e-300, -0.0, 0.0, 1e-310, 1.0, 1.0 + 2**-52, 1e13, 5e14, 1e300, float("inf")]
    df = spark.createDataFrame([("a", v) for v in values * 3] + [("b", float("nan")), ("b", 2.0), ("b", 3.0)], "g string, v double")
    probs = {f"q{i}": i / 35 for i in range(36)}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    ranked = sorted(values * 3)
    for i in range(36):
        pos = i / 35 * 35
        low, high = ranked[int(pos)], ranked[-int(-pos // 1)]
        assert got["a"][f"q{i}"] == (low if low == high else pytest.approx(low + (pos - int(pos)) * (high - low)))
    assert got["b"].q0 == 2.0 and got["b"].n == 3 and str(got["b"].q35) == "nan"


def test_plans_run_no_job_while_they_are_built(spark):
    from ledgerlight.operators.metrics import metric_stats, metric_summary_advanced
    from ledgerlight.sources import tables
    from ledgerlight.streaming.sessions import debounce
    m = tables.metrics_events(spark, "/root/testdata/sf0.001")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    spark.sparkContext.setJobGroup("planning", "plans only")
    metric_stats(m), metric_summary_advanced(m), debounce(ev, "user_id", "ts", "value", "30 minutes", tiebreak="event_id")
    spark.sparkContext.setJobGroup("other", "")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")


def test_rows_of_one_day_grained_time_are_not_one_task(spark):
    """A category whose rows all carry one midnight: lag and lead as by one window, in many slices."""
    from ledgerlight.operators.ordered import tie_slice, value_cell
    rng = random.Random(3)
    rows = {("hot", rng.choice("abc"), rng.choice([None, float(rng.randrange(-500, 500)), rng.random()])) for _ in range(3000)}
    day = "2024-01-05 00:00:00"
    df = spark.createDataFrame([(c, day, s, v) for c, s, v in rows] + [("x", "2024-01-05 00:01:00.5", "a", float(i)) for i in range(5)] + [("hot", "2024-01-05 00:00:00.25", "a", 7.0)],
                               "category string, t string, subcategory string, v double").withColumn("created_at", F.col("t").cast("timestamp_ntz")).drop("t")
    levels = tie_slice("created_at", F.col("subcategory").alias("s"), value_cell("v").alias("c"))
    sizes = [r["count"] for r in df.groupBy("category", levels).count().collect()]
    assert max(sizes) < 0.2 * len(rows) and len(sizes) > 500
    order = ["created_at", "subcategory", "v"]
    got = neighbors(df, ["category"], order, levels, "v", "p", "n")
    w = Window.partitionBy("category").orderBy(*order)
    want = df.select("*", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_percentiles_of_values_that_lie_close_together(spark):
    """All values of a group in one cell: the later rounds tell them apart."""
    rng = random.Random(8)
    values = [1e9 + rng.random() for _ in range(4000)] + [-1e9 - rng.random() * 1e-3 for _ in range(500)]
    df = spark.createDataFrame([(None, v) for v in values], "g string, v double")
    probs = {f"q{i}": i / 50 for i in range(51)}
    names = {"avg": "a", "max": "hi", "min": "lo", "sum": "s", "stddev": "sd", "variance": "var"}
    got = exact_percentiles(df, ["g"], "v", probs, names).first()
    want = df.agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()], F.avg("v").alias("a"), F.max("v").alias("hi"), F.min("v").alias("lo"),
                  F.sum("v").alias("s"), F.stddev_samp("v").alias("sd"), F.var_samp("v").alias("var")).first()
    assert got.n == len(values)
    for name in [*probs, *names.values()]:
        assert got[name] == pytest.approx(want[name], rel=1e-12), name


def test_moments_keep_a_small_variance_beside_a_large_mean(spark):
    df = spark.createDataFrame([(1e9 + i % 2,) for i in range(1000)] + [(None,)], "v double")
    got = exact_percentiles(df, [], "v", {"m": 0.5}, {"variance": "var", "stddev": "sd"}).first()
    assert got["var"] == pytest.approx(250 / 999, rel=1e-5) and got.m == 1e9 + 0.5
    one = exact_percentiles(df.limit(1), [], "v", {"m": 0.5}, {"variance": "var"}).first()
    assert one["var"] is None and one.n == 1
