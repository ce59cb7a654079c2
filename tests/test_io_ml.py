"""Sources, sinks and the random-forest pipeline."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerlight.operators import ml as ML
from ledgerlight.operators import sales as S
from ledgerlight.sinks import writers as W
from ledgerlight.sources import readers as R
from ledgerlight.sources import tables as T


def test_incremental_is_strict_and_pushed(spark):
    o = T.read(spark, SMALL, "orders")
    last = o.agg(F.max("o_orderdate")).first()[0]
    assert R.incremental(o, "o_orderdate", last).count() == 0
    assert R.incremental(o, "o_orderdate", None).count() == o.count()
    plan = R.incremental(o, "o_orderdate", "2001-07-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan


def test_chunked_and_pages_cover_all_rows_once(spark):
    o = T.read(spark, SMALL, "orders")
    n = o.count()
    assert R.chunked(o, "o_orderkey", 4).count() == n
    pages = [R.page(o, "o_orderkey", k, 500) for k in range(0, n, 500)]
    keys = [r.o_orderkey for p in pages for r in p.select("o_orderkey").collect()]
    assert len(keys) == n and len(set(keys)) == n


def test_month_partition_read_prunes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    W.write_month_partitioned(T.metrics_events(spark, SMALL), path)
    assert sorted(os.listdir(path))[0].startswith("created_month=2024-01")
    df = W.read_month_range(spark, path, dt.date(2024, 1, 8), dt.date(2024, 1, 22))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "created_month" in plan


def test_fact_load_overwrites_only_its_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    ss = T.staging_sales(spark, SMALL)
    W.load_fact_sales(ss, path)
    total = spark.read.parquet(path).count()
    july = ss.filter(F.date_format("order_date", "yyyy-MM") == "2001-07")
    W.load_fact_sales(july, path)                     # re-load one month
    assert spark.read.parquet(path).count() == total  # other months untouched, July not doubled


def test_newest_per_key(spark):
    rows = [(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "z", 1)]
    df = spark.createDataFrame(rows, "k int, v string, t int")
    got = {r.k: r.v for r in W.newest_per_key(df, ["k"], ["t"]).collect()}
    assert got == {1: "b", 2: "z"}


def test_typed_table_append_and_unique_key(spark, tmp_dir):
    name = "ml_features_t"
    W.create_typed_table(spark, W.ML_FEATURES_DDL, name=name, location=os.path.join(tmp_dir, "mlf"))
    W.create_typed_table(spark, W.ML_FEATURES_DDL, name=name, location=os.path.join(tmp_dir, "mlf"))  # idempotent
    long = spark.createDataFrame([("1", "recency_zscore", 0.1234567, "numerical")],
                                 "customer_id string, feature_name string, feature_value double, feature_type string")
    W.append_features(long, name, dt.datetime(2001, 8, 2))
    W.append_features(long, name, dt.datetime(2001, 8, 3))
    t = spark.table(name)
    assert t.count() == 2
    assert str(t.schema["feature_value"].dataType) == "DecimalType(15,6)"
    assert float(t.first().feature_value) == pytest.approx(0.123457)
    assert t.groupBy("customer_id", "feature_name", "created_at").count().filter("count > 1").count() == 0
    spark.sql(f"INSERT INTO {name} (id, customer_id, feature_name, feature_value, feature_type) "
              "VALUES (7, '2', 'frequency_zscore', 1.5, 'numerical')")
    assert spark.table(name).filter("customer_id = '2'").first().created_at is not None   # DEFAULT applied


def test_csv_and_landed_json(spark, tmp_dir):
    c = T.read(spark, SMALL, "customer")
    c.write.option("header", "true").csv(os.path.join(tmp_dir, "c"))
    back = R.load_csv(spark, os.path.join(tmp_dir, "c"), c.schema)
    assert back.exceptAll(c).count() == 0
    with open(os.path.join(tmp_dir, "bad.json"), "w") as f:
        f.write('{"event_id": 1, "value": 2.5}\n{bad\n')
    from ledgerlight.plans.io_queries import EVENT_SCHEMA
    j = R.load_json_landed(spark, os.path.join(tmp_dir, "bad.json"), EVENT_SCHEMA).cache()
    assert j.count() == 2 and j.filter(F.col("_corrupt_record").isNotNull()).count() == 1


def test_report_file_name_and_format(spark, tmp_dir):
    summary = S.sales_summary(T.staging_sales(spark, SMALL), "2001-08-02")
    rep = W.daily_sales_report(summary)
    target = W.write_report(rep, tmp_dir, "daily_sales_report", "2001-08-02")
    assert target.endswith("daily_sales_report_2001-08-02")
    first = rep.first()
    assert first.total_revenue.startswith("$") and first.completion_rate.endswith("%")
    assert len(first.sales_date) == 10


def test_split_is_stable_and_eighty_twenty(spark):
    df = T.training_frame(spark, SMALL)
    a, b = ML.prepare_data(df, F.col("row_key"))
    a2, _ = ML.prepare_data(df.repartition(7), F.col("row_key"))
    assert a.count() + b.count() == df.count()
    assert 0.77 < a.count() / df.count() < 0.83
    assert a.select("row_key").exceptAll(a2.select("row_key")).count() == 0


def test_forest_learns_planted_signal_and_round_trips(spark, tmp_dir):
    df = T.training_frame(spark, SMALL)
    train, test = ML.prepare_data(df, F.col("row_key"))
    feats = ["quantity", "discount", "tax"]
    model = ML.train_model(train, feats)
    assert model.stages[-1].getNumTrees == ML.NUM_TREES
    ev = ML.evaluate_model(ML.predict(model, test)).first()
    assert ev.r2_score > 0.9 and ev.mse > 0
    imp = {r.feature: r.importance for r in ML.feature_importance(model, feats).collect()}
    assert imp["quantity"] > imp["tax"] and sum(imp.values()) == pytest.approx(1.0)
    path = os.path.join(tmp_dir, "model")
    ML.save_model(model, path)
    again = PipelineModel.load(path)
    p1 = ML.predict(model, test).select("row_key", "prediction")
    p2 = ML.predict(again, test).select("row_key", "prediction")
    assert p1.exceptAll(p2).count() == 0


def test_training_rows_are_spread_evenly_whatever_the_files(spark):
    """One partition (a file of one row group) holds all rows, with one key and null features among them."""
    from collections import Counter

    rows = spark.range(0, 120_000, 1, 1).selectExpr("'same' as row_key", "if(id % 7 = 0, null, double(id % 50)) as quantity", "0.5D as discount", "double(id) as target")
    dealt = ML.spread(rows, ["quantity", "discount", "target"], ["quantity", "discount"])
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 3 and max(sizes) < 1.01 * min(sizes)
    assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, rows.drop("row_key").collect()))
    few = rows.limit(100)
    assert ML.spread(few, ["quantity", "target"], ["quantity"]).rdd.getNumPartitions() == few.rdd.getNumPartitions()
