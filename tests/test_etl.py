"""The composed daily run and the command line."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerlight.plans import etl
from ledgerlight.plans.etl import daily_etl
from ledgerlight.sinks import versioned as V
from ledgerlight.sources import tables as T


def test_daily_etl_outputs_are_complete_and_rerunnable(spark, tmp_dir):
    target = os.path.join(tmp_dir, "warehouse")
    for _ in range(2):                      # a repeated run replaces, it does not duplicate
        out = daily_etl(spark, SMALL, target, "2001-08-02")
    n = T.staging_sales(spark, SMALL).count()
    staged = out.read("fact_sales")
    assert staged.count() == n
    assert staged.drop("order_month").exceptAll(T.staging_sales(spark, SMALL)).count() == 0
    assert out.read("dim_customers").count() == T.read(spark, SMALL, "customer").count()
    assert out.read("dim_products").count() == T.read(spark, SMALL, "part").count()
    assert out.read("daily_reports").count() == out.read("sales_summary").count() > 0
    q = out.read("quality").first()
    recent = T.staging_sales(spark, SMALL).filter("order_date >= timestamp_ntz'2001-07-01 00:00:00'").count()
    assert q.total_rows == q.valid_rows == recent  # the second run extracts whole months only
    reports = sorted(os.listdir(out.reports))
    assert reports == ["customer_analysis_report_2001-08-02", "daily_sales_report_2001-08-02"]
    assert out.read("fact_sales", lambda month: month >= "2001-07").count() == recent


TEXT = ", ".join(f"{c} string" for c in T.SALES_TYPES)


def landing(rows):
    """An extract of rows (id, date, value); text that is no date lies in the extract, no text at all is undated."""
    def extract(spark, _, first, mark):
        frame = spark.createDataFrame([(str(i), "1", "2", d, v, "3", "0.5", "completed") for i, d, v in rows], TEXT)
        if first is None:
            return frame
        undated = F.col("order_date").isNull() & (F.col("order_id").cast("bigint") > (-1 if mark is None else mark))
        return frame.filter((F.coalesce(F.col("order_date").try_cast("date"), F.current_date()) >= F.lit(first)) & F.col("order_date").isNotNull() | undated)
    return extract


def loaded(out):
    return sorted((r.order_id, r.order_date and r.order_date.strftime("%Y-%m-%d"), r.order_month) for r in out.read("fact_sales").collect())


def test_daily_etl_follows_changes_of_the_source(spark, tmp_dir):
    """A moved row, a deleted row, a month whose rows all become invalid, and an old month that stays."""
    target = os.path.join(tmp_dir, "warehouse")
    rows = [(1, "2001-03-05", "10"), (2, "2001-07-05", "10"), (3, "2001-07-20", "10"), (4, "2001-08-01", "10"), (5, "bad", "10"), (6, "2001-08-01", "-4")]
    out = daily_etl(spark, SMALL, target, "2001-08-02", extract=landing(rows))
    assert loaded(out) == [(1, "2001-03-05", "2001-03"), (2, "2001-07-05", "2001-07"), (3, "2001-07-20", "2001-07"), (4, "2001-08-01", "2001-08")]
    assert out.quarantine().count() == 2
    rows = [(1, "2001-03-05", "99"), (2, "2001-08-01", "10"), (4, "2001-08-01", "10"), (3, "2001-07-20", "none")]
    out = daily_etl(spark, SMALL, target, "2001-08-03", extract=landing(rows))
    assert loaded(out) == [(1, "2001-03-05", "2001-03"), (2, "2001-08-01", "2001-08"), (4, "2001-08-01", "2001-08")]
    assert [(r.order_id, r.dq_reasons) for r in out.quarantine().filter("run_date = '2001-08-03'").collect()] == [("3", "type_order_value")]
    assert out.quarantine().count() == 3


def test_undated_rows_come_once_whatever_is_repeated(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "warehouse")
    rows = [(1, None, "10"), (2, None, "-1"), (3, "2001-08-01", "10")]
    daily_etl(spark, SMALL, target, "2001-08-02", extract=landing(rows))
    rows += [(8, None, "20"), (9, None, "x")]

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:                 # the mark of a run that did not commit is not kept
        m.setattr(etl.V, "commit", killed)
        with pytest.raises(RuntimeError):
            daily_etl(spark, SMALL, target, "2001-08-03", extract=landing(rows))
    for _ in range(2):
        out = daily_etl(spark, SMALL, target, "2001-08-03", extract=landing(rows))
    assert loaded(out) == [(1, None, None), (3, "2001-08-01", "2001-08"), (8, None, None)]
    assert sorted((r.order_id, r.run_date) for r in out.quarantine().collect()) == [("2", "2001-08-02"), ("9", "2001-08-03")]
    assert out.manifest.marks == {"order_id": 9}


def test_extract_pushes_its_bounds_and_reads_the_lines_once(spark, tmp_dir):
    import datetime as dt
    landed = T.staging_sales_text(spark, SMALL, dt.date(2001, 7, 1), 5)
    plan = etl.dealt_sales(landed)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and sum("l_orderkey" in s for s in scans) == 1
    orders, = [s for s in scans if "o_orderdate" in s]
    pushed = orders[orders.index("PushedFilters"):]
    assert "[Or(GreaterThanOrEqual(o_orderdate,2001-07-01T00:00),And(IsNull(o_orderdate),GreaterThan(o_order" in pushed


STEPS = ["newest_per_key", "commit"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_dies_leaves_the_old_tables(spark, tmp_dir, monkeypatch, step):
    target = os.path.join(tmp_dir, "warehouse")
    old = daily_etl(spark, SMALL, target, "2001-08-02", extract=landing([(1, "2001-07-05", "10"), (2, "2001-08-01", "10")]))
    where = etl.W if step == "newest_per_key" else etl.V

    def dies(*args, **kwargs):
        raise RuntimeError("killed")

    rows = [(2, "2001-08-01", "30"), (3, "2001-08-02", "10")]
    with monkeypatch.context() as m:
        m.setattr(where, step, dies)
        with pytest.raises(RuntimeError, match="killed"):
            daily_etl(spark, SMALL, target, "2001-08-03", extract=landing(rows))
    now = etl.Warehouse(spark, target, V.current(spark, target))
    assert now.manifest == old.manifest and loaded(now) == [(1, "2001-07-05", "2001-07"), (2, "2001-08-01", "2001-08")]
    new = daily_etl(spark, SMALL, target, "2001-08-03", extract=landing(rows))
    assert loaded(new) == [(2, "2001-08-01", "2001-08"), (3, "2001-08-02", "2001-08")]
    assert loaded(old) == [(1, "2001-07-05", "2001-07"), (2, "2001-08-01", "2001-08")]  # a reader of the old version goes on
    gone = V.vacuum(spark, target, keep=1)
    assert len(gone) == 1 and loaded(new) == loaded(etl.Warehouse(spark, target, V.current(spark, target)))


def test_of_two_runs_from_one_manifest_one_commits(spark, tmp_dir):
    base = V.current(spark, tmp_dir)
    first = V.commit(spark, tmp_dir, base.marking(k=1))
    with pytest.raises(V.CommitConflict):
        V.commit(spark, tmp_dir, base.marking(k=2))
    assert V.current(spark, tmp_dir) == first and first.version == 1
    assert V.current(spark, os.path.join(tmp_dir, "nowhere")) == V.Manifest()


def test_nothing_landed(spark, tmp_dir):
    out = daily_etl(spark, SMALL, os.path.join(tmp_dir, "warehouse"), "2001-08-02", extract=landing([]))
    assert loaded(out) == [] and out.quarantine().count() == 0 and out.read("quality").first().total_rows == 0


def test_dimensions_keep_the_newest_version(spark, tmp_dir):
    from ledgerlight.sinks import writers as W
    rows = [(1, "Zoe", "2020-01-01"), (1, "Amy", "2024-01-01"), (2, "Ann", None), (2, "Bea", "2019-01-01"), (3, "Cid", "2021-01-01"), (3, "Dan", "2021-01-01")]
    df = spark.createDataFrame(rows, "customer_id int, first_name string, d string").withColumn("registration_date", F.col("d").cast("timestamp_ntz")).drop("d")
    path = os.path.join(tmp_dir, "dim")
    W.load_dimension(df, ["customer_id"], W.newest_order(df.drop("customer_id"), "registration_date"), path)
    assert {r.customer_id: r.first_name for r in spark.read.parquet(path).collect()} == {1: "Amy", 2: "Bea", 3: "Dan"}


def test_cli_lists_queries(capsys):
    from ledgerlight.__main__ import main
    assert main(["list"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert any(line.startswith("sales_summary\t") for line in lines) and len(lines) >= 70


def test_fields_are_parsed_once_and_dates_become_text_before_the_join(spark):
    """a formatted or parsed time costs more than the rest of a row."""
    dealt = etl.dealt_sales(T.staging_sales_raw(spark, SMALL))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString().splitlines()
    steps = "\n".join(line.split("Relation [")[0] for line in plan)
    for parse in (r"cast\(order_date#\d+ as timestamp_ntz\)", r"cast\(order_date#\d+ as timestamp\)", r"cast\(order_value#\d+ as double\)", r"date_format\("):
        assert len(re.findall(parse, steps)) == 1, parse
    join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    texts = [i for i, line in enumerate(plan) if "cast(o_orderdate" in line]
    assert len(texts) == 1 and texts[0] > join


def test_transforms_open_only_the_months_that_they_look_back_on(spark, tmp_dir, monkeypatch):
    """the run reads what its transforms need, however long the history."""
    opened, read = [], V.read

    def reads(spark, root, manifest, table, keys=lambda key: True):
        opened.append((table, sorted(k for k in manifest.folders[table] if keys(k))))
        return read(spark, root, manifest, table, keys)

    monkeypatch.setattr(etl.V, "read", reads)
    rows = [(1, "1999-03-05", "10"), (2, "2000-07-31", "10"), (3, "2000-08-02", "10"), (4, "2001-07-20", "10"), (5, "12345-01-01", "10"), (6, None, "10")]
    out = daily_etl(spark, SMALL, os.path.join(tmp_dir, "warehouse"), "2001-08-02", extract=landing(rows))
    odd = ["+12345-01", "undated 2001-08-02"]
    assert opened == [("fact_sales", [odd[0], "2000-08", "2001-07", odd[1]]), ("fact_sales", [odd[0], "2001-07", odd[1]]), ("fact_sales", [odd[0], "2001-07", odd[1]])]
    assert out.read("customer_analysis").agg(F.sum("total_orders")).first()[0] == 3  # 2000-08-02 is the first day, 12345 is later
    assert len(out.manifest.folders["fact_sales"]) == 6 and out.read("fact_sales").count() == 6
    assert etl.months_since(dt.date(2000, 8, 1))("2000-07")  # a time with an offset may lie in the month before


def test_month_of_day_is_the_formatted_month(spark):
    from ledgerlight.sinks import writers as W
    days = spark.sql("SELECT explode(array(date'0001-01-01', date'0987-10-31', date'1582-10-04', date'2001-02-28', date'9999-12-31', date'+12345-06-01', date'-0044-03-15', NULL)) AS d")
    found = days.select(W.month_of_day("d").alias("m"), W.month_key("d").alias("k")).collect()
    assert len(found) == 8 and all(r.m == r.k for r in found) and found[3].m == "2001-02"


def test_keys_are_the_folders_that_were_written(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "plain"), (2, "a:b/c%=d"), (3, None), (4, "plain")], "id int, k string")
    keys, facts = V.write_keyed(rows, tmp_dir, "runs/x", {"_odd": F.col("id") % 2 == 1, "_k": F.col("k")}, {"n": F.count(F.lit(1))})
    assert facts == {"n": 4}
    found = {(k["_odd"], k["_k"]): [r.id for r in spark.read.schema("id int").parquet(f"{tmp_dir}/{k['folder']}").collect()] for k in keys}
    assert found == {("true", "plain"): [1], ("false", "a:b/c%=d"): [2], ("true", None): [3], ("false", "plain"): [4]}
    assert V.write_keyed(rows.limit(0), tmp_dir, "runs/y", {"_k": F.col("k")}) == ([], {})
