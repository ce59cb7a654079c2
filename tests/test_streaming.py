"""Streaming operators: batch form equals the stream's closed output; failures stay isolated."""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import functions as F

import pytest

from conftest import SMALL
from ledgerlight.plans.stream_queries import EVENT_FIELDS, message_log
from ledgerlight.sources import tables as T
from ledgerlight.streaming import messages as MSG
from ledgerlight.streaming.sessions import debounce, debounce_stream


def test_debounce_batch_fixture_count(spark):
    """FIXTURES.md: 946 sessions at sf0.001 with a 30-minute gap."""
    ev = T.events(spark, SMALL)
    got = debounce(ev, "user_id", "ts", "value", "30 minutes", tiebreak="event_id")
    assert got.count() == 946
    assert got.agg(F.sum("n_events")).first()[0] == ev.count()


def test_debounce_sessions_do_not_depend_on_the_block_size(spark, monkeypatch):
    from ledgerlight.streaming import sessions
    ev = T.events(spark, SMALL)
    want = debounce(ev, "user_id", "ts", "value", "2 days", tiebreak="event_id")
    monkeypatch.setattr(sessions, "SLICE_BUCKETS", 2)
    got = debounce(ev, "user_id", "ts", "value", "2 days", tiebreak="event_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("day", [dt.datetime(1969, 12, 31), dt.datetime(2020, 12, 31)])
def test_debounce_splits_a_pause_around_the_epoch_as_elsewhere(spark, day):
    at = [day.replace(hour=23, minute=35), day.replace(hour=23, minute=50), day + dt.timedelta(days=1, minutes=25)]
    ev = spark.createDataFrame([(1, t, float(i)) for i, t in enumerate(at)], "user_id int, ts timestamp_ntz, value double")
    got = sorted((r.session_start, r.n_events, r.last_value) for r in debounce(ev, "user_id", "ts", "value", "30 minutes").collect())
    assert got == [(at[0], 2, 1.0), (at[2], 1, 2.0)]


def test_debounce_stream_equals_batch_on_closed_sessions(spark, tmp_dir):
    ev = T.events(spark, SMALL)
    src = os.path.join(tmp_dir, "events")
    # Land the events as four files in time order, one after another (an
    # append-only landing zone), so event time never goes back between batches.
    bounds = [dt.datetime(2024, 1, d) for d in (8, 16, 24)]
    edges = [None] + bounds + [None]
    for lo, hi in zip(edges, edges[1:]):
        part = ev
        if lo is not None:
            part = part.filter(F.col("ts") >= F.lit(lo))
        if hi is not None:
            part = part.filter(F.col("ts") < F.lit(hi))
        part.coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (debounce_stream(stream, "user_id", "ts", "value", "30 minutes", "0 seconds", tiebreak="event_id")
         .writeStream.outputMode("append").format("memory").queryName("debounced")
         .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    streamed = spark.table("debounced")
    batch = debounce(ev, "user_id", "ts", "value", "30 minutes", tiebreak="event_id")
    # A session is closed once the watermark (max event time seen) passes its end.
    wm = ev.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("session_end") <= F.lit(wm))
    cols = ["user_id", "session_start", "session_end", "last_ts", "last_value", "n_events"]
    assert streamed.select(cols).exceptAll(closed.select(cols)).count() == 0
    assert closed.select(cols).exceptAll(streamed.select(cols)).count() == 0
    assert closed.count() >= 940


def test_parse_sends_bad_json_to_dead_letter(spark):
    parsed, dead = MSG.parse_messages(message_log(spark, SMALL), EVENT_FIELDS)
    ev = T.events(spark, SMALL)
    errors = ev.filter(F.col("event_type") == "error").count()
    assert dead.count() == errors
    assert parsed.exceptAll(ev).count() == 0 and ev.exceptAll(parsed).count() == 0


def test_parse_on_a_stream_with_dead_letter(spark, tmp_dir):
    lines = os.path.join(tmp_dir, "lines")
    message_log(spark, SMALL).write.text(lines)
    raw = spark.readStream.format("text").load(lines)
    parsed, dead = MSG.parse_messages(raw, EVENT_FIELDS)
    q1 = parsed.writeStream.format("memory").queryName("parsed_ok") \
        .option("checkpointLocation", os.path.join(tmp_dir, "c1")).start()
    q2 = dead.writeStream.format("memory").queryName("parsed_bad") \
        .option("checkpointLocation", os.path.join(tmp_dir, "c2")).start()
    for q in (q1, q2):
        q.processAllAvailable()
        q.stop()
    assert spark.table("parsed_ok").count() == T.events(spark, SMALL).count()
    assert spark.table("parsed_bad").count() > 0


def test_fan_out_isolates_failing_handler(spark, tmp_dir):
    seen = []

    def good(df, epoch):
        seen.append((epoch, df.count()))

    def broken(df, epoch):
        raise RuntimeError("listener failed")

    def also_good(df, epoch):
        seen.append(("second", epoch))

    run = MSG.fan_out([good, broken, also_good])
    src = os.path.join(tmp_dir, "ev")
    T.events(spark, SMALL).write.parquet(src)
    stream = spark.readStream.schema(T.events(spark, SMALL).schema).parquet(src)
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(tmp_dir, "c")).start()
    q.processAllAvailable()
    q.stop()
    assert seen and seen[0][1] == T.events(spark, SMALL).count()
    assert ("second", 0) in seen
    assert run.errors and run.errors[0][1] == "broken"


def test_status_listener_reports_lifecycle(spark, tmp_dir):
    listener = MSG.StatusListener()
    spark.streams.addListener(listener)
    try:
        src = os.path.join(tmp_dir, "ev")
        T.events(spark, SMALL).write.parquet(src)
        stream = spark.readStream.schema(T.events(spark, SMALL).schema).parquet(src)
        q = stream.writeStream.format("noop").option("checkpointLocation", os.path.join(tmp_dir, "c")).start()
        q.processAllAvailable()
        q.stop()
        deadline = time.time() + 20
        while time.time() < deadline and "disconnected" not in [k for k, _ in listener.events]:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    kinds = [k for k, _ in listener.events]
    assert kinds[0] == "connected" and "progress" in kinds and kinds[-1] == "disconnected"


def test_kpi_windows_stream_update_mode(spark, tmp_dir):
    ev = T.events(spark, SMALL)
    src = os.path.join(tmp_dir, "ev")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = (MSG.kpi_windows(stream, watermark="1 hour").writeStream.outputMode("update").format("memory")
         .queryName("kpis").trigger(processingTime=MSG.KPI_REFRESH)
         .option("checkpointLocation", os.path.join(tmp_dir, "c")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("kpis").select("event_type", "events")
    batch = MSG.kpi_windows(ev).select("event_type", "events")
    assert got.agg(F.sum("events")).first()[0] == batch.agg(F.sum("events")).first()[0]


def test_json_out_round_trip(spark):
    ev = T.events(spark, SMALL)
    msgs = MSG.to_json_messages(ev)
    back = msgs.select(F.from_json("value", EVENT_FIELDS, MSG.JSON_OPTIONS).alias("m")).select("m.*")
    assert back.exceptAll(ev).count() == 0


def test_enrich_points_columns(spark):
    df = spark.createDataFrame([(2.0, "2024-01-01 00:00:00")], "value double, timestamp string")
    r = MSG.enrich_points(df, seed=1).first()
    assert 0 <= r.calculatedValue <= 200 and r.timestamp.year == 2024


def test_message_job_restarts_without_loss_or_repeats(spark, tmp_dir):
    from ledgerlight.streaming.jobs import dead_letters, landed_messages, message_stream_job
    log = message_log(spark, SMALL)
    first = log.filter(F.col("value").contains('"event_type":"view"'))
    rest = log.filter(~F.col("value").contains('"event_type":"view"'))
    src, out, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "out", "ckpt"))
    first.write.text(os.path.join(src, "part1"))
    seen = []
    message_stream_job(spark, src + "/*", EVENT_FIELDS, out, ckpt, handlers=[lambda df, e: seen.append(df.count())]).awaitTermination()
    rest.write.text(os.path.join(src, "part2"))
    message_stream_job(spark, src + "/*", EVENT_FIELDS, out, ckpt).awaitTermination()   # restart, same checkpoint
    ev = T.events(spark, SMALL)
    got = landed_messages(spark, out, EVENT_FIELDS)
    assert got.count() == ev.count()
    assert got.exceptAll(ev).count() == 0 and ev.exceptAll(got).count() == 0
    assert dead_letters(spark, out, EVENT_FIELDS).count() == ev.filter(F.col("event_type") == "error").count()
    assert sum(seen) == first.count()


def test_a_replayed_message_batch_changes_nothing(spark, tmp_dir):
    """The same batch given twice under one id, as after a failure between the write and the checkpoint."""
    from ledgerlight.streaming import jobs
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    message_log(spark, SMALL).write.text(src)
    taken, broken = [], [True]

    def steady(df, epoch):
        taken.append((epoch, df.count()))

    def flaky(df, epoch):
        if broken.pop():
            raise RuntimeError("down")
        taken.append(("flaky", epoch))

    def run(checkpoint):
        q = jobs.message_stream_job(spark, src, EVENT_FIELDS, out, os.path.join(tmp_dir, checkpoint), handlers=[steady, flaky])
        q.awaitTermination()
        return q

    broken.insert(0, False)
    first = run("c1")
    files = sorted(os.listdir(os.path.join(out, "epoch=0", "ok=true")))
    again = run("c2")               # a new checkpoint replays batch 0
    assert first.error_counts == {"flaky": 1} and not again.error_counts
    n = T.events(spark, SMALL).count()
    assert taken == [(0, n), ("flaky", 0)]
    assert sorted(os.listdir(os.path.join(out, "epoch=0", "ok=true"))) == files
    assert jobs.landed_messages(spark, out, EVENT_FIELDS).count() == n


def test_message_job_reads_its_source_once(spark, tmp_dir):
    from ledgerlight.streaming import jobs
    src = os.path.join(tmp_dir, "src")
    log = message_log(spark, SMALL)
    log.write.text(src)
    q = jobs.message_stream_job(spark, src, EVENT_FIELDS, os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"), handlers=[lambda df, e: df.count()])
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == log.count()


def test_debounce_job_writes_closed_sessions(spark, tmp_dir):
    from ledgerlight.streaming.jobs import debounce_stream_job
    ev = T.events(spark, SMALL)
    src = os.path.join(tmp_dir, "ev")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = debounce_stream_job(stream, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"), watermark="0 seconds")
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    wm = ev.agg(F.max("ts")).first()[0]
    batch = debounce(ev, "user_id", "ts", "value", "30 minutes", tiebreak="event_id")
    assert out.count() == batch.filter(F.col("session_end") <= F.lit(wm)).count()


def test_dead_letter_reasons(spark):
    rows = [('{"event_id": 1, "value": 2.5}',), ("{bad",), ('{"event_id": "x"}',), (None,), ("",), (" \t",),
            ('{"event_id": 2} trailing',), ('{"event_id": 3}, {"event_id": 4}',), (' {"event_id": 5} ',)]
    raw = spark.createDataFrame(rows, "value string")
    parsed, dead = MSG.parse_messages(raw, EVENT_FIELDS)
    assert sorted(r.event_id for r in parsed.collect()) == [1, 5]
    assert sorted(r.error for r in dead.collect()) == ["empty message"] * 3 + ["malformed JSON"] * 3 + ["schema mismatch"]


def test_kept_notices_are_bounded():
    listener = MSG.StatusListener()
    for i in range(3 * MSG.NOTICES):
        listener._emit("progress", {"batch": i})
    assert len(listener.events) == MSG.NOTICES and listener.counts["progress"] == 3 * MSG.NOTICES


def test_kpi_stream_refreshes_a_table(spark, tmp_dir):
    from ledgerlight.streaming.jobs import kpi_stream_job, latest_kpis
    ev = T.events(spark, SMALL)
    src, out = os.path.join(tmp_dir, "ev"), os.path.join(tmp_dir, "kpi")
    for part in ev.randomSplit([0.5, 0.5], 1):
        part.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    kpi_stream_job(stream, out, os.path.join(tmp_dir, "c"), watermark="60 days", trigger={"availableNow": True}).awaitTermination(120)
    got = latest_kpis(spark, out)
    want = MSG.kpi_windows(ev.withColumn("ts", F.col("ts").cast("timestamp")))
    cols = ["window_start", "event_type", "events", "max_value"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and want.select(cols).exceptAll(got.select(cols)).count() == 0


def test_status_listener_reports_failure(spark, tmp_dir):
    from pyspark.errors import StreamingQueryException

    listener = MSG.StatusListener()
    spark.streams.addListener(listener)
    try:
        src = os.path.join(tmp_dir, "ev")
        T.events(spark, SMALL).write.parquet(src)
        stream = spark.readStream.schema(T.events(spark, SMALL).schema).parquet(src)

        def explode(df, epoch):
            raise RuntimeError("sink down")

        q = stream.writeStream.foreachBatch(explode).option("checkpointLocation", os.path.join(tmp_dir, "c")).start()
        try:
            q.awaitTermination(60)
        except StreamingQueryException:
            pass
        deadline = time.time() + 20
        while time.time() < deadline and "disconnected" not in [k for k, _ in listener.events]:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    kinds = [k for k, _ in listener.events]
    assert "error" in kinds and kinds[-1] == "disconnected"


def test_kpi_files_stay_as_few_as_the_days_need(spark, tmp_dir):
    """Many refreshes of the same windows, some replayed: newest rows, and no more files than after the first ones."""
    from ledgerlight.streaming.jobs import latest_kpis, upsert_kpis
    root = os.path.join(tmp_dir, "kpi")
    counts = []
    for epoch in range(9):
        rows = [(dt.datetime(2024, 1, 1 + d, h), dt.datetime(2024, 1, 1 + d, h + 1), "view", epoch + 1, float(epoch), 1.0) for d in range(2) for h in range(3)]
        batch = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, event_type string, events long, total_value double, max_value double")
        upsert_kpis(batch, root, epoch)
        if epoch == 4:
            upsert_kpis(batch.withColumn("events", F.lit(99).cast("long")), root, 3)
        counts.append(sum(len(f) for _, _, f in os.walk(os.path.join(root, "runs"))))
    assert max(counts[2:]) <= counts[1] and len(os.listdir(os.path.join(root, "runs"))) <= 2
    got = latest_kpis(spark, root)
    assert got.count() == 6 and {r.events for r in got.collect()} == {9}


def test_debounce_with_timers_equals_batch(spark, tmp_dir):
    """Out-of-order batches with own state: closed sessions as in the batch form, one state row an open burst."""
    from ledgerlight.streaming.sessions import STATE_STORE, debounce_timers
    ev = T.events(spark, SMALL)
    src = os.path.join(tmp_dir, "events")
    last = ev.agg(F.max("ts")).first()[0]
    for k in range(3):
        ev.filter(F.pmod("event_id", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    end = spark.createDataFrame([(10**9, last + dt.timedelta(days=300), 10**6, "end", None, None)], ev.schema)
    end.coalesce(1).write.mode("append").parquet(src)
    spark.conf.set(*STATE_STORE)
    try:
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = (debounce_timers(stream, "user_id", "ts", "value", "30 minutes", "90 days", "event_id")
             .writeStream.outputMode("append").format("memory").queryName("timers").option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start())
        q.processAllAvailable()
        q.stop()
    finally:
        spark.conf.unset(STATE_STORE[0])
    cols = ["user_id", "session_start", "session_end", "last_ts", "last_value", "n_events"]
    got, want = spark.table("timers").select(cols), debounce(ev, "user_id", "ts", "value", "30 minutes", tiebreak="event_id").select(cols)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_debounce_timers_keep_one_row_for_a_hot_key(spark, tmp_dir):
    from ledgerlight.streaming.sessions import STATE_STORE, debounce_timers
    start = dt.datetime(2024, 1, 1)
    rows = [(1, start + dt.timedelta(milliseconds=50 * i), float(i), i) for i in range(4000)] + [(2, start + dt.timedelta(minutes=10), None, 5000)]
    src = os.path.join(tmp_dir, "ev")
    schema = "user_id long, ts timestamp_ntz, value double, event_id long"
    for lo in (0, 2000, 4000):
        spark.createDataFrame(rows[lo:lo + 2000], schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    spark.conf.set(*STATE_STORE)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = (debounce_timers(stream, "user_id", "ts", "value", "300 milliseconds", "0 seconds", "event_id")
             .writeStream.outputMode("append").format("memory").queryName("hot").option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start())
        q.processAllAvailable()
        states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        q.stop()
    finally:
        spark.conf.unset(STATE_STORE[0])
    got, = spark.table("hot").collect()
    assert (got.user_id, got.session_start, got.last_value, got.n_events) == (1, start, 3999.0, 4000)
    assert max(states) <= 12   # bursts, their count and timers of two keys, not events
