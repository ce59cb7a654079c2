"""Registered stream-operator queries in batch form (ST-01, ST-03..05, ST-07, PF-10).

Each streaming operator is a DataFrame function, so its batch run over the
events table is what the oracle checks; the streaming runs are covered by
tests/test_streaming.py.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..session import scratch_path
from ..sources import tables as T
from ..streaming import messages as MSG
from ..streaming.sessions import DEBOUNCE_DELAY, debounce
from .catalog import register

EVENT_FIELDS = T_.StructType([
    T_.StructField("event_id", T_.LongType()), T_.StructField("ts", T_.TimestampNTZType()),
    T_.StructField("user_id", T_.LongType()), T_.StructField("event_type", T_.StringType()),
    T_.StructField("value", T_.DoubleType()), T_.StructField("props", T_.StringType())])


def message_log(spark, sf_dir):
    """Events as a raw JSON message log, plus a cut-off copy of every 'error' event's message
    (a producer that failed mid-write)."""
    ev = T.events(spark, sf_dir)
    msgs = MSG.to_json_messages(ev)
    broken = MSG.to_json_messages(ev.filter(F.col("event_type") == "error")) \
        .select(F.expr("substring(value, 1, length(value) div 2)").alias("value"))
    return msgs.unionByName(broken)


_DEBOUNCE_SQL = """
WITH f AS (
    SELECT user_id, ts, value, event_id,
           CASE WHEN LAG(ts) OVER w IS NULL OR ts - LAG(ts) OVER w >= INTERVAL '{gap}' THEN 1 ELSE 0 END AS brk
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
s AS (
    SELECT *, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM f
)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL '{gap}' AS session_end, MAX(ts) AS last_ts,
       arg_max(value, (ts, event_id)) AS last_value, COUNT(*) AS n_events
FROM s GROUP BY user_id, sid"""


@register("debounce_events", ids=("ST-04",), doubles=["last_value"], sql=_DEBOUNCE_SQL.format(gap="30 minutes"))
def q_debounce_events(spark, sf_dir):
    """Per user, bursts of events separated by 30 minutes of quiet, with the last value of each."""
    return debounce(T.events(spark, sf_dir), "user_id", "ts", "value", "30 minutes", tiebreak="event_id")


@register("debounce_300ms", ids=("ST-04",), doubles=["last_value"], sql=_DEBOUNCE_SQL.format(gap=DEBOUNCE_DELAY))
def q_debounce_300ms(spark, sf_dir):
    """Per user, the last value of each burst with the component's own 300 ms debounce delay."""
    return debounce(T.events(spark, sf_dir), "user_id", "ts", "value", DEBOUNCE_DELAY, tiebreak="event_id")


@register("stream_parse", ids=("ST-01", "FN-14"), doubles=["value"], sql="SELECT * FROM events")
def q_stream_parse(spark, sf_dir):
    """Parsed messages of the log (the cut-off ones go to the dead letter)."""
    parsed, _ = MSG.parse_messages(message_log(spark, sf_dir), EVENT_FIELDS)
    return parsed


@register("stream_dead_letter", ids=("ST-01",), sql="""
SELECT event_id, 'malformed JSON' AS error, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY event_id""")
def q_stream_dead_letter(spark, sf_dir):
    """Messages that are not valid JSON, with the reason, counted by the event whose id they begin with."""
    _, dead = MSG.parse_messages(message_log(spark, sf_dir), EVENT_FIELDS)
    event = F.regexp_extract("raw_message", r'"event_id":(\d+)', 1).cast("bigint")
    return dead.groupBy(event.alias("event_id"), "error").agg(F.count("*").alias("n"))


@register("stream_json_out", ids=("ST-03", "FN-14"), doubles=["value"], sql="""
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text FROM events""")
def q_stream_json_out(spark, sf_dir):
    """Every event serialised as a JSON message, and the fields found in its text."""
    out = MSG.to_json_messages(T.events(spark, sf_dir))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return out.select(field("event_id").cast("bigint").alias("event_id"), field("user_id").cast("bigint").alias("user_id"),
                      field("event_type").alias("event_type"), field("value").cast("double").alias("value"),
                      field("props").alias("props"), field("ts").alias("ts_text"))


@register("stream_fanout", ids=("ST-02",), sql="""
SELECT 'all' AS handler, COUNT(*) AS rows, 0 AS failures FROM events
UNION ALL SELECT 'failing', 0, 1
UNION ALL SELECT 'purchases', COUNT(*) FILTER (WHERE event_type = 'purchase'), 0 FROM events""")
def q_stream_fanout(spark, sf_dir):
    """One micro-batch of all events delivered to three handlers, one of which fails: rows each has written."""
    path = scratch_path(spark, "fan-out")

    def all(batch, epoch_id):  # noqa: A001
        batch.write.mode("overwrite").parquet(f"{path}/handler=all/epoch={epoch_id}")

    def failing(batch, epoch_id):
        raise RuntimeError("handler down")

    def purchases(batch, epoch_id):
        batch.filter(F.col("event_type") == "purchase").write.mode("overwrite").parquet(f"{path}/handler=purchases/epoch={epoch_id}")

    handlers = [all, failing, purchases]
    run = MSG.fan_out(handlers)
    stream = spark.readStream.schema(T.events(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parquet*")
    stream.writeStream.foreachBatch(run).option("checkpointLocation", scratch_path(spark, "fan-out-progress")).trigger(availableNow=True).start().awaitTermination()
    failures = {name: run.error_counts[name] for name in ("all", "failing", "purchases")}
    names = spark.createDataFrame(list(failures.items()), "handler string, failures int")
    written = spark.read.parquet(path).groupBy("handler").agg(F.count("*").alias("rows"))
    return names.join(written, "handler", "left").select("handler", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "failures")


@register("stream_status", ids=("ST-06",), sql="""
SELECT 1 AS connected, COUNT(*) AS rows, 0 AS failed, 1 AS disconnected FROM events""")
def q_stream_status(spark, sf_dir):
    """Lifecycle notices of one streaming run over all events: their counts, and the rows they report."""
    listener = MSG.StatusListener()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(T.events(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parquet*")
        run = (stream.writeStream.foreachBatch(lambda batch, epoch: batch.write.format("noop").mode("overwrite").save())
               .option("checkpointLocation", scratch_path(spark, "status")).trigger(availableNow=True).start())
        run.awaitTermination()
        waited = 0
        while not listener.counts["disconnected"] and waited < 300:  # notices come from another thread
            time.sleep(0.1)
            waited += 1
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([(listener.counts["connected"], listener.rows, listener.counts["error"], listener.counts["disconnected"])],
                                 "connected int, rows bigint, failed int, disconnected int")


@register("stream_kpis", ids=("ST-05",), doubles=["total_value", "max_value"], sql="""
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       event_type, COUNT(*) AS events, SUM(value) AS total_value, MAX(value) AS max_value
FROM events GROUP BY 1, 2, 3""")
def q_stream_kpis(spark, sf_dir):
    """Hourly KPI windows per event type (batch form of the 30-second refreshed stream)."""
    return MSG.kpi_windows(T.events(spark, sf_dir))


@register("enrich_points", ids=("ST-07", "PF-10"), doubles=["value"], sql="""
SELECT event_id, user_id, event_type, value, props, ts AS timestamp, TRUE AS within_bounds FROM events""")
def q_enrich_points(spark, sf_dir):
    """Events with the parsed timestamp, and whether the random-scaled value lies between 0 and 100 times the value."""
    ev = T.events(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    points = MSG.enrich_points(ev, seed=42)
    share = F.col("calculatedValue") / F.nullif(F.col("value"), F.lit(0.0))
    return points.withColumn("within_bounds", F.coalesce((share >= 0) & (share < 100), F.col("value") == 0)).drop("calculatedValue")
