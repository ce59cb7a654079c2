"""Ready-to-run Structured Streaming jobs built from the stream operators.

Each job reads a stream once, applies the batch-tested DataFrame functions and
writes with a checkpoint, so a restart resumes from the last committed
offsets.  What a micro-batch writes is named by its id, so a batch that is
replayed after a failure changes nothing.

Sources: a landing folder of text / JSON-lines files works everywhere;
Kafka (``source_format="kafka"``) needs the Kafka connector on the cluster.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sinks import versioned as V
from .messages import KPI_REFRESH, NOTICES, guarded, kpi_windows, tag_messages
from .sessions import debounce_stream


def read_messages(spark: SparkSession, source: str, source_format: str = "text",
                  options: dict | None = None) -> DataFrame:
    """A stream of raw message text in column ``value``."""
    r = spark.readStream.format(source_format)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if source_format == "kafka":
        return r.load().selectExpr("CAST(value AS STRING) AS value")
    return r.load(source)


def message_stream_job(spark: SparkSession, source: str, schema: T.StructType, out_path: str, checkpoint: str,
                       handlers: Sequence[Callable[[DataFrame, int], None]] = (), source_format: str = "text",
                       options: dict | None = None, trigger: dict | None = None) -> StreamingQuery:
    """ST-01..03: parse messages, land good and bad ones, and give the good ones of each micro-batch to every handler.

    One query: a batch is read and parsed once and lands in ``epoch=<id>/ok=<true|false>`` below ``out_path``; see
    :func:`landed_messages` and :func:`dead_letters`.  Handlers read what has landed.  A batch that is replayed doesn't land again,
    and each handler that has taken it (names must differ) isn't called again; one that failed is, on a replay.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        folder = f"{out_path}/epoch={epoch_id}"
        if not V.exists(session, f"{folder}/_SUCCESS"):
            tagged = tag_messages(batch, schema).withColumn("ok", F.col("error").isNull())
            tagged.write.mode("overwrite").partitionBy("ok").parquet(folder)
        good = _landed(session, folder, schema).filter("ok").select("message.*")
        for handler in handlers:
            done = f"{folder}/_taken_{getattr(handler, '__name__', repr(handler))}"
            if not V.exists(session, done) and guarded(run, handler, good, epoch_id):
                V.touch(session, done)

    run.errors, run.error_counts = deque(maxlen=NOTICES), Counter()
    started = (read_messages(spark, source, source_format, options).writeStream.foreachBatch(run)
               .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
    started.errors, started.error_counts = run.errors, run.error_counts
    return started


def _landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([T.StructField("message", schema), T.StructField("raw_message", T.StringType()),
                         T.StructField("error", T.StringType()), T.StructField("ok", T.BooleanType())])
    return spark.read.schema(full).parquet(path)


def landed_messages(spark: SparkSession, out_path: str, schema: T.StructType) -> DataFrame:
    """The good messages that :func:`message_stream_job` has landed."""
    return _landed(spark, out_path, schema).filter("ok").select("message.*")


def dead_letters(spark: SparkSession, out_path: str, schema: T.StructType) -> DataFrame:
    """The texts that it could not read, with the reason."""
    return _landed(spark, out_path, schema).filter("NOT ok").select("raw_message", "error")


KPI_KEYS = ("window_start", "window_end", "event_type")
EPOCH = "epoch"


def upsert_kpis(batch: DataFrame, root: str, epoch_id: int) -> None:
    """Put the windows of one refresh into the table below ``root`` and replace the days they belong to by one commit.

    Only those days are read and written again, each to few files, and runs that no recent manifest names are deleted, so the
    files are as many as the days need, however many refreshes there were.  A refresh that is replayed changes nothing.
    """
    spark = batch.sparkSession
    before = V.current(spark, root)
    if before.marks.get(EPOCH, -1) >= epoch_id:
        return
    batch = batch.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    days = {r["day"] for r in batch.select("day").distinct().collect()}  # those that the watermark leaves open
    rows = batch.withColumn("_new", F.lit(1))
    if "kpis" in before.schemas:
        old = V.read(spark, root, before, "kpis", lambda day: day in days)
        rows = rows.unionByName(old.withColumn("_new", F.lit(0)))
    rest = [c for c in batch.columns if c not in KPI_KEYS]
    newest = (rows.groupBy(*KPI_KEYS).agg(F.max_by(F.struct(*rest), "_new").alias("r")).select(*KPI_KEYS, "r.*"))
    keys, _ = V.write_keyed(newest, root, V.new_run(f"refresh-{epoch_id}"), {"_day": F.col("day")})
    V.commit(spark, root, before.replacing("kpis", {k["_day"]: k["folder"] for k in keys}, newest.schema).marking(**{EPOCH: epoch_id}))
    V.vacuum(spark, root)


def kpi_stream_job(events: DataFrame, out_path: str, checkpoint: str, watermark: str = "1 hour",
                   window: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """ST-05: KPI windows refreshed every 30 seconds into a table of their newest rows; see :func:`latest_kpis`."""
    return (kpi_windows(events, window=window, watermark=watermark).writeStream
            .outputMode("update").foreachBatch(lambda batch, epoch_id: upsert_kpis(batch, out_path, epoch_id))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": KPI_REFRESH})).start())


def latest_kpis(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest row of each window and event type that :func:`kpi_stream_job` has committed."""
    return V.read(spark, out_path, V.current(spark, out_path), "kpis").drop("day")


def debounce_stream_job(events: DataFrame, out_path: str, checkpoint: str, key: str = "user_id",
                        ts: str = "ts", value: str = "value", gap: str = "30 minutes",
                        watermark: str = "10 minutes", tiebreak: str | None = "event_id",
                        trigger: dict | None = None) -> StreamingQuery:
    """ST-04: closed sessions with their last value, appended exactly once to Parquet."""
    out = debounce_stream(events, key, ts, value, gap, watermark, tiebreak)
    return (out.writeStream.outputMode("append").format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
