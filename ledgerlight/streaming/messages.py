"""Message stream pieces (ST-01..03, ST-05..07) for batch and Structured Streaming.

The reference consumes a WebSocket in a browser: parse each message, hand
it to every listener, survive bad messages and failing listeners.  Here the
same steps are DataFrame functions that work unchanged on a batch frame or
a streaming frame (files or Kafka as the source), with replay and progress
kept by the query checkpoint instead of a reconnect loop.
"""

from __future__ import annotations

import logging
from collections import Counter, deque
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

# Fixed value: the dashboard refresh interval (30,000 ms).
KPI_REFRESH = "30 seconds"
# Notices and errors a driver keeps for looking at; older ones are only counted.
NOTICES = 200
# JSON text keeps microseconds (Spark's default timestamp format keeps milliseconds).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def tag_messages(raw: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """ST-01: every message once: ``message`` (a struct, NULL if the text can't be read), ``raw_message`` and ``error`` (NULL if it can).

    Empty or blank text and text after the record are bad, as for a strict parser: ``from_json`` reads the
    first value only, so the whole text is also read as an array around it, which trailing text breaks.
    Rejected messages are looked at again to tell malformed JSON from JSON that does not fit the schema.
    """
    txt = F.col(text_col)
    corrupt = "_corrupt_record"
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType())])
    opts = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    tagged = raw.select(txt.alias("_raw"), F.from_json(txt, with_corrupt, opts).alias("m"),
                        F.json_array_length(F.concat(F.lit("["), txt, F.lit("]"))).alias("_values"))
    blank = F.col("_raw").isNull() | (F.trim(F.col("_raw"), F.lit(" \t\r\n")) == "")
    trailing = F.coalesce(F.col("_values"), F.lit(0)) != 1
    bad = blank | F.col("m").isNull() | F.col(f"m.{corrupt}").isNotNull() | trailing
    reason = (F.when(blank, "empty message")
              .when(trailing | F.try_parse_json(F.col("_raw")).isNull(), "malformed JSON")
              .otherwise("schema mismatch"))
    fields = F.struct(*[F.col(f"m.{f.name}").alias(f.name) for f in schema.fields])
    return tagged.select(F.when(~bad, fields).alias("message"), F.col("_raw").alias("raw_message"), F.when(bad, reason).alias("error"))


def parse_messages(raw: DataFrame, schema: T.StructType, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """ST-01: ``(parsed, dead_letter)``.

    A message that cannot be read goes to the dead-letter frame with its text and a reason instead of failing the
    stream (the reference emits an error event and carries on); see :func:`tag_messages`.
    """
    tagged = tag_messages(raw, schema, text_col)
    return (tagged.filter(F.col("error").isNull()).select("message.*"),
            tagged.filter(F.col("error").isNotNull()).select("raw_message", "error"))


def to_json_messages(df: DataFrame, out_col: str = "value") -> DataFrame:
    """ST-03: each record serialised as one JSON text message."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias(out_col))


def enrich_points(df: DataFrame, seed: int = 42, value_col: str = "value", ts_col: str = "timestamp") -> DataFrame:
    """ST-07 / PF-10: ``calculatedValue = value * rand * 100`` and a parsed timestamp.

    ``rand`` is seeded per partition, so it is repeatable for a fixed input layout.
    """
    ts = F.col(ts_col)
    parsed = ts if isinstance(df.schema[ts_col].dataType, (T.TimestampType, T.TimestampNTZType)) \
        else F.to_timestamp(ts)
    return df.withColumns({"calculatedValue": F.col(value_col) * F.rand(seed) * 100,
                           ts_col: parsed})


def fan_out(handlers: Sequence[Callable[[DataFrame, int], None]]):
    """ST-02: a ``foreachBatch`` function delivering each micro-batch to every handler.

    The batch is persisted once so handlers do not recompute it; a failing
    handler is logged and recorded, and the others still run.  The returned
    function has the last ``NOTICES`` ``errors`` as ``(epoch_id, handler_name, message)``
    and ``error_counts`` by handler, of all of them (what is kept is for looking at, and bounded).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for h in handlers:
                guarded(run, h, batch, epoch_id)
        finally:
            batch.unpersist()

    run.errors = deque(maxlen=NOTICES)
    run.error_counts = Counter()
    return run


def guarded(run, handler: Callable[[DataFrame, int], None], batch: DataFrame, epoch_id: int) -> bool:
    """Whether ``handler`` has taken the batch; a failure is logged and recorded on ``run``."""
    name = getattr(handler, "__name__", repr(handler))
    try:
        handler(batch, epoch_id)
    except Exception as e:  # noqa: BLE001 -- isolation is the feature
        log.error("handler %s failed on batch %s: %s", name, epoch_id, e)
        run.errors.append((epoch_id, name, str(e)))
        run.error_counts[name] += 1
        return False
    return True


def kpi_windows(events: DataFrame, ts_col: str = "ts", window: str = "1 hour",
                watermark: str | None = None) -> DataFrame:
    """ST-05: per event type and time window: events, value total, largest value.

    On a stream, run it with ``outputMode("update")`` and
    ``trigger(processingTime=KPI_REFRESH)`` to refresh the cards every 30 s;
    pass ``watermark`` to bound the state.
    """
    df = events
    if watermark:
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
    agg = (df.groupBy(F.window(ts_col, window).alias("w"), "event_type")
           .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value"),
                F.max("value").alias("max_value")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "event_type", "events", "total_value", "max_value")


class StatusListener(StreamingQueryListener):
    """ST-06: lifecycle notices -- connected, progress (data), disconnected, error.

    ``events`` holds the last ``NOTICES`` notices; ``counts`` the number of each kind and ``rows`` the rows that all of them report.
    """

    def __init__(self, callback: Callable[[str, dict], None] | None = None):
        self.events: deque[tuple[str, dict]] = deque(maxlen=NOTICES)
        self.counts: Counter[str] = Counter()
        self.rows = 0
        self.callback = callback

    def _emit(self, kind: str, info: dict) -> None:
        self.events.append((kind, info))
        self.counts[kind] += 1
        if self.callback:
            try:
                self.callback(kind, info)
            except Exception as e:  # noqa: BLE001
                log.error("status callback failed: %s", e)

    def onQueryStarted(self, event):
        self._emit("connected", {"id": str(event.id), "name": event.name})

    def onQueryProgress(self, event):
        p = event.progress
        self.rows += p.numInputRows
        self._emit("progress", {"id": str(p.id), "batch": p.batchId, "rows": p.numInputRows})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self._emit("error", {"id": str(event.id), "error": event.exception})
        self._emit("disconnected", {"id": str(event.id)})
