"""Debounce (ST-04): per key, keep only the last value of each burst of events.

A burst (session) ends after ``gap`` of quiet; the emitted row carries the
last value, as a debounced callback would.  Semantics follow Spark's
``session_window``: an event joins the session when it arrives *less* than
``gap`` after the previous one, and the session ends at ``last event + gap``.

Batch form, skew-safe.  Events are cut into time buckets ``gap`` wide.
Two events in one bucket are less than ``gap`` apart, so a session never
breaks inside a bucket: per ``(key, bucket)`` only min / max time, count
and last value matter, which is a mergeable aggregate (a hot key is
reduced map-side).  A key's buckets are cut into blocks of ``SLICE_BUCKETS``
numbers, so even the bucket rows of a hot key are never gathered into one
task.  One pass over a block finds the starts inside it; one row a block then
tells whether its first bucket goes on from the block before, and with which start.

Streaming forms.  :func:`debounce_stream`: ``withWatermark`` + ``session_window`` + ``max_by``; state is kept per key and
dropped once the watermark passes a session's end.  :func:`debounce_timers`: own state (``transformWithState``) with
a timer a key, which emits a burst when its gap of quiet has passed; a key keeps one row for each burst that the
watermark leaves open, however many events it has.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the reference's debounce delay (300 ms).  The registered
# query uses a 30-minute gap on the events table (FIXTURES.md).
DEBOUNCE_DELAY = "300 milliseconds"

#: Consecutive buckets of a key that one task orders; a power of two.
SLICE_BUCKETS = 4096


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _gap_micros(gap: str) -> int:
    num, unit = gap.split()
    unit = unit.lower().rstrip("s")
    scale = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
             "day": 86_400_000_000}[unit]
    return int(float(num) * scale)


def debounce(df: DataFrame, key: str, ts: str, value: str, gap: str, tiebreak: str | None = None) -> DataFrame:
    """Sessions per ``key`` with their last value.

    Returns ``key, session_start, session_end, last_ts, last_value, n_events``.
    ``tiebreak`` orders events with equal timestamps (last one wins).
    """
    g = _gap_micros(gap)
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.struct(F.col(ts))
    ev = df.select(key, ts, value, order.alias("_ord"), _micros(ts).alias("_us"))
    # Floor division, so buckets before 1970 are as wide as those after.
    floor = (F.col("_us") - F.pmod(F.col("_us"), F.lit(g)))
    buckets = (ev.groupBy(key, F.call_function("div", floor, F.lit(g)).alias("_bucket"))
               .agg(F.min("_us").alias("_min_us"), F.max("_us").alias("_max_us"),
                    F.min(ts).alias("_first_ts"), F.max(ts).alias("_last_ts"),
                    F.count(F.lit(1)).alias("_n"),
                    F.max_by(value, "_ord").alias("_last_value"), F.max("_ord").alias("_last_ord")))
    # The key as a struct, which is never NULL: equal keys, NULL ones too, then join plainly and stay where they are.
    block = F.shiftright("_bucket", SLICE_BUCKETS.bit_length() - 1)
    rows = buckets.select(F.struct(key).alias("_k"), block.alias("_block"), *[c for c in buckets.columns if c != key])
    inside = Window.partitionBy("_k", "_block").orderBy("_bucket")
    before = F.lag("_max_us").over(inside)
    rows = rows.withColumn("_start", F.when(F.col("_min_us") - before >= g, F.col("_bucket")))
    rows = rows.withColumn("_start", F.max("_start").over(inside))  # NULL: as the block begins
    # One row a block: does it go on from the block before, and with which start?
    edges = rows.groupBy("_k", "_block").agg(F.min("_bucket").alias("_first"), F.min("_min_us").alias("_from"), F.max("_max_us").alias("_upto"), F.max("_start").alias("_last"))
    along = Window.partitionBy("_k").orderBy("_block")
    gone = F.coalesce(F.col("_from") - F.lag("_upto").over(along) >= g, F.lit(True))
    edges = edges.withColumn("_own", F.when(gone, F.col("_first")))
    # The last start in this block or before it, and that in blocks before.
    latest = F.max(F.coalesce("_last", "_own")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select("_k", "_block", F.coalesce("_own", latest).alias("_carried"))
    out = (rows.join(edges, ["_k", "_block"]).groupBy("_k", F.coalesce("_start", "_carried").alias("_session"))
           .agg(F.min("_first_ts").alias("session_start"),
                F.max("_last_ts").alias("last_ts"),
                F.sum("_n").alias("n_events"),
                F.max_by("_last_value", "_last_ord").alias("last_value")))
    return out.select(F.col(f"_k.{key}").alias(key), "session_start",
                      (F.col("last_ts") + F.expr(f"INTERVAL {g} MICROSECONDS")).alias("session_end"),
                      "last_ts", "last_value", "n_events")


def debounce_stream(stream: DataFrame, key: str, ts: str, value: str, gap: str, watermark: str,
                    tiebreak: str | None = None) -> DataFrame:
    """Streaming debounce: closed sessions are emitted once the watermark passes their end.

    ``ts`` is cast to TIMESTAMP (watermarks refuse TIMESTAMP_NTZ); with the
    session time zone at UTC the values are unchanged.
    """
    order = F.struct(F.col("_ts"), F.col(tiebreak)) if tiebreak else F.struct(F.col("_ts"))
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    out = (s.groupBy(F.col(key), F.session_window("_ts", gap).alias("session"))
           .agg(F.max_by(value, order).alias("last_value"), F.max("_ts").alias("last_ts"),
                F.count(F.lit(1)).alias("n_events")))
    return out.select(key,
                      F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session.end").cast("timestamp_ntz").alias("session_end"),
                      F.col("last_ts").cast("timestamp_ntz").alias("last_ts"),
                      "last_value", "n_events")


#: The state store that own state needs.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _processor(gap: int, fields: list[str], state: T.StructType):
    """A stateful processor that keeps each key's open bursts.  Defined here so that executors get it by value."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Debounce(StatefulProcessor):
        """State: (first, last, events, order of the last, last value) of each open burst, in time order."""

        def init(self, handle) -> None:
            self.handle, self.bursts = handle, handle.getListState("bursts", state)

        def close(self) -> None:
            pass

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
            found = [tuple(b) for b in self.bursts.get()]
            for part in rows:
                part = part.set_axis(["_key", "_ts", "_value", "_tie", "_us"], axis=1).sort_values(["_us", "_tie"], kind="stable")
                burst = (part["_us"].diff() >= gap).cumsum()
                each = part.groupby(burst, sort=True).agg(first=("_us", "first"), last=("_us", "last"), n=("_us", "size"), tie=("_tie", "last"))
                values = part["_value"].astype(object).where(part["_value"].notna(), None).groupby(burst, sort=True).agg(lambda s: s.iloc[-1])
                found = self._joined([*found, *zip(each["first"].tolist(), each["last"].tolist(), each["n"].tolist(), each["tie"].tolist(), values.tolist())])
            self._keep(found)
            return iter(())

        @staticmethod
        def _joined(bursts: list[tuple]) -> list[tuple]:
            out: list[tuple] = []
            for b in sorted(bursts, key=lambda b: b[:2]):
                if out and b[0] - out[-1][1] < gap:
                    a = out.pop()
                    newest = max(a, b, key=lambda x: (x[1], x[3]))
                    b = (a[0], newest[1], a[2] + b[2], newest[3], newest[4])
                out.append(b)
            return out

        def _keep(self, bursts: list[tuple]) -> None:
            """Store the open bursts, and one timer for the first that ends."""
            wanted = [-(-(bursts[0][1] + gap) // 1000)] if bursts else []
            held = list(self.handle.listTimers())
            for t in held:
                if t not in wanted:
                    self.handle.deleteTimer(t)
            for t in wanted:
                if t not in held:
                    self.handle.registerTimer(t)
            if bursts:
                self.bursts.put(bursts)
            else:
                self.bursts.clear()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
            now = timerValues.getCurrentWatermarkInMs() * 1000
            bursts = [tuple(b) for b in self.bursts.get()]
            over = [b for b in bursts if b[1] + gap <= now]
            self._keep(bursts[len(over):])
            if over:
                yield pd.DataFrame([(key[0], b[0], b[1], b[4], b[2]) for b in over], columns=fields).astype({fields[3]: object})

    return Debounce()


def debounce_timers(stream: DataFrame, key: str, ts: str, value: str, gap: str, watermark: str, tiebreak: str) -> DataFrame:
    """Streaming debounce with own state and timers: the sessions of :func:`debounce`, each emitted once, when the watermark
    reaches its end.  ``tiebreak`` is an integer column.  Set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB
    store (``STATE_STORE``), which own state needs.
    """
    kind, value_kind = stream.schema[key].dataType, stream.schema[value].dataType
    s = stream.select(F.col(key).alias(key), F.col(ts).cast("timestamp").alias("_ts"), F.col(value).alias("_value"),
                      F.col(tiebreak).cast("long").alias("_tie")).withColumn("_us", F.unix_micros("_ts")).withWatermark("_ts", watermark)
    long = T.LongType()
    state = T.StructType([T.StructField(n, t) for n, t in (("first", long), ("last", long), ("n", long), ("tie", long), ("value", value_kind))])
    fields = [key, "_first", "_last", "last_value", "n_events"]
    out = T.StructType([T.StructField(n, t) for n, t in zip(fields, (kind, long, long, value_kind, long))])
    found = s.groupBy(key).transformWithStateInPandas(_processor(_gap_micros(gap), fields, state), out, "Append", "EventTime")
    at = lambda us: F.timestamp_micros(us).cast("timestamp_ntz")
    return found.select(key, at(F.col("_first")).alias("session_start"), at(F.col("_last") + _gap_micros(gap)).alias("session_end"),
                        at(F.col("_last")).alias("last_ts"), "last_value", "n_events")
