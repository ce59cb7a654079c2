"""Filter interaction audit: what each filter removes, alone and after others, in every order.

A document is known to the audit by the mask of the filters it fails and by its labels.  Each such code maps
to one wide packed integer with a 64-bit field for every order, step and outcome; a task adds the integers of
its documents, tasks' sums are added per part, and the total is unpacked.  A field holds at most the number of
documents of a part, so no field overflows into the next one.

Masks come from DataFrame functions; a document's text never leaves the scan but as a digest.  A copy is told
from the first of its text by joining on (digest, id), which no text can make hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BYTES = 8
#: Sums of so many parts are held at once in a task; a task with more parts sends some more than once.
HELD_PARTS = 64
#: The sums of a part meet in so many groups first.
FAN = 32
SPACES = " \t\n\x0b\x0c\r"


def default_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text: A under 100 words, B few distinct words, C many capitals, D symbols.  E, a
    copy of the text of a smaller id, is added by :func:`failures`."""
    words = F.split(F.btrim(text, F.lit(SPACES)), r"[\x20\x09-\x0D]+")
    words = F.when(F.btrim(text, F.lit(SPACES)) == "", F.array().cast("array<string>")).otherwise(words)
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": n_words < 100, "B": 100 * n_distinct.cast("long") < 80 * n_words.cast("long"),
            "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"), "D": F.rlike(text, F.lit("[#$%&*|]"))}


def failures(docs: DataFrame, labels: DataFrame, filters: Callable[[Column], dict[str, Column]] = default_filters,
             part: str = "lang", copies: str | None = "E") -> tuple[DataFrame, str]:
    """One row a document: ``part``, ``mask`` (bit i: fails the i-th filter), ``good``, ``toxic``; and the filters' letters.

    A null ``text`` is the empty text, a null ``part`` the empty string.  ``copies`` names the filter that fails a
    document whose text also has a smaller id; a null id is neither smaller nor greater, so such rows don't fail it
    and don't make others fail.  Repeated rows of one id don't fail each other.  A document is good (toxic) if any
    of its rows in ``labels`` has quality (toxic) 1; without labels it is neither.  Other columns play no part.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    named = filters(text)
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(named.values())), F.lit(0))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), bits.alias("mask"),
                       *([F.unhex(F.sha2(text, 256)).alias("digest")] if copies else []))
    letters = "".join(named)
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    if copies:
        rows = stored(rows, "filter-masks")
        first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
        copy = F.col("id").isNotNull() & F.col("first").isNull()
        rows = rows.join(first, ["digest", "id"], "left").withColumn("mask", F.col("mask") + F.when(copy, 1 << len(letters)).otherwise(0))
        letters += copies
    known = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.join(marks, "id", "left").select("part", "mask", known("good"), known("toxic")), letters


def packed(mask: int, good: bool, toxic: bool, filters: int) -> int:
    """The integer of one document: a field for each order, step and outcome, the first in the lowest bits."""
    fields = np.zeros((len(list(permutations(range(filters)))), filters, len(OUTCOMES)), "<u8")
    for o, order in enumerate(permutations(range(filters))):
        gone = False
        for s, f in enumerate(order):
            fails = bool(mask >> f & 1)
            removed = fails and not gone
            fields[o, s] = (not gone and not fails, removed, fails and gone, mask == 1 << f, removed and good, removed and toxic)
            gone |= fails
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int, filters: int) -> np.ndarray:
    """Counts by order, step and outcome."""
    orders = len(list(permutations(range(filters))))
    raw = total.to_bytes(orders * filters * len(OUTCOMES) * FIELD_BYTES, "little")
    return np.frombuffer(raw, "<u8").reshape(orders, filters, len(OUTCOMES)).astype(np.int64)


SUMS = "part string, salt int, total binary"


def _row(part: str, total: int) -> pa.RecordBatch:
    raw = total.to_bytes((total.bit_length() + 7) // 8 or 1, "little")
    return pa.record_batch({"part": pa.array([part]), "salt": pa.array([TaskContext.get().partitionId() % FAN], pa.int32()), "total": pa.array([raw], pa.binary())})


def _count(filters: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        integers: dict[tuple, int] = {}
        sums: dict[str, int] = {}
        for batch in batches:
            counts = pa.Table.from_batches([batch]).group_by(["part", "mask", "good", "toxic"]).aggregate([([], "count_all")])
            for part, *code, n in zip(*(counts.column(c).to_pylist() for c in ("part", "mask", "good", "toxic", "count_all"))):
                if (key := tuple(code)) not in integers:
                    integers[key] = packed(*code, filters)
                sums[part] = sums.get(part, 0) + n * integers[key]
                if len(sums) > HELD_PARTS:
                    yield _row(part, sums.pop(part))
        for part, total in sums.items():
            yield _row(part, total)
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum per part of rows that are sorted by part."""
    held, total = None, 0
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
            if held is not None and part != held:
                yield _row(held, total)
                total = 0
            held = part
            total += int.from_bytes(raw, "little")
    if held is not None:
        yield _row(held, total)


def _unpack(letters: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(letters)
        orders = np.array(list(permutations(range(n)))).reshape(-1, n)
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
                counts = unpacked(int.from_bytes(raw, "little"), n)
                shapley = np.array([counts[:, :, 1][orders == f].sum() for f in range(n)], np.int64)
                flat = counts.reshape(-1, len(OUTCOMES))
                yield pa.record_batch({
                    "part": pa.array([part] * len(flat)), "filter_order": pa.array(["".join(letters[f] for f in o) for o in orders.tolist() for _ in range(n)]),
                    "step": pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))),
                    **{name: pa.array(flat[:, i]) for i, name in enumerate(OUTCOMES)}, "shapley": pa.array(shapley[orders.reshape(-1)])})
    return run


def interactions(masks: DataFrame, letters: str) -> DataFrame:
    """For each ``part``, order of the filters and step: documents kept after the step, removed by it, failing its filter
    but removed earlier (redundant), failing its filter only, good and toxic ones removed, and ``shapley``: what its
    filter removes, summed over all orders.  Takes the rows of :func:`failures`; no rows give no parts."""
    n = len(letters)
    sums = masks.select("part", F.col("mask").cast("int").alias("mask"), "good", "toxic").mapInArrow(_count(n), SUMS)
    for keys in (["part", "salt"], ["part"]):
        sums = sums.repartition(*keys).sortWithinPartitions("part").mapInArrow(_add, SUMS)
    counts = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return sums.mapInArrow(_unpack(letters), f"part string, filter_order string, step int, {counts}")


def oracle_sql() -> str:
    """The same audit in DuckDB SQL: every distinct mask through every order."""
    return r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS lo FROM words GROUP BY text),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (
  SELECT part, (len(w) < 100)::INT AS fa, (100 * len(list_distinct(w)) < 80 * len(w))::INT AS fb,
         (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INT AS fc,
         regexp_matches(text, '[#$%&*|]')::INT AS fd, coalesce(doc_id > lo, FALSE)::INT AS fe,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
codes AS (SELECT part, fa, fb, fc, fd, fe, good, toxic, count(*) AS n FROM docs GROUP BY ALL),
letters(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.c || b.c || d.c || e.c || f.c AS filter_order
  FROM letters a, letters b, letters d, letters e, letters f
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS c FROM orders, range(1, 6) r(step)),
fails AS (
  SELECT codes.*, s.*, CASE c WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END AS hit,
         fa * (strpos(filter_order, 'A') < step)::INT + fb * (strpos(filter_order, 'B') < step)::INT + fc * (strpos(filter_order, 'C') < step)::INT
         + fd * (strpos(filter_order, 'D') < step)::INT + fe * (strpos(filter_order, 'E') < step)::INT AS earlier, fa + fb + fc + fd + fe AS failed
  FROM codes, steps s),
counted AS (
  SELECT part, filter_order, step, c, sum(n * (hit = 0 AND earlier = 0)::INT) AS kept, sum(n * (hit = 1 AND earlier = 0)::INT) AS removed,
         sum(n * (hit = 1 AND earlier > 0)::INT) AS redundant, sum(n * (hit = 1 AND failed = 1)::INT) AS unique_fails,
         sum(n * good * (hit = 1 AND earlier = 0)::INT) AS good_lost, sum(n * toxic * (hit = 1 AND earlier = 0)::INT) AS toxic_lost
  FROM fails GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
FROM counted"""
