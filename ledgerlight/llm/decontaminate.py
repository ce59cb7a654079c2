"""Benchmark decontamination by pigeonhole pieces and bit-parallel edit distance.

An item that occurs in a text with at most ``k`` edits leaves at least one of ``k + 1`` disjoint pieces
of it unchanged.  The pieces of all items are found in one pass over a text by an automaton; around
each hit, Myers' bit-parallel search gives the least edit distance of the whole item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

_OTHER = re.compile(r"[\W_]+")

#: Characters of item text in one automaton; more items are searched in further passes.
BLOCK_CHARS = 4_000_000


def normalised(text: str | None) -> str:
    """Lower-cased words joined by single spaces, with a space at both ends; empty without words."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if words else ""


def budget(item: str, edit_rate: float) -> int:
    """Edits allowed in a normalised item."""
    return int(len(item) * edit_rate)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` disjoint pieces that cover the item, with their offsets."""
    edges = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def best_match(item: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``item`` to a part of ``text`` and that part's end; None if over ``most``.

    Myers: vertical differences of a column of the dynamic-programming table are two bit vectors as
    long as the item; one text character updates the column in a few word operations.
    """
    m = len(item)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = ones, 0, m
    best, end = most + 1, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus) & ones
        h_plus = (minus | ~(diagonal | plus)) & ones
        h_minus = plus & diagonal
        if h_plus & top:
            score += 1
        elif h_minus & top:
            score -= 1
        h_plus = h_plus << 1 & ones
        h_minus = h_minus << 1 & ones
        plus = (h_minus | ~(diagonal | h_plus)) & ones
        minus = h_plus & diagonal
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


class Finder:
    """Finds a block of items, given as (item index, normalised text), in texts."""

    def __init__(self, items: list[tuple[int, str]], edit_rate: float):
        self.items = {i: (text, budget(text, edit_rate)) for i, text in items}
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (text, edits) in self.items.items():
            for offset, piece in pieces(text, edits):
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """Of each item found: its least distance, and the end in the normalised text of the first such match."""
        found: dict[int, tuple[int, int]] = {}
        reach: dict[int, tuple[int, int]] = {}  # per item, the window that hits so far have asked for
        for last, (length, where) in self.automaton.iter(text):
            for i, offset in where:
                item, edits = self.items[i]
                start = last + 1 - length - offset
                lo, hi = max(0, start - edits), start + len(item) + edits
                if i in reach and lo <= reach[i][1]:  # hits close together: one window
                    reach[i] = (min(lo, reach[i][0]), max(hi, reach[i][1]))
                    if reach[i][1] - reach[i][0] < 8 * (len(item) + 2 * edits):
                        continue
                    self._verify(text, i, reach.pop(i), found)
                else:
                    if i in reach:
                        self._verify(text, i, reach[i], found)
                    reach[i] = (lo, hi)
        for i, window in reach.items():
            self._verify(text, i, window, found)
        return found

    def _verify(self, text: str, i: int, window: tuple[int, int], found: dict[int, tuple[int, int]]) -> None:
        if i in found and not found[i][0]:
            return
        item, edits = self.items[i]
        match = best_match(item, text[window[0]:window[1]], edits)
        if match and (i not in found or match[0] < found[i][0]):
            found[i] = (match[0], window[0] + match[1])


def _blocks(items: DataFrame, text: str, edit_rate: float) -> Iterator[list[tuple[int, str]]]:
    """Distinct normalised items in blocks of bounded size, fetched a partition at a time."""
    block: list[tuple[int, str]] = []
    held = n = 0
    for row in items.select(F.col(text).alias("t")).where("t is not null").distinct().toLocalIterator():
        item = normalised(row["t"])
        if not item:
            continue
        block.append((n, item))
        n, held = n + 1, held + len(item)
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, edit_rate: float = 0.0625, key: str = "doc_id",
                 item_key: str = "item_id") -> DataFrame:
    """``key``, ``item_key``, ``distance`` and ``end``: items that occur in a document's text.

    Both texts are normalised to lower-case words; an item occurs if its edit distance to a part of
    the text is at most ``edit_rate`` of its length (one character in 16).  ``end`` is that part's end
    in the normalised text.  Whole texts are searched, once for each block of items.  Null and empty
    texts hold nothing, items without words are never found, items with equal text are all reported,
    and rows that repeat are reported once; either table may be empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col("text").alias("text")).where("text is not null")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, item string, distance int, end long"
    hits = spark.createDataFrame([], schema)
    for block in _blocks(items, "text", edit_rate):
        shared = spark.sparkContext.broadcast({"items": block, "rate": edit_rate})

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            state = shared.value
            if "finder" not in state:
                state["finder"] = Finder(state["items"], state["rate"])
            text_of = dict(state["items"])
            for batch in sliced(batches):
                at, item, distance, end = [], [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    for i, (d, e) in state["finder"].find(normalised(text)).items():
                        at.append(row)
                        item.append(text_of[i])
                        distance.append(d)
                        end.append(e)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(at, pa.int64())), pa.array(item, pa.string()),
                     pa.array(distance, pa.int32()), pa.array(end, pa.int64())], ["key", "item", "distance", "end"])

        hits = hits.union(rows.mapInArrow(search, schema))
    names = items.select(F.col(item_key).alias("item_key"), F.col("text").alias("item_text")).where("item_text is not null")
    kind = names.schema["item_key"].dataType.simpleString()

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "item_text"):
            texts = [normalised(t) for t in batch.column("item_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_key"), pa.array(texts, pa.string())], ["item_key", "item"])

    names = names.mapInArrow(normalise, f"item_key {kind}, item string")
    return (hits.join(names, "item").groupBy("key", "item_key").agg(F.min(F.struct("distance", "end")).alias("m"))
            .select(F.col("key").alias(key), F.col("item_key").alias(item_key), "m.distance", "m.end"))


def clean(docs: DataFrame, items: DataFrame, edit_rate: float = 0.0625) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item occurs; see :func:`contaminated`.

    Row order and repeats stay as they are; a null text holds nothing and stays.
    """
    schema = docs.schema
    for block in _blocks(items, "text", edit_rate):
        shared = docs.sparkSession.sparkContext.broadcast({"items": block, "rate": edit_rate})

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            state = shared.value
            if "finder" not in state:
                state["finder"] = Finder(state["items"], state["rate"])
            for batch in sliced(batches):
                yield batch.filter(pa.array([not state["finder"].find(normalised(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(keep, schema)
    return docs
