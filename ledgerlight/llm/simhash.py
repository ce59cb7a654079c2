"""SimHash near-duplicates: fingerprints of word shingles, bit-sliced comparison, components.

Two fingerprints within ``radius`` differing bits agree on at least ``blocks - radius`` of ``blocks``
bit blocks, so each distinct fingerprint goes to one bucket per choice of that many blocks, and only
fingerprints of a bucket are compared.  A bucket stores its fingerprints vertically: plane ``p`` holds
bit ``p`` of 64 fingerprints in each machine word.  One pass over the planes updates the distances of
a query to 64 fingerprints at a time with carry-save counters, and a query's words are abandoned as
soon as all their fingerprints exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced, stored
from .components import components

SEED = 42
BITS = 64
#: Bit blocks that the buckets choose from: with radius 3, ten tables of 25- or 26-bit keys.
BLOCKS = 5
#: Fingerprints of a bucket that are compared in one group; larger buckets are split over tasks.
GROUP = 4096
#: (query, word) pairs compared in one numpy step; bounds a task's memory.
STEP = 1 << 19


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit SimHash of a text's shingles of ``words`` words, repeats included.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A bit is 1 if it is set in
    over half the shingle hashes.  Fewer words: the whole sequence is the shingle; none: zero.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    end = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    if len(tokens) > words:
        start, end = start[:len(tokens) - words + 1], end[words - 1:]
    else:
        start, end = start[:1], end[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(start.tolist(), end.tolist())], np.uint64)
    set_in = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 200):  # an 8-bit sum holds 200 rows
        planes = np.unpackbits(hashes[i:i + 200].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += planes.sum(axis=0, dtype=np.uint8)
    bits = np.packbits(2 * set_in > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id") -> DataFrame:
    """``key`` and ``fp`` (64 bits as a long) of each row's ``text``; null and empty texts get 0."""
    rows = docs.select(F.col(key).alias("key"), F.col("text").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.int64())], ["key", "fp"])

    return rows.mapInArrow(compute, f"key {kind}, fp long").withColumnRenamed("key", key)


def _masks(radius: int, blocks: int) -> list[int]:
    """For each choice of ``blocks - radius`` blocks, a signed 64-bit mask of their bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    ranges = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(ranges, max(1, blocks - radius))]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def vertical(fps: np.ndarray) -> np.ndarray:
    """Bit planes: element (p, w) holds bit p of fingerprints 64 w to 64 w + 63."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _over(differs: np.ndarray, counters: list[np.ndarray], over: np.ndarray) -> None:
    """Add a plane of differing bits to carry-save counters; what leaves the last one is over."""
    carry = differs
    for c in counters:
        out = c & carry
        c ^= carry
        carry = out
    over |= carry


def near_pairs(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of the same group (groups are runs) that differ in at most ``radius`` bits."""
    n = len(fps)
    planes, first = vertical(fps), np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    stop = np.repeat(first + size, size)
    query = np.arange(n)
    span = (stop - 1) // 64 - (query + 1) // 64 + 1
    span[query + 1 >= stop] = 0
    depth = radius.bit_length()
    spare = (1 << depth) - 1 - radius  # counters start here, so that radius + 1 overflows them
    found_i, found_j = [], []
    ends = np.cumsum(span)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STEP, "right")))
        q = np.repeat(query[lo:hi], span[lo:hi])
        if len(q):
            offset = np.arange(len(q)) - np.repeat(ends[lo:hi] - span[lo:hi] - (ends[lo - 1] if lo else 0), span[lo:hi])
            w = (q + 1) // 64 + offset
            # Fingerprints outside (query, end of its group) count as over from the start.
            low = np.clip(q + 1 - 64 * w, 0, 64).astype(np.uint64)
            high = np.clip(stop[q] - 64 * w, 0, 64).astype(np.uint64)
            inside = _ones(high) & ~_ones(low)
            over = ~inside
            counters = [np.full(len(q), np.uint64(0xFFFFFFFFFFFFFFFF) if spare >> b & 1 else np.uint64(0), np.uint64) for b in range(depth)]
            own = fps[q]
            for p in range(BITS):
                differs = planes[p][w] ^ (np.uint64(0) - (own >> np.uint64(p) & np.uint64(1)))
                _over(differs, counters, over)
                if p % 8 == 7:
                    left = over != np.uint64(0xFFFFFFFFFFFFFFFF)
                    if not left.all():
                        q, w, own, over = q[left], w[left], own[left], over[left]
                        counters = [c[left] for c in counters]
                    if not len(q):
                        break
            if len(q):
                within = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(within)
                found_i.append(q[row])
                found_j.append(64 * w[row] + bit)
        lo = hi
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _ones(k: np.ndarray) -> np.ndarray:
    """Words whose lowest k bits are set, k from 0 to 64."""
    return np.where(k >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (k & np.uint64(63))) - np.uint64(1))


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest with the same components: each linked index and the least index it reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
    linked = np.flatnonzero(root != np.arange(n))
    return linked, root[linked]


def _link_groups(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within each run of rows of one bucket part; a run may go on into the next batch."""
    held: list[pa.RecordBatch] = []

    def link(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        fps = table.column("fp").to_numpy().view(np.uint64)
        columns = [table.column(c).to_numpy() for c in table.column_names if c != "fp"]
        change = np.r_[False, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]
        i, j = near_pairs(fps, np.cumsum(change), radius)
        member, root = _forest(i, j, len(fps))
        signed = fps.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[member]), pa.array(signed[root])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in batch.schema.names if c != "fp"]
        edge = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in keys])) if batch.num_rows > 1 else []
        same = held and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in batch.schema.names if c != "fp")
        if held and not same:
            yield from link(held)
            held = []
        if len(edge):
            last = int(edge[-1]) + 1
            yield from link([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield from link(held)


def links(distinct: DataFrame, radius: int = 3, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs of ``fp`` within ``radius`` bits.

    ``distinct`` holds each fingerprint once.  A bucket of more than ``group`` fingerprints is dealt
    to parts, and every two parts meet in a task of their own, so no task gets an unbounded bucket.
    """
    masks = _masks(radius, max(blocks, radius + 1))
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("tbl", "key"))
    shared = keyed.groupBy("tbl", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / group).cast("int")
    met = (keyed.join(shared, ["tbl", "key"])
           .select("tbl", "key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"))
           .select("tbl", "key", "part", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
           .select("tbl", "key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "fp"))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (met.repartition(n, "tbl", "key", "p", "q").sortWithinPartitions("tbl", "key", "p", "q", "fp")
            .mapInArrow(lambda it: _link_groups(it, radius), "a long, b long"))


def _classes(rows: DataFrame, key: str, fp: str, radius: int) -> DataFrame:
    """``fp``, ``root`` (its component) and ``least`` (its smallest key) for each distinct fingerprint."""
    holders = stored(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("least")), "holders")
    roots = components(links(holders.select("fp"), radius)).withColumnRenamed("node", "fp")
    return holders.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, key: str = "doc_id") -> DataFrame:
    """``key``, ``fp`` and ``component_id`` of each row of ``docs``.

    Documents link if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the
    smallest non-null key of all documents reachable over links, itself included (null if a component
    has no other key).  Texts without words have fingerprint 0 and link like any other.  Repeated rows
    give repeated rows; an empty table gives an empty result; other columns of ``docs`` play no part.
    """
    rows = stored(fingerprints(docs, words, key), "fingerprints")
    classes = stored(_classes(rows, key, "fp", radius), "classes")
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(classes.join(named, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def first_of_each(docs: DataFrame, words: int = 3, radius: int = 3, key: str = "doc_id") -> DataFrame:
    """One row of ``docs``, all columns, for each component of :func:`near_duplicates`.

    It is the row with the component's smallest key (of rows that share this key, that with the
    smallest fingerprint; rows equal in both count once; null keys come last).
    """
    fp = "simhash"
    while fp in docs.columns:
        fp += "_"
    marked = stored(_with_fingerprint(docs, words, fp), "marked")
    classes = _classes(marked, key, fp, radius)
    kept = classes.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), F.col("least"), F.col("fp"))).alias("k"))
    kept = kept.select(F.col("k.least").alias("kept_key"), F.col("k.fp").alias("kept_fp"))
    same = F.col(key).eqNullSafe(F.col("kept_key")) & (F.col(fp) == F.col("kept_fp"))
    return marked.dropDuplicates([key, fp]).join(kept, same, "left_semi").drop(fp)


def _with_fingerprint(docs: DataFrame, words: int, name: str) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, name])

    return docs.mapInArrow(compute, schema)
