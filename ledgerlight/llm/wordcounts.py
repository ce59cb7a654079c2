"""Corpus-wide counts of strings with a small shuffle: sorted, packed and compressed by bucket."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

#: Distinct strings that a task holds before it sends their counts; bounds its memory.
FLUSH = 400_000
SEPARATOR = b"\n"


def pack(counts: dict[bytes, int], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, compressed strings in order and their counts); strings hold no line feed."""
    parts: list[list[bytes]] = [[] for _ in range(buckets)]
    digest = xxhash.xxh3_64_intdigest
    for term in counts:
        parts[digest(term) % buckets].append(term)
    for bucket, terms in enumerate(parts):
        if terms:
            terms.sort()
            numbers = np.fromiter(map(counts.__getitem__, terms), np.int64, len(terms))
            body = SEPARATOR.join(terms)
            yield bucket, zstandard.compress(len(body).to_bytes(8, "little") + body + numbers.tobytes(), 3)


def unpack(blob: bytes) -> tuple[list[bytes], list[int]]:
    data = zstandard.decompress(blob)
    size = int.from_bytes(data[:8], "little")
    return data[8:8 + size].split(SEPARATOR), np.frombuffer(data[8 + size:], np.int64).tolist()


def counted(docs: DataFrame, terms: Callable[[str], Iterable[bytes]], least: int = 1) -> DataFrame:
    """``term`` and ``n``: how often ``terms`` gives each string over all texts, where at least ``least``.

    Counts are combined in each task before the shuffle; the number of buckets is that of the shuffle
    partitions, and a bucket holds each task's share of it once, however often a string occurs.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            packed = list(pack(held, buckets))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in packed], pa.int32()), pa.array([x for _, x in packed], pa.binary())],
                                              ["bucket", "blob"])

        held: Counter[bytes] = Counter()
        for batch in sliced(batches):
            for text in batch.column("text").to_pylist():
                held.update(terms(text))
                if len(held) > FLUSH:
                    yield rows()
                    held.clear()
        yield rows()

    def merge(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        now = None

        def out() -> pa.RecordBatch:
            kept = [(t, n) for t, n in total.items() if n >= least]
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], ["term", "n"])

        for batch in tables:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
                if bucket != now:
                    yield out()
                    total, now = {}, bucket
                for term, n in zip(*unpack(blob.as_py())):
                    total[term] = total.get(term, 0) + n
        yield out()

    rows = docs.select(F.col("text").alias("text")).where("text is not null")
    return (rows.mapInArrow(count, "bucket int, blob binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(merge, "term binary, n long"))
