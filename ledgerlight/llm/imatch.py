"""I-Match document fingerprints over several randomised lexicon subsets.

The lexicon holds the terms whose share of documents lies in a band.  A document's distinct lexicon
terms, in order, are hashed once for the whole lexicon and once for each of many random subsets of it;
a hash survives an edit that leaves its subset's terms alone.  Subsets come in several sizes, so that
short and long documents both have some with few of their terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, stored
from .wordcounts import counted

#: Subsets per size, and the negated binary logarithms of the shares of terms they hold; the first subset is the whole lexicon.
PER_SIZE, SIZES = 6, tuple(range(2, 9))
SUBSETS = 1 + PER_SIZE * len(SIZES)
DIGITS = 8


def terms(text: str | None) -> set[bytes]:
    """Distinct lower-cased words between white space."""
    return {w.encode("utf-8", "surrogatepass") for w in (text or "").lower().split()}


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


def membership(hashes: np.ndarray) -> np.ndarray:
    """For each term hash (rows), whether each subset holds the term."""
    out = np.ones((len(hashes), SUBSETS), bool)
    column = 1
    for size in SIZES:
        for _ in range(PER_SIZE):
            mixed = (hashes ^ np.uint64(column * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            out[:, column] = mixed >> np.uint64(64 - size) == 0
            column += 1
    return out


@dataclass(frozen=True)
class Lexicon:
    terms: list[bytes]  #: in order


def lexicon(docs: DataFrame, least_share: float = 0.001, most_share: float = 0.2, least_docs: int = 2) -> Lexicon:
    """Terms in at least ``least_share`` and at most ``most_share`` of all documents (and ``least_docs``).

    The lower share bounds the lexicon whatever the corpus: at most (mean distinct terms of a
    document) / ``least_share`` terms lie above it.  All of them are kept.
    """
    n = docs.count()
    least = max(least_docs, int(np.ceil(least_share * n)))
    band = counted(docs, terms, least).where(F.col("n") <= max(least, int(most_share * n)))
    kept = band.select("term").toArrow()
    return Lexicon(sorted(kept.column("term").to_pylist()))


class Fingerprinter:
    def __init__(self, known: list[bytes]):
        self.at = {t: i for i, t in enumerate(known)}
        self.hashes = np.fromiter(map(term_hash, known), np.uint64, len(known))
        self.members = membership(self.hashes)

    def __call__(self, text: str | None) -> np.ndarray:
        """One 32-bit hash for each subset, 0 where it holds no term of the text.

        A text without any lexicon term uses all its terms; one without terms has zeros only.
        """
        found = terms(text)
        index = sorted(map(self.at.__getitem__, found & self.at.keys()))
        if index:
            hashes, members = self.hashes[index], self.members[index]
        else:
            hashes = np.fromiter(map(term_hash, sorted(found)), np.uint64, len(found))
            members = membership(hashes)
        out = np.zeros(SUBSETS, np.uint32)
        for k in np.flatnonzero(members.any(axis=0)).tolist():
            out[k] = xxhash.xxh32_intdigest(hashes[members[:, k]].tobytes()) | 1
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal hashes among the subsets with terms of either document; 1 if the fingerprints are equal."""
    used = (a != 0) | (b != 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def text_form(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, known: Lexicon, key: str = "doc_id") -> DataFrame:
    """``key`` and ``fingerprint`` (hex, one group of 8 digits a subset) for each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast({"terms": known.terms})
    rows = docs.select(F.col(key).alias("key"), F.col("text").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _maker(shared.value)
        for batch in sliced(batches):
            found = [text_form(make(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.string())], ["key", "fingerprint"])

    return rows.mapInArrow(run, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def _maker(shared: dict) -> Fingerprinter:
    if "maker" not in shared:
        shared["maker"] = Fingerprinter(shared["terms"])
    return shared["maker"]


COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(make: Fingerprinter, text: str, own: np.ndarray, after: str, other: np.ndarray) -> tuple:
    """A document's row: its text is edited with the start of the text after it."""
    n = len(text)
    edited = text[:n - n // 3] + after[:n // 3]
    changed = make(edited)
    return (n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), text_form(own), text_form(changed),
            likeness(own, changed), likeness(own, other))


def robustness(docs: DataFrame, known: Lexicon, key: str = "doc_id") -> DataFrame:
    """Each document's fingerprint against that of an edit of it and that of the next document.

    Documents follow each other by descending ``key`` (null keys last; equal keys by a hash of the
    text), the last by the first.  The edit replaces the last third of the code points by as many, or
    all, from the start of the next text.  A null text counts as empty; a lone document follows itself.

    Documents are dealt by ranges of the key.  A task compares its consecutive rows; only its first
    and last row meet those of the neighbouring ranges in a further step.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast({"terms": known.terms})
    rows = docs.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text").desc()]
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", *(c.split()[0] for c in COLUMNS.split(", "))]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def batch_of(keys: pa.Array, found: list[tuple], edge: list[tuple[str, int, str]] | None = None) -> pa.RecordBatch:
        columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
        extra = [] if edge is None else [pa.array([e[i] for e in edge], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))]
        return pa.RecordBatch.from_arrays([keys, *columns, *extra], [*names, *(["edge", "part", "text"] if extra else [])])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, part = _maker(shared.value), TaskContext.get().partitionId()
        blank, held = (None,) * 6, None
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            marks = [make(t) for t in texts]
            keys = batch.column("key")
            if held is None:
                yield batch_of(keys.slice(0, 1), [blank], [("first", part, texts[0])])
            else:
                yield batch_of(held[0], [_compared(make, held[1], held[2], texts[0], marks[0])], [(None, part, None)])
            inner = [_compared(make, texts[i], marks[i], texts[i + 1], marks[i + 1]) for i in range(len(texts) - 1)]
            yield batch_of(keys.slice(0, len(inner)), inner, [(None, part, None)] * len(inner))
            held = keys.slice(len(texts) - 1), texts[-1], marks[-1]
        if held is not None:
            yield batch_of(held[0], [blank], [("last", part, held[1])])

    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    done = stored(dealt.mapInArrow(compare, f"key {kind}, {COLUMNS}, edge string, part int, text string"), "compared")
    # Every non-empty range has one first and one last row: at most two rows a partition.
    used = sorted(r["part"] for r in done.where("edge = 'first'").select("part").collect())
    following = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "part int, next int")
    first = done.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("after"))
    last = done.where("edge = 'last'").select("key", "part", "text").join(following, "part").join(first, "next").select("key", "text", "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _maker(shared.value)
        for batch in sliced(batches):
            pairs = zip(batch.column("text").to_pylist(), batch.column("after").to_pylist())
            yield batch_of(batch.column("key"), [_compared(make, t, make(t), a, make(a)) for t, a in pairs])

    inner = done.where("edge is null").select(*names)
    return inner.union(last.mapInArrow(close, f"key {kind}, {COLUMNS}")).withColumnRenamed("key", key)
