"""Byte-level BPE encoding and decoding by merge ranks, over padded numpy matrices.

A text is cut into pieces by a pattern; distinct pieces are put into matrices by length, one piece a
row, one byte's id a cell.  Each round merges the leftmost pair of least rank in every row: pair ranks
come from a hash table over (left id, right id), only the two pairs beside a merge are looked up
again, and rows close up by one cell.  Rows without a mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced
from .units import Memo, spans

NO_RANK = np.int32(2**31 - 1)
EMPTY = np.int64(-1)
#: Pieces of more bytes are merged with a heap: a matrix takes a number of steps that is quadratic in its width.
LONG_PIECE = 2048
#: Distinct units that an encoder remembers.
MEMO_UNITS = 150_000
#: Cells of one matrix; bounds a task's memory.
CELLS = 1 << 21


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PairTable:
    """Open-addressing hash table from a pair of ids to the id (and rank) of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = np.array(pairs or [(0, 0, 0)], np.int64).T
        if not pairs:
            left, right, merged = left[:0], right[:0], merged[:0]
        self.bits = max(4, int(4 * len(left)).bit_length())
        self.keys, self.merged = np.full(1 << self.bits, EMPTY), np.zeros(1 << self.bits, np.int32)
        key, slot = left << 32 | right, self._slot(left << 32 | right)
        while len(key):
            free = np.flatnonzero(self.keys[slot] == EMPTY)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.merged[slot[put]] = key[put], merged[put]
            rest = np.ones(len(key), bool)
            rest[put] = False
            key, merged, slot = key[rest], merged[rest], slot[rest] + 1 & (1 << self.bits) - 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` where the pair isn't mergeable or holds padding (-1)."""
        out = np.full(left.shape, NO_RANK)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(key.flat[todo])
        while len(todo):
            found = self.keys[slot]
            hit = found == key.flat[todo]
            out.flat[todo[hit]] = self.merged[slot[hit]]
            on = ~hit & (found != EMPTY)
            todo, slot = todo[on], slot[on] + 1 & (1 << self.bits) - 1
        return out


def merge_matrix(rows: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge all rows (ids, padded with -1 at the right) to the end; ids concatenated, and their counts."""
    n = len(rows)
    index, done = np.arange(n), [None] * n
    rank = pairs.rank(rows[:, :-1], rows[:, 1:])
    while len(index):
        best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(index), np.int64)
        value = rank[np.arange(len(index)), best] if rank.shape[1] else np.full(len(index), NO_RANK)
        stop = value == NO_RANK
        for i, row in zip(index[stop].tolist(), rows[stop]):
            done[i] = row[row >= 0]
        on = ~stop
        index, rows, rank, best, value = index[on], rows[on], rank[on], best[on], value[on]
        if not len(index):
            break
        at = np.arange(len(index))
        rows[at, best] = value
        keep = np.ones(rows.shape, bool)
        keep[at, best + 1] = False
        rows = rows[keep].reshape(len(index), -1)
        keep = np.ones(rank.shape, bool)
        keep[at, best] = False
        rank = rank[keep].reshape(len(index), -1)
        has = best > 0
        rank[at[has], best[has] - 1] = pairs.rank(rows[at[has], best[has] - 1], rows[at[has], best[has]])
        has = best < rank.shape[1]
        rank[at[has], best[has]] = pairs.rank(rows[at[has], best[has]], rows[at[has], best[has] + 1])
    return np.concatenate(done), np.fromiter(map(len, done), np.int64, n)


def merge_long(ids: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """The same merges for one long piece: a heap of (rank, position) over a linked list."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(merges[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
    heapify(heap)
    while heap:
        rank, i, a, b = heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j], k = rank, -1, after[j]
        after[i] = k
        if k < n:
            before[k] = i
            if (r := merges.get((rank, ids[k]))) is not None:
                heappush(heap, (r, i, rank, ids[k]))
        h = before[i]
        if h >= 0 and (r := merges.get((ids[h], rank))) is not None:
            heappush(heap, (r, h, ids[h], rank))
    return [i for i in ids if i >= 0]


class Encoder:
    """Encodes whole texts by ranks; each match of the pattern is encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.find = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.merges: dict[tuple[int, int], int] | None = None
        self.memo = Memo(self._encode_units, MEMO_UNITS)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.memo.encode(texts)

    def _encode_units(self, new: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        cut = [self.find(u) for u in new]
        pieces: dict[str, int] = {}
        parts = np.array([pieces.setdefault(p, len(pieces)) for c in cut for p in c], np.int64)
        ids, counts = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in pieces])
        ends = np.cumsum(counts)
        flat = spans(ids, (ends - counts)[parts], counts[parts])
        total = np.concatenate([[0], np.cumsum(counts[parts])])
        return new, flat, np.diff(total[np.cumsum([0, *map(len, cut)])])

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, concatenated, and their counts."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(p) > LONG_PIECE:
                out[i] = np.array(self._long(p), np.int32)
            else:
                buckets.setdefault(max(4, len(p) + 3 & ~3) if len(p) <= 32 else 1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for lo in range(0, len(members), step):
                part = members[lo:lo + step]
                length = np.array([len(pieces[i]) for i in part])
                data = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
                rows = np.where(np.arange(width) < length[:, None], self.byte[data], np.int32(-1))
                ids, counts = merge_matrix(rows, self.pairs)
                ends = np.cumsum(counts)
                for i, a, b in zip(part, (ends - counts).tolist(), ends.tolist()):
                    out[i] = ids[a:b]
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.fromiter(map(len, out), np.int64, len(out))

    def _long(self, piece: bytes) -> list[int]:
        if self.merges is None:
            used = self.pairs.keys != EMPTY
            keys = self.pairs.keys[used]
            self.merges = dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist()), self.pairs.merged[used].tolist()))
        return merge_long(self.byte[np.frombuffer(piece, np.uint8)].tolist(), self.merges)


class Decoder:
    """Bytes of id sequences, by one gather over the tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        count = max(ranks.values()) + 1
        tokens = [b""] * count
        for token, rank in ranks.items():
            tokens[rank] = token
        self.length = np.fromiter(map(len, tokens), np.int64, count)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``counts`` ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length)):
            raise ValueError("an id is not in the vocabulary")
        size = self.length[ids]
        flat = spans(self.bytes, self.first[ids], size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(np.r_[0, counts])].tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]


#: Per worker process, the encoder or decoder of a broadcast vocabulary, by the broadcast's dict.
def _made(shared: dict, kind: str):
    if kind not in shared:
        shared[kind] = Encoder(shared["ranks"], shared["pattern"]) if kind == "encoder" else Decoder(shared["ranks"])
    return shared[kind]


def _renamed(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (array of int) for each row of ``docs``; null and empty texts get no ids.

    Whole texts of any length are encoded, as the pattern cuts them, without special tokens; the
    number of merge rounds of a piece grows with its length, and pieces over ``LONG_PIECE`` bytes use
    a heap.  ``ranks`` must hold all 256 bytes.  Repeated rows are encoded alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks, "pattern": pattern})
    rows = docs.select(F.col(key).alias("key"), F.col("text").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _made(shared.value, "encoder")
        for batch in sliced(batches):
            ids, counts = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(offsets, pa.array(ids))], ["key", "ids"])

    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the bytes of its ``ids`` as ``to``; null ids give no bytes.

    An id outside the vocabulary raises ``ValueError``.
    """
    shared = encoded.sparkSession.sparkContext.broadcast({"ranks": ranks})
    schema = T.StructType([*encoded.schema.fields, T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _made(shared.value, "decoder")
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                lists = batch.column(ids)
                counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                found = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, to])

    return encoded.mapInArrow(run, schema)
