"""Exact substring dedup: longest previous factors over the suffixes that can match at all.

A byte goes if it lies in a ``length``-byte string that also starts in a document with a smaller id.

1. Anchors.  Of every run of ``length - gram + 1`` consecutive grams the one of least hash is an anchor,
   so equal strings of ``length`` bytes hold an anchor at the same place.  Anchor hashes are dealt to
   buckets; those in a single document cannot lie in a repeated string and end here.
2. Suffixes.  Around each other anchor its document's bytes are dealt to buckets by the gram.  The
   strings that hold the anchor start at consecutive suffixes; they are sorted, and from the common
   prefixes of neighbours the nearest suffixes with a smaller document, before and after, give each
   suffix its longest factor in an earlier document.  Those of full length mark their string.
3. Marks return to their documents, and the bytes they cover go.

Every task sends each anchor and each distinct context once, however many of its documents hold them.
The contexts of an anchor that occurs very often are not sent whole: they are cut into their strings, dealt
by all bytes of the string, of which a task again sends the rows of its smallest document only.  Equal
strings still meet, as the least anchor of a string is in the same place of both.

Memory.  The number of buckets follows the bytes of text, not the number of partitions; a task takes its
buckets one after the other.  The contexts of a bucket stay packed and are unpacked in portions of whole
grams (of whole strings, where those were cut).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, sliced, stored
from .packing import differs, expand, runs, squeeze

GRAM = 24
#: Anchors, and contexts, that a task holds before it sends them; bounds its memory.
FLUSH_ANCHORS, FLUSH_CONTEXTS = 1_500_000, 300_000
#: Places, or marks, that a task gathers before it sends them to their documents.
FLUSH_FOUND = 500_000
#: Bytes of text a bucket; a bucket's anchors, and what comes for its documents, are held at once.
BUCKET_BYTES = 8_000_000
#: Contexts unpacked at once, unless one gram alone has more.
PORTION = 200_000
#: Bytes of an Arrow batch of blobs; executors and Python workers hold one or two a task.
BATCH_BYTES, BATCH_CONF = 8_000_000, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Suffixes sorted at once, unless one gram alone has more.
SORT = 200_000
#: A gram that is an anchor this often is dealt by its strings; others go to one bucket each.
HOT = 20_000
NO_ID = 2**63 - 1
#: The bits of an anchor's hash that travel with its places.
LOW = np.uint64(0xFFFFFFFFFF)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(data)].copy().view(np.uint64).reshape(-1)


def _hash(*words: np.ndarray) -> np.ndarray:
    """Hash of the three words of each gram."""
    out = words[0] * _M1
    for word, factor in zip(words[1:], (_M2, _M1)):
        out ^= out >> np.uint64(29)
        out += word
        out *= factor
        out ^= out >> np.uint64(32)
    out *= _M2
    return out ^ (out >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position on."""
    words = _words(data)
    n = len(data) - GRAM + 1
    return _hash(words[:n], words[8:n + 8], words[16:n + 16])


def _sliding(a: np.ndarray, best: np.ufunc, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        a, span = best(a[:-span], a[span:]), span * 2
    return best(a[:len(a) - (width - span)], a[width - span:])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text of at least ``length`` bytes."""
    width = length - GRAM + 1
    hashes = gram_hashes(data)
    order = (hashes >> np.uint64(32)).astype(np.uint32)
    least = _sliding(order, np.minimum, width)
    edge = np.zeros(width - 1, np.uint32)
    chosen = _sliding(np.concatenate([edge, least, edge]), np.maximum, width)
    at = np.flatnonzero(order == chosen)
    return at, hashes[at]


def _held_by_several(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (hash, id), and for each row in that order whether its hash has more than one id."""
    order = np.lexsort((ids, hashes))
    h, d = hashes[order], ids[order]
    first, size = runs(differs(h))
    several = d[first] != d[first + size - 1] if len(first) else np.zeros(0, bool)
    return order, np.repeat(several, size)


def home(i: int, buckets: int) -> int:
    """The bucket of a document: ``pmod(xxhash64(id), buckets)`` in Spark."""
    digest = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42)
    return (digest - (1 << 64) if digest >> 63 else digest) % buckets


def _homes(ids: np.ndarray, buckets: int) -> np.ndarray:
    """:func:`home` of each id: xxHash64 of eight bytes, step by step."""
    p1, p2, p3, p4, p5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    out = turned(ids.astype(np.int64).view(np.uint64) * p2, 31) * p1 ^ p5 + np.uint64(42 + 8)
    out = turned(out, 27) * p1 + p4
    out = (out ^ out >> np.uint64(33)) * p2
    out = (out ^ out >> np.uint64(29)) * p3
    return ((out ^ out >> np.uint64(32)).view(np.int64) % buckets).astype(np.int32)


SENT = "bucket int, known binary, blob binary"


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (bucket, something for the documents at home there, something for the bucket)."""
    types = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bucket", "known", "blob"])


def _places(ids: np.ndarray, at: np.ndarray, buckets: int) -> list[tuple]:
    """(home bucket, packed ids and their anchor positions)."""
    homes = _homes(ids, buckets)
    order = np.lexsort((at, ids, homes))
    ids, at, homes = ids[order], at[order], homes[order]
    keep = differs(ids, at)
    ids, at, homes = ids[keep], at[keep], homes[keep]
    first, size = runs(differs(homes))
    out = []
    for lo, n in zip(first.tolist(), size.tolist()):
        starts, counts = runs(differs(ids[lo:lo + n]))
        out.append((int(homes[lo]), squeeze(ids[lo:lo + n][starts], counts.astype(np.int32), at[lo:lo + n].astype(np.uint32))))
    return out


def _send_anchors(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        hashes, ids, at = (np.concatenate([f[i] for f in found]) for i in range(3))
        found.clear()
        order, several = _held_by_several(hashes, ids)
        hashes, ids, at = hashes[order], ids[order], at[order]
        # All places of a hash that several documents here hold are known to matter: one is sent for the others.
        yield _sent([(b, blob, None) for b, blob in _places(ids[several], at[several], buckets)])
        lone = ~several | differs(hashes)
        size = runs(differs(hashes))[1]
        times = np.where(several, np.repeat(size, size), 1)[lone].astype(np.uint32)
        hashes, ids, at = hashes[lone], ids[lone], at[lone]
        bucket = (hashes >> np.uint64(40)).astype(np.int64) % buckets
        order = np.lexsort((at, ids, bucket))
        hashes, ids, at, times, bucket = hashes[order], ids[order], at[order], times[order], bucket[order]
        first, size = runs(differs(bucket))
        for lo, n in zip(first.tolist(), size.tolist()):
            part = slice(lo, lo + n)
            starts, counts = runs(differs(ids[part]))
            low = hashes[part] & LOW
            gaps = np.diff(at[part].astype(np.int64), prepend=0).astype(np.int32)  # starts anew, as a negative gap, with each document
            yield _sent([(int(bucket[lo]), None, squeeze(
                low.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint8), gaps, np.diff(ids[part][starts], prepend=0), counts.astype(np.int32), times[part]))])

    for batch in sliced(batches):
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            if len(data) < length:
                continue
            at, hashes = anchors(data, length)
            found.append((hashes, np.full(len(at), i, np.int64), at.astype(np.uint32)))
            held += len(at)
            if held >= FLUSH_ANCHORS:
                yield from flush()
                held = 0
    if found:
        yield from flush()


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes | None, list[bytes]]]:
    """From batches sorted by bucket: each ``known`` as it comes, and all blobs of each bucket."""
    now, rows = None, []
    for batch in batches:
        for bucket, known, blob in zip(*(batch.column(c) for c in ("bucket", "known", "blob"))):
            bucket = bucket.as_py()
            if known.is_valid:
                yield bucket, known.as_py(), []
                continue
            if bucket != now and rows:
                yield now, None, rows
                rows = []
            now = bucket
            rows.append(blob.as_py())  # one by one: a batch holds blobs of many buckets
    if rows:
        yield now, None, rows


HOMES = "bucket int, known binary"


def _to_homes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "known"])


def _repeated(batches: Iterator[pa.RecordBatch], buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Places of anchors that several documents hold, by home bucket; and with -1 for a bucket, the hashes of
    those that occur ``hot`` times."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        both = [np.concatenate(c) for c in zip(*found)]
        found.clear()
        return _to_homes(_places(*both, buckets))

    for bucket, known, blobs in _by_bucket(batches):
        if known is not None:
            yield _to_homes([(bucket, known)])
            continue
        parts = []
        for blob in blobs:
            low, high, gaps, ids, counts, times = expand(blob, np.uint32, np.uint8, np.int32, np.int64, np.int32, np.uint32)
            parts.append((low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32), np.repeat(np.cumsum(ids), counts),
                          np.cumsum(gaps, dtype=np.int64).astype(np.uint32), times))
        hashes, ids, at, times = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order, several = _held_by_several(hashes, ids)
        first, _ = runs(differs(hashes[order]))
        often = hashes[order][first][np.add.reduceat(times[order], first, dtype=np.int64) >= hot] if len(first) else hashes
        if len(often):
            yield _to_homes([(-1, often.tobytes())])
        found.append((ids[order[several]], at[order[several]]))
        held += len(found[-1][0])
        if held >= FLUSH_FOUND:
            yield flush()
            held = 0
    if found:
        yield flush()


class AtHome:
    """What has come for the documents of one bucket, by (id, text hash or 0)."""

    def __init__(self):
        self.bucket, self.parts, self.found = None, [], None

    def add(self, bucket: int, *columns: np.ndarray) -> None:
        if bucket != self.bucket:
            self.bucket, self.parts = bucket, []
        self.parts.append(columns)
        self.found = None

    def of(self, bucket: int, i: int, text_hash: int) -> list[np.ndarray]:
        """The further columns' rows of one document."""
        if bucket != self.bucket or not self.parts:
            return []
        if self.found is None:
            columns = [np.concatenate(c) for c in zip(*self.parts)]
            order = np.lexsort((columns[1], columns[0]))
            columns = [c[order] for c in columns]
            first, size = runs(differs(columns[0], columns[1]))
            self.columns = columns[2:]
            self.found = {(a, b): slice(lo, lo + n) for a, b, lo, n in zip(columns[0][first].tolist(), columns[1][first].tolist(), first.tolist(), size.tolist())}
        at = self.found.get((i, text_hash))
        return [] if at is None else [c[at] for c in self.columns]


def _contexts(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around each anchor, and how many of them before and from it on are the text's."""
    reach = length - GRAM
    padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, reach + length)[at]
    return around, np.minimum(at, reach).astype(np.uint8), np.minimum(len(data) - at.astype(np.int64), length).astype(np.uint8)


class Contexts:
    """Columns: bytes around an anchor, the text's share of them, document id, text hash, anchor position."""

    def __init__(self, around, left, right, ids, texts, at):
        self.around, self.left, self.right, self.ids, self.texts, self.at = around, left, right, ids, texts, at

    #: Before a packed blob: bytes of its small columns, rows, and whether each is cut to one string.
    HEAD = "<QQ?"

    def take(self, rows: np.ndarray) -> Contexts:
        return Contexts(*(c[rows] for c in vars(self).values()))

    @staticmethod
    def joined(parts: list) -> Contexts:
        return Contexts(*(np.concatenate(c) for c in zip(*(vars(p).values() for p in parts))))

    def pack(self, cut: bool = False) -> bytes:
        pairs, which = np.unique(np.stack([self.ids, self.texts], 1), axis=0, return_inverse=True)
        small = squeeze(self.left, self.right, self.at, which.reshape(-1).astype(np.uint32), pairs[:, 0].copy(), pairs[:, 1].copy())
        return struct.pack(self.HEAD, len(small), len(self.ids), cut) + small + zstandard.compress(np.ascontiguousarray(self.around), 3)

    @staticmethod
    def unpack(blob: bytes) -> Contexts:
        start = struct.calcsize(Contexts.HEAD)
        to = start + struct.unpack_from(Contexts.HEAD, blob)[0]
        left, right, at, which, ids, texts = expand(blob[start:to], np.uint8, np.uint8, np.uint32, np.uint32, np.int64, np.int64)
        around = np.frombuffer(zstandard.decompress(memoryview(blob)[to:]), np.uint8).reshape(len(left), -1)
        return Contexts(around, left, right, ids[which], texts[which], at)

    @staticmethod
    def portions(blobs: list[bytes]) -> Iterator[Contexts]:
        """All rows of some blobs; rows of one gram come together, or of one string where they are cut to it."""
        for cut in (False, True):
            mine = [(blob, rows) for blob in blobs for _, rows, kind in [struct.unpack_from(Contexts.HEAD, blob)] if kind == cut]
            times = -(-sum(rows for _, rows in mine) // PORTION)
            for k in range(times):
                parts = []
                for blob, _ in mine:
                    c = Contexts.unpack(blob)
                    if times > 1:  # by other bits than those that chose the bucket
                        c = c.take(np.flatnonzero((c.dealt_by(cut) * _M1 >> np.uint64(32)) % np.uint64(times) == k))
                    parts.append(c)
                c = Contexts.joined(parts)
                del parts
                if len(c.ids):
                    yield c

    def dealt_by(self, cut: bool) -> np.ndarray:
        """Hash of the gram, or of the string that each row is cut to."""
        if cut:
            return self.string_hashes()
        reach = (self.around.shape[1] - GRAM) // 2
        words = np.ascontiguousarray(self.around[:, reach:reach + GRAM]).view(np.uint64)
        mixed = (words[:, 0] * _M1 ^ words[:, 1]) * _M2 ^ words[:, 2] * _M1
        return (mixed ^ mixed >> np.uint64(29)) * _M2 >> np.uint64(33)

    def classes(self) -> tuple[Contexts, np.ndarray]:
        """Rows ordered by gram, whole context and id; and where a new whole context begins."""
        width = self.around.shape[1]
        reach = (width - GRAM) // 2
        whole = np.concatenate([self.around[:, reach:reach + GRAM], self.around[:, :reach], self.around[:, reach + GRAM:],
                                self.left[:, None], self.right[:, None]], axis=1)
        text = np.ascontiguousarray(whole).view(f"S{width + 2}").reshape(-1)
        order = np.lexsort((self.ids, text))
        return self.take(order), differs(text[order])

    def grams(self) -> np.ndarray:
        reach = (self.around.shape[1] - GRAM) // 2
        return np.ascontiguousarray(self.around[:, reach:reach + GRAM]).view(f"S{GRAM}").reshape(-1)

    def gram_hashes(self) -> np.ndarray:
        """As in the places, without their upper bits."""
        reach = (self.around.shape[1] - GRAM) // 2
        words = np.ascontiguousarray(self.around[:, reach:reach + GRAM]).view(np.uint64)
        return _hash(*words.T) & LOW

    def strings(self, length: int) -> Iterator[Contexts]:
        """Every possible string as a context of nothing else, in portions; those of one offset come together."""
        reach = length - GRAM
        possible = self.possible(length)

        def cut(l: int) -> Contexts:
            c = self.take(np.flatnonzero(possible >> np.uint64(l) & np.uint64(1)))
            around = np.zeros_like(c.around)
            around[:, reach - l:reach - l + length] = c.around[:, reach - l:reach - l + length]
            n = len(around)
            return Contexts(around, np.full(n, l, np.uint8), np.full(n, length - l, np.uint8), c.ids, c.texts, c.at)

        step = max(1, FLUSH_CONTEXTS // max(1, len(self.ids)))
        for lo in range(0, reach + 1, step):
            yield Contexts.joined([cut(l) for l in range(lo, min(lo + step, reach + 1))])

    def single(self, length: int) -> np.ndarray:
        """Whether a row has one possible string only."""
        return self.left.astype(np.int64) + self.right == length

    def string_hashes(self) -> np.ndarray:
        """Hash of all bytes."""
        width = self.around.shape[1]
        padded = np.zeros((len(self.around), -(-width // 8) * 8), np.uint8)
        padded[:, :width] = self.around
        out = np.zeros(len(padded), np.uint64)
        for word in padded.view(np.uint64).T:
            out = (out ^ word) * _M1
            out ^= out >> np.uint64(29)
        return out * _M2 >> np.uint64(33)

    def possible(self, length: int) -> np.ndarray:
        """Bit l of each row: the string that starts l bytes before the anchor lies inside the text."""
        least, most = (length - self.right.astype(np.int64)).astype(np.uint64), self.left.astype(np.uint64)
        return np.where(least <= most, (np.uint64(2) << most) - (np.uint64(1) << least), np.uint64(0))


def longest_previous(order: np.ndarray, common: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with one of a smaller id.

    ``order`` lists suffixes in order, ``common[i]`` is the common prefix of the i-th and the one before.
    The nearest suffixes of smaller id, before and after, hold the longest; both are found by jumping
    over suffixes of no smaller id, with the least common prefix on the way.
    """
    n = len(order)
    value = ids[order]
    best = np.zeros(n, np.int64)
    for step in (-1, 1):
        to = np.arange(n) + step
        least = np.zeros(n + 2, np.int64)
        least[:n] = common if step < 0 else np.r_[common[1:], 0]
        bound = np.full(n + 2, np.iinfo(np.int64).min)  # two rows beyond the ends are smaller than all, with nothing in common
        bound[:n] = value
        to = np.where((to < 0) | (to >= n), n, to)
        to = np.r_[to, n, n]
        least[:n][to[:n] == n] = 0
        while True:
            on = np.flatnonzero((bound[to[:n]] >= value) & (least[:n] > 0))
            if not len(on):
                break
            over = to[on]
            least_new, to_new = np.minimum(least[on], least[over]), to[over]
            least[on], to[on] = least_new, to_new
        best = np.maximum(best, np.where(bound[to[:n]] < value, least[:n], 0))
    out = np.zeros(n, np.int64)
    out[order] = best
    return out


def _earlier(c: Contexts, length: int) -> np.ndarray:
    """Bit l of each row (rows of whole grams, one a context): the string that starts l bytes before the
    anchor also occurs in a row of smaller id."""
    possible = c.possible(length)
    back = np.arange(length - GRAM + 1)
    row, l = np.nonzero(possible[:, None] >> back.astype(np.uint64) & np.uint64(1))
    reach = length - GRAM
    view = np.lib.stride_tricks.sliding_window_view(c.around, length, axis=1)
    suffixes = np.ascontiguousarray(view[row, reach - l])
    order = np.argsort(suffixes.view(f"S{length}").reshape(-1), kind="stable")
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        sorted_rows = suffixes[order]
        differ = sorted_rows[1:] != sorted_rows[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    hit = longest_previous(order, common, c.ids[row]) >= length
    out = np.zeros(len(possible), np.uint64)
    np.bitwise_or.at(out, row[hit], np.uint64(1) << l[hit].astype(np.uint64))
    return out


def _marked(ids: np.ndarray, texts: np.ndarray, at: np.ndarray, marks: np.ndarray, buckets: int) -> list[tuple]:
    """(home bucket, packed documents and anchor positions with their marked strings)."""
    homes = _homes(ids, buckets)
    order = np.lexsort((at, texts, ids, homes))
    ids, texts, at, marks, homes = (c[order] for c in (ids, texts, at, marks, homes))
    first, size = runs(differs(homes))
    out = []
    for lo, n in zip(first.tolist(), size.tolist()):
        part = slice(lo, lo + n)
        starts, counts = runs(differs(ids[part], texts[part]))
        out.append((int(homes[lo]), squeeze(ids[part][starts], texts[part][starts], counts.astype(np.int32), at[part].astype(np.uint32), marks[part])))
    return out


def _send_contexts(batches: Iterator[pa.RecordBatch], length: int, buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Contexts of the wanted places; in the batches, a bucket's places stand before its documents."""
    here = AtHome()
    parts: list[Contexts] = []
    held = 0

    def firsts(c: Contexts) -> tuple[pa.RecordBatch, Contexts]:
        """The marks of contexts that a smaller document of this task has as well: all their strings are repeats; and the others."""
        c, begins = c.classes()
        least = np.repeat(c.ids[begins], runs(begins)[1])
        marks, later = c.possible(length), c.ids > least
        later &= marks != 0
        marks = _marked(c.ids[later], c.texts[later], c.at[later], marks[later], buckets)
        return _sent([(b, blob, None) for b, blob in marks]), c.take(c.ids == least)

    def dealt(c: Contexts, cut: bool) -> Iterator[pa.RecordBatch]:
        bucket = c.dealt_by(cut).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first, size = runs(differs(bucket))
        for i, n in zip(first.tolist(), size.tolist()):
            yield _sent([(int(bucket[i]), None, c.take(order[i:i + n]).pack(cut))])

    def flush() -> Iterator[pa.RecordBatch]:
        c = Contexts.joined(parts)
        parts.clear()
        marks, c = firsts(c)
        yield marks
        del marks
        often = np.isin(c.gram_hashes(), hot)
        if often.any():
            for strings in c.take(often).strings(length):
                marks, strings = firsts(strings)
                yield marks
                yield from dealt(strings, True)
            del marks, strings
            c = c.take(~often)
        yield from dealt(c, False)

    for batch in sliced(batches):
        for bucket, known, i, text_hash, text in zip(*(batch.column(x).to_pylist() for x in ("bucket", "known", "id", "text_hash", "text"))):
            if known is not None:
                ids, counts, at = expand(known, np.int64, np.int32, np.uint32)
                here.add(bucket, np.repeat(ids, counts), np.zeros(len(at), np.int8), at)
                continue
            places = here.of(bucket, i, 0)
            if not places:
                continue
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            at = np.unique(places[0])
            at = at[at.astype(np.int64) + GRAM <= len(data)]  # another row with this id may be longer
            if len(data) < length or not len(at):
                continue
            for lo in range(0, len(at), FLUSH_CONTEXTS):
                part = at[lo:lo + FLUSH_CONTEXTS]
                around, left, right = _contexts(data, part, length)
                parts.append(Contexts(around, left, right, np.full(len(part), i, np.int64), np.full(len(part), text_hash, np.int64), part))
                held += len(part)
                if held >= FLUSH_CONTEXTS:
                    yield from flush()
                    held = 0
    if parts:
        yield from flush()


def _match(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Marks of the contexts of each bucket, by home bucket."""
    found: list[tuple[np.ndarray, ...]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*found)]
        found.clear()
        return _to_homes(_marked(*columns, buckets))

    for bucket, known, blobs in _by_bucket(batches):
        if known is not None:
            yield _to_homes([(bucket, known)])
            continue
        for c in Contexts.portions(blobs):
            found.append(_matched(c, length))
            held += len(found[-1][0])
            if held >= FLUSH_FOUND:
                yield flush()
                held = 0
    if found:
        yield flush()


def _matched(c: Contexts, length: int) -> tuple[np.ndarray, ...]:
    """Ids, text hashes, anchor positions and marks of the rows with marks; all rows of a gram, or of a string, are there."""
    c, begins = c.classes()
    first, size = runs(begins)
    least = np.repeat(c.ids[first], size)
    # A context that a smaller document has as well is a repeat for all its strings.  One row of each
    # context stands for all rows of its smallest document in the suffix order.
    stand = c.take(first)
    gram_first, gram_size = runs(differs(stand.grams()))
    marks = np.zeros(len(first), np.uint64)
    # Contexts of one string each are all different strings, or the same at another offset: nothing to find.
    several = (gram_size > 1) & ~np.logical_and.reduceat(stand.single(length), gram_first)
    chunk, count = [], 0
    for a, n in [*zip(gram_first[several].tolist(), gram_size[several].tolist()), (None, 0)]:
        if chunk and (a is None or (count + n) * (length - GRAM + 1) > SORT):
            rows_of = np.concatenate(chunk)
            marks[rows_of] = _earlier(stand.take(rows_of), length)
            chunk, count = [], 0
        if a is not None:
            chunk.append(np.arange(a, a + n))
            count += n
    marks = np.where(c.ids > least, c.possible(length), np.repeat(marks, size))
    on = marks != 0
    return c.ids[on], c.texts[on], c.at[on], marks[on]


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``stored``, with Arrow batches of ``BATCH_BYTES`` for its write."""
    conf = df.sparkSession.conf
    before = conf.get(BATCH_CONF, None)
    conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        return stored(df, name)
    finally:
        conf.unset(BATCH_CONF) if before is None else conf.set(BATCH_CONF, before)


def covered(size: int, length: int, at: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether each of ``size`` bytes lies in a marked string."""
    edge = np.zeros(size + 1, np.int64)
    row, back = np.nonzero(marks[:, None] >> np.arange(length - GRAM + 1, dtype=np.uint64) & np.uint64(1))
    start = np.unique(at[row].astype(np.int64) - back)  # a string may hold several anchors
    edge[start] += 1
    edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, length: int = 50, key: str = "doc_id", hot: int = HOT) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) of each row.

    A byte of a text's UTF-8 form is removed if a string of ``length`` bytes that covers it also starts
    in a document with a smaller id; strings are those of the input, and none crosses documents.
    ``n_spans`` counts maximal removed runs.  Nulls and empty texts have no bytes; a null id counts as
    larger than all others; rows with equal ids are not earlier than each other.  ``length`` is from
    ``GRAM`` + 1 to ``GRAM`` + 63.  An anchor that occurs ``hot`` times is dealt by its strings; the list of
    those is at most a ``hot``-th of the anchors, and the result doesn't depend on it.
    """
    if not GRAM < length <= GRAM + 63:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 63}")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions, -(-size // BUCKET_BYTES))
    rows = rows.withColumns({"text_hash": F.xxhash64("text"), "bucket": F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")})

    def dealt(df: DataFrame, *order: str) -> DataFrame:
        return df.repartition(partitions, "bucket").sortWithinPartitions("bucket", *order)

    def with_known(known: DataFrame, *columns: str) -> DataFrame:
        """Documents beside what has come for them, which sorts first in a bucket."""
        have = known.select("bucket", "known", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns])
        both = have.union(rows.select("bucket", F.lit(None).cast("binary").alias("known"), *columns))
        return dealt(both.withColumn("is_document", F.col("known").isNull()), "is_document")

    sent = rows.select("id", "text").mapInArrow(lambda it: _send_anchors(it, length, buckets), SENT)
    places = _stored(dealt(sent).mapInArrow(lambda it: _repeated(it, buckets, hot), HOMES), "places")
    often = [np.frombuffer(r["known"], np.uint64) for r in places.where("bucket < 0").select("known").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(np.unique(np.concatenate([np.zeros(0, np.uint64), *often])))
    contexts = (with_known(places.where("bucket >= 0"), "id", "text_hash", "text")
                .mapInArrow(lambda it: _send_contexts(it, length, buckets, shared.value), SENT))
    marks = _stored(dealt(contexts).mapInArrow(lambda it: _match(it, length, buckets), HOMES), "marks")
    discard(places)
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, types = AtHome(), (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in sliced(batches):
            found, kept = [], []
            for row, (bucket, known, i, text_hash, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("bucket", "known", "id", "text_hash", "text")))):
                if known is not None:
                    ids, texts, counts, at, strings = expand(known, np.int64, np.int64, np.int32, np.uint32, np.uint64)
                    here.add(bucket, np.repeat(ids, counts), np.repeat(texts, counts), at, strings)
                    continue
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                mine = here.of(bucket, i, text_hash)
                gone = covered(len(data), length, *mine) if mine else np.zeros(len(data), bool)
                found.append((len(data), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()), data[~gone].tobytes()))
                kept.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(kept, pa.int64())), *(pa.array([f[i] for f in found], t) for i, t in enumerate(types))],
                                             ["key", "n_bytes", "n_removed", "n_spans", "kept"])

    return (with_known(marks, "key", "id", "text_hash", "text")
            .mapInArrow(cut, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("key", key))
