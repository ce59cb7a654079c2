"""Token-id files: blocks of ids in bit or byte planes, each compressed with zstandard, and a chunk index.

Layout under one folder, both parts Parquet so that any store Spark can write will do:

``chunks``  one row a chunk: its shard, its number in the shard, the count of ids before it in the shard,
            the documents it holds with their id counts, and its blocks.  A block holds up to ``block``
            ids, as a count and a list of planes.  Byte plane ``p`` is byte ``p`` (little-endian) of every
            id; bit plane ``p`` is bit ``p``, eight ids to a byte.  A document never spans two chunks.
``index``   the same rows without documents and blocks, with the chunk's first key, document count and
            compressed size: where each chunk's ids begin and what reading it costs.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced
from .units import spans, units

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 18
#: Distinct units that a worker remembers (about 150 bytes each): the library's work is on those it hasn't met.
MEMO_UNITS = 1_250_000
WIDTH = {"byte": 4, "bit": 32}


def to_planes(ids: np.ndarray, planes: str = "byte", level: int = 3) -> list[bytes]:
    """The compressed planes of one block of ids."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        parts = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        parts = raw.T
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(np.ascontiguousarray(p).tobytes()) for p in parts]


def from_planes(count: int, planes: list[bytes]) -> np.ndarray:
    """The ids of a block; the number of planes tells their kind."""
    unpack = zstandard.ZstdDecompressor()
    parts = np.array([np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]).reshape(len(planes), -1)
    if len(planes) == WIDTH["bit"]:
        bits = np.unpackbits(parts, axis=1, bitorder="little")[:, :count]
        raw = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        raw = parts.T
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def _any_of(contents: list[str]) -> re.Pattern | None:
    return re.compile("|".join(map(re.escape, contents))) if contents else None


class _Numbers(dict):
    """Numbers keys as they are first looked up, and lists those that are new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class UnitMemo:
    """Remembers the ids of units, which it looks up once for each time that they occur.

    ``encode_new`` gets distinct units and returns them in an order of its own, their ids concatenated, and the count of each."""

    def __init__(self, encode_new: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]], limit: int):
        self.encode_new, self.limit = encode_new, limit
        self.clear()

    def clear(self) -> None:
        self.numbers, self.used = _Numbers(), 0
        self.ids, self.first, self.count = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def _add(self) -> None:
        order, ids, counts = self.encode_new(self.numbers.new)  # may hold more than was asked for
        at = np.fromiter(map(self.numbers.__getitem__, order), np.int64, len(order))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.numbers) > len(self.first):
            self.first, self.count = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.count))
        self.ids[self.used:self.used + len(ids)] = ids
        self.first[at], self.count[at] = self.used + np.cumsum(counts) - counts, counts
        self.used += len(ids)
        self.numbers.new = []

    def encode(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, given as lists of units, concatenated, and each text's count of ids."""
        if len(self.numbers) > self.limit:
            self.clear()
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        parts = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        if self.numbers.new:
            self._add()
        counts = self.count[parts]
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        return spans(self.ids, self.first[parts], counts), np.diff(ends[np.cumsum(np.concatenate([[0], sizes]))])


class LibraryEncoder:
    """Encodes units of text as the library's ``encode(text, add_special_tokens=False)`` does whole texts;
    so an added token that a text holds, special or not, becomes its id.

    Units that begin with a space and a character follow each other in one string for the library: no
    piece of the byte-level pattern spans two of them, and the tokens' bytes tell where each ends.  Those
    that hold an added token are encoded alone.  Where such a token may reach over a space, a text that
    holds it isn't cut.
    """

    #: Units in one string, and strings in one call of the library.
    JOINED, STRINGS = 20, 250

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = _any_of([t.content for t in added])
        self.uncut = _any_of([t.content for t in added if t.rstrip or any(map(str.isspace, t.content))])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # one character of a token is one byte
        self.signs = {c: i[0] for c in ".," if len(i := self._ids([c])[0]) == 1}
        self.memo = UnitMemo(self._encode, MEMO_UNITS)

    def _cut(self, text: str) -> list[str]:
        return [text] if self.uncut and self.uncut.search(text) else units(text)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, new: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """A unit that ends in a full stop or comma behind an ASCII letter takes the ids of what stands before, which is a
        unit itself, and that of the sign: a piece of the pattern ends there."""
        ended = [u[-1:] in self.signs and u[-2:-1].isascii() and u[-2:-1].isalpha() for u in new]
        if self.added and self.added.search("\0".join(new)):
            ended = [e and not self.added.search(u) for e, u in zip(ended, new)]
        whole, cut = list(compress(new, map(not_, ended))), list(compress(new, ended))
        known, fresh = self.memo.numbers, set(new)
        stems = [u[:-1] for u in cut]
        order, ids, counts = self._encode_whole([*whole, *{t for t in stems if t not in known and t not in fresh}])
        if not cut:
            return order, ids, counts
        # A stem is remembered, or among the new ones; those of ``fresh`` that end so are never a stem, which ends in a letter.
        used = self.memo.used
        place = dict(zip(order, range(len(order))))
        at = np.array([place[t] if t in place else len(order) + known[t] for t in stems])
        first = np.concatenate([used + np.cumsum(counts) - counts, self.memo.first])[at]
        count = np.concatenate([counts, self.memo.count])[at]
        ends = np.cumsum(count + 1)
        joined = np.empty(ends[-1], np.int32)
        last = np.zeros(len(joined), bool)
        last[ends - 1] = True
        joined[~last] = spans(np.concatenate([self.memo.ids[:used], ids]), first, count)
        joined[last] = [self.signs[u[-1]] for u in cut]
        return order + cut, np.concatenate([ids, joined]), np.concatenate([counts, count + 1])

    def _encode_whole(self, new: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        apart = [len(u) > 1 and u.strip() == u[1:] for u in new]  # one space before, none behind
        if self.added and self.added.search("\0".join(new)):
            apart = [a and not self.added.search(u) for a, u in zip(apart, new)]
        alone, joined = list(compress(new, map(not_, apart))), list(compress(new, apart))
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        most = self.JOINED * self.STRINGS
        for lo in range(0, len(alone), most):
            found = self._ids(alone[lo:lo + most])
            ids.append(np.fromiter(chain.from_iterable(found), np.int32))
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        for lo in range(0, len(joined), most):
            part = joined[lo:lo + most]
            strings = ["".join(part[i:i + self.JOINED]) for i in range(0, len(part), self.JOINED)]
            found = np.fromiter(chain.from_iterable(self._ids(strings)), np.int32)
            ends = np.cumsum(self.bytes[found])
            ascii_only = all(map(str.isascii, strings))
            wanted = np.cumsum(list(map(len, part)) if ascii_only else [len(u.encode("utf-8", "surrogatepass")) for u in part])
            at = np.searchsorted(ends, wanted)
            if not (ends[at] == wanted).all():
                raise ValueError("the tokenizer is not byte-level")
            ids.append(found)
            counts.append(np.diff(at, prepend=-1))
        return alone + joined, np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.memo.encode(list(map(self._cut, texts)))


def _schema(kind: str) -> str:
    return (f"shard int, chunk int, first_id long, n_ids long, keys array<{kind}>, counts array<long>, "
            "blocks array<struct<n:int,planes:array<binary>>>, bytes long")


def write(docs: DataFrame, path: str, definition: str, end_id: int | None, key: str = "doc_id", planes: str = "byte",
          block: int = BLOCK_IDS, chunk: int = CHUNK_IDS) -> None:
    """Encode every row's ``text`` and write the ids in ascending ``key`` order under ``path``.

    ``definition`` is the JSON of a byte-level tokenizer; ``end_id`` closes each document.  Whole texts are
    encoded; a null text is empty.  Null keys come first; equal keys follow each other by a hash of
    their text.  Documents are dealt to shards by ranges of (key, text hash); each shard is written by
    one task in order, a chunk at a time.  An empty table gives files without chunks.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    shared = spark.sparkContext.broadcast({"definition": definition})
    kind = rows.schema["key"].dataType.simpleString()
    names = [f.split()[0] for f in ("shard", "chunk", "first_id", "n_ids", "keys", "counts", "blocks", "bytes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "encoder" not in state:
            state["encoder"] = LibraryEncoder(state["definition"])
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        keys, counts, parts, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            blocks = [{"n": len(ids[lo:lo + block]), "planes": to_planes(ids[lo:lo + block], planes)} for lo in range(0, len(ids), block)]
            size = sum(len(p) for b in blocks for p in b["planes"])
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(key_type), pa.list_(pa.int64()),
                     pa.list_(pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))])), pa.int64()]
            values = [shard, number, before, held, keys, counts, blocks, size]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in sliced(batches):
            key_type = batch.column("key").type
            ids, sizes = state["encoder"].encode(batch.column("text").to_pylist())
            ends = np.cumsum(sizes)
            close = [] if end_id is None else [np.array([end_id], np.int32)]
            for k, a, b in zip(batch.column("key").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                keys.append(k)
                counts.append(b - a + len(close))
                parts += [ids[a:b], *close]
                held += counts[-1]
                if held >= chunk:
                    yield out()
                    number, before = number + 1, before + held
                    keys, counts, parts, held = [], [], [], 0
        if keys:
            yield out()

    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, _schema(kind)).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    (spark.read.parquet(f"{path}/chunks")
     .select("shard", "chunk", "first_id", "n_ids", F.element_at("keys", 1).alias("first_key"), F.size("keys").alias("n_docs"), "bytes")
     .write.parquet(f"{path}/index"))


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``start`` (ids of all documents before it) and ``ids`` (little-endian unsigned 32-bit, as
    binary) of every document in the files under ``path``."""
    shards = (spark.read.parquet(f"{path}/index").groupBy("shard").agg(F.max(F.col("first_id") + F.col("n_ids")).alias("n"))
              .orderBy("shard").collect())  # one row a shard
    before, base = 0, {}
    for s in shards:
        base[s["shard"]], before = before, before + s["n"]
    shared = spark.sparkContext.broadcast(base)
    chunks = spark.read.parquet(f"{path}/chunks").select("shard", "first_id", "keys", "counts", "blocks")
    kind = chunks.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                blocks = [from_planes(b["n"], b["planes"]) for b in row["blocks"].as_py()]
                ids = np.concatenate(blocks) if blocks else np.zeros(0, "<u4")
                counts = np.array(row["counts"].as_py(), np.int64)
                ends = np.cumsum(counts)
                starts = shared.value[row["shard"].as_py()] + row["first_id"].as_py() + ends - counts
                found = [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([row["keys"].values, pa.array(starts, pa.int64()), pa.array(found, pa.binary())], ["key", "start", "ids"])

    return chunks.mapInArrow(run, f"key {kind}, start long, ids binary").withColumnRenamed("key", key)
