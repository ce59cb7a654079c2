"""Katz backoff bigram model: Good-Turing discounted counts, exactly normalised backoff weights.

    P(w | h) = c*(h, w) / c(h)      if h w was seen in training
             = alpha(h) P(w)        else; alpha(h) = 1 for an unseen h
    P(w)     = c*(w) / N            if w was seen; else the mass that the discounts leave, for any unseen word

``c*`` discounts counts up to ``TOP`` by Good-Turing and larger ones by ``FLOOR``, so every history leaves
mass for its backoff, and alpha makes each distribution sum to 1.

Three tables are stored in parts: ``unigrams`` (by a hash of the word), ``pairs`` (by a hash of the
second word; holds the counts of pairs) and ``backoff`` (by the history).  Token occurrences travel
once, packed by word: a part has all pairs that end in its words, so it counts both and scores the
occurrences it holds per document.  A word that alone would fill half a part is dealt by its history as
well, and its count, known from the unigrams, travels with the job: there are at most two such words a
part.  Only the unseen pairs go on, to the weight of their history.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced, stored
from .packing import differs, expand, runs, squeeze
from .wordcounts import counted

TOP = 5
FLOOR = 0.5
#: Tokens that a task packs at once; bounds its memory.
FLUSH = 1_500_000
#: Sums travel as multiples of this.
UNIT = 2.0**-34
#: No word holds a space, so these hashes are those of no word.
START, END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" start", b" end"))
END_TERM = b" end"


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def good_turing(of: list[int]) -> np.ndarray:
    """Discounted counts of 0 to ``TOP``; ``of[r]`` is the number of n-grams seen r times, r up to ``TOP`` + 1.

    Where too few are seen for a discount between 0 and 1, the count is lowered by ``FLOOR``.
    """
    lost = (TOP + 1) * of[TOP + 1] / of[1] if of[1] else 0.0
    out = np.zeros(TOP + 1)
    for r in range(1, TOP + 1):
        ratio = -1.0
        if of[r] and lost < 1:
            ratio = ((r + 1) * of[r + 1] / (r * of[r]) - lost) / (1 - lost)
        out[r] = r * ratio if 0 < ratio < 1 else r - FLOOR
    return out


def discounted(counts: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.where(counts > TOP, counts - FLOOR, low[np.minimum(counts, TOP).astype(np.int64)])


class Unigrams:
    """Size of the training data, and log10 P(w) by a word's count."""

    def __init__(self, tokens: int, distinct: int, of: list[int]):
        self.tokens, self.distinct, self.low = tokens, distinct, good_turing(of)
        lost = sum((r - self.low[r]) * of[r] for r in range(1, TOP + 1)) + FLOOR * (distinct - sum(of[1:TOP + 1]))
        self.unseen = lost / tokens if tokens else 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.low) / max(1, self.tokens), self.unseen)


def _batch(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def _send(batches: Iterator[pa.RecordBatch], buckets: int, hot: dict[int, int], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Occurrences packed by the bucket of their word; and, for each flush, its documents in order."""
    names = ["bucket", "flush", "blob", "keys", "train", "sizes"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.list_(kind), pa.list_(pa.bool_()), pa.list_(pa.int32())]
    part, number = TaskContext.get().partitionId(), 0
    vocabulary: dict[bytes, int] = {}
    tokens, keys, train = [], [], []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        name = part << 32 | number
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        yield _batch(names, types, [(name % buckets, name, None, keys, train, sizes.tolist())])
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
        hashes = np.r_[START, END, hashes]
        bucket = (hashes >> np.uint64(33)).astype(np.int64) % buckets
        order = np.lexsort((hashes, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        hashes, bucket = hashes[order], bucket[order]
        w = np.concatenate(tokens)
        h = np.r_[0, w[:-1]]
        h[np.cumsum(sizes) - sizes] = 0  # the start
        d, v = len(sizes), len(hashes)
        key = (rank[w] * v + rank[h]) * d + np.repeat(np.arange(d), sizes)
        key.sort()
        first, times = runs(differs(key))
        key = key[first]
        doc, w, h = key % d, key // d // v, key // d % v
        to = bucket[w]
        spread = np.isin(hashes, np.fromiter(hot, np.uint64, len(hot)))[w]
        to[spread] = ((hashes[w[spread]] ^ hashes[h[spread]] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(to, kind="stable")
        to, doc, w, h, times = to[order], doc[order], w[order], h[order], times[order]
        known = np.packbits(np.array(train, bool))
        edges = np.searchsorted(to, np.arange(buckets + 1))
        for b, (lo, hi) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
            if lo < hi:
                w_first, w_times = runs(differs(w[lo:hi]))
                histories, which = np.unique(hashes[h[lo:hi]], return_inverse=True)
                yield _batch(names, types, [(b, name, squeeze(
                    _steps(hashes[w[lo:hi][w_first]]), w_times.astype(np.int32), _steps(histories), which.astype(np.uint32),
                    doc[lo:hi].astype(np.uint32), times[lo:hi].astype(np.uint32), known), None, None, None)])

    for batch in sliced(batches):
        for k, t, text in zip(*(batch.column(c).to_pylist() for c in ("key", "train", "text"))):
            tokens.append(np.fromiter([*(vocabulary.setdefault(x, len(vocabulary) + 2) for x in words(text)), 1], np.int64))
            keys.append(k)
            train.append(t)
            held += len(tokens[-1])
            if held >= FLUSH:
                yield from flush()
                number, vocabulary, tokens, keys, train, held = number + 1, {}, [], [], [], 0
    if keys:
        yield from flush()


PARTS = "flush long, keys array<{}>, train array<boolean>, sizes array<int>, sums binary, pairs binary, unseen binary, seen_times array<long>"


def _buckets(batches: Iterator[pa.RecordBatch], blob: str) -> Iterator[tuple[pa.RecordBatch | None, list[tuple[int, bytes]]]]:
    """From batches sorted by bucket: rows without a blob as they come, and all (flush, blob) of each bucket."""
    now, rows = None, []
    for batch in batches:
        for i, (bucket, name, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("bucket", "flush", blob)))):
            if data is None:
                yield batch.slice(i, 1), []
                continue
            if bucket != now and rows:
                yield None, rows
                rows = []
            now = bucket
            rows.append((name, data))
    if rows:
        yield None, rows


def _count(batches: Iterator[pa.RecordBatch], unigrams: Unigrams, hot: dict[int, int], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Counts of each bucket's words and pairs, the sums of its occurrences by document, and the unseen pairs."""
    names = ["flush", "keys", "train", "sizes", "sums", "pairs", "unseen", "seen_times"]
    types = [pa.int64(), pa.list_(kind), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    blank = (None,) * len(names)
    for documents, rows in _buckets(batches, "blob"):
        if documents is not None:
            yield _batch(names, types, [(documents.column("flush")[0].as_py(), *(documents.column(c)[0].as_py() for c in names[1:4]), *blank[4:])])
            continue
        flushes = [name for name, _ in rows]
        parts = []
        for i, (_, blob) in enumerate(rows):
            w, times, h, which, doc, n, known = expand(blob, np.uint64, np.int32, np.uint64, np.uint32, np.uint32, np.uint32, np.uint8)
            parts.append((np.repeat(np.cumsum(w, dtype=np.uint64), times), np.cumsum(h, dtype=np.uint64)[which], doc, n, np.unpackbits(known)[doc].astype(bool),
                          np.full(len(doc), i, np.uint32)))
        word, history, doc, n, train, flush = (np.concatenate([p[i] for p in parts]) for i in range(6))
        del parts
        distinct, w = np.unique(word, return_inverse=True)
        histories, h = np.unique(history, return_inverse=True)
        del word, history
        learnt = np.where(train, n, 0).astype(np.float64)
        count = np.bincount(w, learnt, len(distinct)).astype(np.int64)
        for i in np.flatnonzero(np.isin(distinct, np.fromiter(hot, np.uint64, len(hot)))).tolist():
            count[i] = hot[int(distinct[i])]
        pairs, pair = np.unique(w * len(histories) + h, return_inverse=True)
        pair_count = np.bincount(pair, learnt, len(pairs)).astype(np.int64)
        c = pair_count[pair]
        with np.errstate(divide="ignore"):
            lower = np.log10(unigrams.probability(count))
            as_history = np.where((distinct != END) & (count > 0), np.log10(np.maximum(count, 1)), 0.0)
        value = np.where(c > TOP, np.log10(np.maximum(c, 1) - FLOOR), np.where(c == 0, lower[w], 0.0)) - as_history[w]
        # Sums by document of a flush.
        row = flush.astype(np.int64) << 32 | doc
        seen_in, at = np.unique(row, return_inverse=True)
        times = n.astype(np.float64)
        sums = [np.bincount(at, times * (count > 0)[w]), *(np.bincount(at, times * (c == r)) for r in range(1, TOP + 1))]
        real = [np.rint(np.bincount(at, times * x) / UNIT).astype(np.int64) for x in (np.log10(count + 1.0)[w], value)]
        first, size = runs(differs(seen_in >> 32))
        for lo, hi in zip(first.tolist(), (first + size).tolist()):
            blob = squeeze(np.diff((seen_in[lo:hi] & 0xFFFFFFFF).astype(np.uint32), prepend=np.uint32(0)),
                            *(s[lo:hi].astype(np.uint32) for s in sums), *(r[lo:hi] for r in real))
            yield _batch(names, types, [(flushes[int(seen_in[lo] >> 32)], *blank[1:4], blob, *blank[5:])])
        # The table of pairs.
        on = pair_count > 0
        w_first, w_times = runs(differs(pairs[on] // len(histories)))
        w_at = (pairs[on] // len(histories))[w_first]
        table = squeeze(_steps(distinct[w_at]), count[w_at], w_times.astype(np.int32), _steps(histories), (pairs[on] % len(histories)).astype(np.uint32), pair_count[on])
        of = np.bincount(np.minimum(pair_count[on], TOP + 2), minlength=TOP + 3)[:TOP + 2]
        # Unseen pairs, by history.
        missing = np.flatnonzero(c == 0)
        missing = missing[np.lexsort((row[missing], h[missing]))]
        begin, _ = runs(differs(h[missing], row[missing]))
        total = np.add.reduceat(n[missing], begin).astype(np.uint32) if len(begin) else np.zeros(0, np.uint32)
        missing = missing[begin]
        left = squeeze(_steps(histories[h[missing]]), np.array(flushes, np.int64)[flush[missing]], doc[missing].astype(np.uint32), total)
        yield _batch(names, types, [(None, *blank[1:5], table, left, of.tolist())])


def _masses(batches: Iterator[pa.RecordBatch], unigrams: Unigrams, low: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per history of a part of the pairs: its count, discounted count and the lower probability of its successors."""
    for batch in batches:
        for blob in batch.column("pairs").to_pylist():
            _, count, times, histories, h, c = expand(blob, np.uint64, np.int64, np.int32, np.uint64, np.uint32, np.int64)
            histories = np.cumsum(histories, dtype=np.uint64)
            sums = [np.bincount(h, x, len(histories)) for x in (c, discounted(c, low), unigrams.probability(np.repeat(count, times)))]
            used = sums[0] > 0
            histories, sums = histories[used], [s[used] for s in sums]
            bucket = (histories >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            first, size = runs(differs(bucket[order]))
            rows = []
            for lo, n in zip(first.tolist(), size.tolist()):
                o = order[lo:lo + n]
                rows.append((int(bucket[o[0]]), 0, squeeze(_steps(histories[o]), sums[0][o].astype(np.int64), sums[1][o], sums[2][o])))
            yield _batch(["bucket", "flush", "blob"], [pa.int32(), pa.int64(), pa.binary()], rows)


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The backoff weight of each history of a bucket."""
    for _, rows in _buckets(batches, "blob"):
        parts = [expand(blob, np.uint64, np.int64, np.float64, np.float64) for _, blob in rows]
        history = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        distinct, at = np.unique(history, return_inverse=True)
        total, mass, lower = (np.bincount(at, np.concatenate([p[i] for p in parts])) for i in (1, 2, 3))
        alpha = (1 - mass / total) / (1 - lower)
        yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(total.astype(np.int64)), pa.array(alpha)], ["history", "n", "alpha"])


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("unseen").to_pylist():
            h, flush, doc, n = expand(blob, np.uint64, np.int64, np.uint32, np.uint32)
            for lo in range(0, len(h), 100_000):
                cut = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(h, dtype=np.uint64).view(np.int64)[cut]), pa.array(flush[cut]), pa.array(doc[cut].astype(np.int64)),
                                                  pa.array(n[cut].astype(np.int64))], ["history", "flush", "doc", "n"])


def _totals(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The sums of each document, from those of all buckets; batches are sorted by flush."""
    now, documents, sums = None, None, None

    def out() -> pa.RecordBatch:
        keys, train, sizes = documents
        whole = np.zeros((TOP + 3, len(keys))) if sums is None else sums
        columns = [pa.array([now] * len(keys), pa.int64()), pa.array(np.arange(len(keys))), pa.array(keys, kind), pa.array(train, pa.bool_()),
                   pa.array(np.array(sizes, np.int64)), *(pa.array(x.astype(np.int64)) for x in whole[:TOP + 1]), *(pa.array(x * UNIT) for x in whole[TOP + 1:])]
        return pa.RecordBatch.from_arrays(columns, ["flush", "doc", "key", "train", "n_tokens", "n_known", *(f"seen_{r}" for r in range(1, TOP + 1)), "base", "value"])

    for batch in batches:
        for name, keys, train, sizes, blob in zip(*(batch.column(c).to_pylist() for c in ("flush", "keys", "train", "sizes", "sums"))):
            if name != now:
                if now is not None:
                    yield out()
                now, documents, sums = name, None, None
            if blob is None:
                documents = keys, train, sizes
                sums = np.zeros((TOP + 3, len(keys)), np.float64)
            else:  # the documents' row of a flush sorts first
                doc, *found = expand(blob, np.uint32, *[np.uint32] * (TOP + 1), np.int64, np.int64)
                sums[:, np.cumsum(doc)] += np.array(found, np.float64)
    if now is not None:
        yield out()


def score(docs: DataFrame, train: Column, key: str = "doc_id") -> DataFrame:
    """``key``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row.

    The model is learnt from the rows where ``train`` is true (null: false) and scores all rows, whole
    texts.  Tokens are :func:`words` and one end; the first token's history is a start symbol.
    ``score`` is log10 of the model's probability of a text, ``base_score`` that of add-one unigrams with
    one more type for unseen words; ``n_known`` counts tokens seen in training.  Null and empty texts
    have the end alone.  Repeated rows are learnt from and returned each; without training rows all
    scores are 0; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    key_type = rows.schema["key"].dataType
    kind = pa.schema(spark.createDataFrame([], rows.select("key").schema).toArrow().schema).field("key").type
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    table = stored(counted(rows.where("train"), lambda text: [*words(text), END_TERM]), "unigrams")
    of = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max(F.when(F.col("term") == F.lit(END_TERM), F.col("n"))), F.lit(0)),
                   *(F.coalesce(F.sum((F.col("n") == r).cast("long")), F.lit(0)) for r in range(1, TOP + 2))).first()
    unigrams, starts = Unigrams(of[0], of[1], [0, *of[3:]]), of[2]
    share = unigrams.tokens // (2 * buckets)
    hot = {xxhash.xxh3_64_intdigest(bytes(r["term"])): r["n"] for r in table.where(F.col("n") > share).collect()} if share else {}

    sent = rows.mapInArrow(lambda it: _send(it, buckets, hot, kind), f"bucket int, flush long, blob binary, keys array<{key_type.simpleString()}>, train array<boolean>, sizes array<int>")
    parts = stored(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                   .mapInArrow(lambda it: _count(it, unigrams, hot, kind), PARTS.format(key_type.simpleString())), "pairs")
    of = parts.where("seen_times is not null").agg(*(F.coalesce(F.sum(F.element_at("seen_times", r + 1)), F.lit(0)) for r in range(1, TOP + 2))).first()
    low = good_turing([0, *of])

    masses = parts.where("pairs is not null").select("pairs").mapInArrow(lambda it: _masses(it, unigrams, low, buckets), "bucket int, flush long, blob binary")
    backoff = stored(masses.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_weights, "history long, n long, alpha double"), "backoff")

    # In a part, -log10 c(h) was taken for every token; an unseen pair has the weight of its history instead.
    weight = F.log10("alpha") + F.log10(backoff["n"])
    missing = parts.where("unseen is not null").select("unseen").mapInArrow(_unseen, "history long, flush long, doc long, n long")
    missing = (missing.withColumnRenamed("n", "times").join(backoff, "history").select("flush", "doc", (F.col("times") * weight).alias("x"))
               .groupBy("flush", "doc").agg(F.sum("x").alias("unseen")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(["flush long, doc long", f"key {key_type.simpleString()}", "train boolean, n_tokens long, n_known long",
                        *(f"seen_{r} long" for r in range(1, TOP + 1)), "base double, value double"])
    totals = (parts.where("flush is not null").select("flush", "keys", "train", "sizes", "sums").repartition(n, "flush")
              .sortWithinPartitions("flush", F.col("sums").isNotNull()).mapInArrow(lambda it: _totals(it, kind), fields))
    with_discounts = F.col("value") + sum((F.col(f"seen_{r}") * log10(low[r]) for r in range(1, TOP + 1)), F.lit(0.0))
    whole = with_discounts + F.coalesce("unseen", F.lit(0.0)) - log10(max(1, starts))
    return totals.join(missing, ["flush", "doc"], "left").select(
        F.col("key").alias(key), "train", "n_tokens", "n_known", F.lit(unigrams.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * log10(unigrams.tokens + unigrams.distinct + 1)).alias("base_score"), whole.alias("score"))
