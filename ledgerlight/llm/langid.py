"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of code points per language, distributed over the cluster;
the smoothed log-probability matrix (languages x buckets) has a size fixed by parameters, and is
broadcast.  Scoring looks up, per batch, the matrix rows of the n-grams that occur and sums them
by document.

The posterior of a text of more than a few letters is 1 whatever the text is, so :func:`accepted` also
asks for evidence that doesn't grow with length: the mean log-probability of the text's letter 3-grams
in the best language, and its lead over the second.  What both must reach is learned per language from
all training documents, each scored by a model that wasn't fitted on it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

#: Code points between two documents of a batch, so that no n-gram spans both.
GAP = 2
UNDETERMINED = "und"
LETTER, SPACE, DIGIT = 1, 2, 3
#: Held-out fits and leads are counted to the nearest of this many parts of a nat, so that what the quantiles
#: are taken from is bounded by their range, not by the number of documents.
GRID = 4096
#: A mean over n letter 3-grams is uncertain by this, in nats, over sqrt(n): two deviations of a single one.
SPREAD = 4.0
#: The gap assumed between a language and others where only one is learned, in nats a 3-gram.
LONE_GAP = 4.0
#: A text of this many letters of which fewer than the share are in words without digits is no language.
BLOB_LETTERS, BLOB_SHARE = 20, 0.25


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  #: float32, languages x buckets
    log_prior: np.ndarray  #: float64, languages
    #: float64, languages: least mean log-probability a letter 3-gram, and its least lead (-inf: not known).
    least_fit: np.ndarray = field(default_factory=lambda: np.zeros(0))
    least_lead: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with gaps, and each text's first position and length."""
    lower = [t.lower() for t in texts]
    length = np.fromiter(map(len, lower), np.int64, len(lower))
    start = np.concatenate([[0], np.cumsum(length + GAP)])[:-1]
    joined = ("\0" * GAP).join(lower) + "\0" * (GAP + 1)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), start, length


def _buckets(points: np.ndarray, bits: int, orders: int = 3) -> Iterator[np.ndarray]:
    """The bucket of the n-gram that starts at each position, for n = 1 to ``orders``."""
    state = np.zeros(len(points), np.uint32)
    for n in range(orders):
        if n:
            state = state[:-1]
        state = (state ^ points[n:]) * np.uint32(0x9E3779B1)
        state ^= state >> np.uint32(15)
        yield ((state + np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def _inside(start: np.ndarray, length: np.ndarray, total: int) -> np.ndarray:
    """1 at positions that belong to a text, 0 in the gaps."""
    edge = np.zeros(total + 1, np.int8)
    edge[start] += 1
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


@cache
def _kinds() -> np.ndarray:
    """LETTER (marks too), SPACE, DIGIT or 0 for every code point."""
    kinds = np.zeros(0x110000, np.uint8)
    for point in range(len(kinds)):
        c = chr(point)
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            kinds[point] = LETTER
        elif c.isspace():
            kinds[point] = SPACE
        elif c.isnumeric():
            kinds[point] = DIGIT
    return kinds


def _plain(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per position: a letter; one in a word without digits; the start of a 3-gram of those and spaces."""
    kind = _kinds()[points]
    letter, word = kind == LETTER, (kind == LETTER) | (kind == DIGIT)
    begins = word & ~np.r_[False, word[:-1]]
    first = np.flatnonzero(begins)
    digits = np.add.reduceat(kind == DIGIT, first, dtype=np.int64) if len(first) else np.zeros(1, np.int64)
    plain = letter & (digits[np.maximum(np.cumsum(begins) - 1, 0)] == 0)
    fits = plain | (kind == SPACE)
    return letter, plain, fits[:-2] & fits[1:-1] & fits[2:] & (plain[:-2] | plain[1:-1] | plain[2:])


def evidence(log_prob: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean log probability of every text's letter 3-grams (rows) in every language (columns), the count of
    those 3-grams, of the text's letters, and of its letters in words without digits."""
    points, start, length = _code_points(texts)
    letter, plain, counts = _plain(points)
    *_, bucket = _buckets(points, int(np.log2(log_prob.shape[1])))

    def by_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.float64), np.zeros(GAP)])
        total[len(values) + 1:] = total[len(values)]
        return total[start + length] - total[start]

    n = by_text(counts)
    mean = np.stack([by_text(np.where(counts, row[bucket], 0)) for row in log_prob], 1) / np.maximum(n, 1)[:, None]
    return mean, n, by_text(letter), by_text(plain)


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, int], np.ndarray] = {}
    for batch in sliced(batches):
        langs, halves = np.array(batch.column("lang").to_pylist(), object), batch.column("half").to_numpy()
        texts = batch.column("text").to_pylist()
        for lang, half in sorted(set(zip(langs, halves.tolist()))):
            points, start, length = _code_points([texts[i] for i in np.flatnonzero((langs == lang) & (halves == half))])
            inside = _inside(start, length, len(points))
            total = counts.setdefault((lang, half), np.zeros(1 << bits, np.int64))
            for bucket in _buckets(points, bits):
                total += np.bincount(bucket[inside[:len(bucket)]], minlength=1 << bits)
    for (lang, half), total in counts.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used)), pa.array([half] * len(used), pa.int32()), pa.array(used.astype(np.int32)), pa.array(total[used])],
            ["lang", "half", "bucket", "n"])


def _log_share(counts: np.ndarray) -> np.ndarray:
    return np.log(counts / counts.sum(axis=-1, keepdims=True)).astype(np.float32)


def _held_out(batches: Iterator[pa.RecordBatch], languages: list[str], log_probs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of every document with letter 3-grams, by the model of the other half: its own language's mean and lead."""
    at = {lang: i for i, lang in enumerate(languages)}
    for batch in sliced(batches):
        langs, halves = np.array([at[x] for x in batch.column("lang").to_pylist()]), batch.column("half").to_numpy()
        texts = batch.column("text").to_pylist()
        for half in (0, 1):
            rows = np.flatnonzero(halves == half)
            if not len(rows):
                continue
            mean, n, _, _ = evidence(log_probs[1 - half], [texts[i] for i in rows])
            own = mean[np.arange(len(rows)), langs[rows]]
            mean[np.arange(len(rows)), langs[rows]] = -np.inf
            lead, some = own - mean.max(axis=1), n > 0
            yield pa.RecordBatch.from_arrays([pa.array(langs[rows][some].astype(np.int32)), pa.array(own[some]), pa.array(lead[some])], ["at", "fit", "lead"])


def _quantiles(held: DataFrame) -> list[tuple]:
    """``at, leads, measure, [0.01 quantile, median]`` of the fits and leads of all rows, apart for those that lead and others."""
    values = held.select("at", (F.col("lead") > 0).alias("leads"), F.expr("stack(2, 'fit', fit, 'lead', lead) as (measure, value)"))
    counted = (values.withColumn("value", F.rint(F.col("value") * GRID) / GRID)
               .groupBy("at", "leads", "measure", "value").agg(F.count("*").alias("n")))
    return counted.groupBy("at", "leads", "measure").agg(F.percentile("value", [0.01, 0.5], F.col("n")).alias("q")).collect()


def _thresholds(n: int, quantiles: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Least fit and least lead of each of ``n`` languages.

    A text with a quarter in another language has half the usual lead.  The fit may be lower than usual by
    half of what a text of another language is, or as low as that of one in a hundred held-out documents.
    Held-out documents that fit another language better than their own are left out, unless all do.
    """
    least_fit, least_lead = np.full(n, -np.inf), np.full(n, -np.inf)
    found = {(at, leads, measure): q for at, leads, measure, q in quantiles}
    for i in range(n):
        leads = (i, True, "fit") in found
        if (i, leads, "fit") in found:
            (low, usual), (_, lead) = found[i, leads, "fit"], found[i, leads, "lead"]
            gap = lead if n > 1 else LONE_GAP
            least_lead[i] = gap / 2 if n > 1 else -np.inf
            least_fit[i] = min(usual - max(gap, 0) / 2, low)
    return least_fit, least_lead


def train(docs: DataFrame, max_docs_per_language: int | None = None, bits: int = 15, smoothing: float = 0.5,
          max_languages: int = 128) -> LanguageModel:
    """Fit on ``text`` and ``lang`` of the given documents; rows with a null in either are left out.

    Counts, priors and the thresholds of :func:`accepted` come from every document; for the latter each is
    scored by the n-grams of the half of the documents (by a hash of the text) that it isn't in.  The matrix
    is bounded by ``2**bits`` buckets times ``max_languages`` (more distinct labels raise ``ValueError``).
    No usable rows: a model without languages.  A caller that wants less work may name
    ``max_docs_per_language``: counts and thresholds then come from about as many, chosen by a hash of the text.
    """
    rows = docs.select(F.col("text").alias("text"), F.col("lang").alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} distinct labels")
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((0, 1 << bits), np.float32), np.zeros(0))
    if max_docs_per_language is not None:
        share = F.lit(0)
        for lang in languages:
            share = F.when(F.col("lang") == lang, F.lit(int((1 << 30) * min(1.0, max_docs_per_language / sizes[lang])))).otherwise(share)
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share)
    halved = rows.withColumn("half", F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int"))
    counted = (halved.mapInArrow(lambda it: _count(it, bits), "lang string, half int, bucket int, n long")
               .groupBy("lang", "half", "bucket").agg(F.sum("n").alias("n")))
    counts = np.zeros((2, len(languages), 1 << bits))
    at = {lang: i for i, lang in enumerate(languages)}
    got = counted.toArrow()
    counts[got.column("half").to_numpy(), [at[x] for x in got.column("lang").to_pylist()], got.column("bucket").to_numpy()] += got.column("n").to_numpy()
    total = np.array([sizes[x] for x in languages], float)
    halves = docs.sparkSession.sparkContext.broadcast(_log_share(counts + smoothing))
    held = halved.mapInArrow(lambda it: _held_out(it, languages, halves.value), "at int, fit double, lead double")
    thresholds = _thresholds(len(languages), _quantiles(held))
    return LanguageModel(languages, _log_share(counts.sum(axis=0) + smoothing), np.log(total / total.sum()), *thresholds)


def log_likelihood(log_prob: np.ndarray, log_prior: np.ndarray, texts: list[str]) -> np.ndarray:
    """Joint log probability of every text (rows) in every language (columns)."""
    points, start, length = _code_points(texts)
    bits = int(np.log2(log_prob.shape[1]))
    out = np.tile(log_prior, (len(texts), 1))
    full = np.flatnonzero(length)
    for bucket in _buckets(points, bits):
        # Texts of a batch are contiguous: sum each text's span of looked-up rows, gaps apart.
        edges = np.empty(2 * len(full), np.int64)
        edges[0::2], edges[1::2] = start[full], start[full] + length[full]
        if len(full):
            for j in range(len(log_prior)):
                out[full, j] += np.add.reduceat(log_prob[j][bucket], edges, dtype=np.float64)[0::2]
    return out


def _score(batches: Iterator[pa.RecordBatch], languages: list[str], log_prob: np.ndarray,
           log_prior: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = np.array([*languages, UNDETERMINED], object)
    for batch in sliced(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        letters = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
        best, score = np.full(len(texts), len(languages)), np.zeros(len(texts))
        if languages:
            top, posterior = _decide(log_likelihood(log_prob, log_prior, texts))
            best, score = np.where(letters, top, best), np.where(letters, posterior, 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(names[best], pa.string()), pa.array(score)], ["key", "lang_pred", "score"])


def _decide(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the most likely language and its posterior probability."""
    return joint.argmax(axis=1), 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (posterior probability, 0 to 1) for each row of ``docs``.

    Only ``text`` is an input.  A text that is null, empty or has no letter gets ``und`` with score 0,
    as does every text of a model without languages.  Equal likelihoods go to the language that
    sorts first.  Repeated rows are scored alike, one output row for each; texts of any length are
    scored whole, a few megabytes of a batch at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prob, model.log_prior))
    rows = docs.select(F.col(key).alias("key"), F.col("text").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    kind = rows.schema["key"].dataType.simpleString()
    return (rows.mapInArrow(lambda it: _score(it, *shared.value), f"key {kind}, lang_pred string, score double")
            .withColumnRenamed("key", key))


def clear(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Whether each text is clearly in one learned language, as far as its length tells.

    Its letter 3-grams must fit their best language, and lead over the second, by what held-out documents
    of that language do; and of ``BLOB_LETTERS`` letters or more a quarter must be in words without digits.
    """
    mean, n, letters, plain = evidence(model.log_prob, texts)
    rows, best = np.arange(len(texts)), mean.argmax(axis=1)
    fit = mean[rows, best]
    mean[rows, best] = -np.inf
    slack = SPREAD / np.sqrt(np.maximum(n, 1))
    holds = (fit + slack >= model.least_fit[best]) & (fit - mean.max(axis=1) + slack >= model.least_lead[best])
    return (holds | (n == 0)) & ((letters < BLOB_LETTERS) | (plain >= BLOB_SHARE * letters))


def accepted(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined.

    That takes a letter, a posterior of at least ``min_score`` and a text that is :func:`clear`: random
    letters, encoded blobs, scripts and languages that weren't learned, and texts with over about a quarter
    in another language go.  With a model without languages every text that has a letter stays.  Row
    order and repeats are kept as they are.
    """
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            score = _decide(log_likelihood(model.log_prob, model.log_prior, texts))[1]
            yield batch.filter(pa.array((score >= min_score) & clear(model, texts)))

    return docs.where(F.col("text").rlike(r"\p{L}")).mapInArrow(keep, schema)
