import functools
import hashlib

import numpy as np
import pytest

from ledgerlight.llm import imatch
from ledgerlight.llm.wordcounts import counted

rng = np.random.default_rng(5)
WORDS = [f"w{i}" for i in range(300)]
DOCS = [(i, " ".join(rng.choice(WORDS, rng.integers(0, 120)))) for i in range(60)] + [
    (60, None), (61, ""), (62, "rare é🙂 words"), (63, DOCS0 := "same text here"), (64, DOCS0), (64, DOCS0), (None, "without key"), (65, "w1 " * 30_000)]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(k, t, "x", "y") for k, t in DOCS], "doc_id long, text string, term string, fingerprint string").repartition(5)


def test_document_frequencies(docs):
    want = {}
    for _, t in DOCS:
        for w in imatch.terms(t):
            want[w] = want.get(w, 0) + 1
    assert {bytes(r["term"]): r["n"] for r in counted(docs, imatch.terms).collect()} == want
    known = imatch.lexicon(docs, 0.05, 0.3).terms
    n = len(DOCS)
    assert known == sorted(t for t, c in want.items() if np.ceil(0.05 * n) <= c <= int(0.3 * n))


@functools.cache
def held_in(term):
    return imatch.membership(np.array([imatch.term_hash(term)], np.uint64))[0].tolist()


def brute_fingerprint(known, text):
    """From the definition: one hash over the ordered terms of the text in each subset."""
    import xxhash
    mine = sorted(imatch.terms(text) & set(known)) or sorted(imatch.terms(text))
    out = []
    for k in range(imatch.SUBSETS):
        inside = [t for t in mine if held_in(t)[k]]
        body = b"".join(imatch.term_hash(t).to_bytes(8, "little") for t in inside)
        out.append(f"{xxhash.xxh32_intdigest(body) | 1 if inside else 0:08x}")
    return "".join(out)


def test_robustness_against_brute_force(docs):
    known = imatch.lexicon(docs, 0.05, 0.3)
    got = imatch.robustness(docs, known).collect()
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    want = []
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text)
        edited = text[:n - n // 3] + after[:n // 3]
        f, e, o = (brute_fingerprint(known.terms, t) for t in (text, edited, after))

        def like(a, b):
            pairs = [(a[i:i + 8], b[i:i + 8]) for i in range(0, len(a), 8)]
            used = [(x, y) for x, y in pairs if x != "0" * 8 or y != "0" * 8]
            return sum(x == y for x, y in used) / len(used) if used else 1.0

        want.append((key, n, hashlib.sha256(edited.encode()).hexdigest(), f, e, like(f, e), like(f, o)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_fingerprints_of_equal_texts(docs):
    known = imatch.lexicon(docs, 0.05, 0.3)
    marks = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs, known).collect()}
    assert marks[63] == marks[64] and marks[60] == marks[61]


def test_small_tables(docs, spark):
    empty = docs.limit(0)
    known = imatch.lexicon(empty)
    assert known.terms == [] and imatch.robustness(empty, known).count() == 0
    lone = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    row = imatch.robustness(lone, imatch.lexicon(lone)).first()
    assert (row["doc_id"], row["near_next"]) == (1, 1.0)


def test_lexicon_has_no_cap(spark):
    text = " ".join(f"w{i}" for i in range(410_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "x")], "doc_id long, text string")
    assert len(imatch.lexicon(docs, 0.001, 1.0).terms) == 410_000
