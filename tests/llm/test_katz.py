import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlight.llm import katz
from ledgerlight.llm.common import id_remainder
from pyspark.sql import functions as F


class Brute:
    """The model by its definition, over dictionaries."""

    def __init__(self, texts):
        self.uni, self.bi, self.hist = Counter(), Counter(), Counter()
        for t in texts:
            tokens = [*katz.words(t), "END"]
            self.uni.update(tokens)
            for h, w in zip(["START", *tokens], tokens):
                self.bi[h, w] += 1
                self.hist[h] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        count = lambda c: [sum(x == r for x in c.values()) for r in range(katz.TOP + 2)]
        self.low1, self.low2 = katz.good_turing(count(self.uni)), katz.good_turing(count(self.bi))
        star = lambda c, low: c - katz.FLOOR if c > katz.TOP else low[c]
        self.p1 = {w: star(c, self.low1) / self.n for w, c in self.uni.items()}
        self.unseen = 1 - sum(self.p1.values()) if self.n else 1.0
        self.p2 = {(h, w): star(c, self.low2) / self.hist[h] for (h, w), c in self.bi.items()}
        left = {h: [1.0, 1.0] for h in self.hist}
        for (h, w), p in self.p2.items():
            left[h][0] -= p
            left[h][1] -= self.p1[w]
        self.alpha = {h: a / b for h, (a, b) in left.items()}

    def p(self, w, h):
        return self.p2.get((h, w)) or self.alpha.get(h, 1.0) * self.p1.get(w, self.unseen)

    def row(self, text):
        tokens = [*katz.words(text), "END"]
        base = sum(math.log10((self.uni[w] + 1) / (self.n + self.v + 1)) for w in tokens)
        return (len(tokens), sum(w in self.uni for w in tokens), self.n, base,
                sum(math.log10(self.p(w, h)) for h, w in zip(["START", *tokens], tokens)))


rng = np.random.default_rng(4)
WORDS = [f"w{i}" for i in range(60)]
SHARE = np.arange(60, 0, -1.0) ** 2
DOCS = [(i, " ".join(rng.choice(WORDS, int(rng.integers(0, 60)), p=SHARE / SHARE.sum())) + rng.choice(["", " Once%d" % i, "\tÉ Z"])) for i in range(120)] + [
    (200, None), (201, ""), (202, "never seen words here"), (5, "w1 W2 w3"), (5, "w1 W2 w3"), (5, "another text"), (None, "w1 w1 w1"), (203, "w0 " * 20_000)]


def is_train(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 != 2


@pytest.mark.parametrize("flush", [100, 10**6])  # the 20,000 words of one document make w0 a word that is dealt by history
def test_against_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(katz, "FLUSH", flush)
    docs = spark.createDataFrame([(k, t, 1, "h") for k, t in DOCS], "doc_id long, text string, n int, history string").repartition(5)
    got = katz.score(docs, id_remainder("doc_id", 7) != 2).collect()
    model = Brute([t for k, t in DOCS if is_train(k)])
    want = [(k, is_train(k), *model.row(t)) for k, t in DOCS]
    by = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=by), sorted(want, key=by)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-7)


def test_distributions_sum_to_one():
    model = Brute([t for _, t in DOCS])
    for h in ["START", b"w1", b"w50", b"once5", "not seen"]:
        total = sum(model.p(w, h) for w in model.uni) + model.alpha.get(h, 1.0) * model.unseen
        assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("of", [[0] * 7, [0, 5, 0, 0, 0, 0, 0], [0, 100, 40, 20, 12, 8, 5], [0, 1, 9, 9, 9, 9, 9]])
def test_discounts_lie_between_zero_and_the_count(of):
    low = katz.good_turing(of)
    assert all(0 < low[r] < r for r in range(1, katz.TOP + 1))


def test_small_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = katz.score(docs, F.lit(False)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows) == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    assert katz.score(docs.limit(0), F.lit(True)).count() == 0
