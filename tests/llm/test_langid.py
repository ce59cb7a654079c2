import base64
import math
import random

import numpy as np
import pytest

from ledgerlight.llm import langid
from ledgerlight.llm.common import id_remainder

MEDIUM = "/root/testdata/sf0.01"
ROWS = [(1, "the cat and the hat", "en"), (2, "le chat et le chapeau", "fr"), (3, "die Katze und der Hut", "de"), (4, None, "en"), (5, "no label", None),
        (6, "", "fr"), (1, "the cat and the hat", "en"), (None, "the dog and the log", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, x, "k", 0.5) for i, t, x in ROWS], "doc_id long, text string, lang string, key string, score double")


def brute(model, text):
    """Joint log probabilities, one n-gram at a time."""
    bits = int(math.log2(model.log_prob.shape[1]))
    out = list(model.log_prior)
    points = [ord(c) for c in text.lower()]
    for i in range(len(points)):
        padded = np.array([*points[i:], 0, 0, 0], np.uint32)
        for bucket in langid._buckets(padded, bits):
            for j in range(len(out)):
                out[j] += float(model.log_prob[j][bucket[0]])
    return out


def test_likelihoods_against_brute_force(docs):
    model = langid.train(docs)
    assert model.languages == ["de", "en", "fr"]
    assert np.allclose(np.exp(model.log_prob.astype(float)).sum(axis=1), 1, atol=1e-3)
    texts = ["the hat", "", "x", "été 漢🙂\0", "le chat"]
    got = langid.log_likelihood(model.log_prob, model.log_prior, texts)
    assert np.allclose(got, [brute(model, t) for t in texts], atol=1e-3)
    for i, t in enumerate(texts):  # neighbours in a batch make no difference
        assert np.allclose(langid.log_likelihood(model.log_prob, model.log_prior, [t])[0], got[i], atol=1e-6)


def test_predictions_and_odd_rows(spark, docs):
    model = langid.train(docs)
    odd = spark.createDataFrame([(1, None, "en", 1.0), (2, "", "en", 1.0), (3, "12 34 !?", "en", 1.0), (4, "the cat", "fr", 1.0), (4, "the cat", "fr", 1.0),
                                 (None, "le chat et le chapeau " * 20_000, "de", 1.0)], "doc_id long, text string, lang string, key double")
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()), key=str)
    assert [g[:2] for g in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "fr")]
    assert all(0 <= g[2] <= 1 for g in got) and [g[2] for g in got[:3]] == [0.0, 0.0, 0.0]
    kept = langid.accepted(odd, model)
    assert kept.columns == odd.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["4", "4", "None"]


def test_without_labels_or_rows(spark, docs):
    model = langid.train(docs.where("lang is null"))
    assert model.languages == []
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()} == {("und", 0.0)}
    assert langid.accepted(docs, model).count() == 6
    trained = langid.train(docs)
    assert langid.predict(docs.limit(0), trained).count() == 0 and langid.accepted(docs.limit(0), trained).count() == 0


def test_too_many_labels_raise(docs):
    with pytest.raises(ValueError):
        langid.train(docs, max_languages=2)


def test_a_bounded_sample_is_drawn_by_text(spark, docs):
    many = spark.createDataFrame([(f"word{i} and more", "en") for i in range(2000)] + [("ein wort", "de")], "text string, lang string")
    model = langid.train(many, max_docs_per_language=100)
    assert model.languages == ["de", "en"]


def test_counts_and_thresholds_come_from_every_document(spark):
    """More documents of a language than the 20,000 once counted, and the 2,000 once scored for the thresholds."""
    texts = [(f"the w{i} and {'cat' * (i % 9)} of it", "en") for i in range(21_000)] + [(f"der k{i} und {'hund' * (i % 7)} da", "de") for i in range(3_000)]
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(4)
    model = langid.train(docs)
    rows = docs.selectExpr("text", "lang", "cast(pmod(xxhash64(text, 'half'), 2) as int) as half").collect()
    counts = np.zeros((2, 2, 1 << 15))
    for half in (0, 1):
        for i, lang in enumerate(["de", "en"]):
            points, start, length = langid._code_points([r["text"] for r in rows if r["half"] == half and r["lang"] == lang])
            inside = langid._inside(start, length, len(points))
            for bucket in langid._buckets(points, 15):
                counts[half, i] += np.bincount(bucket[inside[:len(bucket)]], minlength=1 << 15)
    assert np.allclose(model.log_prob, langid._log_share(counts.sum(axis=0) + 0.5), atol=1e-5)
    for i, lang in enumerate(["de", "en"]):
        fit, lead = [], []
        for half in (0, 1):
            mean, n, _, _ = langid.evidence(langid._log_share(counts + 0.5)[1 - half], [r["text"] for r in rows if r["half"] == half and r["lang"] == lang])
            fit, lead = [*fit, *mean[n > 0, i]], [*lead, *(mean[:, i] - mean[:, 1 - i])[n > 0]]
        fit, lead = np.array(fit), np.array(lead)
        fit, lead = fit[lead > 0], lead[lead > 0]
        assert len(fit) > 2_900
        assert model.least_lead[i] == pytest.approx(np.median(lead) / 2, abs=2 / langid.GRID)
        assert model.least_fit[i] == pytest.approx(min(np.median(fit) - np.median(lead) / 2, np.quantile(fit, 0.01)), abs=2 / langid.GRID)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    held = docs.where(id_remainder("doc_id", 5) == 0)
    pairs = langid.predict(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in pairs) >= 0.98 * len(pairs)


def test_texts_in_no_one_language_go(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    held = docs.where(id_remainder("doc_id", 5) == 0).where("text rlike '[a-zA-Z]'")
    long = {x: [r["text"] for r in held.where(f"lang = '{x}' and length(text) > 1000").orderBy("doc_id").limit(5).collect()] for x in model.languages}
    rng = random.Random(3)
    bad = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(400)),
           base64.b64encode(rng.randbytes(300)).decode(), rng.randbytes(200).hex(), "Съешь ещё этих мягких французских булок, да выпей чаю. " * 5,
           "我能吞下玻璃而不伤身体。今天天气很好。" * 20, "    return [y for y in range(x) if y % 2 == 0]\n" * 8]
    for a, b in (("en", "fr"), ("de", "en"), ("es", "fr")):
        bad += [x[:400] + " " + y[:400] for x, y in zip(long[a], long[b])]  # one half after the other
        bad += [" ".join(w for pair in zip(x.split()[:60], y.split()[:60]) for w in pair) for x, y in zip(long[a], long[b])]  # and word by word
    got = langid.accepted(spark.createDataFrame(list(enumerate(bad)), "doc_id long, text string"), model).collect()
    assert [bad[r["doc_id"]][:80] for r in got] == []
    good = ["It is.", "A", *(x[:n] for n in (30, 100, 1000) for some in long.values() for x in some)]
    assert langid.accepted(spark.createDataFrame([(t,) for t in good], "text string"), model).count() == len(good)
    assert langid.accepted(held, model).count() >= 0.98 * held.count()


def test_one_learned_language(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("lang = 'en'")
    model = langid.train(docs)
    bad = spark.createDataFrame([("".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400)),)], "text string")
    assert langid.accepted(bad, model).count() == 0
    assert langid.accepted(docs, model).count() >= 0.98 * docs.where("text rlike '[a-zA-Z]'").count()
