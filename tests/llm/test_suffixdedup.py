import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import suffixdedup as S

LENGTH = 50


def brute(docs, length=LENGTH):
    """(n_bytes, n_removed, n_spans, kept) of each (id, text)."""
    data = [(S.NO_ID if i is None else i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in data:
        for s in range(len(b) - length + 1):
            first[b[s:s + length]] = min(i, first.get(b[s:s + length], i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < i:
                gone[s:s + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(b) else 0))
        out.append((len(b), int(gone.sum()), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return out


@given(st.binary(min_size=50, max_size=400) | st.text("ab", min_size=50, max_size=400).map(str.encode))
@settings(max_examples=100, deadline=None)
def test_every_string_holds_the_anchor_of_its_least_gram(data):
    data = np.frombuffer(data, np.uint8)
    at, hashes = S.anchors(data, LENGTH)
    order = S.gram_hashes(data) >> np.uint64(32)
    assert (S.gram_hashes(data)[at] == hashes).all()
    places = set(at.tolist())
    for s in range(len(data) - LENGTH + 1):
        window = order[s:s + LENGTH - S.GRAM + 1]
        assert set((s + np.flatnonzero(window == window.min())).tolist()) <= places


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 50)), min_size=1, max_size=30))
@settings(max_examples=300, deadline=None)
def test_longest_previous(rows):
    ids, common = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    common[0] = 0
    want = [max([0] + [min(common[min(i, j) + 1:max(i, j) + 1]) for j in range(len(rows)) if ids[j] < ids[i]]) for i in range(len(rows))]
    assert S.longest_previous(np.arange(len(rows)), common, ids).tolist() == want


def corpus():
    rng = np.random.default_rng(11)
    words = ["the", "of", "ünd", "and", "re", "ing", "tion", "ß", "日本", "x"]
    text = lambda n: " ".join(rng.choice(words, n))
    shared = [text(n) for n in (12, 14, 20, 40, 100)]
    docs = []
    for i in range(70):
        parts = [text(int(rng.integers(0, 30)))]
        for _ in range(int(rng.integers(0, 3))):
            s = shared[int(rng.integers(0, 5))]
            a = int(rng.integers(0, 20))
            parts += [s[a:], text(int(rng.integers(0, 10)))]
        docs.append((int(rng.integers(0, 40)) if i % 7 == 0 else 100 + i, " ".join(parts)))
    whole = text(80)
    docs += [(500, whole), (501, whole), (501, whole), (502, whole + "!"), (503, whole[1:]), (None, whole), (None, whole[:120]), (504, None), (505, ""),
             (506, "a" * 3000), (507, "a" * 49), (508, "a" * 51), (509, "\0" * 60), (510, "\0" * 70), (511, "b" * 10 + "a" * 60 + "\0" * 55), (1, whole[30:140]),
             (512, "ab" * 100_000), (513, "ab" * 60), (1, "one id, two texts " + shared[3])]
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(S, "FLUSH_ANCHORS", 40)
        monkeypatch.setattr(S, "FLUSH_CONTEXTS", 30)
        monkeypatch.setattr(S, "SORT", 300)
    docs = [d for d in corpus() if not small or len(d[1] or "") < 5000]
    df = spark.createDataFrame([(i, t, 0, "m") for i, t in docs], "doc_id long, text string, id int, marks string").repartition(6)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in S.remove_repeats(df).collect()]
    assert sorted(got, key=str) == sorted([(i, *b) for (i, _), b in zip(docs, brute(docs))], key=str)


def test_home_is_the_bucket_that_spark_computes(spark):
    ids = [0, 1, -5, 2**63 - 1, -2**63, 123456789012]
    df = spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "pmod(xxhash64(id), 51) b")
    assert {r.id: r.b for r in df.collect()} == {i: S.home(i, 51) for i in ids}


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_length_is_checked(spark):
    with pytest.raises(ValueError):
        S.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=S.GRAM)


@pytest.mark.parametrize("hot", [1, 25])
def test_often_found_anchors_against_brute_force(spark, hot):
    docs = [d for d in corpus() if len(d[1] or "") < 5000]
    rng = np.random.default_rng(5)
    phrase = "this phrase of some forty bytes is common "
    docs += [(1000 + i, " ".join(map(str, rng.integers(0, 30, 6))) + phrase + " ".join(map(str, rng.integers(0, 30, 6)))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in S.remove_repeats(df, hot=hot).collect()]
    assert sorted(got, key=str) == sorted([(i, *b) for (i, _), b in zip(docs, brute(docs))], key=str)


def test_an_often_found_gram_is_dealt_to_many_buckets():
    import pyarrow as pa
    texts = [f"{i:040d} a phrase in many texts, of forty bytes {i * 7:040d}" for i in range(500)]
    at = texts[0].index("phrase")
    gram = np.frombuffer(texts[0].encode()[at:at + S.GRAM], np.uint8)
    buckets = 40
    places = S.squeeze(np.arange(500), np.ones(500, np.int32), np.full(500, at, np.uint32))
    batch = pa.table({"bucket": pa.array([0] * 501, pa.int32()), "known": pa.array([places] + [None] * 500, pa.binary()), "id": pa.array([None, *range(500)], pa.int64()),
                      "text_hash": pa.array([None, *range(500)], pa.int64()), "text": [None, *texts]}).to_batches()[0]

    def dealt(hot):
        rows = [r for b in S._send_contexts(iter([batch]), LENGTH, buckets, hot) for r in b.to_pylist() if r["blob"]]
        return {b: sum(len(S.Contexts.unpack(r["blob"]).ids) for r in rows if r["bucket"] == b) for b in {r["bucket"] for r in rows}}

    assert list(dealt(np.zeros(0, np.uint64)).values()) == [500]
    spread = dealt(S.gram_hashes(gram) & S.LOW)
    assert len(spread) == buckets and max(spread.values()) < 3 * sum(spread.values()) / buckets


@pytest.mark.parametrize("hot", [1, S.HOT])
def test_many_buckets_and_portions_against_brute_force(spark, monkeypatch, hot):
    for name, value in (("BUCKET_BYTES", 500), ("PORTION", 7), ("FLUSH_FOUND", 20), ("BATCH_BYTES", 1000)):
        monkeypatch.setattr(S, name, value)
    docs = [d for d in corpus() if len(d[1] or "") < 2000]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    before = spark.conf.get(S.BATCH_CONF)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in S.remove_repeats(df, hot=hot).collect()]
    assert sorted(got, key=str) == sorted([(i, *b) for (i, _), b in zip(docs, brute(docs))], key=str)
    assert spark.conf.get(S.BATCH_CONF) == before


def test_matching_a_large_bucket_takes_bounded_memory():
    """400,000 contexts, 300 of which a second document has too, took 295 MB when a bucket was unpacked at once."""
    import tracemalloc

    import pyarrow as pa
    rng = np.random.default_rng(3)
    n, reach = 20_000, LENGTH - S.GRAM

    def contexts(around, i):
        rows = len(around)
        return S.Contexts(around, np.full(rows, reach, np.uint8), np.full(rows, LENGTH, np.uint8), np.full(rows, i), np.full(rows, i), np.arange(rows, dtype=np.uint32))

    blobs, again = [], []
    for i in range(20):
        around = rng.integers(0, 4, (n, reach + LENGTH), np.uint8)
        again.append(around[:15])
        blobs.append(contexts(around, i).pack())
    blobs.append(contexts(np.concatenate(again), 99).pack())
    batches = [S._sent([(0, None, b)]) for b in blobs]
    tracemalloc.start()
    rows = pa.Table.from_batches(S._match(iter(batches), LENGTH, 10)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = [S.expand(r["known"], np.int64, np.int64, np.int32, np.uint32, np.uint64) for r in rows]
    assert sorted(np.concatenate([f[3] for f in found]).tolist()) == list(range(300))
    assert all((f[0] == 99).all() and (f[4] == 2 ** (reach + 1) - 1).all() for f in found)
    assert peak < 150e6


def test_homes_of_many_ids():
    ids = np.r_[np.random.default_rng(1).integers(-2**63, 2**63 - 1, 500), 0, 1, -1, 2**63 - 1, -2**63]
    for buckets in (1, 51, 7919):
        assert S._homes(ids, buckets).tolist() == [S.home(i, buckets) for i in ids.tolist()]


@pytest.mark.parametrize("length", [S.GRAM + 1, LENGTH, S.GRAM + 63])
def test_possible_strings(length):
    reach = length - S.GRAM
    left, right = (c.reshape(-1).astype(np.uint8) for c in np.meshgrid(np.arange(reach + 1), np.arange(S.GRAM, length + 1)))
    c = S.Contexts(None, left, right, None, None, None)
    want = [sum(1 << l for l in range(reach + 1) if l <= a and length - l <= b) for a, b in zip(left.tolist(), right.tolist())]
    assert c.possible(length).tolist() == want
