import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import simhash
from ledgerlight.llm.components import components


def brute_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, keys, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(fps))]


@given(st.text(alphabet="ab \té\nZ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) % 2**64 == brute_fingerprint(text)


def test_fingerprint_of_a_long_text():
    text = " ".join(f"w{i * i % 977}" for i in range(5000))
    assert simhash.fingerprint(text, 3) % 2**64 == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_near_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = base[rng.integers(0, 12, 700)]
    for _ in range(3):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64))
    group = np.sort(rng.integers(0, 5, 700))
    i, j = simhash.near_pairs(fps, group, radius)
    found = set(zip(i.tolist(), j.tolist()))
    f, g = fps.tolist(), group.tolist()
    assert len(found) == len(i)
    assert found == {(a, b) for a in range(700) for b in range(a + 1, 700)
                     if g[a] == g[b] and bin(f[a] ^ f[b]).count("1") <= radius}


def test_links_with_split_buckets_give_the_same_components(spark):
    rng = np.random.default_rng(7)
    fps = np.unique(np.r_[rng.integers(0, 2**62, 300), 5 ^ (1 << rng.integers(0, 40, 200)) ^ (1 << rng.integers(0, 40, 200))])
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    want = brute_components(fps.tolist(), fps.tolist())
    for group in (16, 4096):
        got = {r["node"]: r["root"] for r in components(simhash.links(df, 3, group=group)).collect()}
        assert [got.get(int(x), int(x)) for x in fps] == want


DOCS = [(1, "a b c d e f g h"), (2, "A  b c d\te f g h"), (3, None), (4, ""), (5, " \n"), (6, "one"), (7, "one two"),
        (7, "one two"), (8, "éa ñb ça"), (9, "x " * 5000), (None, "a b c d e f g h"), (None, "lonely row without key"), (0, "other words of some text")]


def test_near_duplicates_and_odd_rows(spark):
    docs = spark.createDataFrame([(k, t, "x", k) for k, t in DOCS], "doc_id long, text string, fp string, root long")
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t in DOCS]
    assert got == sorted(zip([k for k, _ in DOCS], fps, brute_components(fps, [k for k, _ in DOCS])), key=str)


def test_first_of_each_keeps_one_row_of_a_component(spark):
    docs = spark.createDataFrame([(k, t, "x", k) for k, t in DOCS], "doc_id long, text string, simhash string, k long")
    got = simhash.first_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(["0", "1", "3", "6", "7", "8", "9", "None"])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.first_of_each(docs).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_long_path(spark):
    n = 200
    order = np.random.default_rng(1).permutation(n)
    df = spark.createDataFrame([(int(order[i]), int(order[i + 1])) for i in range(n - 1)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(n)} | {500: 500, 501: 500}
