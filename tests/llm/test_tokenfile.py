import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlight.llm import tokenfile
from ledgerlight.session import scratch_path

DEFINITION = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()
THEIRS = Tokenizer.from_str(DEFINITION)
OURS = tokenfile.LibraryEncoder(DEFINITION)


@pytest.mark.parametrize("planes", ["byte", "bit"])
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70))
@settings(max_examples=100, deadline=None)
def test_planes_round_trip(planes, ids):
    ids = np.array(ids, "<u4")
    packed = tokenfile.to_planes(ids, planes)
    assert len(packed) == tokenfile.WIDTH[planes]
    assert (tokenfile.from_planes(len(ids), packed) == ids).all()


@given(st.lists(st.text(alphabet="ab'sZ19,.é漢🙂 \n\t\0\x1c\x85\xa0　|<>", max_size=40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_units_encode_as_whole_texts(texts):
    ids, counts = OURS.encode(texts)
    ends = np.cumsum(counts)
    assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == [THEIRS.encode(t, add_special_tokens=False).ids for t in texts]


DOCS = [(5, "five five <|endoftext|>"), (1, None), (2, ""), (9, "word " * 4000), (9, "word " * 4000), (None, "no key"), (7, " two  spaces\n\n"), (3, "é漢🙂 x")]


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_files_round_trip(spark, planes):
    docs = spark.createDataFrame([(k, t, 1, "s") for k, t in DOCS], "doc_id long, text string, start int, keys string")
    path = scratch_path(spark, "tokens")
    tokenfile.write(docs, path, DEFINITION, 2, planes=planes, block=100, chunk=300)
    got = tokenfile.read(spark, path).collect()
    want, at = [], 0
    for k, t in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = THEIRS.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((k, at, np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted([(r["doc_id"], r["start"], bytes(r["ids"])) for r in got], key=str) == sorted(want, key=str)
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r["n_ids"] for r in index) == at and sum(r["n_docs"] for r in index) == len(DOCS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = scratch_path(spark, "tokens")
    tokenfile.write(docs, path, DEFINITION, 2)
    assert tokenfile.read(spark, path).count() == 0


def test_query_columns(spark, tmp_dir):
    from ledgerlight.llm.queries import op6_token_files
    spark.createDataFrame(DOCS[:4], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op6_token_files(spark, tmp_dir).collect()}
    at = 0
    for k, t in sorted(DOCS[:4]):
        ids = THEIRS.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[k] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


PLAIN = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
LITERALS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "a  <|endoftext|>\n\n b <|endoftext|><|endoftext|> c", " <|endoftext|> ", "a <|endof text|> b"]


@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "a", "b's", "\n", "é漢", "<|endof", "text|>", "19"]), max_size=12).map("".join), max_size=6))
@settings(max_examples=300, deadline=None)
def test_added_tokens_encode_as_by_an_untouched_tokenizer(texts):
    ids, counts = tokenfile.LibraryEncoder.encode(OURS, LITERALS + texts)
    ends = np.cumsum(counts)
    assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in LITERALS + texts]


def test_added_tokens_over_spaces():
    from tokenizers import AddedToken
    theirs = Tokenizer.from_str(DEFINITION)
    theirs.add_tokens([AddedToken("two words", rstrip=True), AddedToken("strip", lstrip=True, rstrip=True), AddedToken("one", single_word=True)])
    texts = ["a two words b c", "a  strip b strip  c", "one alone one", "nothing of this", "two  words"]
    ids, counts = tokenfile.LibraryEncoder(theirs.to_str()).encode(texts)
    ends = np.cumsum(counts)
    assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_with_added_tokens_in_texts(spark, tmp_dir):
    from ledgerlight.llm.queries import op6_token_files
    docs = list(enumerate(LITERALS))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_dir}/literals/documents.parquet")
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op6_token_files(spark, f"{tmp_dir}/literals").collect()}
    at = 0
    for k, t in docs:
        ids = PLAIN.encode(t, add_special_tokens=False).ids + [2]
        assert got[k] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@given(st.lists(st.text(alphabet="aZé漢,.'1 \n*", max_size=30), max_size=8), st.lists(st.text(alphabet="ab, .", max_size=12), max_size=8))
@settings(max_examples=300, deadline=None)
def test_units_that_end_in_signs(texts, more):
    """Stems met before, in the same batch, later, and only with a sign."""
    fresh = tokenfile.LibraryEncoder.__new__(tokenfile.LibraryEncoder)
    fresh.__dict__.update(OURS.__dict__)
    fresh.memo = tokenfile.UnitMemo(fresh._encode, 5)
    for batch in (texts, more, [t + "," for t in texts], texts + more):
        ids, counts = fresh.encode(batch)
        ends = np.cumsum(counts)
        assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == [THEIRS.encode(t, add_special_tokens=False).ids for t in batch]


def test_a_large_memo_grows():
    ours = tokenfile.LibraryEncoder(DEFINITION)
    texts = [" ".join(f"w{i * 7919 % 100_003}x{'.' if i % 3 else ''}" for i in range(lo, lo + 30_000)) for lo in range(0, 90_000, 30_000)]
    for t in texts:
        assert ours.encode([t])[0].tolist() == THEIRS.encode(t, add_special_tokens=False).ids
