import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import bpe
from ledgerlight.llm.units import units

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.Encoder(RANKS, P.PATTERN)

ODD = "ab'sZ19,.é漢🙂 \n\t\r\0\x1c\x85\xa0  　|<>_́"


def encode(texts):
    ids, counts = OURS.encode(texts)
    ends = np.cumsum(counts)
    return [ids[e - c:e].tolist() for e, c in zip(ends, counts)]


@given(st.lists(st.text(alphabet=ODD, max_size=40) | st.text(max_size=40), max_size=8))
@settings(max_examples=400, deadline=None)
def test_as_tiktoken(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert encode(texts) == [THEIRS.encode_ordinary(t) for t in texts]


@given(st.text(alphabet=ODD, max_size=60))
@settings(max_examples=400, deadline=None)
def test_units_cut_between_pieces(text):
    cut = units(text)
    assert "".join(cut) == text
    assert [p for u in cut for p in regex.findall(P.PATTERN, u)] == regex.findall(P.PATTERN, text)


@pytest.mark.parametrize("text", ["a" * 1500, "ab" * 900, "a" * 5000, " " * 3000 + "x", "é" * 4000, "the quick " * 3000, "x" * 2047 + "y" * 3000,
                                  "=" * 2048, "".join(random.Random(1).choice("etaoin shrdlu\n") for _ in range(20000)), "<|endoftext|> a"])
def test_long_texts_and_pieces(text):
    assert encode([text]) == [THEIRS.encode_ordinary(text)]


def test_long_pieces_merge_alike_by_matrix_and_heap():
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"aehinorst") for _ in range(rng.randrange(2, 300))) for _ in range(60)]
    ids, counts = OURS.encode_pieces(pieces)
    ends = np.cumsum(counts)
    assert [OURS._long(p) if p not in RANKS else [RANKS[p]] for p in pieces] == [ids[e - c:e].tolist() for e, c in zip(ends, counts)]


def test_memo_starts_anew_when_full():
    small = bpe.Encoder(RANKS, P.PATTERN)
    small.memo.limit = 10
    for k in range(30):
        text = f"word{k} and word{k + 1} or word{k % 3}"
        assert small.encode([text, ""])[0].tolist() == THEIRS.encode_ordinary(text)


def test_round_trip_and_odd_rows(spark):
    texts = [(1, "Hello  world\n\n x"), (2, None), (3, ""), (1, "Hello  world\n\n x"), (None, "é漢🙂"), (5, "z" * 100_000)]
    docs = spark.createDataFrame([(k, t, "i", "d") for k, t in texts], "doc_id long, text string, ids string, decoded string")
    got = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS).collect()
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in got) == sorted(
        (str(k), THEIRS.encode_ordinary(t or ""), (t or "").encode()) for k, t in texts)
    assert bpe.decode(bpe.encode(docs.limit(0), RANKS, P.PATTERN), RANKS).count() == 0


def test_unknown_id_raises():
    with pytest.raises(ValueError):
        bpe.Decoder(RANKS).decode(np.array([60000]), np.array([1]))
