import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import decontaminate as D


def brute(item, text):
    """Least edit distance of the item to any part of the text, by dynamic programming."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        diagonal, column[0] = column[0], 0
        for i, a in enumerate(item, 1):
            diagonal, column[i] = column[i], min(column[i] + 1, column[i - 1] + 1, diagonal + (a != c))
        best = min(best, column[-1])
    return best


@given(st.text("ab c", min_size=1, max_size=90), st.text("ab c", max_size=120), st.integers(0, 90))
@settings(max_examples=300, deadline=None)
def test_bit_parallel_distance(item, text, most):
    got, want = D.best_match(item, text, most), brute(item, text)
    if want <= most and text:
        assert got[0] == want
        assert brute(item, text[:got[1]]) == want
    else:
        assert got is None or not text


def test_finder_against_brute_force():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeionst") for _ in range(rng.randrange(2, 7)))
    items = [" ".join(word() for _ in range(rng.randrange(1, 30))) for _ in range(12)]
    finder = D.Finder([(i, D.normalised(t)) for i, t in enumerate(items)], 0.0625)
    for _ in range(60):
        chars = list(rng.choice(items))
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(chars))
            chars[at:at + rng.randrange(2)] = rng.choice(["", "q", "xy"])
        text = D.normalised(" ".join(word() for _ in range(20)) + " " + "".join(chars) + " " + " ".join(word() for _ in range(9)))
        want = {}
        for i, item in enumerate(items):
            d = brute(D.normalised(item), text)
            if d <= D.budget(D.normalised(item), 0.0625):
                want[i] = d
        assert {i: d for i, (d, _) in finder.find(text).items()} == want


ITEM = "The quick brown fox jumps over the lazy dog, near the old river bank at dawn."


@pytest.fixture()
def tables(spark):
    docs = [(1, f"Before. {ITEM} After."), (2, None), (3, ""), (4, ITEM.upper().replace(" ", "\n")), (5, "the quick brown fox runs off"),
            (6, "x " * 50_000 + ITEM.replace("quick", "quikc") + " y" * 1000), (1, f"Before. {ITEM} After."), (None, ITEM), (8, ITEM + ITEM)]
    items = [(10, ITEM), (11, ITEM.lower()), (12, None), (13, "  !? "), (14, "no such words in any of the documents here")]
    return (spark.createDataFrame([(k, t, "item", 1) for k, t in docs], "doc_id long, text string, item string, distance int"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_hits_and_odd_rows(tables):
    docs, items = tables
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in D.contaminated(docs, items).collect()}
    assert got == {(d, i): 2 * (d == 6) for d in (1, 4, 6, None, 8) for i in (10, 11)}


def test_clean_keeps_rows_and_columns(tables):
    docs, items = tables
    kept = D.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]


def test_items_in_blocks(tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(D, "BLOCK_CHARS", 10)
    assert D.contaminated(docs, items).count() == 10
    assert D.clean(docs, items).count() == 3


def test_empty_tables(tables):
    docs, items = tables
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0
    assert D.clean(docs, items.limit(0)).count() == 9
