import random
import re
from itertools import permutations

import duckdb
import pytest

from ledgerlight.llm import filteraudit

ORDERS = ["".join(p) for p in permutations("ABCDE")]
LONG = " ".join(f"w{i}" for i in range(120))
ODD = [(1, None, "en"), (2, "", "en"), (3, LONG, "en"), (4, LONG, None), (4, LONG, None), (None, LONG, "fr"), (None, LONG, "fr"), (5, LONG + " #", "fr"),
       (6, "a " * 200_000, "de"), (7, "ABC def", "de"), (8, LONG.upper(), ""), (9, "Word\x0bword\x1cword x " * 40, "en"), (2, "", "zz"), (10, LONG.upper(), "en"), (0, LONG, "en")]
LABELS = [(3, 1, 0), (3, 0, 1), (4, 1, None), (None, 1, 1), (7, 0, 1), (99, 1, 1), (10, 1, 1), (2, None, None)]


def brute(docs, labels):
    lo, good, toxic = {}, set(), set()
    for k, t, _ in docs:
        if k is not None:
            lo[t or ""] = min(k, lo.get(t or "", k))
    for k, q, x in labels:
        if k is not None:
            good |= {k} if q == 1 else set()
            toxic |= {k} if x == 1 else set()
    rows = {}
    for part in {p or "" for *_, p in docs}:
        for o in ORDERS:
            for s in range(1, 6):
                rows[part, o, s] = [0] * 6
    shapley = dict.fromkeys(((p, f) for p in {p or "" for *_, p in docs} for f in "ABCDE"), 0)
    for k, t, part in docs:
        t, part = t or "", part or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, hit in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)), ("C", 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)),
                                  ("D", re.search("[#$%&*|]", t)), ("E", k is not None and lo[t] < k)) if hit}
        for o in ORDERS:
            for s in range(1, 6):
                f, before = o[s - 1], fails & set(o[:s - 1])
                out = f in fails and not before
                for i, x in enumerate((not fails & set(o[:s]), out, f in fails and before, fails == {f}, out and k in good, out and k in toxic)):
                    rows[part, o, s][i] += bool(x)
                shapley[part, f] += out
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in rows.items()}


def frames(spark, docs, labels):
    d = spark.createDataFrame([(*r, 7, "x") for r in docs], "doc_id long, text string, lang string, mask int, part string")
    m = spark.createDataFrame([(*r, "t") for r in labels], "doc_id long, quality int, toxic int, text string")
    return d, m


def result(spark, docs, labels):
    found = filteraudit.interactions(*filteraudit.failures(*frames(spark, docs, labels)))
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found.collect()}


def test_odd_rows(spark):
    assert result(spark, ODD, LABELS) == brute(ODD, LABELS)


def test_random_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["Aa", "b", "C", "d#", "e"], k=rng.choice([0, 3, 120]))) for _ in range(40)] + [" ".join(f"{rng.random():.9f}" for _ in range(130)) for _ in range(20)]
    docs = [(rng.randrange(300), rng.choice(texts), rng.choice(["en", "de", None])) for _ in range(400)]
    labels = [(rng.randrange(300), rng.randrange(2), rng.randrange(2)) for _ in range(150)]
    assert result(spark, docs, labels) == brute(docs, labels)


def test_sql_on_odd_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", ODD)
    con.execute("CREATE TABLE labels(doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    names = ("part", "filter_order", "step", *filteraudit.OUTCOMES, "shapley")
    got = con.execute(f"SELECT {', '.join(names)} FROM ({filteraudit.oracle_sql()})").fetchall()
    assert {r[:3]: r[3:] for r in got} == brute(ODD, LABELS)


def test_empty_tables(spark):
    assert result(spark, [], []) == {}
    assert result(spark, ODD[:3], []) == brute(ODD[:3], [])


def test_many_parts_and_tasks(spark):
    docs = [(i, "a b", f"part{i % 150}") for i in range(600)]
    d, m = frames(spark, docs, [])
    found = filteraudit.interactions(*filteraudit.failures(d.repartition(7), m))
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found.collect()} == brute(docs, [])


@pytest.mark.parametrize("n", [1, 3, 5])
def test_fields_hold_large_counts(n):
    each = [filteraudit.packed(m, g, t, n) for m in range(2**n) for g in (False, True) for t in (False, True)]
    big = 2**60
    total = sum(x * big for x in each[:4])
    assert (filteraudit.unpacked(total, n) == sum(filteraudit.unpacked(x, n) for x in each[:4]) * big).all()


def test_another_set_of_filters(spark):
    d, m = frames(spark, [(1, "ab", "x"), (2, "abc", "x"), (3, "c", "x")], [])
    masks, letters = filteraudit.failures(d, m, lambda t: {"P": t.contains("a"), "Q": t.contains("c")}, copies=None)
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in filteraudit.interactions(masks, letters).collect()}
    assert got == {("PQ", 1): (1, 2, 0, 1, 3), ("PQ", 2): (0, 1, 1, 1, 3), ("QP", 1): (1, 2, 0, 1, 3), ("QP", 2): (0, 1, 1, 1, 3)}
