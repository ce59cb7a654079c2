import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from ledgerlight.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def one_space(v):
    return " " if v is None else v


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = one_space(role), one_space(text)
        k = zlib.crc32(f"{one_space(conv)}:{one_space(turn)}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def enumerated(rows, most=3):
    """Every sequence of edits with at most so many insertions."""
    kinds, best = faults(rows), None
    for edits in product("DKR", repeat=len(rows)):
        for gaps in product(range(most + 1), repeat=len(rows) + 1):
            if sum(gaps) > most:
                continue
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
            i, slots, cost = 0, [], 0
            for e in audit:
                if e == "I":
                    slots.append("ua")
                    cost += 2
                    continue
                kind, role = kinds[i], rows[i][2]
                i += 1
                if e == "D":
                    cost += 3
                elif kind in ("blank", "duplicate"):
                    break
                else:
                    cost += (kind == "truncated") + 2 * (e == "R")
                    slots.append("ua" if e == "R" else role[:1] or "-")
            else:
                if any(FORM.fullmatch("".join(s)) for s in product(*slots)) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def stepwise(rows):
    """Plain dynamic programming over rows and states."""
    kinds = faults(rows)
    least = {0: (0, "")}
    better = lambda d, q, v: d.__setitem__(q, min(v, d.get(q, v)))

    def inserted(d):
        for _ in range(4):
            for q, (c, a) in list(d.items()):
                better(d, 3 if q == 2 else 2, (c + 2, a + "I"))
        return d

    for (_, _, role, _), kind in zip(rows, kinds):
        after = {}
        for q, (c, a) in inserted(least).items():
            better(after, q, (c + 3, a + "D"))
            if kind in ("", "truncated"):
                c += kind == "truncated"
                better(after, 3 if q == 2 else 2, (c + 2, a + "R"))
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, role[:1]))
                if to is not None:
                    better(after, to, (c, a + "K"))
        least = after
    return min(v for q, v in inserted(least).items() if q in (0, 3))


def applied(rows, audit):
    lines, i, need = [], 0, "user"
    for e in audit:
        if e == "I":
            lines.append((need, ""))
        else:
            _, _, role, text = rows[i]
            i += 1
            if e == "D":
                continue
            lines.append((role if e == "K" else need, text))
        need = "assistant" if lines[-1][0][:1] == "u" else "user"
    return lines


def brute(rows, ids=()):
    out = {}
    for conv in {r[0] for r in rows} | set(ids):
        own = in_order([r for r in rows if r[0] == conv])
        kinds, turns = faults(own), [r[1] for r in own if r[1] is not None]
        cost, audit = stepwise(own)
        text = "\n".join(f"{r}:{t}" for r, t in applied(own, audit))
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
                     illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


ODD = [(1, None, None, None), (1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, 3, "assistant", "yes"), (1, 9, "user", "hi."), (None, 0, "user", "x."), (None, None, "assistant", "y!"),
       (2, 0, "system", "s."), (3, 5, "", "no role."), (3, 6, "tool", "call."), (4, 1, "user", ""), (4, 2, "assistant", " \t\x0b"), (5, 0, "assistant", "a."), (5, 1, "user", "b"),
       (5, 2, "assistant", "c.\n"), (6, -4, "user", "é" * 300_000 + "."), (6, 8, "assistant", "ok?"), (7, 1, "system", "a."), (7, 2, "system", "b."), (7, 3, "user", "c."),
       (8, None, "user", "one."), (8, None, "assistant", "two."), (8, None, "user", "three."), (9, 2**62, "u", "a."), (9, 2**62 + 1, "a", "b.")]


def random_rows(seed, conversations, most, texts=("a.", "b", "c?", "", "d!", "e.", "f.", "g.")):
    rng = random.Random(seed)
    return [(c, rng.choice([None, rng.randrange(most)]) if rng.random() < 0.1 else t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rng.choice(texts) + str(rng.randrange(9)) * rng.randrange(2))
            for c in range(conversations) for t in range(rng.randrange(most))]


@pytest.mark.parametrize("seed", range(3))
def test_dynamic_programming_agrees_with_enumeration(seed):
    for conv, n in [(c, 4) for c in range(12)]:
        rows = in_order([r for r in random_rows(seed, 13, n) if r[0] == conv])
        want = enumerated(rows)
        assert stepwise(rows) == want
        layers = [x for r, k in zip(rows, faults(rows)) for x in C.row_layers(r[2][:1], ("", "blank", "duplicate", "truncated").index(k), 1)]
        (path,) = C.lightest(layers, 0, True, C.ACCEPTING)
        assert (path.cost, path.audit) == want


def test_blocks_join_to_the_same_paths():
    rng = random.Random(4)
    for _ in range(60):
        layers = [x for _ in range(rng.randrange(1, 30)) for x in C.row_layers(rng.choice("usat") , rng.randrange(4), rng.choice([1, 1, 2]))]
        cuts = sorted(rng.choices(range(len(layers) + 1), k=3))
        blocks = [layers[i:j] for i, j in zip([0, *cuts], [*cuts, len(layers)])]
        paths = C.joined([[p for q in C.STATES for p in C.lightest(b, q, True)] for b in blocks])
        assert sorted(p[:4] for p in paths) == sorted(p[:4] for q in C.STATES for p in C.lightest(layers, q, True))


def result(spark, rows, parts=None):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", digest string, copies int")
    out = C.report(df.repartition(parts) if parts else df).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def test_odd_rows(spark):
    assert result(spark, ODD) == brute(brute_damage(ODD), {r[0] for r in ODD})


def test_random_conversations(spark):
    rows = random_rows(9, 120, 9)
    assert result(spark, rows, 5) == brute(brute_damage(rows), {r[0] for r in rows})


@pytest.mark.parametrize("block", [3, 256])
def test_one_conversation_holds_most_rows(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "FAN_BITS", 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(1)
        rows = random_rows(2, 30, 6) + [(17, rng.choice([None, t, t]), rng.choice(["user", "assistant", "system"]), f"{rng.randrange(900)}{rng.choice('.? ')}") for t in range(1500)]
        assert result(spark, rows, 6) == brute(brute_damage(rows), {r[0] for r in rows})
        rows = [(3, None, "user", f"t{i}.") for i in range(300)] + [(4, 7, "user", "same.")] * 300 + [(None, i, "user", "same.") for i in range(300)]
        assert result(spark, rows, 6) == brute(brute_damage(rows), {r[0] for r in rows})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table_and_string_ids(spark):
    assert result(spark, []) == {}
    df = spark.createDataFrame([("x", 1, "user", "a."), ("x", 2, "assistant", "b."), ("y", 1, "assistant", "b.")], "conv_id string, turn int, role string, text string")
    found = C.repair(df)
    assert {(r["conv_id"], r["pos"], r["edit"], r["role"], r["text"]) for r in found.lines.collect()} >= {("x", 0, "K", "user", "a."), ("x", 1, "K", "assistant", "b.")}
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in found.summaries.collect()} == {"x": (0, "KK"), "y": (2, "IK")}


def test_query(spark):
    from ledgerlight.llm.queries import op11_conversation_repair
    small = "/root/testdata/sf0.01"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    got = op11_conversation_repair(spark, small)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r["conv_id"]: tuple(r)[1:] for r in got.collect()} == brute(brute_damage(rows), {r[0] for r in rows})
