"""Conversation structure repair by lightest derivations.

A conversation is well formed if its roles' initials are nothing or an optional s and then pairs ua.  Keeping a row is
free, giving it the role user or assistant costs 2, deleting it 3, inserting an empty row 2; blank rows and copies of an
earlier row must go, and a truncated row that stays costs 1.

Repairs are deductions over items (rows consumed, state of the role grammar).  An item's value is (cost, audit), the
audit being the initials of its edits; a deduction joins a consumed prefix with one edit of the next row, an insertion,
or a whole block of rows: costs add, audits are concatenated.  Both are superior functions in the order (cost, rows consumed,
audit), so an agenda that pops the least value finalises each item with its lightest derivation and ends when the goal
item is popped.  No audit of an item begins another of the same cost (it would differ by insertions, which cost), so
concatenation keeps the order of audits.

Rows are sorted over the cluster by conversation and turn.  A conversation inside a partition is repaired there.  One that
reaches over a border of partitions, or is long, is cut into blocks: a block is the items from each state to each state,
blocks join by the same agenda, in rounds over the partitions, and each part then gets the states it begins and ends in.  So
no task holds more than one block of rows and its partition's audits, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, stored

SPACES = " \t\n\x0b\x0c\r"
#: States of the role grammar: nothing yet, after s, after u, after a pair.  Fixed values: where an initial leads.
STATES = (0, 1, 2, 3)
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTING = (0, 3)
LEGAL = ("su", "ua", "au")
RETAG, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
CLEAN, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: A conversation of more rows or characters is handled in blocks of so many rows.
BLOCK, HELD_CHARS = 256, 1_000_000
#: So many parts of a conversation join in one group of a round.
FAN_BITS = 5
#: Characters of a text by which rows of one turn and role are ordered; then by a digest.
HEAD = 64
#: Rows that a task gathers before it passes them on.
OUT_ROWS, OUT_CHARS = 4096, 4_000_000


class Path(NamedTuple):
    """The lightest derivation from state ``q`` to state ``r``; ``trail`` has the first state of each part it crosses."""
    q: int
    r: int
    cost: int
    audit: str
    trail: str


#: What one step offers: by the state it begins in, (state it leads to, cost, audit, trail).
Layer = list[list[tuple[int, int, str, str]]]


def _needed(q: int) -> int:
    """The state after the only role, user or assistant, that may follow state ``q``."""
    return 3 if q == 2 else 2


def row_layers(initial: str, fault: int, copies: int) -> Iterator[Layer]:
    """The edits of a row, and of its ``copies - 1`` repetitions, which all must go."""
    gone = copies
    if fault in (CLEAN, TRUNCATED):
        extra = CUT_SHORT if fault == TRUNCATED else 0
        yield [[(q, DELETE, "D", ""), (_needed(q), RETAG + extra, "R", ""), *([(STEP[q][initial], extra, "K", "")] if initial in STEP[q] else [])] for q in STATES]
        gone -= 1
    if gone:
        yield [[(q, DELETE * gone, "D" * gone, "")] for q in STATES]


def lightest(layers: list[Layer], start: int, insertions: bool, goals: tuple[int, ...] = ()) -> list[Path]:
    """Lightest derivations of the items (all layers, r), by Knuth's agenda; with ``goals`` only that of the goal item,
    which any of these states derives."""
    agenda = [(0, 0, "", "", start)]
    final: set[tuple[int, int]] = set()
    found = []
    while agenda:
        cost, i, audit, trail, q = heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == len(layers):
            if not goals or q in goals:
                found.append(Path(start, q, cost, audit, trail))
            if goals and q in goals:
                break
        else:
            for r, more, edit, crossed in layers[i][q]:
                if (i + 1, r) not in final:
                    heappush(agenda, (cost + more, i + 1, audit + edit, trail + crossed, r))
        if insertions and (i, _needed(q)) not in final:
            heappush(agenda, (cost + INSERT, i, audit + "I", trail, _needed(q)))
    return found


def joined(blocks: list[list[Path]]) -> list[Path]:
    """The paths through several blocks, one after the other."""
    if len(blocks) == 1:
        return blocks[0]
    layers = [[[(p.r, p.cost, p.audit, p.trail) for p in block if p.q == q] for q in STATES] for block in blocks]
    return [p for q in STATES for p in lightest(layers, q, False)]


class Facts(NamedTuple):
    """What is counted of consecutive rows.  ``first`` and ``last`` are the initials at the ends, None without rows."""
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    lo: int | None = None
    hi: int | None = None
    first: str | None = None
    last: str | None = None

    def then(self, b: Facts) -> Facts:
        meet = self.last is not None and b.first is not None
        return Facts(self.blank + b.blank, self.duplicate + b.duplicate, self.truncated + b.truncated,
                     self.illegal + b.illegal + (meet and self.last + b.first not in LEGAL),
                     self.turns + b.turns - (self.hi is not None and self.hi == b.lo),
                     b.lo if self.lo is None else self.lo, self.hi if b.hi is None else b.hi,
                     b.first if self.first is None else self.first, self.last if b.last is None else b.last)


def row_facts(turn: int | None, initial: str, fault: int, copies: int) -> Facts:
    again = copies - 1
    return Facts(copies if fault == BLANK else 0, copies if fault == DUPLICATE else again * (fault in (CLEAN, TRUNCATED)), int(fault == TRUNCATED),
                 again * (2 * initial not in LEGAL), int(turn is not None), turn, turn, initial, initial)


class Walker:
    """Applies an audit to rows as they come: (edit, role, text) of what stays or is put in."""

    def __init__(self, state: int, audit: str):
        self.state, self.audit, self.at = state, audit, 0

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", self._put(), ""

    def _put(self) -> str:
        self.state = _needed(self.state)
        return "assistant" if self.state == 3 else "user"

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(copies):
            yield from self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = STEP[self.state][role[:1]]
                yield edit, role, text
            elif edit == "R":
                yield edit, self._put(), text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


#: Kinds of rows that repairing in place gives: a repaired line, a whole conversation, a row and a part of one that goes on.
LINE, WHOLE, ROW, PART = 0, 1, 2, 3
PATHS = "array<struct<q:int,r:int,cost:bigint,audit:string,trail:string>>"
FACTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, lo bigint, hi bigint, first string, last string"
COLUMNS = f"kind int, part int, pos bigint, edit string, role string, text string, copies bigint, parts array<int>, paths {PATHS}, {FACTS}"


class Sink:
    """Gathers rows as columns and passes them on as Arrow batches of bounded size."""

    def __init__(self, names: list[str], types: pa.Schema):
        self.names, self.types = names, types
        self._clear()

    def _clear(self) -> None:
        self.columns: dict[str, list] = {n: [] for n in self.names}
        self.rows = self.chars = 0

    def put(self, chars: int, **values: object) -> None:
        for n, column in self.columns.items():
            column.append(values.get(n))
        self.rows += 1
        self.chars += chars

    def full(self) -> bool:
        return self.rows >= OUT_ROWS or self.chars >= OUT_CHARS

    def batch(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(self.columns[f.name], f.type) for f in self.types], schema=self.types)
        self._clear()
        return out


def _arrow(conv_type: pa.DataType) -> pa.Schema:
    path = pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("trail", pa.string())])
    return pa.schema([("conv_id", conv_type), ("kind", pa.int32()), ("part", pa.int32()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                      ("text", pa.string()), ("copies", pa.int64()), ("parts", pa.list_(pa.int32())), ("paths", pa.list_(path)),
                      *[(n, pa.string() if n in ("first", "last") else pa.int64()) for n in Facts._fields]])


class _Conversation:
    """One conversation's rows in one partition, as they stream by."""

    def __init__(self, key: object, part: int, goes_on: bool, sink: Sink):
        self.key, self.part, self.open, self.sink = key, part, goes_on, sink
        self.held: list[tuple[str, str, int]] = []
        self.layers: list[Layer] = []
        self.blocks: list[tuple[int, list[Path]]] = []
        self.facts, self.chars, self.pos = Facts(), 0, 0

    def add(self, turn: int | None, role: str, text: str, fault: int, copies: int) -> None:
        self.layers += row_layers(role[:1], fault, copies)
        self.facts = self.facts.then(row_facts(turn, role[:1], fault, copies))
        self.held.append((role, text, copies))
        self.chars += len(text)
        if len(self.layers) >= BLOCK or self.chars > HELD_CHARS:
            self.open = True
        if self.open:
            self._pass_on()

    def _pass_on(self) -> None:
        for role, text, copies in self.held:
            self.sink.put(len(text), conv_id=self.key, kind=ROW, part=self.part, pos=self.pos, role=role, text=text, copies=copies)
            self.pos += 1
        self.held, self.chars = [], 0
        if len(self.layers) >= BLOCK:
            self._block()

    def _block(self) -> None:
        """Close a block; blocks of equal size join, so each row's audit is copied once for every doubling."""
        size, paths = 1, [p for q in STATES for p in lightest(self.layers, q, True)]
        self.layers = []
        while self.blocks and self.blocks[-1][0] == size:
            paths = joined([self.blocks.pop()[1], paths])
            size *= 2
        self.blocks.append((size, paths))

    def end(self, last: bool) -> None:
        facts = self.facts._asdict()
        if not self.open and not last:
            best, = lightest(self.layers, 0, True, ACCEPTING)
            walk = Walker(0, best.audit)
            lines = [x for row in self.held for x in walk.row(*row)] + list(walk.end())
            for pos, (edit, role, text) in enumerate(lines):
                self.sink.put(len(text), conv_id=self.key, kind=LINE, part=self.part, pos=pos, edit=edit, role=role, text=text)
            self.sink.put(len(best.audit), conv_id=self.key, kind=WHOLE, part=self.part, paths=[best._asdict()], **facts)
            return
        self._pass_on()
        self._block()
        while len(self.blocks) > 1:
            (_, right), (_, left) = self.blocks.pop(), self.blocks.pop()
            self.blocks.append((0, joined([left, right])))
        paths = [p._replace(trail=str(p.q))._asdict() for p in self.blocks[0][1]]
        self.sink.put(sum(len(p["audit"]) for p in paths), conv_id=self.key, kind=PART, part=self.part, parts=[self.part], paths=paths, **facts)


def _in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair each conversation that lies within this sorted partition; split up the first, the last and long ones."""
    part, sink, now = TaskContext.get().partitionId(), None, None
    for batch in batches:
        if sink is None:
            types = _arrow(batch.schema.field("conv_id").type)
            sink = Sink(types.names, types)
        for start in range(0, batch.num_rows, BLOCK):
            columns = (c.to_pylist() for c in batch.slice(start, BLOCK).columns)
            for key, turn, role, text, fault, copies in zip(*columns):
                if now is None or key != now.key:
                    first = now is None
                    if not first:
                        now.end(False)
                    now = _Conversation(key, part, first, sink)
                if copies:
                    now.add(turn, role, text, fault, copies)
                if sink.full():
                    yield sink.batch()
    if now is not None:
        now.end(True)
        yield sink.batch()


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the parts of each (conversation, group); rows are sorted by those and by part."""
    held, key = [], None

    def result() -> pa.RecordBatch:
        types = _arrow(conv_type)
        sink, facts = Sink(types.names, types), Facts()
        for row in held:
            facts = facts.then(Facts(*(row[n] for n in Facts._fields)))
        paths = joined([[Path(**p) for p in row["paths"]] for row in held])
        sink.put(0, conv_id=key[0], kind=PART, part=key[1], parts=[x for row in held for x in row["parts"]], paths=[p._asdict() for p in paths], **facts._asdict())
        return sink.batch()

    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if (row["conv_id"], row["part"]) != key:
                if held:
                    yield result()
                held, key = [], (row["conv_id"], row["part"])
            held.append(row)
    if held:
        yield result()


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply to each part of a conversation its piece of the audit, which stands before its rows."""
    walk, key, pos, sink = None, None, 0, None

    def put(lines: Iterator[tuple[str, str, str]]) -> None:
        nonlocal pos
        for edit, role, text in lines:
            sink.put(len(text), conv_id=key[0], kind=LINE, part=key[1], pos=pos, edit=edit, role=role, text=text)
            pos += 1

    for batch in batches:
        if sink is None:
            types = _arrow(batch.schema.field("conv_id").type)
            sink = Sink(types.names, types)
        for start in range(0, batch.num_rows, BLOCK):
            columns = (batch.slice(start, BLOCK).column(n).to_pylist() for n in ("conv_id", "part", "pos", "role", "text", "copies", "state", "audit"))
            for conv, part, at, role, text, copies, state, audit in zip(*columns):
                if at < 0:
                    if walk:
                        put(walk.end())
                    walk, key, pos = Walker(state, audit), (conv, part), 0
                else:
                    put(walk.row(role, text, copies))
                if sink.full():
                    yield sink.batch()
    if walk:
        put(walk.end())
        yield sink.batch()


def _best(paths: Column) -> Column:
    whole = F.filter(paths, lambda p: (p["q"] == 0) & p["r"].isin(*ACCEPTING))
    return F.array_min(F.transform(whole, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"), p["trail"].alias("trail"), p["r"].alias("r"))))


class Repaired(NamedTuple):
    #: conv_id, part, pos (both: order), edit (K, R or I), role, text
    lines: DataFrame
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    summaries: DataFrame


def faulty(rows: DataFrame) -> DataFrame:
    """Rows with equal conversation, turn, role and text counted as ``copies``, and the ``fault`` of the first of them."""
    digest = F.unhex(F.sha2("text", 256))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("digest", digest)
    blank = F.btrim("text", F.lit(SPACES)) == ""
    again = rows.where(~blank).groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("set"), "turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    ends = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)).isin(".", "!", "?")
    fault = F.when(blank, BLANK).when(later, DUPLICATE).when(~ends, TRUNCATED).otherwise(CLEAN)
    return rows.join(again, same, "left").select("conv_id", "turn", "role", "text", fault.alias("fault"), "copies", "digest")


def repair(rows: DataFrame, ids: DataFrame | None = None) -> Repaired:
    """Repair every conversation of ``rows`` (``conv_id``, ``turn`` integer, ``role``, ``text``).

    Rows go by turn, nulls first; rows of one turn by role, the first 64 characters, and a digest of the text.  A null role or text
    is one space, a null ``conv_id`` a conversation of its own; equal rows are copies of which all but the first are duplicates.
    A role whose initial is not s, u or a, and an empty one, can't be kept.  ``ids`` (``conv_id``) names conversations that
    have a summary even without rows.  Empty tables give empty results; other columns play no part.
    """
    spark = rows.sparkSession
    one_space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    found = faulty(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), one_space("role"), one_space("text")))
    if ids is not None:
        nothing = {"turn": F.lit(None).cast("long"), "role": F.lit(" "), "text": F.lit(""), "fault": F.lit(BLANK), "copies": F.lit(0).cast("long"), "digest": F.lit(None).cast("binary")}
        found = found.unionByName(ids.select("conv_id").distinct().select("conv_id", *[c.alias(n) for n, c in nothing.items()]))
    order = ["conv_id", "turn", "role", F.substring("text", 1, HEAD), "digest"]
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, "
    moved = found.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest").mapInArrow(_in_place, conv + COLUMNS)
    done = stored(moved, "repair")

    parts = done.where(F.col("kind") == PART)
    last = done.agg(F.max("part")).first()[0] or 0
    while last:
        last >>= FAN_BITS
        group = F.shiftright("part", FAN_BITS).alias("part")
        keyed = parts.select("conv_id", group, F.col("part").alias("pos"), "parts", "paths", *Facts._fields)
        parts = keyed.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "pos").mapInArrow(_join_parts, conv + COLUMNS)
    parts = stored(parts.withColumn("best", _best(F.col("paths"))).drop("paths"), "repair-parts")

    # each part's first and last state, and so its piece of the audit
    states = F.concat("best.trail", F.col("best.r").cast("string"))
    chosen = parts.select(F.col("conv_id").alias("c"), F.posexplode("parts").alias("i", "p"), states.alias("states")).select(
        "c", "p", F.substring("states", F.col("i") + 1, F.lit(1)).cast("int").alias("state"), F.substring("states", F.col("i") + 2, F.lit(1)).cast("int").alias("to"))
    mine = F.filter("paths", lambda x: (x["q"] == F.col("state")) & (x["r"] == F.col("to")))[0]["audit"]
    heads = done.where(F.col("kind") == PART).join(chosen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select(
        "conv_id", "part", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), "state", mine.alias("audit"))
    body = done.where(F.col("kind") == ROW).select("conv_id", "part", "pos", "role", "text", "copies", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("audit"))
    applied = heads.unionByName(body).repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "pos").mapInArrow(_apply, conv + COLUMNS)

    whole = done.where(F.col("kind") == WHOLE).withColumn("best", _best(F.col("paths")))
    gaps = F.when(F.col("turns") > 0, F.col("hi") - F.col("lo") + 1 - F.col("turns")).otherwise(0).cast("long")
    facts = ["conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit")]
    lines = ["conv_id", "part", "pos", "edit", "role", "text"]
    return Repaired(done.where(F.col("kind") == LINE).select(*lines).unionByName(applied.select(*lines)), whole.select(*facts).unionByName(parts.select(*facts)))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, sha, keys, digests = None, None, [], []
    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        for start in range(0, batch.num_rows, BLOCK):
            columns = (batch.slice(start, BLOCK).column(n).to_pylist() for n in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns):
                if sha is None or conv != key:
                    if sha is not None:
                        keys.append(key)
                        digests.append(sha.hexdigest())
                    key, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if keys:
            yield pa.record_batch({"conv_id": pa.array(keys, conv_type), "sha256": pa.array(digests, pa.string())})
            keys, digests = [], []
    if sha is not None:
        yield pa.record_batch({"conv_id": pa.array([key], conv_type), "sha256": pa.array([sha.hexdigest()], pa.string())})


def digests(lines: DataFrame) -> DataFrame:
    """``conv_id`` and SHA-256 (hex) of each conversation's ``role:text`` lines joined by newlines.

    A digest of a whole conversation can only be taken in order, so one task streams it; it holds one batch."""
    conv = f"conv_id {lines.schema['conv_id'].dataType.simpleString()}, sha256 string"
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos").select("conv_id", "role", "text").mapInArrow(_hash, conv)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (``conv_id``, ``turn``, ``role``, ``text``; nulls: one space) with faults given by crc32 of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(c, F.lit(" "))
    key = F.concat(space(F.col("conv_id").cast("string")), F.lit(":"), space(F.col("turn").cast("string")))
    kind, text = id_remainder(key, 20), space(F.col("text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    role = F.when(kind == 4, "user").otherwise(space(F.col("role")))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("time"), times.alias("times")).where(
        "time <= times").drop("time", "times")


def report(rows: DataFrame) -> DataFrame:
    """The repair of damaged ``rows``: a summary and the digest of the repaired conversation for every ``conv_id`` of ``rows``."""
    found = repair(damaged(rows), rows.select("conv_id"))
    sums = digests(found.lines).withColumnRenamed("conv_id", "c")
    return found.summaries.join(sums, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        *found.summaries.columns, F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
