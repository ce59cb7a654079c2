"""Secret scans with corpus-wide ownership, in DataFrame expressions only.

Patterns give base spans; a wider pattern gives candidates.  The hash of every value is aggregated
over the corpus by distinct repositories and owners: values that many owners hold are copied examples,
values of a single owner look live.  Candidates that look live become spans as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, group of the value, least length of the value.  Runs of one class of characters are
#: searched with their least length in the pattern, as a run that is too short holds no longer one.
BASE = (("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]{12,}", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32))
#: Whole runs that hold a digit and a letter.
CANDIDATE = ("owned", "(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 0, 20)
PLACEHOLDER = "[SECRET]"
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,hash:string>"


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind: the pieces between matches and the matches give the code-point positions."""
    pat = F.lit(pattern)
    matches = F.zip_with(F.regexp_extract_all(text, pat, F.lit(0)), F.regexp_extract_all(text, pat, F.lit(group)),
                         lambda m, v: F.struct(m.alias("m"), v.alias("v")))
    parts = F.zip_with(F.split(text, pattern, -1), matches, lambda p, m: F.struct(p.alias("p"), m["m"].alias("m"), m["v"].alias("v")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        first = acc["at"] + F.length(x["p"])
        last = first + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(first.alias("start"), F.lit(rank).alias("rank"), last.alias("end"), F.lit(kind).alias("kind"),
                        F.sha2(x["v"], 256).alias("hash")).cast(SPAN)
        return F.struct(last.cast("bigint").alias("at"), F.when(F.length(x["v"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(parts, start, add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _found(docs: DataFrame) -> Column:
    """All base and candidate spans of ``text`` in order."""
    text = F.coalesce(docs["text"], F.lit(""))
    base = F.concat(*[_spans(text, r, *spec) for r, spec in enumerate(BASE)])
    return F.array_sort(F.concat(base, _spans(text, len(BASE), *CANDIDATE)))


def _ownership(found: DataFrame, max_owners: int) -> DataFrame:
    """Per distinct list of spans its live spans; per hash, owners and repositories are counted once each."""
    held = found.select("repository", "owner", F.explode("found.hash").alias("hash")).distinct()
    owners = (held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
              .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories")))
    lists = found.select("list", "found").dropDuplicates(["list"])
    live = (lists.select("list", F.explode("found").alias("span")).select("list", "span", F.col("span.hash").alias("hash"))
            .join(owners.where(F.col("owners") <= max_owners), "hash"))
    return live.groupBy("list").agg(F.collect_list("span").alias("live"))


def _located(docs: DataFrame, key: str, repository: str, owner: str) -> DataFrame:
    rows = docs.select(F.col(key).alias("key"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), _found(docs).alias("found"))
    return rows.withColumn("list", F.when(F.size("found") > 0, F.sha2(F.to_json("found"), 256)))


def scan(docs: DataFrame, key: str = "doc_id", repository: str = "source", owner: str = "source", max_owners: int = 1) -> DataFrame:
    """``key``, ``base``, ``spans`` (arrays of start, rank, end, kind, hash) and ``n_live`` for each row.

    ``base`` holds the spans of ``BASE``; ``spans`` also those of the candidate pattern, apart from base
    spans, whose value belongs to at most ``max_owners`` owners in the whole corpus; ``n_live`` counts
    the base spans of such values.  A null text has no spans; a null repository or owner counts as one
    more; repeated rows give repeated rows with equal spans and count once in the ownership.
    Positions are code points, the end exclusive.
    """
    rows = stored(_located(docs, key, repository, owner), "secrets")
    some = rows.where("list is not null")
    none = F.array().cast(f"array<{SPAN}>")
    joined = some.join(_ownership(some, max_owners), "list", "left").select("key", "found", F.coalesce("live", none).alias("live"))
    return (joined.union(rows.where("list is null").select("key", "found", none.alias("live")))
            .select(F.col("key").alias(key), _of_base("found").alias("base"), _with_owned("found", "live").alias("spans"),
                    F.size(_of_base("live")).cast("long").alias("n_live")))


def _of_base(spans: str) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(BASE))


def _with_owned(found: str, live: str) -> Column:
    """Base spans, and live candidates that touch none of them, in order."""
    base = _of_base(found)
    return F.array_sort(F.concat(base, F.filter(live, lambda s: (s["rank"] == len(BASE)) & ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _redacted(text: Column, spans: Column) -> Column:
    def add(acc: Column, s: Column) -> Column:
        start = F.greatest(s["start"], acc["at"])
        put = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int")), F.lit(PLACEHOLDER))
        # A span that begins inside the one before extends it without a placeholder of its own.
        out = F.when(s["start"] >= acc["at"], put).otherwise(acc["out"])
        return F.struct(F.greatest(s["end"], acc["at"]).cast("bigint").alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, add, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def redact(docs: DataFrame, repository: str = "source", owner: str = "source", max_owners: int = 1) -> DataFrame:
    """``docs``, all rows and columns, with every span of :func:`scan` in ``text`` replaced by a placeholder.

    A column ``n_chars`` is set to the new length.  Texts without spans, nulls too, stay as they are.
    """
    found, spans, live = (_free(docs, n) for n in ("found", "list", "live"))
    any_hit = reduce(lambda a, b: a | b, [F.coalesce(F.col("text"), F.lit("")).rlike(p[1]) for p in (*BASE, CANDIDATE)])
    hit = docs.where(any_hit).withColumn(found, _found(docs)).withColumn(spans, F.sha2(F.to_json(found), 256))
    rows = stored(hit.select(F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(found).alias("found"),
                             F.col(spans).alias("list")), "secrets")
    owned = _ownership(rows, max_owners).select(F.col("list").alias(spans), F.col("live").alias(live))
    marked = hit.join(owned, spans, "left").withColumn(live, F.coalesce(live, F.array().cast(f"array<{SPAN}>")))
    done = marked.withColumn("text", _redacted(F.col("text"), _with_owned(found, live)))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.where(~any_hit).union(done.select(*docs.columns))


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
