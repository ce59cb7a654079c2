"""URL filters in DataFrame operations: rules indexed by a token, fetched by the tokens of a URL.

A host rule is found under its host, which the URL offers as one of its host's suffixes.  A pattern
rule is found under the rarest of the literal tokens that each URL it matches must hold; regular
expressions run only on the (URL, rule) pairs that a shared token brings together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    verdict: str  #: allow or block
    host: str
    path: str


@dataclass(frozen=True)
class PatternRule:
    verdict: str
    tokens: tuple[str, ...]  #: runs of a-z and 0-9 that a matching URL holds as whole tokens
    pattern: str  #: searched in the URL, A-Z lower-cased


#: Fixed rules of the query.
HOST_RULES = (HostRule("allow", "org", "/"), HostRule("block", "example.org", "/es/"), HostRule("block", "example.org", "/en/1"),
              HostRule("allow", "com", "/fr/"), HostRule("block", "com", "/de/"))
PATTERN_RULES = (
    PatternRule("block", ("casino", "win"), r"://([^/?#]*[.-])?casino-win\b"),
    PatternRule("block", ("casino",), r"://([^/?#]*[.-])?casino[.-]"),
    PatternRule("block", ("free", "bets"), r"://([^/?#]*[.-])?free-bets\b"),
    PatternRule("block", ("cheap", "pills"), r"://([^/?#]*[.-])?cheap-pills\b"),
    PatternRule("block", ("ads", "track"), r"://([^/?#]*[.-])?ads-track\b"),
    PatternRule("block", ("doubleclick",), r"://([^/?#]*\.)?doubleclick\."),
    PatternRule("block", ("porn",), r"://([^/?#]*[.-])?porn[.-]"),
    PatternRule("block", ("click", "track"), r"[/?&]track[/=]click\b"),
    PatternRule("allow", ("robots", "txt"), r"/robots\.txt$"),
)


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def parts(url: str) -> dict[str, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end) and path (up to ``?``, ``#`` or the end)."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    return {"host": _lower(host), "path": path}


def _tokens() -> Column:
    """Distinct index tokens of a URL: host suffixes, marked by a leading dot, and runs of a-z and 0-9."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("."), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    return F.array_union(suffixes, F.regexp_extract_all(_lower(F.col("url")), F.lit("[a-z0-9]+"), F.lit(0)))


def _index(spark: SparkSession, tokens: DataFrame, hosts: tuple[HostRule, ...], patterns: tuple[PatternRule, ...]) -> DataFrame:
    """One row a rule under the token it is fetched by; a pattern rule's is its rarest in ``tokens``."""
    schema = "token string, kind string, verdict string, rule string, path string, pattern string"
    by_host = spark.createDataFrame([("." + r.host, "host", r.verdict, r.host + r.path, r.path, None) for r in hosts], schema)
    literals = spark.createDataFrame([(t, i) for i, r in enumerate(patterns) for t in r.tokens], "token string, id int")
    count = tokens.join(literals.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    order = Window.partitionBy("id").orderBy(F.coalesce("n", F.lit(0)), "token")
    rarest = literals.join(count, "token", "left").withColumn("r", F.row_number().over(order)).where("r = 1").select("id", "token")
    rules = spark.createDataFrame([(i, r.verdict, r.pattern) for i, r in enumerate(patterns)], "id int, verdict string, pattern string")
    by_token = rules.join(rarest, "id").select(
        "token", F.lit("pattern").alias("kind"), "verdict", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("path"), "pattern")
    return by_host.union(by_token)


def judge(pages: DataFrame, hosts: tuple[HostRule, ...] = HOST_RULES, patterns: tuple[PatternRule, ...] = PATTERN_RULES,
          key: str = "page_id") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) for each row's ``url``.

    The longest host rule that fits decides (equal lengths: the one that sorts last) and is ``rule``;
    else an allowing pattern rule, else a blocking one, else allow.  A null ``url`` or one without
    ``://`` has an empty host and path and no host rule.  Rows with equal URLs are judged once and all
    returned; an empty table gives an empty result; other columns play no part.
    """
    rows = pages.select(F.col(key).alias("key"), F.col("url").alias("url"))
    urls = rows.where("url is not null").select("url").distinct().select("url", *[c.alias(n) for n, c in parts("url").items()])
    tokens = urls.select("url", "path", F.explode(_tokens()).alias("token"))
    index = _index(pages.sparkSession, tokens, hosts, patterns).withColumnRenamed("path", "rule_path")
    fetched = tokens.join(index, "token")
    fits = F.when(F.col("kind") == "host", F.startswith("path", "rule_path")).otherwise(F.rlike(_lower(F.col("url")), F.col("pattern")))
    judged = fetched.where(fits).groupBy("url").agg(
        F.max(F.when(F.col("kind") == "host", F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias("best"),
        F.min(F.when(F.col("kind") == "pattern", F.col("verdict"))).alias("by_pattern"))
    verdict = F.coalesce("best.verdict", "by_pattern", F.lit("allow"))
    return rows.join(judged, "url", "left").select(
        F.col("key").alias(key), *[c.alias(n) for n, c in parts("url").items()], F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def oracle_sql(hosts: tuple[HostRule, ...] = HOST_RULES, patterns: tuple[PatternRule, ...] = PATTERN_RULES) -> str:
    """The same judgement in DuckDB SQL, by trying every rule."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    host_rows = ", ".join(f"({quoted(r.verdict)}, {quoted(r.host)}, {quoted(r.path)})" for r in hosts)
    any_of = lambda v: " OR ".join(f"regexp_matches(low, {quoted(r.pattern)})" for r in patterns if r.verdict == v) or "FALSE"
    return f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {host_rows}),
cut AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
numbered AS (SELECT row_number() OVER () AS n, * FROM named),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM numbered JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN {any_of("allow")} THEN 'allow' WHEN {any_of("block")} THEN 'block' ELSE 'allow' END) AS verdict
FROM numbered LEFT JOIN best USING (n)
"""
