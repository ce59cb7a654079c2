import re

import duckdb
import pandas as pd
import pytest

from ledgerlight.llm import urls

URLS = ["http://x.org", "http://x.org/", "https://Example.ORG/es/1", "https://a.example.org/en/1x?y#z", "https://a.example.org/en/2", "http://b.com/fr/1",
        "http://b.com/de/1", "http://casino-win.example.com/en/1", "http://www.casino-win.example.com/fr/", "http://free-bets.example.net?x", None, "",
        "no scheme/casino-win", "://", "http://example.org?q=/es/", "http://x.net/robots.txt", "http://casino.y.net/robots.txt", "HTTP://M.CASINO-WIN.NET/a b",
        "http://myexample.org/es/", "http://x.net/track/click", "http://x.net/://doubleclick.net", "http://cheap-pills.net/" + "a/" * 30_000, "http://a.org:80/",
        "http://..org/x", "http://org/", "http://x.org\n/a", "http://x.net/en/7#casino-win", "ftp://ads-track.é.net/"]


def brute(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    host, low = lower(host), lower(url)
    fit = [r for r in urls.HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        best = max(fit, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict
    hit = {r.verdict for r in urls.PATTERN_RULES if re.search(r.pattern, low)}
    return host, path, None, "allow" if "allow" in hit or not hit else "block"


def test_against_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[2]), (2, URLS[2])]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, rule string")
    got = urls.judge(pages)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted([(i, *brute(u)) for i, u in rows], key=str)
    assert urls.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("rule", urls.PATTERN_RULES)
def test_a_match_holds_the_rules_tokens(rule):
    for url in URLS:
        if url and re.search(rule.pattern, url.lower()):
            assert set(rule.tokens) <= set(re.findall("[a-z0-9]+", url.lower()))


def test_oracle_agrees_with_brute_force():
    rows = [(i, u) for i, u in enumerate(URLS) if u is None or "\n" not in u]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url"]))
    got = con.execute(urls.oracle_sql()).fetchall()
    assert sorted(got) == sorted((i, *brute(u)) for i, u in rows)
