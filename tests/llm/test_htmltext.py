import html
import random
import re

import pytest

from ledgerlight.llm import htmltext as H

MEDIUM = "/root/testdata/sf0.01"
PLAIN = H.Weights()


def article(page):
    """The text of a page of the table's own form, read off its article element."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def pages(spark):
    return [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()]


def weights_of(rows):
    counts = H.Counter()
    for *_, page in rows:
        H.count_labelled(page, counts)
    return H.Weights({w: (counts[w, "main"], counts[w, "all"]) for w, _ in counts})


def test_held_out_pages(pages):
    weights = weights_of(pages[::2])
    assert all(H.extract(p, weights) == article(p) for *_, p in pages[1::2])
    assert all(H.extract(p, PLAIN) == article(p) for *_, p in pages)


def test_held_out_pages_without_the_element_that_labels_them(pages):
    weights = weights_of(pages[::2])
    hidden = lambda p: p.replace("<article>", "<div>").replace("</article>", "</div>")
    assert all(H.extract(hidden(p), weights) == article(p) for *_, p in pages[1::2])


@pytest.mark.parametrize("seed", range(20))
def test_scan_finds_the_greatest_sum(seed):
    rng = random.Random(seed)
    values = [rng.randrange(-9, 8) for _ in range(rng.randrange(40))]
    best = max([(sum(values[i:j]), -i, -j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)], default=(0, 0, 0))
    start, end = H.best_run(values)
    assert sum(values[start:end]) == max(best[0], 0)


LONG = "word " * 30
CASES = {
    "nothing": ("", ""),
    "markup only": ("<html><body><nav>a</nav></body></html>", ""),
    "text only": (f"{LONG}&amp; more", f"{LONG}& more"),
    "references": (f"<p>{LONG}&lt;b&gt; &#233;&#x1F642;&nbsp;&copy; &notit; a&amp;lt;</p>", f"{LONG}<b> é🙂 © ¬it; a&lt;"),
    "spaces": (f"<p>\n {LONG}\t\r\n x&#32;&#9;y<br>z</p>", f"{LONG}x y z"),
    "inline": (f"<P>{LONG}un<b>bro</B>ken <i>w<span>o</span>rd", f"{LONG}unbroken word"),
    "around": (f"<header>Site</header><nav><a href=x>Home</a></nav><div class='main-menu'>m</div><p>{LONG}one<p>two {LONG}</p><aside>side {LONG}</aside><footer>{LONG}</footer>", f"{LONG}one\ntwo {LONG.strip()}"),
    "within": (f"<main><h1>Title</h1><p>{LONG}</p><aside>{LONG * 9}</aside><form><p>mail</p></form><div class=ad>buy</div><script>if (a<b) x()</script><style>p{{}}</style><!-- <p>no</p> --><p>end.</p><section id=comments><p>{LONG * 9}</p></section></main>",
               f"Title\n{LONG.strip()}\nend."),
    "comment articles": (f"<article><header><h1>T</h1></header><p>{LONG}</p></article><article class='comment'><p>{LONG * 5}</p></article>", f"T\n{LONG.strip()}"),
    "layout names": (f"<body class='has-sidebar'><div class='content with-sidebar'><div class=entry-header><h2>A title of five words</h2></div><p>{LONG}</p></div><div id='sidebar'><p>{LONG}</div>", f"A title of five words\n{LONG.strip()}"),
    "lists and tables": (f"<article><p>{LONG}</p><ul><li>a<li>b <a href=q>c</a></ul><table><tr><td>1<td>2</table><p>{LONG}</p></article>", f"{LONG.strip()}\na\nb c\n1\n2\n{LONG.strip()}"),
    "quotes": (f"<p title='a > b' data-x=\"</p>\">{LONG}<img alt='x>y'>z < 3 <3</p><a href=\"open>x</a>", f"{LONG}z < 3 <3"),
    "unclosed": (f"<p>{LONG}</p><script>never closed {LONG * 5}", LONG.strip()),
    "linked": (f"<div><a href=1>{LONG}</a><br><a href=2>{LONG}</a></div><p>{LONG}x</p>", f"{LONG}x"),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, text = CASES[name]
    assert H.extract(page, PLAIN) == " ".join(text.split(" ")).strip()


def test_long_pages_take_linear_time():
    for page in ("<" * 200_000, "<a '" * 100_000, "<!--" * 100_000, "<p>" * 100_000, "<div>" * 50_000, "&" * 200_000, "</x " * 100_000, "<article>" + "<p>w " * 100_000, "<script" * 100_000):
        H.extract(page, PLAIN)


def test_odd_rows(spark):
    rows = [(1, None, None), (1, "u", ""), (None, "u", f"<p>{LONG}</p>"), (2, "v", "<p>x</p>" * 60_000), (2, "v", "<p>x</p>" * 60_000), (3, "w", "\0<p>\x1f é")]
    df = spark.createDataFrame([(*r, "clash", 4) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = H.extracted(df, H.learn(df))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(k, u, t, len(t)) for k, u, t in ((k, u, H.extract(h, PLAIN)) for k, u, h in rows)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert dict((r["page_id"], r["n_chars"]) for r in got.collect())[2] == 2 * 60_000 - 1
    empty = df.limit(0)
    assert H.extracted(empty, H.learn(empty)).collect() == []


def test_learning_is_bounded_and_the_same_on_the_cluster(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert H.learn(df).counts == weights_of(pages).counts
    few = H.learn(df, max_pages=50).counts
    assert 0 < few["-nav|"][1] < 110


def test_query(spark, pages):
    from ledgerlight.llm.queries import op12_html_text
    got = op12_html_text(spark, MEDIUM)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {tuple(r) for r in got.collect()} == {(k, u, t, len(t)) for k, u, t in ((k, u, article(p)) for k, u, p in pages)}


def test_pages_whose_elements_have_no_names(pages):
    bare = lambda p: re.sub("(?<=[</])(article|nav|footer)(?=>)", "div", p).replace(' class="ad"', "")
    weights = weights_of(pages[::2])
    right = [H.extract(bare(p), weights) == article(p) for *_, p in pages[1::2]]
    assert sum(right) > 0.9 * len(right)
