"""HTML extraction by maximum-scoring subsequence.

A page is a sequence of tokens, words and tags.  Words score by where they stand, tags negatively, and one linear
scan finds the contiguous run of the greatest sum: the main text.  Weights are learnt from labelled pages, which mark
their text by one ``article`` (or ``main``) element: a word's weight is the share of words in its place that belong to the
marked text, less a half; a tag's the share of such tags outside it, negated.  Fixed prior shares stand in for
places that labelled pages don't show.

Elements that are no text by their kind or by what their class says (menus, adverts, forms, comments, ...) count as one tag
each and give no words, whether the run ends there or goes on behind them.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

# Fixed values of HTML: elements that break lines, that have no end tag, and whose content isn't markup.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot
    th thead tr ul""".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea"
#: Elements that a start tag ends if one is open, up to the nearest of the others.
ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
        "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
# Elements that are never main text, and names in class, id or role that say so.
SKIPPED = frozenset("aside button canvas dialog dir footer form iframe menu nav noscript object search select svg template".split())
SKIPPED_NAMES = frozenset("""ad ads advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment comments complementary
    consent contentinfo cookie cookies copyright disclaimer discussion disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter
    notice notices overlay pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup social
    sponsor sponsored subscribe subscription teaser toolbar widget""".split())
COMMENT_NAMES = frozenset("comment comments reply replies".split())
#: A class that begins so speaks of the layout around it; a header of these is the text's own.
LAYOUT, OWN_HEADER = frozenset("has hide is no not show with without".split()), frozenset("article content entry post story".split())
# Prior share of an element's words (outside links; in links) and tags that are main text.
PRIOR = {"p": 0.9, "blockquote": 0.9, "article": 0.85, "main": 0.85, "h1": 0.8, "h2": 0.8, "h3": 0.8, "h4": 0.8, "h5": 0.8, "h6": 0.8, "pre": 0.8,
         "figcaption": 0.7, "li": 0.7, "dd": 0.7, "dt": 0.7, "td": 0.6, "th": 0.6, "div": 0.65, "section": 0.65, "body": 0.6}
PRIOR_OTHER, PRIOR_LINKED, PRIOR_TAG, PRIOR_SKIPPED = 0.6, 0.35, 0.5, 0.3
#: Elements whose own text is loose on a page that sets half of its words or more in paragraphs, and the prior then.
LOOSE, PRIOR_LOOSE = frozenset(("div", "section", "body", "other")), 0.35
#: Prior share inside and outside of a page's article or main element.
PRIOR_ZONE = {"in": 0.97, "out": 0.03}
#: Words or tags that a prior counts as, the integers that a weight of one is, and what any tag costs.
PRIOR_COUNT, SCALE, TAG_COST = 100, 1000, 50

TOKEN = re.compile(rf"""<!--.*?(?:--!?>|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)
    |<(/?)([a-z][^\s/<>]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][^\s/<>]*)([^<>]*)>?|</?[!?/][^>]*>?|[^<]+|<""", re.S | re.I | re.X)
MARKS = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
MAIN = ("article", "main")


@dataclass(frozen=True)
class Weights:
    """Integer weights by place or tag; those of places that labelled pages don't show come from the priors."""
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)  #: main text, all

    def share(self, what: str, prior: float) -> float:
        main, total = self.counts.get(what, (0, 0))
        return (main + prior * PRIOR_COUNT) / (total + PRIOR_COUNT)

    def word(self, leaf: str, linked: bool, zone: str) -> int:
        prior = PRIOR_ZONE.get(zone, PRIOR_LINKED if linked else PRIOR_LOOSE if leaf[0] == "+" else PRIOR.get(leaf, PRIOR_OTHER))
        return round(SCALE * (self.share(place(leaf, linked, zone), prior) - 0.5))

    def tag(self, name: str, zone: str) -> int:
        prior = PRIOR_ZONE.get(zone, PRIOR_SKIPPED if name[0] == "-" else PRIOR.get(name, PRIOR_TAG))
        return -round(SCALE * (1 - self.share(f"{name}|{zone}", prior))) - TAG_COST


def place(leaf: str, linked: bool, zone: str) -> str:
    return f"{'a ' if linked else ''}{leaf}|{zone}"


def _marked(attributes: str) -> tuple[set[str], bool]:
    """The names in class, id and role that tell what an element is, and if it has the role main."""
    names, main = set(), False
    for kind, value in MARKS.findall(attributes):
        main |= kind.lower() == "role" and value.strip("\"'").lower() == "main"
        for one in value.strip("\"'").split():
            parts = [p.lower() for p in PARTS.findall(one)]
            if parts and parts[0] not in LAYOUT:
                names.update(p for p in parts if p in SKIPPED_NAMES)
                if "header" in parts and not OWN_HEADER & set(parts):
                    names.add("header")
    return names, main


@dataclass
class Token:
    kind: str  #: "word": a run of words in one place; else a tag's name, "-" before it for a skipped element
    text: str
    n: int  #: words
    leaf: str
    linked: bool
    zones: tuple[bool, bool]  #: in an article, in a main element
    block: int


@dataclass
class _Open:
    name: str
    skipped: bool
    main: str  #: "article" or "main" if it is one


def tokens(html: str) -> list[Token]:
    """The page's runs of words and tags.  What is in a skipped element is left out; its tags are one token."""
    out: list[Token] = []
    stack: list[_Open] = []
    depths: dict[str, list[int]] = defaultdict(list)  # of open elements, by name
    skipping, block, linked = 0, 0, False
    within = {"article": 0, "main": 0}

    def put(kind: str, text: str = "", n: int = 0) -> None:
        leaf = next((e.name for e in reversed(stack) if e.name in BLOCKS), "body")
        out.append(Token(kind, text, n, leaf if leaf in PRIOR else "other", linked, (within["article"] > 0, within["main"] > 0), block))

    def close(down_to: int) -> None:
        nonlocal skipping
        while len(stack) > down_to:
            e = stack.pop()
            depths[e.name].pop()
            skipping -= e.skipped
            if e.main:
                within[e.main] -= 1

    def end_open(names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        found, stop = (max((depths[n][-1] for n in some if depths[n]), default=-1) for some in (names, stops))
        if found > stop:
            close(found)

    for m in TOKEN.finditer(html):
        whole = m[0]
        if whole[0] != "<" or len(whole) == 1:
            if not skipping:
                text = unescape(whole) if "&" in whole else whole
                put("word", text, len(text.split()))
            continue
        name = m[3] or m[6]
        if not name:
            continue
        name, ending, attributes = name.lower(), m[2] or m[5], m[4] or m[7] or ""
        breaks = name in BLOCKS
        if breaks:
            block += 1
            linked = False
        if ending:
            if name == "a":
                linked = False
            if depths[name]:
                quiet = skipping
                close(depths[name][-1])
                if quiet:
                    continue
            if not skipping and (breaks or name == "a"):
                put(name)
            continue
        if name == "br":
            if not skipping:
                put("br", " ")
            continue
        if name in VOID:
            continue
        if breaks:
            end_open(("p",), ("button", "table", "td", "th", "caption"))
            if name in ENDS:
                end_open(*ENDS[name])
        if name == "a":
            linked = True
        names, role = _marked(attributes) if "=" in attributes else ((), False)
        main = name if name in MAIN else "main" if role else ""
        own = within["article"] or within["main"]
        skip = name in SKIPPED or name == "header" and not own
        if main or name in ("body", "html", "head"):
            skip = bool(COMMENT_NAMES.intersection(names)) and name == "article"
        elif names and not (names == {"header"} and own):
            skip = True
        if skip:
            if not skipping:
                put(f"-{name if name in SKIPPED or name == 'header' else 'class'}")
        elif not skipping and (breaks or name == "a"):
            put(name)
        if breaks or skip:
            main = "" if skip else main
            depths[name].append(len(stack))
            stack.append(_Open(name, skip, main))
            skipping += skip
            if main:
                within[main] += 1
    return out


def zone_of(page: list[Token]) -> Callable[[Token], str]:
    """Where a token stands: in or out of the page's articles, else of its main elements; "" on a page without them."""
    k = next((k for k in (0, 1) if any(t.zones[k] for t in page)), None)
    return (lambda t: "") if k is None else (lambda t: "in" if t.zones[k] else "out")


def leaf_of(page: list[Token]) -> Callable[[Token], str]:
    """The element that a word stands in; "+" before it where the text is loose."""
    in_paragraphs = sum(t.n for t in page if t.leaf == "p")
    if 2 * in_paragraphs < sum(t.n for t in page):
        return lambda t: t.leaf
    return lambda t: f"+{t.leaf}" if t.leaf in LOOSE else t.leaf


def scores(page: list[Token], weights: Weights) -> list[int]:
    zone, leaf, known, out = zone_of(page), leaf_of(page), {}, []
    for t in page:
        key = (t.kind, leaf(t) if t.kind == "word" else "", t.linked, zone(t))
        if key not in known:
            known[key] = weights.word(key[1], t.linked, key[3]) if t.kind == "word" else 0 if t.kind == "br" else weights.tag(t.kind, key[3])
        out.append(known[key] * (t.n if t.kind == "word" else 1))
    return out


def best_run(values: list[int]) -> tuple[int, int]:
    """Bounds of the first contiguous run of the greatest positive sum; (0, 0) if none is positive."""
    best, bounds, run, start = 0, (0, 0), 0, 0
    for i, v in enumerate(values):
        if run <= 0:
            run, start = 0, i
        run += v
        if run > best:
            best, bounds = run, (start, i + 1)
    return bounds


def text_of(run: list[Token]) -> str:
    blocks, at, parts = [], None, []
    for t in run:
        if t.block != at:
            blocks.append("".join(parts))
            at, parts = t.block, []
        parts.append(t.text)
    blocks.append("".join(parts))
    return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def extract(html: str | None, weights: Weights) -> str:
    page = tokens(html or "")
    start, end = best_run(scores(page, weights))
    return text_of(page[start:end])


def count_labelled(html: str | None, counts: Counter) -> None:
    """Add a labelled page's words and tags, in and out of its one article or main element, by place."""
    page = tokens(html or "")
    k = next((k for k in (0, 1) if any(t.zones[k] for t in page)), None)
    if k is None:
        return
    edges = sum(a.zones[k] != b.zones[k] for a, b in zip(page, page[1:])) + page[0].zones[k] + page[-1].zones[k]
    if edges != 2:
        return
    leaf = leaf_of(page)
    for t in page:
        if t.kind == "br":
            continue
        n, zone = (t.n, "in") if t.kind == "word" else (1, "in")
        zone = zone if t.zones[k] else "out"
        for z in ("", zone):
            what = place(leaf(t), t.linked, z) if t.kind == "word" else f"{t.kind}|{z}"
            counts[what, "all"] += n
            counts[what, "main"] += n * t.zones[k]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in sliced(batches, "html"):
        for html in batch.column("html").to_pylist():
            count_labelled(html, counts)
    places = sorted({w for w, _ in counts})
    yield pa.record_batch({"what": pa.array(places, pa.string()), "main": pa.array([counts[w, "main"] for w in places], pa.int64()),
                           "total": pa.array([counts[w, "all"] for w in places], pa.int64())})


def learn(pages: DataFrame, max_pages: int = 20_000, key: str = "page_id") -> Weights:
    """Weights from labelled pages (``html``; those with one article or main element), drawn by a hash of ``key`` and
    ``url`` so that about ``max_pages`` at most are read.  Places are a fixed set, so the counts have a bounded size.
    Without labelled pages the priors hold."""
    n = pages.count()
    drawn = F.pmod(F.xxhash64(key, "url"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_pages / max(n, 1)) + 0.5)
    labelled = pages.where(drawn & F.rlike("html", F.lit(r"(?i)<(article|main)[\s>]|role=")))
    rows = labelled.select("html").mapInArrow(_count, "what string, main bigint, total bigint").groupBy("what").agg(F.sum("main").alias("main"), F.sum("total").alias("total"))
    return Weights({r["what"]: (r["main"], r["total"]) for r in rows.collect()})


def extracted(pages: DataFrame, weights: Weights, key: str = "page_id") -> DataFrame:
    """``key``, ``url``, ``text``: the main text of every row's ``html``, and ``n_chars``, its code points.

    A null or empty page, and one without a run of positive score, has the empty text.  Equal rows are all returned, whole pages
    are read however long, other columns play no part; an empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            texts = [extract(h, weights) for h in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column(key), batch.column("url"), pa.array(texts, pa.string())], [key, "url", "text"])

    types = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, "url"))
    found = pages.select(key, "url", "html").mapInArrow(run, f"{types}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
