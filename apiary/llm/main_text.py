"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page becomes a sequence of tags and runs of words. Words score positive and tags
negative, by weights learnt from labelled pages; one linear scan finds the contiguous
region of the greatest total score. Labelled are the pages that mark their article
themselves (one ``<article>`` element or ``itemprop="articleBody"``): a bounded sample
(``SAMPLE`` distinct pages, those of the smallest hashes) gives, for each kind of place a
word can stand in (nearest block, inside a link) and for each tag, how often it occurs
inside and outside of the article. The mark itself is no feature, so the weights also
serve pages that mark nothing. Page parts (below) are left out of every text: their tags
score nothing, and their words a little below nothing.

If the region found lies mostly in the one article a page marks, it is set to that
element. Of the region all words are kept but those of page parts: elements for menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments, known by element name, role, or class and id words (fixed
lists below), and hidden elements.

Text: character references decoded, white space (as Unicode has it) inside a block to one
space, blocks joined by one space; ``<br>`` separates words; tags inside a line do not.

Defined cases: null or empty html gives an empty text; pages without words too;
broken markup, unclosed tags, quotes and comments are read to the end of
the page; bytes that are no UTF-8 become U+FFFD; repeated rows each give a row; a page
of any length is processed whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apiary.llm.common import small_batches

# Distinct pages the weights are learnt from, at most.
SAMPLE = 2000

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
PAGE_PARTS = set(
    "script style noscript template head title svg iframe object canvas audio video map form fieldset legend label "
    "select option textarea button output datalist nav menu header footer aside dialog noembed noframes".split()
)
# Words of class, id and role that name a page part.
PART_NAMES = set(
    "ad ads adsbygoogle advert adverts advertisement advertising adsense adbox adslot taboola outbrain sponsor sponsored sponsors promo promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments commentlist disqus respond responses reply replies discussion feedback "
    "disclaimer sidebar offcanvas menu "
    "nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar share sharing social related "
    "recommended recommendations widget widgets pagination pager search copyright contentinfo complementary".split()
)
# A class such as has-sidebar or no-comments tells of a page part elsewhere.
_ELSEWHERE = {"has", "with", "no", "without", "not", "is"}
# These wrap whole pages: their classes name no part.
_WRAPPERS = {"html", "body", "main"}
# Start tags that end an open paragraph.
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dd dt".split()
)
# Start tags that end an open element of the same kind, up to the element that holds both.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def is_part(name: str, rest: str) -> bool:
    """The element is a page part or hidden, by its name and attributes."""
    if name in PAGE_PARTS:
        return True
    if not rest or name in _WRAPPERS:
        return False
    for found in _ATTRIBUTE.finditer(rest):
        key = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and _HIDDEN_STYLE.search(value):
            return True
        if key in ("class", "id", "role"):
            for token in value.split():
                words = [w.lower() for w in _NAME_WORD.findall(token)]
                if name == "article":
                    # An article's own classes may tell of its subject; only a whole one names a part.
                    words = [token.lower()]
                if words and words[0] not in _ELSEWHERE and not PART_NAMES.isdisjoint(words):
                    return True
    return False


@dataclass
class Page:
    """Events of a page in order: words as (place, raw text, part), tags as (name, separates)."""

    kinds: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    parts: list[bool] = field(default_factory=list)
    # Event ranges of the marked articles.
    articles: list[tuple[int, int]] = field(default_factory=list)


def read(source: str) -> Page:
    """The events of a page. Open elements are tracked, so every run of words knows where it stands."""
    page = Page()
    # Open elements: name, in a page part, nearest block, in a link, first event of a marked article or -1.
    stack: list[tuple[str, bool, str, bool, int]] = [("", False, "", False, -1)]
    is_open: Counter = Counter()
    lower = None

    def words(text: str) -> None:
        if text and not text.isspace():
            _, part, block, link, _ = stack[-1]
            page.kinds.append("part" if part else f"link {block}" if link else f"in {block}")
            page.texts.append(text)
            page.counts.append(len(text.split()))
            page.parts.append(part)
        elif text:
            page.kinds.append("")
            page.texts.append(" ")
            page.counts.append(0)
            page.parts.append(stack[-1][1])

    def tag(name: str, part: bool) -> None:
        page.kinds.append("" if part else f"<{name}")
        page.texts.append(None if name in INLINE else "\n")
        page.counts.append(0)
        page.parts.append(part)

    def pop() -> None:
        name, _, _, _, article = stack.pop()
        is_open[name] -= 1
        if article >= 0:
            page.articles.append((article, len(page.kinds)))

    def close(names: set[str], within: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in within:
                return

    at = 0
    while True:
        found = _TAG.search(source, at)
        words(source[at : found.start()] if found else source[at:])
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["close"] or found["close2"]:
            tag(name, stack[-1][1])
            if is_open[name]:
                close({name}, set())
            continue
        rest = found["rest"] or found["rest2"] or ""
        if name in _ENDS_P and is_open["p"]:
            close({"p"}, {"table", "td", "th", "article", "section", "div", "body"})
        if name in _SIBLINGS and any(is_open[n] for n in _SIBLINGS[name][0]):
            close(*_SIBLINGS[name])
        _, part, block, link, _ = stack[-1]
        part = part or is_part(name, rest)
        tag(name, part)
        if name in VOID:
            continue
        marked = not part and (name == "article" or "articleBody" in rest)
        if name in RAW:
            # Raw text ends at its own end tag only.
            lower = source.lower() if lower is None else lower
            if len(lower) != len(source):
                end = re.compile(f"</{name}", re.IGNORECASE).search(source, at)
                at = end.start() if end else len(source)
            else:
                end = lower.find(f"</{name}", at)
                at = end if end >= 0 else len(source)
            continue
        if not rest.endswith("/") or name not in ("path", "use"):
            inner = block if name in INLINE or name in ("article", "section", "main") else name
            stack.append((name, part, inner, link or name == "a", len(page.kinds) if marked else -1))
            is_open[name] += 1
    while len(stack) > 1:
        pop()
    return page


def marked_article(page: Page) -> tuple[int, int] | None:
    """The one article a page marks (the outermost, if they nest)."""
    outer: list[tuple[int, int]] = []
    for article in sorted(page.articles, key=lambda a: (a[0], -a[1])):
        if not outer or article[0] >= outer[-1][1]:
            outer.append(article)
    return outer[0] if len(outer) == 1 else None


def tally(page: Page) -> dict[str, tuple[int, int]]:
    """Words per kind of place, and tags per name, inside and outside of the marked article."""
    article = marked_article(page)
    counts: dict[str, list[int]] = {}
    for i, (kind, n) in enumerate(zip(page.kinds, page.counts, strict=True)):
        if kind:
            outside = not article[0] <= i < article[1] or page.parts[i]
            counts.setdefault(kind, [0, 0])[outside] += n or 1
    return {kind: (n[0], n[1]) for kind, n in counts.items()}


class Weights:
    """Score of a word by its place (at most 1) and of a tag by its name (below 0)."""

    # Used for kinds that no labelled page shows.
    UNSEEN_WORD, UNSEEN_LINK, UNSEEN_TAG = 1.0, -1.0, -0.25
    # Words of page parts, which no text holds: a region may reach over some.
    PART = -0.05

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.kind = {}
        for kind, (inside, outside) in counts.items():
            odds = math.log((inside + 1) / (outside + 1))
            if kind.startswith("<"):
                self.kind[kind] = max(-5.0, min(-0.1, odds - 0.1))
            elif kind == "part":
                self.kind[kind] = self.PART
            else:
                # Seldom seen places stay near the value for unseen ones.
                trust = (inside + outside) / (inside + outside + 50)
                self.kind[kind] = max(-2.0, min(1.0, trust * odds + (1 - trust) * self._unseen(kind)))

    def _unseen(self, kind: str) -> float:
        if kind.startswith("<"):
            return self.UNSEEN_TAG
        if kind == "part":
            return self.PART
        return self.UNSEEN_LINK if kind.startswith("link") else self.UNSEEN_WORD

    def score(self, kind: str, n: int) -> float:
        if not kind:
            return 0.0
        weight = self.kind.get(kind)
        if weight is None:
            weight = self.kind[kind] = self._unseen(kind)
        return weight * (n or 1)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Range of the maximum-scoring contiguous subsequence, empty if no score is positive (first one on ties)."""
    best, lo, hi = 0.0, 0, 0
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, lo, hi = total, start, i + 1
    return lo, hi


def main_text(source: str | None, weights: Weights) -> str:
    """Main text of one page."""
    if not source:
        return ""
    page = read(source)
    lo, hi = best_region([weights.score(k, n) for k, n in zip(page.kinds, page.counts, strict=True)])
    article = marked_article(page)
    if article:
        kept = [0 if part else n for n, part in zip(page.counts, page.parts, strict=True)]
        inside = sum(kept[max(lo, article[0]) : min(hi, article[1])]) if lo < article[1] and article[0] < hi else 0
        if 2 * inside >= sum(kept[lo:hi]):
            lo, hi = article
    out = [t for t, part in zip(page.texts[lo:hi], page.parts[lo:hi], strict=True) if t is not None and (not part or t == "\n")]
    return " ".join("".join(references.unescape(t) if "&" in t else t for t in out).split())


def train(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` distinct pages; those that mark no article, or several, teach nothing."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.where(F.col("html").isNotNull()).select(
        F.xxhash64(F.col("html").cast("string")).alias("_hash"), F.col("html").cast("string").cast("binary").alias("_html")
    )
    chosen = [r[0] for r in rows.select("_hash").distinct().orderBy("_hash").limit(sample).collect()]
    if not chosen:
        return Weights({})
    taught = rows.where(F.col("_hash") <= chosen[-1]).groupBy("_hash").agg(F.first("_html").alias("_html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list[int]] = {}
        for batch in batches:
            for source in batch.column("_html"):
                page = read(source.as_py().decode("utf-8", "replace"))
                if marked_article(page):
                    for kind, (a, b) in tally(page).items():
                        have = total.setdefault(kind, [0, 0])
                        have[0] += a
                        have[1] += b
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), *(pa.array([n[i] for n in total.values()], pa.int64()) for i in (0, 1))],
            ["kind", "inside", "outside"],
        )

    found = taught.select("_html").mapInArrow(count, "kind string, inside long, outside long")
    sums = found.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return Weights({r["kind"]: (r["inside"], r["outside"]) for r in sums.collect()})


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) of every page. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source in batch.column("_html"):
                source = source.as_py()
                texts.append(main_text(None if source is None else source.decode("utf-8", "replace"), weights))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    small_batches(pages.sparkSession)
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").cast("binary").alias("_html"),
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")
