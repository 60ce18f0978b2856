"""Main text of web pages.

A page is flattened to text blocks: runs of text between block-level tags, with
words counted and the share of them inside links.  A block is described by its
own figures, those of both neighbours, and where it stands: inside a part that is
beside the text (menu, form, advert, comments and the like), inside one whose class
may mean that (alert, teaser, social), inside an article.  A decision tree says
whether it is main text.  It is grown (Gini, exact splits) from the small table of
labelled blocks below when the operator is called, and travels to the tasks as
nested tuples.  Without an article, and for parts that only may be beside the text,
the words and link density of the neighbours decide.

No tag, class or id makes a page lose its text: a part that holds the page's article,
or on a page without one half of its unlinked words, is not beside the text.  (Comment,
advert and consent parts are, even if they hold articles of their own.)  A class
or id marks a part only if its first or last word is a name of such parts and none
says a state (has-sidebar, comments-open), and never marks an article, unless one
inside another.  Elements that are not shown (hidden, display:none) have no text.

Defined results: null and empty html give no text; markup that is never closed
ends with its parent, and end tags without a start are passed over at no cost, so the
time is proportional to the page; text outside any tag is a block; repeated
rows are extracted alike; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachlens.llm.common import batches_by_size

BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("""script style noscript template head title iframe object svg math canvas audio video select
textarea button datalist map""".split())
#: elements that begin where a like one must have ended
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body div section article main aside nav header footer form table ul ol dl blockquote td".split())
SIDE = frozenset("nav aside form menu dialog footer search".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
SIDE_NAMES = frozenset("""ad ads adbox advert advertisement advertising adverts banner breadcrumb breadcrumbs
comment comments consent cookie cookies copyright discussion disqus feedback footer gdpr legal login masthead menu modal
nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended
related replies reply respond share sharing sidebar sidebars signup sponsor sponsored subscribe subscription
toolbar topbar widget widgets""".split())
#: names of parts that may be beside the text, or not
MAYBE_NAMES = frozenset("alert social teaser".split())
HEAD_NAMES = frozenset(["header", "masthead", "topbar"])
#: words by which a class tells of a page's state or subject and names no part
STATE_NAMES = frozenset("""has no not with without is are hide show open closed enabled disabled category cat tag
topic format""".split())
#: names of parts that stay beside the text whatever they hold
NEVER_TEXT = frozenset("""ad ads adbox advert advertisement advertising adverts comment comments consent cookie
cookies discussion disqus feedback gdpr recommended related replies reply respond sponsor sponsored""".split())

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "side", "maybe", "place",
            "rights")
#: labelled blocks: FEATURES in order, then 1 for main text.  side: inside a part
#: beside the text; maybe: inside one that may be; place: 1 inside an article, -1
#: outside the article of a page that has one, 0 on a page without; rights: says
#: whose the rights are.
LABELLED = """
1 1.0 0 0 1 1.0 1 0 -1 0 0
12 0 1 1.0 9 0 1 0 -1 0 0
25 0 2 1.0 8 0 1 0 -1 0 0
80 0 30 0 20 0 1 0 1 0 0
7 0 80 0 50 0 1 0 1 0 0
18 0.4 50 0 6 0 1 0 1 0 0
4 1.0 70 0 3 1.0 1 0 1 0 0
30 0 40 0 25 0 1 0 1 0 0
30 0 0 0 25 0 1 0 0 0 0
12 0 40 0 3 0 1 0 0 0 0
65 0 40 0 50 0 1 0 0 0 0
2 1.0 1 1.0 3 1.0 1 0 0 0 0
40 0 5 0 3 0 0 0 -1 0 0
3 0 40 0 70 0 0 0 -1 0 0
55 0.2 3 1.0 6 1.0 0 0 -1 0 0
90 0 0 0 60 0 0 0 -1 0 0
9 0 60 0 45 0 0 0 -1 0 0
20 0 2 0 18 0 0 1 -1 0 0
12 0 40 0 30 0 0 0 -1 0 0
9 0 12 0 60 0 0 0 1 0 1
10 0 1 1.0 70 0 0 0 1 0 1
1 0 40 0 35 0 0 0 1 0 1
60 0 9 0 45 0 0 0 1 0 1
45 0.1 60 0 2 0 0 0 1 0 1
4 1.0 60 0 30 0 0 0 1 0 1
30 0.5 4 0 0 0 0 0 1 0 1
1 0 2 1.0 9 0 0 0 1 0 1
3 1.0 3 1.0 3 1.0 0 0 1 0 1
90 0 1 1.0 12 0 0 0 1 0 1
20 0 12 0 15 0.3 0 0 1 0 1
13 0.6 90 0 1 1.0 0 0 1 0 1
3 0 0 0 12 0 0 0 1 0 1
2 0 0 0 2 1.0 0 0 1 0 1
1 0 0 0 0 0 0 0 1 0 1
1 1.0 0 0 0 0 0 0 1 0 1
3 0 9 1.0 2 1.0 0 0 1 0 1
2 0 2 1.0 0 0 0 0 1 0 1
5 1.0 20 0 0 0 0 0 1 0 1
8 0.6 3 1.0 40 0 0 0 1 0 1
4 0 3 1.0 3 1.0 0 0 1 1 1
3 0 0 0 2 1.0 0 0 1 1 1
14 0 40 0 50 0 0 0 1 1 1
20 0 50 0 30 0 0 0 1 1 1
6 0 30 0 0 0 0 0 1 1 1
30 0 8 0 60 0 0 1 1 0 1
22 0 9 0 45 0 0 1 1 0 1
14 0.1 3 0 40 0 0 1 1 0 1
45 0 3 0 50 0 0 1 1 0 1
3 0 50 0 45 0 0 1 1 0 1
2 0 12 0 30 0 0 1 1 0 1
2 0 0 0 48 0 0 1 1 0 1
3 0 0 0 20 0 0 1 1 0 1
15 0 0 0 50 0 0 1 1 0 1
2 0 20 0 60 0 0 1 1 0 1
2 1.0 40 0 2 1.0 0 1 1 0 0
1 0 40 0 2 1.0 0 1 1 0 0
2 0 2 1.0 30 0 0 1 1 0 0
12 1.0 30 0 9 0 0 1 1 0 0
9 0.8 60 0 50 0 0 1 1 0 0
30 0 9 0 45 0 0 1 0 0 0
12 0 40 0 50 0 0 1 0 0 0
3 0 50 0 45 0 0 1 0 0 0
1 1.0 0 0 1 1.0 0 0 0 0 0
2 1.0 1 1.0 2 1.0 0 0 0 0 0
4 1.0 30 0 45 0 0 0 0 0 0
5 0.8 2 1.0 40 0 0 0 0 0 0
6 0.6 50 0 3 1.0 0 0 0 0 0
20 0.9 30 0 4 1.0 0 0 0 0 0
45 0.7 40 0 60 0 0 0 0 0 0
3 0 0 0 2 1.0 0 0 0 0 0
2 0 1 1.0 1 1.0 0 0 0 0 0
4 0 2 1.0 3 1.0 0 0 0 0 0
3 0 3 1.0 2 1.0 0 0 0 0 0
9 0 4 1.0 3 1.0 0 0 0 0 0
5 0 2 1.0 4 1.0 0 0 0 0 0
4 0 3 1.0 0 0 0 0 0 0 0
6 0 9 1.0 2 1.0 0 0 0 0 0
3 0 12 1.0 0 0 0 0 0 0 0
9 0 2 1.0 0 0 0 0 0 0 0
17 0 3 1.0 0 0 0 0 0 1 0
17 0 40 0 0 0 0 0 0 1 0
5 0 30 0 0 0 0 0 0 1 0
9 0 4 0 3 0 0 0 0 1 0
12 0 8 0 0 0 0 0 0 1 0
7 0 50 0 2 1.0 0 0 0 1 0
4 0 9 0 1 1.0 0 0 0 1 0
30 0 5 0 2 0 0 0 0 1 0
6 0 9 0 2 1.0 0 0 0 1 0
12 0 60 0 3 1.0 0 0 0 1 0
8 0 3 1.0 50 0 0 0 0 0 1
6 0 2 1.0 30 0 0 0 0 0 1
5 0 1 1.0 25 0 0 0 0 0 1
4 0 1 1.0 9 0 0 0 0 0 1
50 0 8 0 42 0.1 0 0 0 0 1
42 0.1 50 0 6 0 0 0 0 0 1
6 0 42 0 38 0 0 0 0 0 1
38 0.2 6 0 2 1.0 0 0 0 0 1
22 0 3 0 18 0 0 0 0 0 1
18 0 22 0 4 0 0 0 0 0 1
9 0 18 0 25 0 0 0 0 0 1
70 0 0 0 0 0 0 0 0 0 1
10 0 0 0 0 0 0 0 0 0 1
5 0 0 0 0 0 0 0 0 0 1
3 0 55 0 60 0 0 0 0 0 1
55 0.1 2 1.0 3 1.0 0 0 0 0 1
30 0 4 1.0 0 0 0 0 0 0 1
14 0 3 1.0 2 1.0 0 0 0 0 1
1 0 30 0 2 0 0 0 0 0 1
2 0 1 0 2 0 0 0 0 0 1
2 0 2 0 1 0 0 0 0 0 1
1 0 2 0 40 0 0 0 0 0 1
4 0 3 0 5 0 0 0 0 0 1
5 0 4 0 3 0 0 0 0 0 1
7 0 6 0 0 0 0 0 0 0 1
3 0 5 0 0 0 0 0 0 0 1
6 0 60 0 0 0 0 0 0 0 1
7 0 50 0 2 1.0 0 0 0 0 1
4 0 6 0 1 1.0 0 0 0 0 1
3 0 7 0 2 1.0 0 0 0 0 1
6 0 9 0 2 1.0 0 0 0 0 1
12 0 60 0 3 1.0 0 0 0 0 1
10 0 70 0 3 1.0 0 0 0 0 1
4 0 50 0 3 1.0 0 0 0 0 1
8 0 5 0 2 1.0 0 0 0 0 1
2 0 30 0 1 1.0 0 0 0 0 1
"""


# -- the tree ---------------------------------------------------------------

def labelled_rows(table: str = LABELLED) -> tuple[list[list[float]], list[int]]:
    rows = [[float(v) for v in line.split()] for line in table.strip().splitlines()]
    return [r[:-1] for r in rows], [int(r[-1]) for r in rows]


def grow(x: list[list[float]], y: list[int]) -> tuple | float:
    """(feature, cut, low, high) where rows at or under the cut go low; a leaf is
    the share of main text."""
    share = sum(y) / len(y)
    best = (2 * share * (1 - share) - 1e-9, None, None)
    for j in range(len(x[0])):
        values = sorted({r[j] for r in x})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            low = [v for r, v in zip(x, y) if r[j] <= cut]
            high = [v for r, v in zip(x, y) if r[j] > cut]
            gini = sum(2 * sum(s) * (1 - sum(s) / len(s)) for s in (low, high)) / len(y)
            if gini < best[0]:
                best = (gini, j, cut)
    if best[1] is None:
        return share
    _, j, cut = best
    parts = [[(r, v) for r, v in zip(x, y) if (r[j] > cut) == side] for side in (False, True)]
    return (j, cut, *(grow([r for r, _ in p], [v for _, v in p]) for p in parts))


def likely(tree: tuple | float, row: list[float]) -> float:
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


# -- blocks -----------------------------------------------------------------

@dataclass
class Block:
    text: str
    words: int
    link_words: int
    part: int = 0
    article: int = 0
    side: bool = False
    maybe: bool = False


@dataclass
class _Part:
    """A part that is, or may be, beside the text, in the one around it."""
    up: int
    maybe: bool
    never_text: bool
    plain_words: int = 0


@dataclass
class _Open:
    tag: str
    part: int
    silent: bool
    article: int
    link: bool


def _names(value: str | None) -> list[list[str]]:
    """The words of each class, but of those that say a state."""
    spaced = (re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", c).lower() for c in (value or "").split())
    words = (re.findall(r"[a-z0-9]+", c) for c in spaced)
    return [w for w in words if w and not STATE_NAMES.intersection(w)]


_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_RIGHTS = re.compile(r"©|\(c\) ?\d{4}|\bcopyright\b|all rights reserved", re.IGNORECASE)


class _Flattener(HTMLParser):
    """Blocks, parts and articles of a page.  Where the elements of a tag stand
    in the stack of open ones is kept by tag, so no tag walks the stack."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = [_Open("", 0, False, 0, False)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.block_places: list[int] = []
        self.scope_places: list[int] = []
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.link_words = 0
        self.parts: list[_Part] = [_Part(0, False, False)]
        self.articles: list[int] = [0]  # the part each outermost article stands in, from 1 on

    def flush(self) -> None:
        words = "".join(self.pieces).split()
        if words:
            top = self.open[-1]
            linked = min(self.link_words, len(words))
            self.blocks.append(Block(" ".join(words), len(words), linked, top.part, top.article))
            self.parts[top.part].plain_words += len(words) - linked
        self.pieces, self.link_words = [], 0

    def _part(self, tag: str, attrs: dict[str, str | None], article: bool) -> _Part | None:
        """The part that an element begins, if it is (or may be) beside the text."""
        up = self.open[-1].part
        plain = tag in ("html", "body", "main") or (tag == "article" and not self.places["article"])
        names = [] if plain else _names(attrs.get("class")) + _names(attrs.get("id"))
        ends = {w for n in names for w in (n[0], n[-1])}
        never = bool(ends & NEVER_TEXT)
        known = SIDE_NAMES - HEAD_NAMES if article or tag == "article" else SIDE_NAMES | HEAD_NAMES
        if (tag in SIDE or (tag == "header" and not article) or ends & known
                or (not plain and (attrs.get("role") or "").lower() in SIDE_ROLES)):
            return _Part(up, False, never)
        return _Part(up, True, False) if ends & MAYBE_NAMES else None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.flush()
            self._close_implied(tag)
        elif tag == "br":
            self.pieces.append(" ")
        if tag in VOID:
            return
        up, said = self.open[-1], dict(attrs)
        part, article = up.part, up.article
        if made := self._part(tag, said, bool(article)):
            self.parts.append(made)
            part = len(self.parts) - 1
        if tag in ("article", "main") and not article:
            self.articles.append(part)
            article = len(self.articles) - 1
        silent = up.silent or tag in SILENT or "hidden" in said or bool(_UNSEEN.search(said.get("style") or ""))
        at = len(self.open)
        self.places[tag].append(at)
        if tag in BLOCK:
            self.block_places.append(at)
        if tag in SCOPE:
            self.scope_places.append(at)
        self.open.append(_Open(tag, part, silent, article, up.link or tag == "a"))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes void elements only

    def _close(self, at: int) -> None:
        for o in self.open[at:]:
            self.places[o.tag].pop()
        del self.open[at:]
        for places in (self.block_places, self.scope_places):
            while places and places[-1] >= at:
                places.pop()

    def _close_implied(self, tag: str) -> None:
        at = max((self.places[t][-1] for t in CLOSES.get(tag, {"p"}) if self.places[t]), default=0)
        if at and not (self.scope_places and self.scope_places[-1] > at):
            self._close(at)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        at = self.places[tag][-1] if self.places[tag] else 0
        if at and (tag in BLOCK or not self.block_places or self.block_places[-1] < at):
            self._close(at)

    def handle_data(self, data: str) -> None:
        top = self.open[-1]
        if not top.silent:
            self.pieces.append(data)
            if top.link:
                self.link_words += len(data.split())


def _freed(parts: list[_Part], articles: list[int], blocks: list[Block]) -> tuple[set[int], bool]:
    """The parts that hold the page's text and so are not beside it, and whether the
    page has an article."""
    inside = [0] * len(articles)
    for b in blocks:
        inside[b.article] += b.words
    barred, never = [False], [False]  # beside the text itself or by what is around
    for p in parts[1:]:
        barred.append(barred[p.up] or not p.maybe)
        never.append(never[p.up] or p.never_text)
    real = [k for k in range(1, len(articles)) if not never[articles[k]]]
    if real:
        around = [articles[k] for k in real if not barred[articles[k]]]
        holders = around or [articles[max(real, key=lambda k: inside[k])]]
    else:
        total = list(p.plain_words for p in parts)
        for i in range(len(parts) - 1, 0, -1):
            total[parts[i].up] += total[i]
        holders = [i for i in range(1, len(parts)) if not never[i] and 2 * total[i] >= max(total[0], 1)]
    out: set[int] = set()
    for i in holders:
        while i and i not in out:
            out.add(i)
            i = parts[i].up
    return out, bool(real)


def flatten(html: str) -> tuple[list[Block], bool]:
    """The text blocks of a page in order, and whether it has an article."""
    reader = _Flattener()
    reader.feed(html)
    reader.close()
    reader.flush()
    free, has_article = _freed(reader.parts, reader.articles, reader.blocks)
    side, maybe = [False], [False]
    for i, p in enumerate(reader.parts[1:], 1):
        side.append(side[p.up] or (i not in free and not p.maybe))
        maybe.append(maybe[p.up] or (i not in free and p.maybe))
    for b in reader.blocks:
        b.side, b.maybe = side[b.part], maybe[b.part]
    return reader.blocks, has_article


def described(blocks: list[Block], has_article: bool) -> list[list[float]]:
    """FEATURES of each block; beyond the ends stands an empty block."""
    none = Block("", 0, 0)
    around = [none, *blocks, none]
    share = [b.link_words / b.words if b.words else 0.0 for b in around]
    return [[b.words, share[i], around[i - 1].words, share[i - 1], around[i + 1].words, share[i + 1],
             b.side, b.maybe, (1 if b.article else -1) if has_article else 0, bool(_RIGHTS.search(b.text))]
            for i, b in enumerate(around[1:-1], 1)]


def main_text(html: str | None, tree: tuple | float) -> str:
    blocks, has_article = flatten(html or "")
    return "\n".join(b.text for b, row in zip(blocks, described(blocks, has_article))
                     if likely(tree, row) >= 0.5)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of ``pages`` without ``html``, and text and n_chars (replacing
    columns of these names)."""
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    tree = grow(*labelled_rows())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, html):
            texts = [main_text(h.as_py(), tree) for h in batch.column(html)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "text"])

    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType())])
    return pages.select(*keep, html).mapInArrow(run, schema).withColumn(
        "n_chars", F.length("text").cast("bigint"))
