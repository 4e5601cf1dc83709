"""Main-text extraction from HTML (operator 7) by tree scoring.

A tolerant pass over the tags builds the tree of block elements. Every block of
text passes points (one, plus its commas, plus one per 100 characters up to
three), discounted by its link density, to its parent, half to the grandparent,
a third and a fourth further up. The container with the best score, again
discounted by its own link density, is kept, or the ``article`` or ``main`` it
lies in, and with it those siblings that score at least a fifth as much or are
long, nearly link-free text.

Left out before scoring: scripts, styles and other non-text elements, menus,
page headers, footers, sidebars, forms, hidden parts, and blocks whose class, id
or role names them as advert, notice, navigation, sharing box, related links or
reader comments. A ``header`` inside an article belongs to the article. Apart
from hidden parts, an element stays, its score halved, if it holds all text of
the page's main articles, or is a frame (a name like ``sidebar-left`` or
``layout-header`` often says how the page is laid out) around the largest of
them. Main articles are outermost ``article`` and ``main`` elements that don't lie
in a menu, sidebar, footer, advert or comments; what lies inside one is never
protected, and the names of an article within an article count. A page without
main articles keeps frames that hold most of its unlinked text. If nothing would
be left of a page, first what layout words name stays, then all but hidden parts.
Ids of headings, and of sections with headings inside an article, are anchors and
name nothing, unless they say comments.

A ``div`` or ``section`` that holds text and no blocks is a paragraph: it scores
its parent, so paragraphs of any length stay together.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by newlines. The whole html is read;
nothing is capped. The pass is linear in the page's length.

Defined cases: null, empty and tag-only html give an empty text; plain text
without tags is one block; unclosed and stray tags are repaired; repeated rows
give the same text each; input columns named like results are replaced.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text, prepare, table

# Element and name lists of HTML pages.
BLOCKS = frozenset("""html body p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th
caption section article main header footer nav aside form fieldset figure figcaption address hr details summary menu
dialog center hgroup search""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math object canvas select title xmp noembed noframes".split())
DROPPED = frozenset("nav footer aside form menu dialog button fieldset search".split())
KEEP = frozenset("html body article main".split())
# a start tag of the first kind ends an open element of the second
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
INSERTS = COMMENTS | frozenset("""ad ads adv adbox adslot banner banners sponsor sponsored promo advert adverts advertisement advertising
cookie cookies consent gdpr notice notices notification alert popup popover modal overlay newsletter subscribe subscription signup
login""".split())
NAMES = INSERTS | frozenset("""sidebar sidebars rail menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar
discussion share sharing social related recommended recommendations recirculation widget widgets pagination pager search
contentinfo complementary hidden skip""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDES = frozenset("nav aside footer".split())
# reasons against an element: the id of a section in an article, a layout word within a name, its tag, a layout word as its
# name, a name of comments, adverts or notices, hidden
ANCHOR, FRAME, TAG, NAME, INSERT, HIDDEN = 1, 2, 3, 4, 5, 6
PREFIX = frozenset("has with no without is".split())

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^<>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)>|<(/?)([a-zA-Z][^\s/><]*)([^<>]*)(?:>|\Z|(?=<))""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _unwanted(tag: str, attrs: str, in_article: bool, nested: bool) -> int:
    """What says that this element is not main text (0: nothing)?"""
    why = NAME if tag in ASIDES else TAG if tag in DROPPED or (tag == "header" and not in_article) else 0
    if not attrs:
        return why
    for name, *vals in _ATTR.findall(attrs):
        name, val = name.lower(), next((v for v in vals if v), "")
        if name == "hidden" or (name == "aria-hidden" and val.lower() == "true"):
            why = HIDDEN if tag not in KEEP or nested else why
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", val, re.I) and (tag not in KEEP or nested):
                why = HIDDEN
        elif name in ("class", "id", "role") and not (name == "id" and tag in HEADINGS):
            for one in val.split():
                one_why = _named(one, in_article)
                if tag in KEEP and not nested:  # the page's own article: only if it is a comment or advert itself
                    one_why = INSERT if tag == "article" and one.lower() in INSERTS else 0
                elif name == "id" and tag == "section" and in_article and one_why != INSERT:
                    one_why = min(one_why, ANCHOR)
                why = max(why, one_why)
    return why


def _named(one: str, in_article: bool) -> int:
    """What one name of an element says."""
    words = {w.lower() for w in _WORD.findall(one)}
    if words & PREFIX:
        return 0
    if words & INSERTS:
        return INSERT
    if words & NAMES or ("header" in words and not in_article):
        return NAME if len(words) == 1 else FRAME
    return 0


class _Page:
    """Blocks of text and the tree of block elements of one page."""

    def __init__(self):
        self.parent, self.tag, self.out, self.art = [-1], [""], [False], [False]
        self.why, self.nested = [0], [False]  # nested: in an article
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.stack: list[tuple[str, int]] = []        # open elements and their nodes
        self.open: dict[str, int] = {}
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0

    def node(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self, node: int | None = None):
        if self.parts:
            node = self.node() if node is None else node
            text = " ".join("".join(self.parts).split())
            if text and not self.out[node]:
                self.blocks.append((node, text, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def text(self, s: str):
        if s:
            if "&" in s:
                s = html.unescape(s)
            self.parts.append(s)
            if self.links:
                self.linked += len(" ".join(s.split()))

    def pop(self):
        tag, _ = self.stack[-1]
        below = self.stack[-2][1] if len(self.stack) > 1 else 0
        if tag in BLOCKS or below != self.node():
            self.flush()
        self.stack.pop()
        self.open[tag] -= 1
        if tag == "a":
            self.links -= 1

    def close(self, tag: str):
        if self.open.get(tag):
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()

    def start(self, tag: str, attrs: str):
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID and tag != "hr":
            return
        block = tag in BLOCKS
        if block:
            if self.open.get("p"):
                self.close("p")
            if tag in ENDS and any(self.open.get(t) for t in ENDS[tag]):
                for k in range(len(self.stack) - 1, -1, -1):
                    if self.stack[k][0] in SCOPE[tag]:
                        break
                    if self.stack[k][0] in ENDS[tag]:
                        while len(self.stack) > k:
                            self.pop()
                        break
            self.flush()
        if tag == "hr":
            return
        up = self.node()
        why = HIDDEN if self.out[up] else _unwanted(tag, attrs, self.art[up], self.nested[up])
        node = up
        if block or (why and not self.out[up]):  # an inline element left out gets a node of its own
            node = len(self.parent)
            self.parent.append(up)
            self.tag.append(tag)
            self.out.append(why == HIDDEN)
            self.why.append(why)
            self.art.append(self.art[up] or tag in ("article", "main"))
            self.nested.append(self.nested[up] or tag == "article")
            if not block:
                self.flush(up)  # what the block holds so far stays
        self.stack.append((tag, node))
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag == "a":
            self.links += 1


def _parse(doc: str) -> _Page:
    page, at, n = _Page(), 0, len(doc)
    while at < n:
        m = _TAG.search(doc, at)
        if m is None:
            page.text(doc[at:])
            break
        page.text(doc[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        attrs = m[3] or m[6] or ""
        if m[1] or m[4]:
            page.close(tag)
        elif tag in RAW:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(doc, at)
                at = end.end() if end else n
        else:
            page.start(tag, attrs)
    while page.stack:
        page.pop()
    page.flush()
    return page


def _leave_out(page: _Page) -> list[float]:
    """Marks what is left out in ``page.out``, drops its blocks, and gives each
    node the share of its score that counts."""
    n = len(page.parent)
    own, heading = [0] * n, [False] * n
    for node, text, in_links in page.blocks:
        own[node] += len(text) - in_links
    for k in range(n - 1, 0, -1):  # children come after their parents
        own[page.parent[k]] += own[k]
        heading[page.parent[k]] |= heading[k] or page.tag[k] in HEADINGS
    why = [0 if page.why[k] == ANCHOR and heading[k] else page.why[k] for k in range(n)]
    under = [False] * n  # in a menu, sidebar, footer, advert or comments
    held, largest, mains = [0] * n, [0] * n, 0
    for k in range(1, n):
        under[k] = under[page.parent[k]] or why[k] in (NAME, INSERT, HIDDEN)
        if page.tag[k] in ("article", "main") and not page.art[page.parent[k]] and not under[k]:
            held[k] = largest[k] = own[k]
            mains += own[k]
    for k in range(n - 1, 0, -1):
        held[page.parent[k]] += held[k]
        largest[page.parent[k]] = max(largest[page.parent[k]], largest[k])

    def protected(k: int) -> bool:
        if mains:
            return not page.art[page.parent[k]] and (held[k] == mains or (why[k] == FRAME and largest[k] == largest[0]))
        return why[k] == FRAME and own[k] * 2 > own[0]

    # reasons that count; fewer if nothing would be left
    for counted in ((ANCHOR, FRAME, TAG, NAME, INSERT), (TAG, INSERT), (INSERT,), ()):
        share, out = [1.0] * n, [False] * n
        for k in range(1, n):
            up = page.parent[k]
            share[k], out[k] = share[up], out[up] or page.out[k]
            if why[k] and not out[k]:
                if why[k] in counted and not protected(k):
                    out[k] = True
                else:
                    share[k] /= 2
        if any(not out[b[0]] for b in page.blocks):
            break
    page.out = out
    page.blocks = [b for b in page.blocks if not out[b[0]]]
    return share


def main_text(doc: str) -> str:
    """The main text of one page."""
    if not doc:
        return ""
    page = _parse(doc)
    share_of = _leave_out(page)
    if not page.blocks:
        return ""
    n = len(page.parent)
    score, chars, linked, inner = [0.0] * n, [0] * n, [0] * n, [False] * n
    for node, _, _ in page.blocks:
        up = page.parent[node]
        while up > 0 and not inner[up]:
            inner[up] = True
            up = page.parent[up]
    for node, text, in_links in page.blocks:
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
        # a paragraph scores its ancestors; text lying directly in a container scores that
        holds = page.tag[node] in ("article", "main", "body", "td", "") or (page.tag[node] in ("div", "section") and inner[node])
        up = node if holds else page.parent[node]
        for share in (1, 2, 3, 4):
            if up < 0:
                break
            score[up] += points / share
            up = page.parent[up]
        chars[node] += len(text)
        linked[node] += in_links
    for k in range(n - 1, 0, -1):  # children come after their parents
        chars[page.parent[k]] += chars[k]
        linked[page.parent[k]] += linked[k]
    score = [x * y for x, y in zip(score, share_of)]
    plain = lambda k: 1 - linked[k] / chars[k] if chars[k] else 0.0
    best = max(range(n), key=lambda k: (score[k] * plain(k), -k))
    k, chosen, around = best, {best}, {}
    while k > 0:  # the outermost article it lies in, or else the main part
        if page.tag[k] in ("article", "main"):
            around[page.tag[k]] = k
        k = page.parent[k]
    if around:
        best = around.get("article", around.get("main"))
        chosen = {best}
    if page.tag[best] not in ("article", "main"):
        least = score[best] * plain(best) / 5
        for k in range(1, n):
            if k != best and page.parent[k] == page.parent[best] and chars[k] and not page.out[k]:
                if (score[k] * plain(k) >= least and score[k] > 0) or (chars[k] > 80 and plain(k) > 0.75) or page.tag[k] == "h1":
                    chosen.add(k)
    inside = [False] * n
    for k in range(n):
        inside[k] = k in chosen or (page.parent[k] >= 0 and inside[page.parent[k]])
    return "\n".join(text for node, text, _ in page.blocks if inside[node])


class _Extract:
    def __call__(self, text: pa.Array) -> list:
        out = [main_text(x) for x in text.to_pylist()]
        return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` of the main text."""
    prepare(pages.sparkSession)
    return map_text(pages, html_col, [("text", T.StringType()), ("n_chars", T.LongType())], _Extract, keep=keep)


def q_op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), keep=["page_id", "url"])
