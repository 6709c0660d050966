"""HTML extraction (operator 12): main text by the distribution of line blocks.

A page is cut into lines at its block elements.  Stripping the markup takes the
elements that hold no article text with it: scripts, styles and other raw text,
navigation, footers, asides, forms and hidden elements by their tags, and
sidebars, notices, adverts, page headers and reader comments also by the words
of their class, id and role.  What is left of a line's text, without the text of
its links, is the line's length.  The lengths are summed over sliding windows of
``WINDOW`` lines.  Where the sum rises over the page's threshold is a surge
point, where it falls to nothing the dive point after it; the text between them
is kept.  The threshold follows the page (a share of its highest sum, ``FLOOR``
at most), so a page of one short sentence has a surge too.

Where a page has ``article`` or ``main`` elements, lines outside of them have
length 0 and every sum above 0 is a surge, so the article's short lines stay.
Elsewhere a main heading (``h1``) in a surge's first window is its first line.

Edge cases: null, empty and blank pages, and pages without text, give an empty
text; open elements end with what encloses them, a truncated page at its end; a
boilerplate element that holds the article (a page-wide form, an advert that
never ends) is none; character references are decoded once; all white space
(also no-break spaces) counts as such; ``br`` is white space inside a block;
texts are taken whole; ties need no rule, lines keep the page's order; repeated
rows give equal rows; an empty table gives an empty one; other columns are kept,
one of a result's name is replaced.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reelhouse.llm.util import add_columns

WINDOW = 3  # lines whose lengths are summed
FLOOR = 86  # characters in a window that are a surge on any page
SHARE = 0.25  # of the page's highest window sum, where that is less

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select
    summary table tbody td tfoot th thead tr ul""".split())
AWAY = frozenset("head header nav footer aside form button select dialog menu svg object audio video canvas map label datalist".split())
#: Words of a class, id or role whose element holds no article text.
BOILERPLATE = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars
    aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments
    commentlist respond reply replies discussion disqus share sharing social related recommended recommendations widget widgets
    search pagination pager copyright disclaimer complementary contentinfo hidden""".split())
REMARKS = frozenset("comment comments commentlist respond reply replies discussion disqus".split())
#: Start tags that end an open element of these names (their end tags may be left out).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "optgroup": ("option", "optgroup")}
NOT_IN_P = BLOCK - {"option", "optgroup", "legend", "summary", "body", "html", "head"}
WHOLE = frozenset(("html", "body", "main"))
CORE = frozenset(("article", "main", "h1"))
SCOPE = frozenset(("table", "ul", "ol", "dl", "div", "article", "section", "select", "aside", "nav", "main", "form"))

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|(?=<)|\Z)""", re.S | re.X)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I | re.S) for name in RAW}
ATTR = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An element of a page: where it starts and ends among the tokens, and what its tag says."""

    __slots__ = ("name", "first", "last", "away", "remark", "core")

    def __init__(self, name: str, first: int, away: bool, remark: bool):
        self.name, self.first, self.last, self.away, self.remark, self.core = name, first, None, away, remark, False


def judged(name: str, attrs: str) -> tuple[bool, bool]:
    """Whether a start tag names boilerplate, and whether that is reader comments."""
    if name in AWAY:
        return True, False
    if name in WHOLE or "=" not in attrs and "hidden" not in attrs:
        return False, False
    words, hidden = set(), False
    for m in ATTR.finditer(attrs):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key in ("class", "id", "role"):
            words.update(w.lower() for w in WORDS.findall(value))
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and INVISIBLE.search(value):
            hidden = True
    remark = not words.isdisjoint(REMARKS)
    if name == "article":
        return remark, remark
    return hidden or not words.isdisjoint(BOILERPLATE), remark


def parse(html: str) -> tuple[list[tuple[str, str]], list[Element]]:
    """Tokens ("text", "block" or "link" and "/link") and the elements over them."""
    tokens: list[tuple[str, str]] = []
    elements: list[Element] = []
    stack: list[Element] = []

    def end(depth: int) -> None:
        while len(stack) > depth:
            stack.pop().last = len(tokens)

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            tokens.append(("text", html[at:]))
            break
        if m.start() > at:
            tokens.append(("text", html[at:m.start()]))
        at = max(m.end(), m.start() + 1)
        name = m.group("name")
        if name is None:
            if m.group().startswith("<![CDATA["):
                tokens.append(("text", m.group()[9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if m.group("close"):
            if name in BLOCK or name == "br":
                tokens.append(("block" if name in BLOCK else "text", " "))
            for d in range(len(stack) - 1, -1, -1):
                if stack[d].name == name:
                    end(d)
                    break
                if name not in BLOCK and stack[d].name in BLOCK:
                    break  # an inline end tag ends nothing outside its block
            if name == "a":
                tokens.append(("/link", ""))
            continue
        if name in RAW:
            stop = RAW_END[name].search(html, at)
            at = stop.end() if stop else n
            continue
        if name in NOT_IN_P:
            for d in range(len(stack) - 1, -1, -1):
                if stack[d].name == "p":
                    end(d)
                    break
                if stack[d].name in SCOPE:
                    break
        for d in range(len(stack) - 1, -1, -1) if name in ENDS else ():
            if stack[d].name in ENDS[name]:
                end(d)
                break
            if stack[d].name in SCOPE:
                break
        if name in BLOCK:
            tokens.append(("block", ""))
        elif name == "br":
            tokens.append(("text", " "))
        elif name == "a":
            tokens.append(("link", ""))
        if name not in VOID:
            e = Element(name, len(tokens), *judged(name, m.group("attrs")))
            if name in CORE:
                for outer in stack:
                    outer.core |= name != "article" or not e.remark
            elements.append(e)
            stack.append(e)
    end(0)
    return tokens, elements


class Lines:
    """Lines of a page in order: text, length (0 for links and outside of the article), and which are main headings."""

    def __init__(self):
        self.texts, self.lengths, self.mine, self.heading = [], [], [], []

    def add(self, parts: list[str], linked: int, mine: bool, heading: bool) -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            self.texts.append(text)
            self.lengths.append(max(0, len(text) - linked) if mine else 0)
            self.mine.append(mine)
            self.heading.append(heading)


def depth_over(tokens: list, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the spans."""
    depth = np.zeros(len(tokens) + 1, np.int64)
    for a, b in spans:
        depth[a] += 1
        depth[b] -= 1
    return np.cumsum(depth) > 0


def lines_of(html: str) -> tuple[Lines, bool]:
    """Lines of a page without boilerplate, and whether an article or main element holds text."""
    tokens, elements = parse(html)
    # remarks and the head go in any case, other boilerplate unless the article is inside
    gone = [e for e in elements if e.away and (e.remark or e.name == "head" or not e.core)]
    away = depth_over(tokens, [(e.first, e.last) for e in gone])
    core = depth_over(tokens, [(e.first, e.last) for e in elements if e.name in ("article", "main") and not e.away])
    titles = depth_over(tokens, [(e.first, e.last) for e in elements if e.name == "h1"])
    framed = any(kind == "text" and core[i] and not away[i] and x.strip() for i, (kind, x) in enumerate(tokens))
    out, parts, linked, link, at = Lines(), [], 0, False, 0
    for i, (kind, x) in enumerate(tokens):
        if kind == "text":
            if away[i]:
                continue
            if parts and core[i] != core[at]:
                out.add(parts, linked, bool(core[at]) or not framed, bool(titles[at]))
                parts, linked = [], 0
            parts.append(x)
            at = i
            if link:
                linked += len(" ".join(unescape(x).split()))
        elif kind == "block":
            if parts:
                out.add(parts, linked, bool(core[at]) or not framed, bool(titles[at]))
            parts, linked, link = [], 0, False
        else:
            link = kind == "link"
    if parts:
        out.add(parts, linked, bool(core[at]) or not framed, bool(titles[at]))
    return out, framed


def kept_lines(lengths: list[int], heading: list[bool], framed: bool) -> np.ndarray:
    """Lines between surge and dive points of the sums over WINDOW lines."""
    n = len(lengths)
    size = np.array(lengths, np.int64)
    total = np.concatenate(([0], np.cumsum(np.append(size, np.zeros(WINDOW, np.int64)))))
    sums = total[WINDOW:WINDOW + n] - total[:n]  # of line i and the WINDOW - 1 after it
    least = 1 if framed else max(1, min(FLOOR, SHARE * sums.max(initial=0)))
    keep, at = np.zeros(n, bool), 0
    while at < n:
        if sums[at] < least or not size[at]:
            at += 1
            continue
        dive = at
        while dive < n and sums[dive]:
            dive += 1
        first = next((i for i in range(at, min(at + WINDOW, dive)) if heading[i] and not framed), at)
        keep[first:dive] = True
        at = dive
    return keep


def main_text(html: str | None) -> str:
    """Main text of a page, a line for each block."""
    if not html:
        return ""
    lines, framed = lines_of(html)
    keep = kept_lines(lines.lengths, lines.heading, framed)
    return "\n".join(x for x, k, mine in zip(lines.texts, keep, lines.mine) if k and mine)


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` with the main text of each page and its number of characters in place of the markup."""

    def run(b: pa.RecordBatch) -> list:
        found = [main_text(x) for x in b.column(b.schema.get_field_index(html)).to_pylist()]
        return [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())]

    return add_columns(pages, run, [T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())], drop=(html, text, n_chars))
