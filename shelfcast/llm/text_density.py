"""Main text of web pages by composite text density.

Every element gets its characters per tag, adjusted for links: with C characters (LC of them in
links) and T tags (LT of them links) below it, and the page body's share of link characters,

    density = C / T * log_b(C / LC * T / LT),   b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

where zero denominators count as 1, and C / T on pages without links. The element with the largest sum
of its children's densities leads; the smallest density on its path to the body is the threshold. From the body down, each element at or
above the threshold gives the subtree of its own largest sum, or the block around it if that is part of a line.

Menus, headers, footers, sidebars, notices, adverts, forms, comments and invisible parts are left out
first, by element, role and whole class or id names, so they add nothing to any density. Except for invisible parts
and controls, such an element stays, for the density to decide, if its articles hold at least as much text (not in links)
as those outside of all such elements and half as much as those of any of them, or, where there are none outside, if it holds most of the page's text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.llm.common import append_columns, kept_fields, slices

# Element kinds of HTML and the usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
LEFT_OUT = frozenset("nav footer aside form dialog menu search".split())
ALWAYS_OUT = frozenset("head button select canvas audio video annotation annotation-xml".split())
PAGE_HEAD = frozenset(["header"])
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment "
    "comments disqus replies share sharing social related recommended newsletter subscribe subscription pagination pager "
    "toolbar login signup".split())
#: Of these names, those that are no content in an article either.
IN_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr popup nav navbar breadcrumb "
    "breadcrumbs comments disqus share sharing newsletter subscribe pagination pager toolbar login signup".split())
HEAD_NAMES = frozenset(["header", "masthead", "topbar"])
NEVER = frozenset(["html", "body", "main", "article"])
#: Elements that a start tag closes when they are open inside the given scope.
_P_ENDS = BLOCK - {"option", "optgroup", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select"]),
         **dict.fromkeys(("tr", "td", "th", "tbody", "tfoot"), frozenset(["table"]))}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _left_out(tag: str, attrs: str, inside: bool) -> int:
    """1: the element is page furniture, 2: it is invisible or a control; ``inside``: it stands in an article or main element."""
    if tag in NEVER:
        return 0
    if tag in ALWAYS_OUT:
        return 2
    out = int(tag in LEFT_OUT or (tag in PAGE_HEAD and not inside))
    for m in _ATTR.finditer(attrs):
        name = m[1].lower()
        value = html.unescape(m[2] or m[3] or m[4] or "")
        if name in ("class", "id"):
            names = set(value.lower().split())
            if names & (IN_ARTICLE if inside else FURNITURE) or (not inside and names & HEAD_NAMES):
                out = 1
        elif name == "role" and value.lower() in ROLES:
            out = 1
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return 2
    return out


class _Page:
    """Elements in page order (so a subtree is a range), blocks of text, and the sums that densities need."""

    def __init__(self, source: str, stay: frozenset | None = None):
        """``stay``: numbers of the start tags whose furniture stays; None: all of it."""
        self.stay, self.turn = stay, 0
        self.furniture: list[tuple[int, int]] = []  # (element, number of its start tag) of what stays
        self.tag, self.parent, self.last = ["#page"], [-1], [0]
        self.chars, self.link_chars = [0], [0]
        self.blocks: list[tuple[int, str]] = []  # (innermost element, text)
        self.stack = [(0, "#page")]
        self.live = [0]      # the elements of the stack that are not skipped
        self.open: dict[str, list[int]] = {}  # places in the stack by tag
        self.out_at = 0      # depth of the furniture that is being skipped, 0: none
        self.links = 0       # open links
        self.inside = 0      # open article and main elements
        self.pieces: list[str] = []
        self.owner = 0
        self._read(source)
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        self.last[0] = len(self.tag) - 1

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((self.owner, text))
            self.pieces = []
        self.owner = self.live[-1]

    def _text(self, raw: str) -> None:
        if self.out_at or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not self.pieces:
            self.owner = self.stack[-1][0]
        self.pieces.append(text)
        n = len(" ".join(text.split()))
        self.chars[self.stack[-1][0]] += n
        if self.links:
            self.link_chars[self.stack[-1][0]] += n

    def _push(self, tag: str, attrs: str) -> None:
        self.turn += 1
        out = 0 if self.out_at else _left_out(tag, attrs, self.inside > 0)
        stays = out == 1 and (self.stay is None or self.turn in self.stay)
        skip = bool(self.out_at) or (out and not stays)
        if tag in BLOCK:
            self._flush()
        if skip:
            self.stack.append((None, tag))
            if not self.out_at:
                self._flush()
                self.out_at = len(self.stack) - 1
        else:
            self.tag.append(tag)
            self.parent.append(self.stack[-1][0])
            self.last.append(0)
            self.chars.append(0)
            self.link_chars.append(0)
            self.stack.append((len(self.tag) - 1, tag))
            self.live.append(len(self.tag) - 1)
            if stays:
                self.furniture.append((len(self.tag) - 1, self.turn))
        self.open.setdefault(tag, []).append(len(self.stack) - 1)
        self.links += tag == "a"
        self.inside += tag in ("article", "main")

    def _pop(self) -> None:
        node, tag = self.stack.pop()
        if node is not None:
            self.live.pop()
            self.last[node] = len(self.tag) - 1
        if tag in BLOCK:
            self._flush()
        if self.out_at and len(self.stack) <= self.out_at:
            self.out_at = 0
        self.open[tag].pop()
        self.links -= tag == "a"
        self.inside -= tag in ("article", "main")

    def _close_implied(self, tag: str) -> None:
        if tag in _P_ENDS and self.open.get("p"):
            self._pop_to(("p",), frozenset(["table", "button", "td", "th", "li", "article", "section", "div"]) - {tag})
        if tag == "a" and self.open.get("a"):
            self._pop_to(("a",), BLOCK)
        if tag in CLOSES:
            while any(self.open.get(t) for t in CLOSES[tag]) and self._pop_to(CLOSES[tag], SCOPE[tag]):
                pass

    def _pop_to(self, tags: tuple, scope: frozenset) -> bool:
        """Close the innermost of ``tags`` and all in it, unless an element of the scope stands between."""
        last = max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)
        if not last or any(self.open[t][-1] > last for t in scope if self.open.get(t)):
            return False
        while len(self.stack) > last:
            self._pop()
        return True

    def _read(self, source: str) -> None:
        at = 0
        while m := _TOKEN.search(source, at):
            self._text(source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if tag == "br":
                    self.pieces.append(" ")
                elif self.open.get(tag):
                    while self.stack[-1][1] != tag:
                        self._pop()
                    self._pop()
                continue
            if not source.startswith(">", m.end() - 1):  # a tag cut off by the end of the page
                break
            attrs = m[3] or m[6] or ""
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            self._close_implied(tag)
            if tag in VOID:
                if tag == "hr":
                    self._flush()
                elif tag == "br" and self.pieces:
                    self.pieces.append(" ")
                continue
            self._push(tag, attrs)
        self._text(source[at:] if not m else "")


def _wrappers(p: _Page) -> frozenset:
    """Start tags of the furniture that holds the page's articles or most of its text; ``p``: with all furniture."""
    n = len(p.tag)
    text = [c - lc for c, lc in zip(p.chars, p.link_chars)]
    for i in range(n - 1, 0, -1):
        text[p.parent[i]] += text[i]
    named = {i for i, _ in p.furniture}
    articles, under = [0] * n, [False] * n  # text of the outermost articles in a subtree; under furniture
    outside = 0
    for i in range(n - 1, 0, -1):
        articles[i] = text[i] if p.tag[i] in ("article", "main") else articles[i]
        articles[p.parent[i]] += articles[i]
    topmost = [False] * n  # in an article
    for i in range(1, n):
        up = p.parent[i]
        under[i] = under[up] or i in named
        topmost[i] = topmost[up] or p.tag[i] in ("article", "main")
        if topmost[i] and not topmost[up] and not under[i]:
            outside += text[i]
    least = max(outside, max((articles[i] for i in named), default=0) / 2, 1)
    return frozenset(turn for i, turn in p.furniture
                     if articles[i] >= least or (not outside and 2 * text[i] > text[0]))


def _densities(p: _Page) -> tuple[list[float], list[float]]:
    """Density of each element and the sum over its children."""
    n = len(p.tag)
    chars, link_chars = p.chars[:], p.link_chars[:]
    tags, links = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        up = p.parent[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        links[up] += links[i] + (p.tag[i] == "a")
    share = link_chars[0] / (chars[0] or 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        c, lc, t = chars[i], link_chars[i], tags[i] or 1
        if not c:
            continue
        density[i] = c / t
        if share:
            base = math.log(c / ((c - lc) or 1) * lc + share * c + math.e)
            density[i] *= math.log(max(c / (lc or 1) * t / (links[i] or 1), 1.0)) / math.log(base)
    for i in range(1, n):
        sums[p.parent[i]] += density[i]
    return density, sums


def _block(p: _Page, i: int) -> int:
    """The block that an element stands in (a block is text as a whole)."""
    while i and p.tag[i] not in BLOCK:
        i = p.parent[i]
    return i


def _chosen(p: _Page) -> list[int]:
    """Roots of the text's subtrees, in page order, none inside another."""
    density, sums = _densities(p)
    n = len(p.tag)
    best_in = list(range(n))  # element of the largest sum in each subtree, the outermost of equals
    for i in range(n - 1, 0, -1):
        up = p.parent[i]
        if sums[best_in[i]] > sums[best_in[up]] or (sums[best_in[i]] == sums[best_in[up]] and best_in[up] != up):
            best_in[up] = best_in[i]
    best = best_in[0]
    path = [best]
    while path[-1]:
        path.append(p.parent[path[-1]])
    threshold = min(density[i] for i in path)
    out, taken = [], -1
    marked = sorted({_block(p, best_in[i]) for i in range(n) if density[i] and density[i] >= threshold})
    for i in marked:
        if i > taken:
            out.append(i)
            taken = p.last[i]
    return out


def main_text(source: str | None) -> str:
    """The blocks of the main text, one per line."""
    if not source:
        return ""
    p = _Page(source)
    if p.furniture:
        p = _Page(source, _wrappers(p))
    roots = _chosen(p)
    out, k = [], 0
    for owner, text in p.blocks:
        while k < len(roots) and owner > p.last[roots[k]]:
            k += 1
        if k < len(roots) and roots[k] <= owner:
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text (the main text, empty if none) and n_chars (its code points); no shuffle.

    Null and empty pages have no text; a page without tags is all text. Character references are decoded,
    white space in a block becomes one space, blocks are joined by one line feed. Unclosed and misnested elements
    are closed as browsers do in the usual cases. Pages are independent: repeated rows get equal texts, an
    empty table gives an empty result, input columns named like a result are replaced. Work grows with a page's
    length, without recursion, so very long and deeply nested pages are fine.
    """
    more = [("text", T.StringType()), ("n_chars", T.LongType())]
    schema = T.StructType([pages.schema[c] for c in kept_fields(pages, [n for n, _ in more])]
                          + [T.StructField(n, t) for n, t in more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col):
            texts = [main_text(x) for x in batch.column(html_col).to_pylist()]
            yield append_columns(batch, text=pa.array(texts, pa.string()), n_chars=pa.array([len(x) for x in texts], pa.int64()))
    return pages.mapInArrow(run, schema)
