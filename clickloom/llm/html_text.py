"""Main text of web pages by minimum cut over their text blocks.

A page is read into blocks: runs of text between block-level tags, without scripts, styles and other
elements that show no text. A fixed logistic classifier scores each block from its length, link share and what it lies in.
The costs of calling it content or boilerplate become the capacities to the two terminals of a flow
network; neighbours in page order and neighbours under one parent are tied by smoothness edges, the stronger
the closer they are in the tree. The maximum flow's cut labels the blocks; those on
the source's side are the text.

Pages are independent of each other: no shuffle, each page in memory alone. Edge cases: null, empty and
text-free pages give an empty text; unclosed and stray tags are repaired as browsers do, roughly; an unclosed
comment, script, style, title or textarea runs to the end; other elements that show no text end with what holds them,
never closed at the next block; head has no text of its own and needs no end; repeated rows give repeated results; an empty table has no rows; further columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickloom.llm.frames import fresh

# fixed values: HTML's element groups, and the words that name page parts in classes and ids
#: Their content is no markup; unclosed, it runs to the end.
RAW = "script style title textarea"
#: Elements whose content is markup, but shows no text.
SILENT = frozenset("noscript template svg iframe select datalist button annotation annotation-xml".split())
NESTING = frozenset("template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr "
                   "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom msub msup "
                   "msubsup munder mover munderover mmultiscripts mprescripts mtable".split())
#: Inline, but apart from the text around it.
SPACED = frozenset("br mtr mtd".split())
#: What ends a silent element that is never closed.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th "
                   "thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
#: What an implied end tag does not reach beyond.
SCOPES = frozenset("ul ol dl table body article section main aside nav div form".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert menu menus nav navbar navigation navi breadcrumb breadcrumbs sidebar side aside widget widgets related recommended "
    "recommendations share sharing social comment comments disqus reply replies respond footer foot header masthead topbar toolbar "
    "subscribe subscription newsletter signup login register search popup modal overlay copyright legal pagination pager tags "
    "contentinfo complementary".split())
CONTENT_WORDS = frozenset("article post entry story content main maintext articlebody postbody entrycontent".split())

# the classifier's weights
IN_BOILERPLATE, IN_CONTENT, OUTER = -6.0, 4.0, 1.0
BASE, PER_WORD, MOST_WORDS, SENTENCE, LINK_SHARE = -1.0, 0.08, 30, 0.5, -4.0
#: Strength of the smoothness edges between neighbours in page order, and under one parent.
ADJACENT, SIBLING = 1.5, 0.75

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW.split())})(?=[\s/>])(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*>", re.S | re.I)
#: Attributes that end in a slash which belongs to no value.
_EMPTY = re.compile(r"""(?:^|[\s"'])[^\s"'=]*/\Z""")
_SILENT = re.compile(rf"<(?:{'|'.join(SILENT)})(?=[\s/>])", re.I)
_MARK = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Za-z]+")


def _kind(tag: str, attributes: str, inside: int) -> int:
    """1 if the element marks content, -1 boilerplate, 0 neither; ``inside``: the nearest mark around it."""
    if tag in CONTENT_TAGS:
        return 1
    if tag in BOILERPLATE_TAGS and not (tag == "header" and inside > 0):
        return -1
    if attributes and not attributes.isspace():
        good = False
        for m in _MARK.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    return -1
            elif name in ("hidden", "aria-hidden"):
                if value != "false":
                    return -1
            else:
                words = _WORDS.findall(value)
                if tag not in INLINE and any(w in BOILERPLATE_WORDS for w in words):
                    return -1
                good = good or any(w in CONTENT_WORDS for w in words)
        if good and tag not in ("body", "html") and tag not in INLINE:
            return 1
    return 0


def _closed(source: str) -> set[int]:
    """Where the silent elements start that have an end tag of their own."""
    out: set[int] = set()
    waiting: dict[str, list[int]] = {}
    if _SILENT.search(source):
        for m in _TOKEN.finditer(source):
            if m[3] is None or (tag := m[3].lower()) not in SILENT:
                continue
            starts = waiting.setdefault(tag, [])
            if m[2]:
                if starts:
                    out.add(starts.pop())
            elif not _EMPTY.search(m[4]):
                if tag not in NESTING:
                    starts.clear()
                starts.append(m.start())
    return out


class Page:
    """The text blocks of a page: texts, scores, and the elements they lie in."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.scores: list[float] = []
        self.owner: list[int] = []
        self.parent, self.depth = [-1], [0]
        stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]  # tag, element, nearest mark, the one around that
        pieces: list[str] = []
        linked = links = 0
        at = 0
        closed = _closed(source)
        silent, ends = 0, True  # the place on the stack of the outermost silent element, and whether it is closed
        for m in _TOKEN.finditer(source):
            if m.start() > at and not silent:
                piece = source[at:m.start()]
                pieces.append(piece)
                if links:
                    linked += len(piece)
            at = m.end()
            tag = m[3]
            if tag is None:
                if m[1] is not None and m[1].lower() == "textarea" and not silent:
                    pieces.append(" ")
                continue
            tag = tag.lower()
            if tag in ("script", "style", "title", "textarea", "head"):
                continue  # ends without a start and empty elements; what may stand in head shows no text
            if silent and not m[2]:
                outer, inner = stack[silent][0], (t[0] for t in stack[silent + 1:])
                if tag == outer and not ends or tag in BLOCKS and (
                        not ends or outer == "svg" and not any(t in ("foreignobject", "desc") for t in inner)):
                    del stack[silent:]
                    silent = 0
            elif silent:
                place = 0 if tag in INLINE else next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if place:
                    del stack[max(place, silent):]
                if place and place <= silent:
                    outer, silent = silent, 0
                    if place == outer:
                        continue
            if silent:
                if not m[2] and tag not in INLINE and tag not in SPACED and tag not in VOID and not _EMPTY.search(m[4]):
                    stack.append((tag, *stack[-1][1:]))
                continue
            if tag in SILENT:
                if not m[2]:
                    if tag in ("select", "button"):
                        pieces.append(" ")
                    if not _EMPTY.search(m[4]):
                        silent, ends = len(stack), m.start() in closed
                        stack.append((tag, *stack[-1][1:]))
                continue
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links - 1) if m[2] else links + 1
                    continue
                if not m[4] or m[2]:
                    continue
                if not _kind(tag, m[4], 0):
                    continue
            elif tag in SPACED:
                pieces.append(" ")
                continue
            elif pieces:
                self._flush(pieces, linked, stack[-1])
                pieces, linked = [], 0
            if m[2]:
                self._close(stack, tag)
                links = 0
                continue
            if tag in VOID or tag in INLINE:
                continue
            links = 0
            if tag in CLOSES:
                self._imply(stack, CLOSES[tag])
            elif stack[-1][0] == "p" or any(s[0] == "p" for s in stack[-4:]):
                self._imply(stack, ("p",))
            _, element, near, far = stack[-1]
            kind = _kind(tag, m[4], near)
            self.parent.append(element)
            self.depth.append(self.depth[element] + 1)
            stack.append((tag, len(self.parent) - 1, kind or near, near if kind else far))
        if at < len(source) and not silent:
            pieces.append(source[at:])
        if pieces:
            self._flush(pieces, linked, stack[silent - 1])

    def _flush(self, pieces: list[str], linked: int, top: tuple) -> None:
        raw = "".join(pieces)
        text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        if not text:
            return
        words = text.count(" ") + 1
        score = BASE + PER_WORD * min(words, MOST_WORDS) + LINK_SHARE * min(1.0, linked / len(raw))
        if text[-1] in ".!?…:;\"'»”":
            score += SENTENCE
        _, element, near, far = top
        score += IN_CONTENT if near > 0 else IN_BOILERPLATE if near < 0 else 0.0
        score += OUTER * far
        self.texts.append(text)
        self.scores.append(score)
        self.owner.append(element)

    @staticmethod
    def _close(stack: list[tuple], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return

    @staticmethod
    def _imply(stack: list[tuple], tags: tuple) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in SCOPES:
                return

    def distance(self, a: int, b: int) -> int:
        """Steps in the tree between the elements of two blocks."""
        x, y, steps = self.owner[a], self.owner[b], 0
        while x != y:
            if self.depth[x] < self.depth[y]:
                x, y = y, x
            x, steps = self.parent[x], steps + 1
        return steps

    def edges(self) -> list[tuple[int, int, float]]:
        out, last = [], {}
        for i in range(len(self.texts)):
            if i:
                out.append((i - 1, i, ADJACENT / (1 + self.distance(i - 1, i))))
            around = self.parent[self.owner[i]]
            before = last.get(around)
            if before is not None and before != i - 1:
                out.append((before, i, SIBLING / (1 + self.distance(before, i))))
            last[around] = i
        return out


def source_side(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut: which nodes stay with the source.

    ``gain``: capacity from the source less capacity to the sink, as the smaller of the two passes straight
    through. Shortest augmenting paths run from all nodes with source capacity left to one with sink capacity.
    """
    n = len(gain)
    supply, demand = [max(g, 0.0) for g in gain], [max(-g, 0.0) for g in gain]
    to: list[list[list]] = [[] for _ in range(n)]
    for a, b, w in edges:
        forth, back = [b, w, None], [a, w, None]
        forth[2], back[2] = back, forth
        to[a].append(forth)
        to[b].append(back)
    least = 1e-9
    while True:
        came: list = [None] * n
        queue = deque()
        for i in range(n):
            if supply[i] > least:
                came[i] = ()
                queue.append(i)
        end = -1
        while queue and end < 0:
            v = queue.popleft()
            for arc in to[v]:
                u = arc[0]
                if came[u] is None and arc[1] > least:
                    came[u] = (v, arc)
                    if demand[u] > least:
                        end = u
                        break
                    queue.append(u)
        if end < 0:
            return [c is not None for c in came]
        path, v = [], end
        while came[v]:
            v, arc = came[v]
            path.append(arc)
        flow = min(supply[v], demand[end], min(arc[1] for arc in path))
        supply[v] -= flow
        demand[end] -= flow
        for arc in path:
            arc[1] -= flow
            arc[2][1] += flow


def main_text(source: str | None) -> str:
    """The blocks labelled content, in page order, joined by a space."""
    if not source:
        return ""
    page = Page(source)
    # cost of calling it boilerplate less cost of calling it content: log(1 + e^z) - log(1 + e^-z) = z
    inside = source_side(page.scores, page.edges())
    return " ".join(t for t, keep in zip(page.texts, inside, strict=True) if keep)


def extract_text(pages: DataFrame, html_column: str = "html", text: str = "text") -> DataFrame:
    """All columns but the html, and the main text (its name gets an underscore where taken)."""
    others = [c for c in pages.columns if c != html_column]
    text = fresh(others, text)
    schema = T.StructType([*pages.select(*others).schema.fields, T.StructField(text, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(s.as_py()) for s in batch.column(html_column)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), found], names=[*others, text])

    return pages.select(*others, html_column).mapInArrow(work, schema)
