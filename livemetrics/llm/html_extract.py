"""Operator 5, HTML extraction: minimum-cut labelling of text blocks.

A page is cut into blocks at block-level tags.  A linear classifier over a block's tags,
class names, link share, length and wording gives each block a cost for being content and
one for being boilerplate: the terminal capacities of a flow network.  Neighbouring blocks
and blocks of one DOM parent are joined by smoothness edges whose capacity falls with their
tree distance.  The minimum cut labels all blocks at once; the content blocks, with
character references decoded and white space folded, are joined in page order by newlines.

The cut is exact: blocks whose terminal capacity exceeds all their edges are decided first
(their edges turn into terminal capacities of the neighbours, which is repeated), and a
max-flow by shortest augmenting paths settles what remains.

Elements that wrap half of the page's text and its title (or, for a form, a paragraph) do not
mark what they hold as boilerplate.

Scale: one scan, one page at a time, no shuffle; memory is bounded by the largest page, and
cutting and scoring its blocks takes time linear in it.

Defined edge results: null or empty html, or a page without content blocks: empty text;
unclosed or cut-off tags, comments and scripts end with the page; a null ``page_id`` or url
is kept; repeated rows give repeated results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter, deque
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from livemetrics.llm.common import map_arrow

SCHEMA = "page_id long, url string, text string, n_chars long"

# Fixed values of HTML: elements without an end tag, without readable text, and of block level.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = "script|style|template|textarea|title|iframe|svg|select|canvas|audio|video"
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
option p pre search section summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - frozenset("td th tr tbody thead tfoot caption option legend summary body html head".split())
SELF_NESTING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("form",),
                "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/>])[^>]*+(?<=/)>"           # self-closed: holds nothing
    rf"|<(?P<raw>{UNREAD})(?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-z][^>]*+(?:>|\Z)", re.I | re.S)
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Words of class, id and role names that mark boilerplate or content.
BAD_NAMES = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline
comment comments commentlist consent cookie cookies copyright dialog disclaimer discussion disqus feedback footer
foot footnav form gdpr header legal login masthead menu menubar message modal nav navbar navigation newsletter
notice notices notification overlay pager pagination popup privacy promo promoted recommend recommended related
replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe tags
toast toolbar topbar warning widget widgets""".split())
GOOD_NAMES = frozenset("article articlebody body content entry main maincontent post story text".split())
# Bad words that may as well belong to the main part, and the words of layout that say so.
EITHER_NAMES = frozenset("dialog form legal message response search".split())
LAYOUT_NAMES = frozenset("article body content layout main page post wrapper".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog button fieldset search head".split())
_WORDING = re.compile(r"©|all rights reserved|\bcookies?\b|\bsubscribe\b|\bsign (?:in|up)\b|\blog ?in\b|privacy policy"
                      r"|terms of (?:use|service)|\badvertisement\b|\bsponsored\b", re.I)


@dataclass(frozen=True)
class CutWeights:
    """Evidence for content (positive) or boilerplate (negative), and smoothness."""
    bad_tag: float = -8.0
    bad_name: float = -6.0
    good_tag: float = 4.0
    good_name: float = 2.5
    heading: float = 0.8
    links: float = -5.0                      # times the share of characters inside links
    long_text: float = 1.5                   # 12 words or more
    sentence: float = 0.7                    # ends like a sentence
    short_text: float = -0.8                 # under 4 words
    wording: float = -2.5
    bias: float = -0.2
    adjacent: float = 0.8                    # edge to the next block, divided by tree distance
    sibling: float = 0.6                     # edge to the next block of the same parent


class Block(NamedTuple):
    text: str
    element: int                             # innermost open element (0: the page)
    link_share: float


class Element(NamedTuple):
    tag: str
    parent: int
    depth: int
    names: frozenset[str]                    # words of its class, id and role


class Evidence(NamedTuple):
    """What an element's tag and names, and those of the elements around it, say."""
    article: bool = False                    # inside an article element
    good_tag: bool = False
    bad_tag: bool = False
    good_name: bool = False
    bad_name: bool = False


def _names(attr: str) -> frozenset[str]:
    """Words of the class, id and role names; in a name that also has a word of layout, words
    that may mean either ("message-body", "search-layout") say nothing."""
    out: set[str] = set()
    for m in _HINT.findall(attr):
        for name in "".join(m).split():
            parts = {p.lower() for p in _PART.findall(name)}
            out |= parts - EITHER_NAMES if not parts.isdisjoint(LAYOUT_NAMES) else parts
    return frozenset(out)


def parse_page(page: str) -> tuple[list[Block], list[Element]]:
    """Text blocks of a page in order, scripts, styles, comments and hidden parts left out, and
    its elements (number 0 is the page).  Time is linear in the page: what is open is counted,
    never listed per block."""
    out: list[Block] = []
    elements = [Element("", 0, 0, frozenset())]
    stack: list[tuple[int, str, bool]] = []  # (element, tag, hidden)
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked = plain = hidden = 0

    def close() -> None:
        nonlocal linked, plain
        if pieces:
            text = " ".join("".join(pieces).split())
            if text and not hidden:
                whole = linked + plain
                out.append(Block(text, stack[-1][0] if stack else 0, linked / whole if whole else 0.0))
            pieces.clear()
        linked = plain = 0

    def text_piece(raw: str) -> None:
        nonlocal linked, plain
        s = html_lib.unescape(raw) if "&" in raw else raw
        pieces.append(s)
        if s and not s.isspace():
            if opened["a"]:
                linked += len(s)
            else:
                plain += len(s)

    def pop_to(i: int) -> None:
        nonlocal hidden
        for _, tag, gone in stack[i:]:
            opened[tag] -= 1
            hidden -= gone
        del stack[i:]

    def pop_nearest(tags: tuple[str, ...], stops) -> None:
        """Close the innermost open element of ``tags``, unless one of ``stops`` is further in."""
        if any(opened[t] for t in tags):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][1] in tags:
                    return pop_to(i)
                if stack[i][1] in stops:
                    return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text_piece(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"] and m["raw"].lower() in ("textarea", "select", "title", "iframe"):
                close()
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if block:
            close()
        elif tag == "br":
            pieces.append(" ")
        if m["end"]:
            pop_nearest((tag,), () if block else BLOCK)      # an inline end tag does not close a block
            continue
        attr = m["attr"] or ""
        if block:
            if tag in ENDS_P:
                pop_nearest(("p",), BLOCK)
            if tag in SELF_NESTING:
                same = next((x for x in (("dt", "dd"), ("td", "th")) if tag in x), (tag,))
                pop_nearest(same, SELF_NESTING[tag])
        if tag in VOID or attr.endswith("/") and tag not in BLOCK:
            continue
        # page-wide elements carry layout names ("has-sidebar"): only good ones count there
        names = _names(attr) if "=" in attr else frozenset()
        if tag in ("html", "body", "main", "article"):
            names = names & GOOD_NAMES
        gone = bool(attr) and _HIDDEN.search(attr) is not None
        parent = stack[-1][0] if stack else 0
        stack.append((len(elements), tag, gone))
        elements.append(Element(tag, parent, elements[parent].depth + 1, names))
        opened[tag] += 1
        hidden += gone
    if at < len(page):
        text_piece(page[at:])
    close()
    return out, elements


def page_blocks(page: str) -> list[Block]:
    return parse_page(page)[0]


def _wide(blocks: list[Block], elements: list[Element]) -> list[bool]:
    """Page-wide wrappers: they hold half of the page's text and its first h1, or, for a form, a
    paragraph of 12 words or more.  Their own tag and names do not mark boilerplate."""
    chars, paragraph, title = [0] * len(elements), [False] * len(elements), [False] * len(elements)
    first = True
    for b in blocks:
        chars[b.element] += len(b.text)
        tag = elements[b.element].tag
        if tag == "p" and b.text.count(" ") >= 11:
            paragraph[b.element] = True
        elif tag == "h1" and first:
            title[b.element], first = True, False
    for i in range(len(elements) - 1, 0, -1):                # children come after their parent
        parent = elements[i].parent
        chars[parent] += chars[i]
        paragraph[parent] |= paragraph[i]
        title[parent] |= title[i]
    return [2 * c >= chars[0] and (t or p and e.tag == "form") for c, t, p, e in zip(chars, title, paragraph, elements)]


def element_evidence(blocks: list[Block], elements: list[Element]) -> list[Evidence]:
    """Evidence of every element, from its own tag and names and its parent's evidence."""
    out = [Evidence()]
    wide = _wide(blocks, elements)
    for i, e in enumerate(elements[1:], 1):
        up = out[e.parent]
        bad = not wide[i] and (e.tag in BAD_TAGS or e.tag == "header" and not up.article)
        out.append(Evidence(up.article or e.tag == "article", up.good_tag or e.tag in ("article", "main"), up.bad_tag or bad,
                            up.good_name or not e.names.isdisjoint(GOOD_NAMES),
                            up.bad_name or not wide[i] and not e.names.isdisjoint(BAD_NAMES)))
    return out


def content_score(b: Block, tag: str, e: Evidence, w: CutWeights = CutWeights()) -> float:
    """Evidence that a block is content: the difference of its two terminal capacities."""
    s = w.bias + w.links * b.link_share
    if e.bad_tag or e.bad_name:               # what stands in an aside is not the article around it
        s += w.bad_tag * e.bad_tag + w.bad_name * e.bad_name
    else:
        s += w.good_tag * e.good_tag + w.good_name * e.good_name
    if tag in ("h1", "h2", "h3"):
        s += w.heading
    n = b.text.count(" ") + 1
    if n >= 12:
        s += w.long_text
    elif n < 4:
        s += w.short_text
    if b.text[-1] in ".!?…:;\"”»":
        s += w.sentence
    if _WORDING.search(b.text):
        s += w.wording if n < 40 else w.wording / 4
    return s


def _distance(elements: list[Element], a: int, b: int) -> int:
    """Steps between two elements in the tree; over neighbouring blocks this walks only what was
    closed and opened between them."""
    k = 0
    while a != b:
        if elements[a].depth < elements[b].depth:
            a, b = b, a
        a, k = elements[a].parent, k + 1
    return k


def smooth_edges(blocks: list[Block], elements: list[Element], w: CutWeights = CutWeights()) -> dict[tuple[int, int], float]:
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges[i - 1, i] = w.adjacent / max(1, _distance(elements, blocks[i - 1].element, b.element))
        parent = elements[b.element].parent
        j = last.get(parent)
        if j is not None:
            edges[j, i] = edges.get((j, i), 0.0) + w.sibling
        last[parent] = i
    return edges


def min_cut(score: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Content side of the minimum cut: minimises the terminal capacities cut (``score[i]`` lost
    if a positive block is cut off, ``-score[i]`` if a negative one is kept) plus cut edges."""
    n = len(score)
    score = list(score)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        near[i][j] = near[i].get(j, 0.0) + c
        near[j][i] = near[j].get(i, 0.0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:                               # persistency: decided whatever the rest does
        i = todo.popleft()
        if label[i] is None and abs(score[i]) >= sum(near[i].values()) and (score[i] or not near[i]):
            label[i] = score[i] > 0
            for j, c in near[i].items():
                score[j] += c if label[i] else -c
                del near[j][i]
                todo.append(j)
            near[i].clear()
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _max_flow(rest, score, near)):
            label[i] = side
    return [bool(x) for x in label]


def _max_flow(rest: list[int], score: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Shortest augmenting paths from blocks with positive to blocks with negative capacity."""
    cap = {i: dict(near[i]) for i in rest}
    left = {i: score[i] for i in rest}
    eps = 1e-12
    while True:
        source = [i for i in rest if left[i] > eps]
        before: dict[int, int | None] = dict.fromkeys(source)
        queue, end = deque(source), None
        while queue and end is None:
            i = queue.popleft()
            for j, c in cap[i].items():
                if c > eps and j not in before:
                    before[j] = i
                    if left[j] < -eps:
                        end = j
                        break
                    queue.append(j)
        if end is None:
            return [i in before for i in rest]
        path = [end]
        while before[path[-1]] is not None:
            path.append(before[path[-1]])
        path.reverse()
        flow = min([left[path[0]], -left[end], *(cap[a][b] for a, b in zip(path, path[1:]))])
        left[path[0]] -= flow
        left[end] += flow
        for a, b in zip(path, path[1:]):
            cap[a][b] -= flow
            cap[b][a] = cap[b].get(a, 0.0) + flow


def main_text(page: str | None, w: CutWeights = CutWeights()) -> str:
    """The article of one page: its content blocks joined by newlines."""
    if not page:
        return ""
    blocks, elements = parse_page(page)
    said = element_evidence(blocks, elements)
    score = [content_score(b, elements[b.element].tag, said[b.element], w) for b in blocks]
    keep = min_cut(score, smooth_edges(blocks, elements, w))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  weights: CutWeights = CutWeights()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    src = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"),
                       pages[html_col].alias("html"))

    def run(batches):
        for b in batches:
            text = [main_text(h.as_py(), weights) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return map_arrow(src, run, SCHEMA)
