"""Operator 3: main text of HTML pages by minimum-cut labelling.

A page is cut into text blocks at its block elements.  A classifier gives each
block a log-odds of being content, a sum of finite terms:

* its elements: inside ``nav``, ``footer`` and the like, inside ``article``, ``main`` or a header;
* the class and id words of its elements, the strongest for and the strongest against;
* its shape (length, share of linked text, sentence ends), at most ``SHAPE_LIMIT`` either way.

The weights of words and shapes start from counts that stand in this module and are learned
from the blocks of at most ``FIT_PAGES`` pages of up to ``FIT_BYTES`` that an element alone
decides, whatever their classes say.  A class, form or role around more than ``WRAPPER_SHARE`` of a page's text
is layout and says nothing.  The log-odds become terminal capacities: positive ones from
the source, negative ones to the sink.  Adjacent blocks, and consecutive blocks of
one container, are joined by smoothness edges that weaken with their distance in
the DOM.  The minimum cut separates content from boilerplate.

A block whose terminal capacity exceeds the sum of its smoothness edges lies on that
side in every minimum cut, so it is fixed first, which is exact and usually leaves a
few blocks for the max-flow (Dinic's algorithm).

Defined results: null, empty and text-less pages give an empty text; repeated rows
are kept, one result per row; cut ties go to boilerplate (the source side is the set
reachable in the residual graph); unclosed elements end with their parents, an
unclosed script or comment at the end of the page.  Character references are decoded,
white space inside a block becomes one blank, blocks are joined by one blank.  Only
id, url and html are read.
"""

from __future__ import annotations

import html as html_text
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import bounded_sample

FIT_PAGES, FIT_BYTES = 2_000, 16_384
#: Log-odds of elements: of nav and the like, of forms and roles, of articles, of text beside an article, of headers and headings in them.
ELEMENT, FORM, ARTICLE, BESIDE, HEADER, HEADING = -4.0, -3.5, 2.0, -2.5, -3.5, 1.0
WORD_LIMIT, SHAPE_LIMIT = 3.5, 2.5
WRAPPER_SHARE = 0.6
ADJACENT, SIBLING = 2.4, 1.6  # smoothness of neighbours in the page and in a container

# HTML element names and common words of class and id attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
BOILER_TAGS = frozenset("nav footer aside button select option optgroup datalist menu head object audio video canvas map".split())
FORM_TAGS = frozenset("form fieldset dialog".split())
CONTENT_TAGS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILER_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion nav navbar navigation menu menus submenu
    breadcrumb breadcrumbs footer foot masthead topbar sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal
    overlay newsletter subscribe subscription signup login signin share sharing social related recommended recommendations teaser teasers pagination pager
    copyright toolbar skip banner banners disclaimer form search""".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commentary disqus reply replies respond discussion".split())
HEADER_WORDS = frozenset(["header", "head"])
CONTENT_WORDS = frozenset("article content main post entry story articlebody".split())
LAYOUT_WORDS = frozenset("has with no layout wrapper wrap container grid row page site".split())

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
TAG_PART = re.compile(r"""=\s*+(["'])|>""")
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")  # a tag or comment that the page's end cuts off
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![^\s"'])(hidden)(?![^\s/>])""", re.S)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE_END = re.compile(r"[.!?…。！？](?:\s|$)")
CUES = ("class", "id", "role", "hidden", "aria-hidden", "style", "itemprop")


#: Words that are cues, and the counts of content and boilerplate blocks they start from.
WORD_PRIOR = {w: (0.1, 20.0) for w in BOILER_WORDS} | {w: (0.1, 20.0) for w in COMMENT_WORDS} | {w: (1.0, 20.0) for w in HEADER_WORDS} | {w: (20.0, 1.0) for w in CONTENT_WORDS}


def element_cue(tag: str, attributes: str) -> tuple[str | None, frozenset]:
    """What an element says about the text in it: its kind (boiler, form, article, header) and its cue words."""
    kind = "boiler" if tag in BOILER_TAGS else "form" if tag in FORM_TAGS else "article" if tag in CONTENT_TAGS else "header" if tag == "header" else None
    if not attributes or not any(c in attributes.lower() for c in CUES):
        return kind, frozenset()
    words: set[str] = set()
    for name, a, b, c, bare in ATTRIBUTE.findall(attributes):
        name, value = (name or bare).lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            kind = kind or "form"
        if name == "role" and value.lower() in BOILER_ROLES:
            kind = kind or "form"
        if (name == "role" and value.lower() in CONTENT_TAGS) or (name == "itemprop" and value == "articleBody"):
            kind = "article"
        if name in ("class", "id"):
            words.update(w.lower() for w in WORD.findall(value))
    if tag in ("html", "body"):
        return kind, frozenset()
    if words & LAYOUT_WORDS or tag in CONTENT_TAGS:
        words -= BOILER_WORDS | HEADER_WORDS
    if words & CONTENT_WORDS:
        words -= HEADER_WORDS
    if tag not in ("div", "section", "td"):
        words -= CONTENT_WORDS
    return kind, frozenset(words.intersection(WORD_PRIOR))


class Mark:
    """An open element with a cue; marks are a chain up to the root."""

    __slots__ = ("parent", "kind", "words", "begin", "size", "state")

    def __init__(self, parent: Mark | None, kind: str | None, words: frozenset, begin: int):
        self.parent, self.kind, self.words, self.begin, self.size = parent, kind, words, begin, 0
        self.state: tuple[frozenset, frozenset] | None = None


NOTHING = (frozenset(), frozenset())


def settle(mark: Mark | None, most: float) -> tuple[frozenset, frozenset]:
    """Kinds and words of a mark and all above it; what wraps more than ``most`` characters says nothing, but for elements."""
    todo = []
    while mark is not None and mark.state is None:
        todo.append(mark)
        mark = mark.parent
    state = mark.state if mark is not None else NOTHING
    for m in reversed(todo):
        kinds, words = state
        wraps = m.size > most
        if m.kind and not (wraps and m.kind == "form"):
            kinds = kinds | {m.kind}
        if m.words:
            words = words | ((m.words & CONTENT_WORDS) if wraps else m.words)
        m.state = state = (kinds, words)
    return state


class Block:
    __slots__ = ("text", "gap", "holders", "mark", "tag", "linked", "kinds", "words")

    def __init__(self, text: str, gap: int, holders: tuple, mark: Mark | None, tag: str, linked: int):
        self.text, self.gap, self.holders, self.mark, self.tag, self.linked = text, gap, holders, mark, tag, linked
        self.kinds, self.words = NOTHING


class Tags:
    """Ends of start tags in one page: quoted values of any length hide a ``>``."""

    def __init__(self, page: str):
        self.page = page
        self.unclosed: set[str] = set()  # quotes that nothing closes any more
        self.plain = False  # some tag never ended, so quotes hide nothing

    def end(self, at: int) -> int:
        """The place after the tag whose name ends at ``at``, or -1."""
        start = at
        while not self.plain:
            m = TAG_PART.search(self.page, at)
            if m is None:
                self.plain = True
            elif m[1] is None:
                return m.end()
            elif m[1] in self.unclosed or (close := self.page.find(m[1], m.end())) < 0:
                self.unclosed.add(m[1])
                at = m.end()
            else:
                at = close + 1
        return self.page.find(">", start) + 1 or -1


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, with the cues of their elements."""
    out: list[Block] = []
    stack: list[tuple[str, int, Mark | None]] = []
    open_tags: Counter = Counter()  # of the stack
    near: list[int] = []  # numbers of the open block elements
    parts: list[str] = []
    tags = Tags(page)
    top: Mark | None = None
    linked = serial = total = 0
    depth_then = lowest = 0  # of the last block, and since then
    last = page.rfind(">") + 1  # no tag ends after it
    tail = UNFINISHED.search(page, last)
    at, size = 0, tail.start() if tail else len(page)

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if open_tags["a"]:
            linked += len(text)

    def flush() -> None:
        nonlocal linked, total, depth_then, lowest
        if parts:
            text = " ".join(html_text.unescape("".join(parts)).split())
            if text:
                tag = next((t for t, _, _ in reversed(stack) if t not in INLINE), "")
                gap = depth_then + len(near) - 2 * min(lowest, len(near))
                out.append(Block(text, gap, tuple(near[-2:-4:-1]), top, tag, min(linked, len(text))))
                depth_then = lowest = len(near)
                total += len(text)
            parts.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal top, lowest
        for tag, _, mark in reversed(stack[to:]):
            open_tags[tag] -= 1
            if mark is not None:
                mark.size = total - mark.begin
                top = mark.parent
            if tag not in INLINE:
                near.pop()
        del stack[to:]
        lowest = min(lowest, len(near))

    while at < size:
        m = TOKEN.search(page, at, size) if at < last else None
        if m is None:
            add(page[at:size])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if (end := tags.end(at)) < 0:
            add(page[m.start() : size])
            break
        tag, attributes, at = m[2].lower(), page[at : end - 1], end
        if tag in RAW and not m[1]:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                found = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = found.end() if found else size
            continue
        if tag == "br":
            add(" ")
            continue
        inline = tag in INLINE
        if not inline:
            flush()
        if tag in VOID:
            continue
        if m[1]:
            for i in range(len(stack) - 1, -1, -1) if open_tags[tag] else ():
                if stack[i][0] == tag:
                    close(i)
                    break
                if inline and stack[i][0] not in INLINE:  # an inline end does not close blocks
                    break
        else:
            if not inline and (to := implied_end(tag, stack, open_tags)) is not None:
                close(to)
            serial += 1
            kind, words = element_cue(tag, attributes)
            mark = None
            if kind or words:
                top = mark = Mark(top, kind, words, total)
            stack.append((tag, serial, mark))
            open_tags[tag] += 1
            if not inline:
                near.append(serial)
    flush()
    close(0)
    for block in out:
        block.kinds, block.words = settle(block.mark, WRAPPER_SHARE * total)
    return out


#: What a start tag closes when it is still open, and the elements beyond which it does not look.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPE = frozenset("table ul ol dl select div section article main body td th".split())


def implied_end(tag: str, stack: list, open_tags: Counter) -> int | None:
    """From where on the start tag of a block closes the stack."""
    closes = IMPLIED.get(tag, ()) + ("p",)
    if any(open_tags[c] for c in closes):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in closes:
                return i
            if stack[i][0] in SCOPE:
                break
    return None


def shape(block: Block) -> tuple[str, ...]:
    """Discrete features of a block's text."""
    n = len(block.text)
    share = block.linked / max(n, 1)
    words = block.text.count(" ") + 1
    if block.tag in HEADINGS:  # short and without a full stop by nature
        return (f"tag_{block.tag}", "links0" if share == 0 else "links2")
    return (
        f"length{min(int(math.log2(words + 1)), 7)}",
        f"links{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}",
        f"ends{sum(1 for _ in islice(SENTENCE_END.finditer(block.text), 3))}",
        f"tag_{block.tag if block.tag in ('p', 'li', 'td', 'div', 'pre', 'blockquote') or block.tag in HEADINGS else 'other'}",
    )


def certain(block: Block) -> bool | None:
    """Whether an element alone makes the block content, or boilerplate."""
    if "boiler" in block.kinds:
        return False
    if block.kinds == {"article"} and not block.words & (BOILER_WORDS | COMMENT_WORDS):
        return True
    return None


def structure(block: Block, has_article: bool, weights: dict[str, float]) -> float:
    """Log-odds from the elements around a block and their words.

    ``has_article``: the page has text in an article element, so text outside is
    less likely to be content, whatever the names of its classes.
    """
    kinds, words = block.kinds, [weights[w] for w in block.words]
    odds = min([0.0, *words]) + max([0.0, *words])
    comment = bool(block.words & COMMENT_WORDS)
    inside = "article" in kinds and not comment
    odds += (ELEMENT if "boiler" in kinds else 0.0) + (FORM if "form" in kinds else 0.0) + (ARTICLE if inside else 0.0)
    if "header" in kinds:
        odds += HEADING if block.tag in HEADINGS and (inside or block.words & CONTENT_WORDS) else HEADER
    return odds + (BESIDE if has_article and not inside else 0.0)


#: Shape weights before any page was seen, as (content, boilerplate) blocks.
PRIOR = {
    "length1": (2, 8), "length2": (3, 7), "length3": (5, 5), "length4": (6, 4), "length5": (8, 2), "length6": (9, 1), "length7": (9, 1),
    "links0": (7, 4), "links1": (5, 5), "links2": (2, 8), "links3": (1, 9), "ends0": (3, 7), "ends1": (6, 4), "ends2": (8, 2), "ends3": (9, 1),
    "tag_p": (8, 2), "tag_li": (3, 7), "tag_td": (4, 6), "tag_div": (4, 6), "tag_pre": (8, 2), "tag_blockquote": (8, 2), "tag_other": (5, 5),
    "tag_h1": (8, 2), "tag_h2": (7, 3), "tag_h3": (6, 4), "tag_h4": (5, 5), "tag_h5": (5, 5), "tag_h6": (5, 5),
}


def learn(df: DataFrame, html_col: str, fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Log-odds per shape feature and cue word, from certain blocks of a bounded sample of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                for b in blocks_of(value.as_py() or ""):
                    if (side := certain(b)) is not None:
                        seen.update((f, side) for f in (*shape(b), *b.words))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in seen], pa.string()), pa.array([c for _, c in seen], pa.bool_()), pa.array(list(seen.values()), pa.int64())], names=["feature", "content", "n"])

    sample = bounded_sample(df, html_col, fit_pages, FIT_BYTES)
    pages = df.sparkSession.createDataFrame([(x,) for x in sample], "_html string")
    rows = pages.mapInArrow(run, "feature string, content boolean, n long").groupBy("feature", "content").agg(F.sum("n").alias("n")).collect()
    counts = {f: [float(a), float(b)] for f, (a, b) in (PRIOR | WORD_PRIOR).items()}
    for r in rows:
        counts[r["feature"]][0 if r["content"] else 1] += r["n"]
    # kinds of features, so that each shape's odds are relative to its kind's
    kind = lambda f: "tag" if f.startswith("tag_") else f.rstrip("0123456789")
    total: dict[str, list[float]] = {}
    for f in PRIOR:
        t = total.setdefault(kind(f), [0.0, 0.0])
        t[0] += counts[f][0]
        t[1] += counts[f][1]
    odds = {f: math.log(counts[f][0] / total[kind(f)][0]) - math.log(counts[f][1] / total[kind(f)][1]) for f in PRIOR}
    return odds | {w: min(max(math.log(counts[w][0] / counts[w][1]), -WORD_LIMIT), WORD_LIMIT) for w in WORD_PRIOR}


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in the page, and neighbours in a container."""
    out, last_in = [], {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, ADJACENT / (1 + b.gap)))
        for up, holder in enumerate(b.holders, 2):
            container = (up, holder)
            if (j := last_in.get(container)) is not None and j < i - 1:
                out.append((j, i, SIBLING / up))
            last_in[container] = i
    return out


class Dinic:
    """Max-flow on a small graph; capacities are floats."""

    def __init__(self, n: int):
        self.graph: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[float] = []

    def edge(self, a: int, b: int, forth: float, back: float = 0.0) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            self.graph[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.graph)
        level[s] = 0
        todo = deque([s])
        while todo:
            x = todo.popleft()
            for e in self.graph[x]:
                if self.cap[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    todo.append(self.to[e])
        return level

    def source_side(self, s: int, t: int) -> list[bool]:
        """After the maximum flow from s to t: which nodes the residual graph reaches from s."""
        while (level := self.levels(s))[t] >= 0:
            used = [0] * len(self.graph)
            path: list[int] = []
            x = s
            while True:
                if x == t:
                    push = min(self.cap[e] for e in path)
                    for e in path:
                        self.cap[e] -= push
                        self.cap[e ^ 1] += push
                    path, x = [], s
                    continue
                while used[x] < len(self.graph[x]):
                    e = self.graph[x][used[x]]
                    if self.cap[e] > 1e-9 and level[self.to[e]] == level[x] + 1:
                        break
                    used[x] += 1
                if used[x] < len(self.graph[x]):
                    path.append(e)
                    x = self.to[e]
                elif x == s:
                    break
                else:
                    x = self.to[path.pop() ^ 1]
                    used[x] += 1
        return [lv >= 0 for lv in self.levels(s)]


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of the minimum cut: True is content."""
    n = len(odds)
    near = [0.0] * n
    for a, b, w in edges:
        near[a] += w
        near[b] += w
    fixed: list[bool | None] = [odds[i] > 0 if abs(odds[i]) > near[i] else None for i in range(n)]
    free = [i for i in range(n) if fixed[i] is None]
    if not free:
        return [bool(x) for x in fixed]
    place = {x: k for k, x in enumerate(free)}
    terminal = [odds[i] for i in free]
    flow = Dinic(len(free) + 2)
    s, t = len(free), len(free) + 1
    for a, b, w in edges:
        fa, fb = place.get(a), place.get(b)
        if fa is not None and fb is not None:
            flow.edge(fa, fb, w, w)
        elif fa is not None:
            terminal[fa] += w if fixed[b] else -w
        elif fb is not None:
            terminal[fb] += w if fixed[a] else -w
    for k, c in enumerate(terminal):
        if c > 0:
            flow.edge(s, k, c)
        elif c < 0:
            flow.edge(k, t, -c)
    side = flow.source_side(s, t)
    return [side[place[i]] if fixed[i] is None else bool(fixed[i]) for i in range(n)]


def block_odds(blocks: list[Block], weights: dict[str, float]) -> list[float]:
    has_article = any(certain(b) for b in blocks)
    out = []
    for b in blocks:
        form = sum(weights.get(f, 0.0) for f in shape(b))
        out.append(structure(b, has_article, weights) + min(max(form, -SHAPE_LIMIT), SHAPE_LIMIT))
    return out


def main_text(page: str, weights: dict[str, float]) -> str:
    blocks = blocks_of(page)
    labels = min_cut(block_odds(blocks, weights), edges_of(blocks))
    return " ".join(b.text for b, keep in zip(blocks, labels, strict=True) if keep)


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars long)`` for every page."""
    weights = df.sparkSession.sparkContext.broadcast(learn(df, html_col))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [main_text(v.as_py() or "", weights.value) for v in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    rows = df.select(F.col(id_col), F.col(url_col).cast("string").alias(url_col), F.col(html_col).cast("string").alias("_html"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, `{url_col}` string, text string, n_chars long")
