"""Main text of web pages by a minimum cut over their blocks.

A page is cut into blocks at block-level tags.  A log-linear classifier gives each block the cost of calling it content and that
of calling it boilerplate; these costs are the capacities from the source and to the sink.  Edges between neighbours in page
order and between neighbours under the same parent, weaker the farther apart they stand in the DOM, are the smoothness costs.
The maximum flow gives the cut of least total cost, and the blocks on the source side are the main text.

Features of the classifier: length, link share, digits and marks, a sentence mark at the end, a copyright sign, heading, distance to
the longest block, a place before the first heading or at the end, and what the elements around say by tag and name (class, id, role):
inside an article or main part or not, and a doubt by names that tell of boilerplate.  Names are read word by word.  Those that tell
it surely (comment-list, cookie-notice, sidebar) count however much text the element holds; others (social-science, legal) are a doubt
that long blocks outweigh, and on pages without marked content less of one, the more of the text such an element holds.  A doubt ends
at an article or main inside, but that of comments.  There are two sets of weights: for pages that mark their content by tags or
names, and for plain pages, which don't.

There are no labelled pages, so ``train`` lets pages that mark their content teach: their blocks are labelled by the marks, and
the weights are fitted by penalised likelihood, for plain pages with all marks hidden, so that text alone must tell.  There the
scale of the smoothness is fitted with them, by pseudo-likelihood: how much a block's label follows from its neighbours' ones.  The
penalty pulls towards ``PRIOR``, which also serves tables without such pages.  Training reads about ``MOST_PAGES`` pages, a hash
sample, and at most ``BLOCKS_A_PAGE`` evenly spread blocks of each; both bounds are parameters and concern the fit alone.

Script, style, title, form controls and the like hold no text at all.  Blocks inside elements whose meaning is fixed (nav,
footer, aside, form ...) are tied to the sink.  Character references are decoded, white space inside a block becomes one space,
empty blocks vanish, blocks are joined in page order by one space.

Null and empty pages give the empty text.  Unclosed and misnested markup, stray angle brackets and unfinished comments are
read to the end, in time that grows with the length and depth of a page and not with their squares.  Pages of any length are
read whole.  Repeated rows get equal rows; columns other than those asked for are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skiagram.llm.shared import bounded_sample

# Element names of HTML by role.
SILENT = frozenset("script style noscript template title textarea select option button svg math object iframe canvas audio video head datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
AWAY = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
CLOSES_P = BLOCK - {"html", "body"}
# Words in class, id and role that tell what an element holds.
COMMENT_WORDS = frozenset("comment comments commentlist commentform commenter commenters disqus respond responses replies".split())
SURE_WORDS = frozenset("ads adsbygoogle advert adverts advertisement advertisements banner banners breadcrumb breadcrumbs complementary consent contentinfo copyright footer gdpr login masthead menu menus modal nav navbar navigation newsletter newsletters pager pagination popup promo promos promoted promotion sidebar signup sponsor sponsored sponsors subscribe subscription toolbar".split())
UNSURE_WORDS = frozenset("ad cookie cookies form notice notices recommendations recommended related reply search share sharing skip social widget widgets".split())
VAGUE_WORDS = frozenset("foot legal side".split())
HEADER_WORDS = frozenset("branding header".split())
STATE_WORDS = frozenset("close has hide no not open show toggle with without".split())
NEUTRAL_WORDS = frozenset("area article articles bar block body bottom box button buttons center col column container content group heading icon icons info inner item items label law left link links list main media message more outer page panel policy post posts primary right row secondary section site slot stories text title to top unit view wrap wrapper zone".split())
CONTENT_WORDS = re.compile(r"(?i)(?:^|[\s_-])(?:article\w*|post|entry|content|main|story|body|text|prose)(?=$|[\s_-])")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.S)
TAG_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"(?i)(?:^|;)\s*display\s*:\s*none\b")
SPACE = re.compile(r"\s+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_ITSELF = frozenset("li dd dt td th tr".split())

#: Cost that ties a block to the sink; the others are log odds of at most MOST_COST.
TIED, MOST_COST = 1e6, 12.0
#: Smoothness between neighbours in page order (over 1 + their distance in the DOM) and under one parent, before it is scaled.
NEXT, SIBLING = 0.6, 0.4
#: How much a name tells of boilerplate; what is sure, and comments more, counts SURE times a doubt.
WEAK_NAME, SURE_NAME, COMMENT_NAME = 1, 2, 3
SURE = 3.0
MOST_PAGES, BLOCKS_A_PAGE = 1_000, 256
FEATURES = ("bias", "length", "long", "links", "sentence", "heading", "short", "digits", "marks", "rights", "far", "before", "last", "inside", "doubt")
#: Log odds of content on pages that mark their content, and on plain ones; the last number scales the smoothness.
PRIOR = np.array(
    [
        [-2.5, 1.0, 0.0, -4.0, 0.4, 0.8, -0.3, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 5.5, -6.0, 1.0],
        [0.2, 1.0, 0.0, -4.0, 0.4, 0.8, -0.3, 0.0, 0.0, -2.0, 0.0, -0.5, -0.2, 0.0, -6.0, 1.0],
    ]
)

#: A negative scale would reward labels that differ; a cut can't say that.
LEAST_WEIGHTS = np.append(np.full(len(FEATURES), -np.inf), 0.0)


@dataclass(slots=True)
class Node:
    """A block-level element: the one around it and how deep it stands."""

    parent: Node | None
    depth: int


@dataclass(slots=True)
class Scope:
    """An open element."""

    name: str
    silent: bool
    away: bool
    inside: bool
    named: int  # the outermost element around whose name tells of boilerplate
    level: int  # how much the names around tell of it
    linked: bool
    heading: bool
    node: Node
    block_at: int  # place on the stack of the nearest block-level element, or -1


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    away: bool
    inside: bool
    heading: bool
    node: Node
    named: int
    level: int


@lru_cache(8192)
def name_level(labels: str, header: bool) -> int:
    """How much class, id and role tell of boilerplate: 0 for nothing.  What follows a word such as has or no tells of the page around;
    some words tell it only beside neutral ones (share-buttons, not social-science), some never surely.
    With ``header`` words for a page's header count."""
    unsure = UNSURE_WORDS | HEADER_WORDS if header else UNSURE_WORDS
    most = 0
    for name in labels.split():
        words = [w.lower() for w in WORDS.findall(name)]
        words = words[: next((k for k, w in enumerate(words) if w in STATE_WORDS), len(words))]
        if not COMMENT_WORDS.isdisjoint(words):
            return COMMENT_NAME
        if not SURE_WORDS.isdisjoint(words) or not unsure.isdisjoint(words) and all(w in unsure or w in VAGUE_WORDS or w in NEUTRAL_WORDS for w in words):
            most = SURE_NAME
        elif not (unsure | VAGUE_WORDS).isdisjoint(words) or header and words == ["top"]:
            most = max(most, WEAK_NAME)
    return most


def attributes_of(raw: str) -> dict[str, str]:
    """Attributes of a start tag by name in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *value in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), "".join(value))
    return out


def tokens(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, name, text or attributes, end) of texts, start and end tags, in order; the end of a start tag is where its text starts.

    Quotes in a tag may hold angle brackets; where they don't close, the next bracket ends the tag.
    """
    at, quotes = 0, True
    while at < len(page):
        m = MARKUP.search(page, at)
        if not m:
            yield "text", "", page[at:], len(page)
            return
        if m.start() > at:
            yield "text", "", page[at : m.start()], m.start()
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                yield "text", "", html.escape(m[0][9:-3]), at
            continue
        rest = TAG_REST.match(page, at) if quotes else None
        if rest is None:
            quotes = False  # nothing from here on has an end outside quotes that would close
            end = page.find(">", at) + 1
            if not end:
                yield "text", "", page[m.start() :], len(page)
                return
        else:
            end = rest.end()
        raw, at = page[at : end - 1], end
        sent = yield ("end" if m[1] else "start"), m[2].lower(), raw, at
        if sent is not None:  # raw text was read up to there
            at = sent
            yield "", "", "", at


class Reader:
    """Cuts a page into blocks; an element opens a scope that says whether its text is silent, away or content."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack = [Scope("", False, False, False, 0, 0, False, False, Node(None, 0), -1)]
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = self.number = 0

    def flush(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                top = self.stack[-1]
                self.blocks.append(Block(text, self.linked, top.away, top.inside, top.heading, top.node, top.named, top.level))
            self.parts.clear()
        self.linked = 0

    def say(self, raw: str) -> None:
        top = self.stack[-1]
        if not top.silent:
            self.parts.append(raw)
            if top.linked:
                self.linked += len(raw.strip())

    def close_to(self, k: int) -> None:
        for scope in self.stack[k:]:
            self.open[scope.name] -= 1
        del self.stack[k:]

    def end(self, name: str) -> None:
        if name == "br":
            self.parts.append(" ")
        if not self.open[name]:
            return
        lowest = 1 if name in BLOCK else max(1, self.stack[-1].block_at + 1)  # an inline end tag does not close blocks
        for k in range(len(self.stack) - 1, lowest - 1, -1):
            if self.stack[k].name == name:
                if self.stack[-1].block_at >= k:
                    self.flush()
                self.close_to(k)
                return

    def start(self, name: str, raw: str) -> bool:
        """Whether the element now stands open."""
        if name in ("br", "hr"):
            self.parts.append(" ")
        if name == "hr":
            self.flush()
        if name in VOID:
            return False
        if name in BLOCK:
            self.flush()
            k = self.stack[-1].block_at
            if k > 0 and name in CLOSES_P and (self.stack[k].name == "p" or self.stack[k].name == name and name in CLOSED_BY_ITSELF):
                self.close_to(k)
        up = self.stack[-1]
        has = attributes_of(raw) if raw else {}
        labels = " ".join(has[k] for k in ("class", "id", "role") if k in has)
        self.number += 1
        inside = (up.inside or name in CONTENT_TAGS or bool(labels and CONTENT_WORDS.search(labels))) and not up.away
        away = up.away or name in AWAY or not inside and name == "header"
        own = name_level(labels, not inside) if labels and name not in ("body", "html") else 0
        held = up.level if own or name not in CONTENT_TAGS or up.level == COMMENT_NAME else 0
        level = max(held, own)
        named = (up.named or self.number) if level else 0
        if raw.rstrip().endswith("/"):
            return False
        silent = up.silent or name in SILENT or "hidden" in has or bool(HIDDEN.search(has.get("style", "")))
        block = name in BLOCK
        self.stack.append(Scope(name, silent, away, inside, named, level, up.linked or name == "a", name in HEADINGS or up.heading and not block, Node(up.node, up.node.depth + 1) if block else up.node, len(self.stack) if block else up.block_at))
        self.open[name] += 1
        return True


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order."""
    reader, flow = Reader(), tokens(page)
    no_end: set[str] = set()
    for kind, name, raw, at in flow:
        if kind == "text":
            reader.say(raw)
        elif kind == "end":
            reader.end(name)
        elif kind == "start":
            opened = reader.start(name, raw)
            if name in RAW:
                found = None if name in no_end else re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if found is None:
                    no_end.add(name)
                stop = found.start() if found else len(page)
                if opened:
                    reader.say(page[at:stop])
                    reader.close_to(len(reader.stack) - 1)
                flow.send(found.end() if found else len(page))
    reader.flush()
    return reader.blocks


def doubts(found: list[Block]) -> list[float]:
    """Doubt by the names of the elements around each block: SURE for sure names, whatever they hold; for others 1 on pages that mark
    their content, else half of the share of the page's text that stands elsewhere."""
    marked = is_marked(found)
    held: Counter[int] = Counter()
    for b in found:
        if not b.away and b.level < SURE_NAME:
            held[b.named] += len(b.text)
    total = sum(held.values())

    def doubt(b: Block) -> float:
        if b.away or not b.level:
            return 0.0
        if b.level >= SURE_NAME:
            return SURE
        return 1.0 if marked else 0.5 * (1 - held[b.named] / total)

    return [doubt(b) for b in found]


def features(found: list[Block], doubt: list[float], marked: bool) -> np.ndarray:
    """A row for each block; without ``marked`` nothing is told of tags and names but headings and doubts."""
    longest = max(range(len(found)), key=lambda i: (0 if found[i].away else len(found[i].text)), default=0)
    title = next((i for i, b in enumerate(found) if b.heading), 0)
    rows = []
    for i, (b, d) in enumerate(zip(found, doubt, strict=True)):
        size = len(b.text)
        digits = sum(map(b.text.count, "0123456789"))
        marks = sum(map(b.text.count, "|©»·/:"))
        inside = marked and b.inside and not d
        rows.append((1.0, min(size, 1000 if 0 < d < SURE else 400) / 100, min(size, 1000) / 1000, min(1.0, b.linked / size), float(b.text[-1] in ".!?:;\"'”»…"), float(b.heading), float(size < 15), digits / size, min(1.0, 10 * marks / size), float("©" in b.text), min(abs(i - longest), 20) / 20, float(i < title), float(i == len(found) - 1 > 0), float(inside), d))
    return np.array(rows).reshape(-1, len(FEATURES))


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Pairs of neighbours and what it costs to tell them apart, before it is scaled."""
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            a, c, apart = found[i - 1].node, b.node, 0
            while a is not c:  # up to the element that holds both; in all no farther than a walk over the page
                if a.depth >= c.depth:
                    a = a.parent
                else:
                    c = c.parent
                apart += 1
            edges.append((i - 1, i, NEXT / (1 + apart)))
        around = id(b.node.parent or b.node)
        if (before := last.get(around)) is not None and before != i - 1:
            edges.append((before, i, SIBLING))
        last[around] = i
    return edges


def minimum_cut(n: int, terminal: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side of a minimum cut, by Dinic's maximum flow; node n is the source, n + 1 the sink."""
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, (keep, drop) in enumerate(terminal):
        both = min(keep, drop)
        if keep > both:
            edge(s, i, keep - both, 0)
        if drop > both:
            edge(i, t, drop - both, 0)
    for a, b, w in edges:
        edge(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        here = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= tiny)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while here[u] < len(out[u]):
                e = out[u][here[u]]
                if room[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                here[u] += 1
            if here[u] < len(out[u]):
                path.append(e)
                u = to[e]
            elif path:
                u = to[path.pop() ^ 1]
                here[u] += 1
            else:
                break


def is_marked(found: list[Block]) -> bool:
    """Whether a page marks its content."""
    return any(b.inside and not b.named for b in found)


def costs(found: list[Block], weights: np.ndarray = PRIOR) -> list[tuple[float, float]]:
    """Cost of calling each block boilerplate and cost of calling it content."""
    marked = is_marked(found)
    odds = np.clip(features(found, doubts(found), marked) @ weights[0 if marked else 1, :-1], -MOST_COST, MOST_COST)
    return [(0.0, TIED) if b.away else (max(o, 0.0), max(-o, 0.0)) for b, o in zip(found, odds.tolist(), strict=True)]


def labelled(page: str, weights: np.ndarray = PRIOR) -> list[tuple[Block, bool]]:
    found = blocks(page)
    scale = weights[0 if is_marked(found) else 1, -1]
    return list(zip(found, minimum_cut(len(found), costs(found, weights), [(a, b, w * scale) for a, b, w in smoothness(found)]), strict=True))


def main_text(page: str | None, weights: np.ndarray = PRIOR) -> str:
    return " ".join(b.text for b, content in labelled(page, weights) if content) if page else ""


def fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, pull: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of largest likelihood less ``pull`` / 2 times their squared distance from ``prior``, by Newton steps."""
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (p - y) + pull * (w - prior)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), slope)
        if np.abs(slope).max() < 1e-6:
            break
    return w


def lessons(page: str, most: int = BLOCKS_A_PAGE) -> tuple[np.ndarray, np.ndarray]:
    """Of a page that marks its content, features with and without marks, how much more the neighbours are content than not (stacked
    in that order), and labels; else nothing."""
    found = blocks(page)
    content = np.array([b.inside and not b.named and not b.away for b in found], float)
    if not content.any():
        return np.zeros((0, 2 * len(FEATURES) + 1)), np.zeros(0)
    lean = np.zeros((len(found), 1))
    for a, b, w in smoothness(found):
        lean[a] += w * (2 * content[b] - 1)
        lean[b] += w * (2 * content[a] - 1)
    own = np.arange(0, len(found), -(-len(found) // most))
    return np.hstack([features(found, doubts(found), True), features(found, [0.0] * len(found), False), lean])[own], content[own]


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights from the rows of lessons.  With the neighbours' labels among the features, the fit is of largest pseudo-likelihood for the
    energy that the cut makes least, and the weight of these is the scale of the smoothness."""
    k = len(FEATURES)
    return np.stack([np.append(fit(x[:, :k], y, PRIOR[0, :-1]), PRIOR[0, -1]), np.maximum(fit(x[:, k:], y, PRIOR[1]), LEAST_WEIGHTS)])


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = MOST_PAGES) -> np.ndarray:
    """Weights for pages that mark their content and for plain ones."""
    rows = bounded_sample(pages.select(id_col, html_col), id_col, most, "pages").select(F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0):
                x, y = lessons(page.as_py() or "")
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array(y, pa.float64())], ["x", "y"])

    got = rows.mapInArrow(run, "x array<double>, y double").toPandas()
    if got["y"].nunique() < 2:
        return PRIOR
    return fitted(np.stack(got["x"].to_numpy()), got["y"].to_numpy())


def extracted(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), weights: np.ndarray | None = None) -> DataFrame:
    """The kept columns, text and n_chars of every page; without ``weights`` they are learned from the pages."""
    weights = train(pages, keep[0], html_col) if weights is None else weights
    rows = pages.select(*keep, F.col(html_col).cast("string"))
    schema = StructType([*rows.schema.fields[:-1], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), weights) for x in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*batch.schema.names[:-1], "text", "n_chars"])

    return rows.mapInArrow(run, schema)
