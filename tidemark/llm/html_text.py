"""HTML extraction: boosted trees judge DOM nodes, a tree decoding keeps their choices consistent.

A page is parsed into block elements; inline elements belong to the block around them.  Each
block is described by subtree density, attribute tokens, depth and sibling statistics, and
gradient-boosted trees give the probability that it is main text.  Decoding finds the best
assignment of three states: *in* (main text, except for children that are out), *out* (with
all that it holds), *mixed* (a container that leaves the choice to its children).  So nothing
below an *out* block is kept, and *in* blocks stand below *mixed* or *in* ones only.

The trees are trained on labelled pages ``(html, label spans)``.  Where there are none,
:func:`derived_pages` builds them from the article texts and the menus of the provided
pages: known blocks in templates of different markup, with sidebars, notices, adverts,
forms and comments.

Edge cases: a null or empty page, and one without main text, give the empty string.  Unclosed
and stray tags are closed or ignored as browsers do; comments, scripts and styles have no text.
A tag with an unclosed quote ends at the first ``>``.  Unknown elements are part of the text around them, and a hidden
element inside a paragraph does not part it.
Character references are decoded, also those without semicolon.  A line break is white space.
Very long pages take time in proportion to their length.
Repeated rows are treated alike; other columns are kept, result columns replace columns of the
same name.
"""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import smallest_by_hash
from tidemark.llm.words import slices

# Kinds of HTML elements, and words of class and id attributes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = {"script", "style", "noscript", "template", "title", "textarea", "select", "option", "svg", "math", "iframe", "object", "button"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe"}
#: Elements that stand as blocks of their own; all others, unknown ones too, belong to the text around them.
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "colgroup", "dd", "details", "dialog", "dir", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
          "html", "legend", "li", "listing", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
          "tfoot", "th", "thead", "tr", "ul", "xmp"}
#: Elements without an end that show as something between words, and those that leave no trace.
SHOWN_VOID, UNSEEN_VOID = {"br", "img", "input", "embed"}, VOID - {"br", "img", "input", "embed", "hr"}
#: An opening tag of a key closes an open element of its values, unless one of the barriers stands between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BARRIERS = {"ul", "ol", "dl", "table", "body", "html", "div", "article", "section", "main", "aside", "nav", "header", "footer", "form", "blockquote"}
MAIN_WORDS = {"article", "body", "content", "entry", "main", "post", "story", "text"}
SIDE_WORDS = {"ad", "ads", "advert", "advertisement", "aside", "banner", "bar", "breadcrumb", "comment", "comments", "consent", "cookie", "cookies",
              "copyright", "disqus", "footer", "form", "header", "legal", "links", "login", "masthead", "menu", "meta", "modal", "nav", "navbar",
              "navigation", "newsletter", "notice", "pager", "popup", "promo", "promoted", "recommended", "related", "reply", "replies", "search",
              "share", "sidebar", "signup", "site", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "widget"}
SIDE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_MARK = re.compile("[>\"']")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for name in sorted(RAW)}
_ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_OWN_MAIN = re.compile(r"<(?:article|main)[\s/>]", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
FEATURES = 26


@dataclass
class Block:
    tag: str
    parent: int
    depth: int
    words: set[str] = field(default_factory=set)
    children: list[int] = field(default_factory=list)
    runs: list[int] = field(default_factory=list)  # its own pieces of text, by place in the page
    elements: int = 1
    chars: int = 0
    linked: int = 0
    marks: int = 0
    paragraphs: int = 0
    pieces: int = 0


def tag_end(page: str, at: int, failed: set[int]) -> int:
    """Where the tag ends whose name ends at ``at``: after the first ``>`` outside quotes.

    A tag with a quote that nothing closes ends at the first ``>`` at all; a later ``>`` must exist.  ``failed``
    remembers the quotes that lead to such an end, so that no stretch of the page is read for them twice.
    """
    place, opened = at, []
    while mark := _MARK.search(page, place):
        if mark[0] == ">":
            return mark.end()
        opened.append(mark.start())
        close = -1 if mark.start() in failed else page.find(mark[0], mark.end())
        if close < 0:
            break
        place = close + 1
    failed.update(opened)
    return page.find(">", at) + 1


def tokens(page: str):
    """Tags, comments and declarations as ``(begin, end, closing, name, end of the name)``, the name None for the latter two.

    The caller may send the place to go on from.  Takes time in proportion to the page, whatever is in it.
    """
    last, failed, at = page.rfind(">"), set(), 0
    while head := _OPEN.search(page, at):
        if head[1]:
            end = page.find("-->", head.end()) + 3
            end = end if end > 2 else len(page)
        elif head.start() > last:  # no tag ends after this
            at = page.find("<!--", head.start())
            if at < 0:
                return
            continue
        else:
            end = tag_end(page, head.end(), failed) if head[3] else page.find(">", head.end()) + 1
        at = (yield head.start(), end, bool(head[2]), head[3], head.end()) or end


class Open:
    """The open elements: names with the block each belongs to, and the places of each name."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}
        self.boxes, self.barriers = [0], [0]  # places of blocks, and of those that nothing is closed beyond

    def push(self, name: str, block: int, box: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if box:
            self.boxes.append(len(self.stack))
        if name in BARRIERS or name in HIDDEN:
            self.barriers.append(len(self.stack))
        self.stack.append((name, block))

    def pop(self) -> tuple[str, bool]:
        """The innermost name, and whether it was a block."""
        name, _ = self.stack.pop()
        self.places[name].pop()
        box = self.boxes[-1] == len(self.stack)
        if box:
            self.boxes.pop()
        if self.barriers[-1] == len(self.stack):
            self.barriers.pop()
        return name, box

    def innermost(self, name: str) -> int:
        """The place of the innermost open element of a name, 0 without one."""
        return (self.places.get(name) or [0])[-1]

    def ended_by(self, name: str) -> int:
        """The outermost element that an opening tag of a block ends, 0 for none."""
        floor = self.barriers[-1]
        same = max((self.innermost(x) for x in CLOSES.get(name, ())), default=0)
        if same > floor:
            return same
        paragraphs = self.places.get("p", [])
        return next(iter(paragraphs[bisect_right(paragraphs, floor) :]), 0)


def resume(found, at: int):
    """The next token from a place on."""
    try:
        return found.send(at)
    except StopIteration:
        return None


def parse(page: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """Block elements in page order, the root first, and pieces of text ``(block, text)`` in page order."""
    blocks, pieces = [Block("#root", -1, 0)], []
    opened = Open()
    stack = opened.stack
    buffer: list[str] = []
    linked = hidden = at = 0

    def flush() -> None:
        nonlocal linked
        if hidden:  # what stands before a hidden element goes on after it
            return
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            owner = blocks[stack[-1][1]]
            owner.runs.append(len(pieces))
            owner.chars += len(text)
            owner.linked += min(linked, len(text))
            owner.marks += sum(text.count(c) for c in ".,;:?!")
            owner.pieces += 1
            pieces.append((stack[-1][1], text))
        linked = 0

    def close_to(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            if stack[-1][0] in BLOCKS:
                flush()
            if opened.pop()[0] in HIDDEN:
                hidden -= 1

    found = tokens(page)
    token = next(found, None)
    while token:
        begin, end, closing, name, named = token
        if begin > at and not hidden:
            text = page[at:begin]
            buffer.append(text)
            if opened.innermost("a"):
                linked += len(text.strip())
        at = end
        name = name and name.lower()
        if name is None:
            pass
        elif closing:
            if name == "br" and not hidden:
                buffer.append(" ")
            place = opened.innermost(name)
            if place and (name in BLOCKS or name in HIDDEN or place > opened.boxes[-1]):
                close_to(place)
        elif name in UNSEEN_VOID:
            pass
        elif name in SHOWN_VOID:
            if not hidden:
                buffer.append(" ")
        elif name == "hr":
            flush()
        elif name not in BLOCKS and name not in HIDDEN:
            opened.push(name, stack[-1][1], False)
            blocks[stack[-1][1]].elements += 1
        else:
            if name in BLOCKS:
                flush()
                if ended := opened.ended_by(name):
                    close_to(ended)
            if not (page[end - 2] == "/" and name in ("svg", "math")):
                owner = stack[-1][1]
                # Words of the attributes, those of a few names only.
                given = _ATTRIBUTE.finditer(page, named, end - 1)
                words = {w for m in given for w in _WORDS.findall("".join(g or "" for g in m.groups()).lower())}
                blocks.append(Block(name, owner, blocks[owner].depth + 1, words))
                blocks[owner].children.append(len(blocks) - 1)
                opened.push(name, len(blocks) - 1, True)
                if name in HIDDEN:
                    hidden += 1
                    if name in RAW:  # nothing in it is a tag or a comment but its own end
                        stop = _RAW_END[name].search(page, at)
                        at = stop.end() if stop else len(page)
                        close_to(len(stack) - 1)
        token = resume(found, at)
    if at < len(page) and not hidden:
        buffer.append(page[at:])
    close_to(1)
    flush()
    for i in range(len(blocks) - 1, 0, -1):  # children come after their parents
        block, up = blocks[i], blocks[blocks[i].parent]
        block.paragraphs += block.tag == "p"
        for name in ("elements", "chars", "linked", "marks", "paragraphs", "pieces"):
            setattr(up, name, getattr(up, name) + getattr(block, name))
    return blocks, pieces


def describe(blocks: list[Block]) -> np.ndarray:
    """``[blocks, FEATURES]``."""
    out = np.zeros((len(blocks), FEATURES))
    total = max(1, blocks[0].chars)
    seen = 0  # text before a block, by the order of the blocks
    above = [(False, False)] * len(blocks)
    rank = [(0, 1)] * len(blocks)
    kin: list[Counter[str]] = [Counter()] * len(blocks)  # tags of a block's children, and their text
    sums = [0] * len(blocks)
    for i, b in enumerate(blocks):
        for k, child in enumerate(b.children):
            rank[child] = (k, len(b.children))
        kin[i] = Counter(blocks[c].tag for c in b.children) or Counter([b.tag])
        sums[i] = sum(blocks[c].chars for c in b.children) if b.children else b.chars
        main, side = len(b.words & MAIN_WORDS), len(b.words & SIDE_WORDS)
        is_main, is_side = b.tag in ("article", "main"), b.tag in SIDE_TAGS
        up = above[b.parent] if b.parent >= 0 else (False, False)
        above[i] = (up[0] or is_main or main > 0, up[1] or is_side or side > 0)
        parent = blocks[b.parent] if b.parent >= 0 else b
        up_at = max(b.parent, 0)
        many = max(1, len(parent.children))
        out[i] = (
            b.depth, math.log1p(b.chars), b.chars / total, b.linked / max(1, b.chars), b.elements / max(1, b.chars) * 100,
            b.marks / max(1, b.chars) * 100, math.log1p(b.chars / max(1, b.pieces)), b.paragraphs, math.log1p(b.elements),
            b.tag == "p", b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), b.tag in ("li", "ul", "ol", "dl"), b.tag in ("div", "section"),
            is_main, is_side, main, side, up[0], up[1], rank[i][0] / rank[i][1], math.log1p(rank[i][1]),
            kin[up_at][b.tag] / many, b.chars / max(1, parent.chars),
            math.log1p(sums[up_at] / many), seen / total, len(b.runs),
        )
        seen += b.chars if not b.children else 0
    return out


@dataclass
class Trees:
    """Boosted trees as nested ``(feature, threshold, left, right)`` with numbers as leaves."""

    trees: list[tuple[float, object]]

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for weight, tree in self.trees:
            open_nodes = [(tree, np.arange(len(x)))]
            while open_nodes:
                node, rows = open_nodes.pop()
                if isinstance(node, tuple):
                    low = x[rows, node[0]] <= node[1]
                    open_nodes += [(node[2], rows[low]), (node[3], rows[~low])]
                else:
                    margin[rows] += weight * node
        return 1 / (1 + np.exp(-2 * margin))


def read_trees(text: str) -> Trees:
    """The trees of a fitted model, from its published description."""
    lines = [line.strip() for line in text.splitlines()[1:]]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= ([-\d.eE+]+)\)", line).groups()
        left = node()
        at += 1  # the Else line
        return (int(feature), float(threshold), left, node())

    trees = []
    while at < len(lines):
        head = re.match(r"Tree \d+ \(weight ([-\d.eE+]+)\):", lines[at])
        at += 1
        if head:
            trees.append((float(head[1]), node()))
    return Trees(trees)


def decode(blocks: list[Block], probability: np.ndarray, mixed_cost: float = 0.7) -> list[bool]:
    """Which blocks are *in*, by the cheapest consistent assignment of states."""
    p = np.clip(probability, 1e-3, 1 - 1e-3)
    cost_in, cost_out = -np.log(p), -np.log(1 - p)
    inside, mixed, outside = cost_in.copy(), np.full(len(blocks), mixed_cost), cost_out.copy()
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        for c in b.children:
            inside[i] += min(inside[c], outside[c])
            mixed[i] += min(inside[c], mixed[c], outside[c])
            outside[i] += outside[c]
        if not b.children:
            mixed[i] = np.inf
        if not b.chars:
            inside[i] = mixed[i] = outside[i] = 0.0
    state = [""] * len(blocks)
    for i, b in enumerate(blocks):
        above = state[b.parent] if b.parent >= 0 else "mixed"
        choices = {"mixed": ("out", "mixed", "in"), "in": ("in", "out"), "out": ("out",)}[above]
        state[i] = min(choices, key=lambda s: {"in": inside[i], "out": outside[i], "mixed": mixed[i]}[s])
    return [s == "in" for s in state]


def main_text(page: str | None, trees: Trees) -> str:
    if not page:
        return ""
    blocks, pieces = parse(page)
    kept = decode(blocks, trees.probability(describe(blocks)))
    return "\n".join(text for block, text in pieces if kept[block])


def extract(pages: DataFrame, trees: Trees, column: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text and its number of code points, ``n_chars``."""

    @F.arrow_udf("string")
    def run(source: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.record_batch([source], names=["html"]), "html", 1 << 20):
            parsed = [parse(x.as_py() or "") for x in part.column(0)]
            features = [describe(blocks) for blocks, _ in parsed]
            chances = np.split(trees.probability(np.concatenate(features)), np.cumsum([len(f) for f in features])[:-1])
            for (blocks, pieces), p in zip(parsed, chances, strict=True):
                kept = decode(blocks, p)
                out.append("\n".join(t for block, t in pieces if kept[block]))
        return pa.array(out, pa.string())

    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (text, "n_chars", "_text")]
    found = pages.select(*kept, run(F.col(column)).alias("_text"))
    names = [F.col(f"`{c}`") for c in found.columns if c != "_text"]
    return found.select(*names, F.col("_text").alias(text), F.length("_text").cast("long").alias("n_chars"))


def harvest(page: str) -> tuple[list[str], list[str]]:
    """Pieces of text inside and outside of a page's own ``article`` or ``main`` element.

    Without such an element, the inside are blocks of prose: long, with marks, few links, and in nothing that is named as a side part.
    """
    blocks, pieces = parse(page)
    inner = [False] * len(blocks)
    for i, b in enumerate(blocks):
        inner[i] = b.parent >= 0 and (inner[b.parent] or b.tag in ("article", "main"))
    if not any(inner[b] for b, _ in pieces):
        aside = [False] * len(blocks)
        for i, b in enumerate(blocks):
            aside[i] = b.parent >= 0 and aside[b.parent] or b.tag in SIDE_TAGS or bool(b.words & SIDE_WORDS)
            inner[i] = not aside[i] and bool(b.runs) and b.chars >= 60 and b.marks > 0 and b.linked <= 0.3 * b.chars
    return [t for b, t in pieces if inner[b]], [t for b, t in pieces if not inner[b]]


_MAIN = [("article", ""), ("main", ""), ("div", "article-body"), ("div", "post-content"), ("div", "entry-content"), ("section", "story"),
         ("div", "content"), ("div", "")]
_SIDE = [("nav", ""), ("div", "menu"), ("ul", "navbar"), ("header", ""), ("div", "site-header"), ("footer", ""), ("div", "footer"), ("aside", ""),
         ("div", "sidebar"), ("div", "widget"), ("div", "ad"), ("div", "advert banner"), ("div", "cookie-notice"), ("div", "notice"), ("form", ""),
         ("form", "newsletter"), ("div", "comments"), ("section", "comment-list"), ("div", "related"), ("div", "share social"), ("div", "promo")]


def invent(seed: str, main: list[str], side: list[str]) -> tuple[str, list[str]]:
    """A page made of known pieces, and the pieces of its main text in order; the same one for the same seed."""
    rng = random.Random(int(hashlib.md5(seed.encode()).hexdigest()[:12], 16))
    side = side or ["Home"]
    escape = lambda t: html.escape(t, quote=rng.random() < 0.5)

    def attribute(word: str) -> str:
        return f' class="{word}"' if word and rng.random() < 0.8 else f" id='{word.split()[0]}'" if word else ""

    def boiler(kind: tuple[str, str]) -> str:
        tag, word = kind
        own = [rng.choice(side if rng.random() < 0.6 else main)[: rng.choice([15, 30, 60, 200])] for _ in range(rng.randint(1, 6))]
        if tag in ("nav", "ul") or word in ("menu", "related", "share social", "sidebar"):
            inner = "".join(f'<li><a href="/{i}">{escape(t)}</a></li>' for i, t in enumerate(own))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif word in ("comments", "comment-list"):
            inner = "".join(f'<div class="comment"><b>user{i}</b><p>{escape(rng.choice(main)[:300])}</p></div>' for i, t in enumerate(own))
        elif tag == "form":
            inner = f"<label>{escape(own[0])}</label><input type=text><button>ok</button>"
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<p>{}</p>", "<span>{}</span>"]).format(escape(own[0]))
        return f"<{tag}{attribute(word)}>{inner}</{tag}>"

    tag, word = rng.choice(_MAIN)
    chosen = [t for t in main if t][: rng.choice([1, 3, 8, 40])] or ["text"]
    body, kept = [], []
    for i, text in enumerate(chosen):
        shape = "<h1>{}</h1>" if i == 0 and rng.random() < 0.7 else rng.choice(["<p>{}</p>"] * 8 + ["<p><b>{}<br>", "<div>{}</div>", "<blockquote>{}</blockquote>", "<h2>{}</h2>"])
        body.append(shape.format(escape(text)))
        kept.append(text)
        if rng.random() < 0.06:
            body.append(boiler(rng.choice(_SIDE[10:])))
    article = f"<{tag}{attribute(word)}>{''.join(body)}</{tag}>"
    before = "".join(boiler(rng.choice(_SIDE)) for _ in range(rng.randint(0, 4)))
    after = "".join(boiler(rng.choice(_SIDE)) for _ in range(rng.randint(0, 4)))
    middle = f"{before}{article}{after}"
    for _ in range(rng.randint(0, 2)):
        middle = f"<div{attribute(rng.choice(['', 'wrapper', 'container', 'page']))}>{middle}</div>"
    return f"<!DOCTYPE html><html><head><title>{escape(chosen[0][:60])}</title><style>p{{}}</style></head><body>{middle}</body></html>", kept


def labelled_blocks(page: str, main: list[str]) -> list[tuple[list[float], float]]:
    """Features and label of each block with text; one is main if its text is, but for a tenth."""
    blocks, pieces = parse(page)
    good = [0] * len(blocks)
    at = 0
    for block, text in pieces:  # the main pieces occur in order
        if at < len(main) and text == " ".join(main[at].split()):
            at += 1
            while block >= 0:
                good[block] += len(text)
                block = blocks[block].parent
    x = describe(blocks)
    return [(x[i].tolist(), float(good[i] >= 0.9 * b.chars)) for i, b in enumerate(blocks) if b.chars]


def derived_pages(pages: DataFrame, key: str = "page_id", column: str = "html", sample: int = 500) -> DataFrame:
    """Labelled blocks ``(label, features)`` of at most ``sample`` pages and of pages made from their pieces."""
    whole = pages.filter(F.length(column) > 0).select(F.col(key).cast("string").alias("k"), F.col(column).alias("h")).withColumn("x", F.xxhash64("h"))
    picked = smallest_by_hash(whole.select("k", "x").distinct(), sample, "k", "x", seed=8)
    # At most ``sample`` short rows are broadcast.
    same = F.col("k").eqNullSafe(F.col("pk")) & (F.col("x") == F.col("px"))
    chosen = whole.join(F.broadcast(picked.toDF("pk", "px")), same, "left_semi").dropDuplicates(["k", "x"]).select("k", "h")

    def build(batches):
        for batch in batches:
            rows = []
            for k, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                main, side = harvest(page)
                if not main:
                    continue
                made = [invent(f"{k}-{i}", main, side) for i in range(2)]
                own = [(page, main)] if _OWN_MAIN.search(page) else []  # else its own labels are but a guess
                for source, kept in [*made, *own]:
                    rows += [{"label": label, "features": x} for x, label in labelled_blocks(source, kept)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("label", pa.float64()), ("features", pa.list_(pa.float64()))]))

    return chosen.mapInArrow(build, "label double, features array<double>")


def train(labelled: DataFrame, rounds: int = 15, depth: int = 4) -> Trees:
    """Boosted trees from labelled blocks; without blocks of both kinds, trees that find no main text."""
    data = labelled.select("label", array_to_vector("features").alias("features")).persist()
    try:
        if data.select("label").distinct().count() < 2:
            return Trees([(1.0, -1.0)])
        model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=19, minInstancesPerNode=5).fit(data)
        return read_trees(model.toDebugString)
    finally:
        data.unpersist()
