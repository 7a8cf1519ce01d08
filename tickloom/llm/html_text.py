"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks with their place in the document tree. A classifier gives each block the
cost of calling it content and of calling it boilerplate; these are its capacities to the two terminals.
Neighbouring blocks and blocks under one parent are joined by edges whose capacity grows with how much of
their tree path they share. The minimum cut, found by maximum flow, is the cheapest labelling in which close
blocks agree. The classifier is a logistic regression over what the text is like and what the tree says (an
article, a menu, an advert). The odds of tags and words below are its prior: they are the costs of what the
training never saw, and the training says how far tags and names are to be trusted.

It learns from pages whose tree labels most blocks clearly, and from copies of them in which the tags and names
of some elements are forgotten and a few names are exchanged, under the labels of the whole page. So costs are
moderate where the tree says little, and there the edges count; how much is fitted on the same copies.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NAME = re.compile(r"<(/?)([a-z][a-z0-9:-]*)", re.I)
_PART = re.compile(r"[^>=]*+(?:(>)|=\s*+([\"']?))")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "template", "noscript", "textarea", "svg", "iframe")}
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Log odds of content for a block below a tag, and below an element named with a word.
TAG_ODDS = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "button": -9.0, "select": -9.0}
TAG_ODDS |= {"head": -20.0, "title": -20.0, "menu": -9.0, "dialog": -9.0, "header": -3.0, "h1": 1.0, "blockquote": 1.0, "figcaption": -0.5, "p": 1.5, "pre": 1.5, "h2": 1.0, "h3": 1.0}
PROSE = frozenset("h1 h2 h3 blockquote figcaption p pre".split())
WORD_ODDS = dict.fromkeys(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer comment comments reply replies disqus cookie cookies consent notice notices popup modal newsletter subscribe signup login "
    "share sharing social related recommended widget toolbar pagination pager copyright legal disclaimer alert form search".split(),
    -9.0,
)
WORD_ODDS |= dict.fromkeys("article content entry post story main maincontent articlebody".split(), 3.0)


#: Odds by the elements around a block: the strongest tag or name for content, sums of tags and of names against it,
#: sum of the tags of running text.
Tree = tuple[float, float, float, float]
TEXT, TREE = 9, 4


@dataclass
class Block:
    text: str
    element: int  # number of the element that the block stands in, and of that one's parent
    parent: int
    depth: int  # how many elements are open, and how many of these were open since the block before
    common: int
    tree: Tree  # what the tree says
    link_share: float
    tag: str

    @property
    def odds(self) -> float:
        """Log odds of content by the prior."""
        return sum(self.tree)


@dataclass(frozen=True)
class Model:
    """Weights of the features of text and tree, and the capacity of an edge between blocks of one element."""

    weights: np.ndarray
    smooth: float


def name_odds(attributes: str) -> float:
    """Log odds by the words of an element's names.

    A name speaks against content if half of its words or more do and none speaks for it, so that one word of a long
    name decides nothing. The strongest name against content counts, or else the strongest for it.
    """
    found = []
    for name in " ".join("".join(g) for g in _NAMED.findall(attributes)).lower().split():
        odds = [WORD_ODDS.get(w, 0.0) for w in _WORD.findall(name)]
        against = sum(o < 0 for o in odds)
        if max(odds, default=0.0) > 0:
            found.append(max(odds) if not against else 0.0)
        elif against and 2 * against >= len(odds):
            found.append(min(odds))
    return min(found, default=0.0) if min(found, default=0.0) < 0 else max(found, default=0.0)


def hidden(attributes: str) -> bool:
    """Whether an element's own attributes hide it."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


def _tag_end(page: str, at: int, unpaired: set[str]) -> int:
    """The end of the tag whose name ends at ``at``, or -1; quotes count behind = and where they are closed."""
    begin = at
    while m := _PART.match(page, at):
        at = m.end()
        if m[1]:
            return at
        if m[2] and m[2] not in unpaired:
            close = page.find(m[2], at)
            if close < 0:
                unpaired.add(m[2])
            else:
                at = close + 1
    return page.find(">", begin) + 1 or -1


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of a page's tags in time that grows with its length.

    Comments, declarations and elements whose content is no text have an empty name; a tag without end is text.
    """
    at, unpaired = page.find("<"), set()
    while at >= 0:
        end, name, closing, attributes = -1, "", False, ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            end = end if end > 2 else len(page)
        elif m := _NAME.match(page, at):
            end, name, closing = _tag_end(page, m.end(), unpaired), m[2].lower(), bool(m[1])
            if end < 0:
                return
            attributes = page[m.end() : end - 1]
            if name in _RAW_END and not closing:
                ends = _RAW_END[name].search(page, end)
                end, name = (ends.end() if ends else len(page)), ""
        elif page[at + 1 : at + 2] in ("!", "?", "/"):
            end = page.find(">", at) + 1
            if not end:
                return
        if end >= 0:
            yield at, end, name, closing, attributes
        at = page.find("<", max(end, at + 1))


def blocks(page: str, seen: Callable[[str, str], tuple[str, str]] | None = None) -> list[Block]:
    """Text blocks in page order; scripts, styles, markup and hidden parts are left out.

    ``seen`` says which tag and attributes an element is taken to have when odds are given, blocks stay the same.
    """
    out: list[Block] = []
    # tag, number, odds of it and what is around it, whether it is hidden, whether it lies in an article
    stack: list[tuple[str, int, Tree, bool, bool]] = [("", 0, (0.0,) * TREE, False, False)]
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    linked, serial, in_link, common = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked, common
        raw = "".join(parts)
        text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        tag, number, tree, unseen, _ = stack[-1]
        if text and not unseen:
            parent = stack[-2][1] if len(stack) > 1 else -1
            depth = len(stack) - 1
            out.append(Block(text, number, parent, depth, common, tree, min(1.0, linked / len(text)), tag))
            common = depth
        parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal common
        open_tags[stack.pop()[0]] -= 1
        common = min(common, len(stack) - 1)

    done = 0
    for start, end, tag, closing, attributes in tags(page):
        if start > done:
            parts.append(page[done:start])
            if in_link:
                linked += start - done
        done = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if closing:
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            in_link = 0
        elif tag not in VOID:
            if stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                pop()
            _, _, around, unseen, in_article = stack[-1]
            kind, names = seen(tag, attributes) if seen else (tag, attributes)
            tagged = 0.0 if kind == "header" and in_article else TAG_ODDS.get(kind, 0.0)
            named = name_odds(names) if names else 0.0
            if kind in ("article", "main", "body", "html"):
                named = max(named, 0.0)
            tree = around
            if tagged or named:
                prose = tagged if kind in PROSE else 0.0
                tagged -= prose
                tree = (max(around[0], tagged, named), around[1] + min(tagged, 0.0), around[2] + min(named, 0.0), around[3] + prose)
            unseen = unseen or hidden(attributes)
            serial += 1
            if not attributes.endswith("/"):
                stack.append((tag, serial, tree, unseen, in_article or kind == "article"))
                open_tags[tag] = open_tags.get(tag, 0) + 1
    if done < len(page):
        parts.append(page[done:])
    flush()
    return out


def text_features(found: list[Block]) -> np.ndarray:
    """What each block's text is like: length, words, links, sentence marks, digits, and the same of its neighbours."""
    if not found:
        return np.zeros((0, 9))
    own = np.array(
        [
            [
                np.log1p(len(b.text)),
                np.log1p(b.text.count(" ") + 1),
                b.link_share,
                b.text[-1] in ".!?…",
                min(1.0, sum(map(b.text.count, ".,;")) / (b.text.count(" ") + 1)),
                "©" in b.text or "|" in b.text,
            ]
            for b in found
        ],
        float,
    )
    before, after = np.roll(own[:, :1], 1, 0), np.roll(own[:, :1], -1, 0)
    before[0] = after[-1] = 0
    return np.hstack([own, before, after, np.ones((len(found), 1))])


def features(found: list[Block]) -> np.ndarray:
    """Features of the text, then odds of the tree, bounded so that deep nesting is not endless trust."""
    tree = np.array([b.tree for b in found], float).reshape(len(found), TREE)
    return np.hstack([text_features(found), np.clip(tree, -20.0, [4.0, 0.0, 0.0, 2.0])])


def costs(found: list[Block], weights: np.ndarray) -> np.ndarray:
    """Log odds of content. What a text is like has a bounded say. Weights of the text alone leave the tree's at the prior."""
    given = features(found)
    return np.clip(given[:, :TEXT] @ weights[:TEXT], -1.4, 2.5) + given[:, TEXT:] @ [*weights[TEXT:], *PRIOR[len(weights) :]]


PRIOR = np.repeat([0.0, 1.0], [TEXT, TREE])
#: How far the tree is trusted at least and at most. A block of comments in an article stays out within these bounds
#: whatever its text is like, edges aside: 0.85 * 9 > 0.75 * 4 + 1.5 + 2.5. A paragraph in nothing that has a telling tag
#: or name is content: 0.95 * 1.5 > 1.4.
TRUST = np.array([[0.25, 0.85, 0.85, 0.95], [0.75, 1.0, 1.0, 1.0]])


def fit(features: np.ndarray, labels: np.ndarray, counts: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic regression of rows that stand for ``counts`` blocks each, by Newton steps with a small pull to the prior."""
    w = PRIOR.copy()
    if len(np.unique(labels)) < 2:
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        hessian = features.T @ (features * (counts * p * (1 - p))[:, None]) + 1.0 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, features.T @ (counts * (labels - p)) - 1.0 * (w - PRIOR))
        w[TEXT:] = np.clip(w[TEXT:], *TRUST)
    return w


def forgetful(rng: np.random.Generator, share: float = 0.5, wrong: float = 0.05) -> Callable[[str, str], tuple[str, str]]:
    """Elements lose their telling tag, and their names, with a chance of ``share`` each, or get a name of the other kind."""

    def seen(tag: str, attributes: str) -> tuple[str, str]:
        lost, kept, swapped = rng.random(3)
        odds = name_odds(attributes) if attributes else 0.0
        if odds and swapped < wrong:
            attributes = 'class="ad"' if odds > 0 else 'class="content"'
        elif kept < share:
            attributes = ""
        return ("div" if lost < share and tag in TAG_ODDS and tag not in ("title", "head") else tag), attributes

    return seen


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut; edges carry their capacity both ways.

    A node whose own preference exceeds all its edges together is settled, and its edges then count for its
    neighbours' preferences. What is left falls into small connected parts, and each is cut by maximum flow.
    """
    n, eps = len(source), 1e-9
    net = [a - b for a, b in zip(source, sink, strict=True)]
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        room[i][j] = room[i].get(j, 0.0) + c
        room[j][i] = room[j].get(i, 0.0) + c
    bound = [sum(r.values()) for r in room]
    label: list[bool | None] = [None] * n
    waiting = list(range(n))
    while waiting:
        i = waiting.pop()
        if label[i] is not None or abs(net[i]) <= bound[i] + eps:
            continue
        label[i] = net[i] > 0
        for j, c in room[i].items():
            del room[j][i]
            net[j] += c if label[i] else -c
            bound[j] -= c
            waiting.append(j)
        room[i] = {}
    for i in range(n):
        if label[i] is None:
            part, seen = [i], {i}
            for x in part:
                for y in room[x]:
                    if y not in seen:
                        seen.add(y)
                        part.append(y)
            kept = _source_side(part, net, room)
            for x in part:
                label[x] = x in kept
    return [bool(x) for x in label]


def _source_side(part: list[int], net: list[float], room: list[dict[int, float]]) -> set[int]:
    """Nodes of one connected part that still reach the source after a maximum flow.

    Each node's surplus goes by shortest augmenting paths from it, so a search stays near. What a search without a
    path has seen has no way out any more and is not searched again.
    """
    eps = 1e-9
    left = {i: max(0.0, net[i]) for i in part}  # from the source
    need = {i: max(0.0, -net[i]) for i in part}  # to the sink
    closed: set[int] = set()
    for start in part:
        while left[start] > eps and start not in closed:
            came, queue, end = {start: -1}, deque([start]), -1
            while queue and end < 0:
                i = queue.popleft()
                for j, c in room[i].items():
                    if c > eps and j not in came and j not in closed:
                        came[j] = i
                        queue.append(j)
                        if need[j] > eps:
                            end = j
                            break
            if end < 0:
                closed.update(came)
                break
            path = [end]
            while path[-1] != start:
                path.append(came[path[-1]])
            steps = list(zip(path[1:], path, strict=False))
            flow = min(left[start], need[end], *(room[i][j] for i, j in steps))
            left[start] -= flow
            need[end] -= flow
            for i, j in steps:
                room[i][j] -= flow
                room[j][i] += flow
    return closed


def label(found: list[Block], weights: np.ndarray, smooth: float) -> list[bool]:
    """Whether each block is content, by the minimum cut."""
    odds = costs(found, weights)
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:  # the share of the longer tree path that two neighbours have in common
            edges.append((i - 1, i, smooth * (b.common + 1) / (max(b.depth, found[i - 1].depth) + 1)))
        if (before := last.get(b.parent)) is not None and before < i - 1:
            same = b.depth if b.element == found[before].element else b.depth - 1
            edges.append((before, i, smooth * (same + 1) / (b.depth + 1) / 2))
        last[b.parent] = i
    return min_cut(np.maximum(odds, 0).tolist(), np.maximum(-odds, 0).tolist(), edges)


def main_text(page: str | None, weights: np.ndarray, smooth: float = 1.5) -> str:
    """Content blocks of a page, one per line."""
    found = blocks(page or "")
    return "\n".join(b.text for b, kept in zip(found, label(found, weights, smooth), strict=True) if kept) if found else ""


def examples(page: str, page_seed: int, copies: int) -> Iterator[tuple[list[Block], list[int | None]]]:
    """A page and its forgetful copies, each with the labels of the whole page; None where the tree is not clear."""
    whole = blocks(page)
    labels = [int(b.odds > 0) if abs(b.odds) >= 2 else None for b in whole]
    rng = np.random.default_rng(page_seed % (1 << 32))
    for n in range(copies + 1):
        yield (blocks(page, forgetful(rng)) if n else whole), labels


SMOOTH = (0.25, 0.5, 0.75, 1.0, 1.25, 1.5)


def agreement(pages: DataFrame, weights: np.ndarray, smooth: tuple[float, ...], copies: int = 2) -> dict[float, tuple[int, int, int]]:
    """For each edge capacity: (blocks of forgetful copies, labelled right by the cut, labelled other than by their own cost).

    ``pages`` has the columns (html, seed).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(smooth), 3), int)
        for batch in batches:
            for page, seed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for n, (found, labels) in enumerate(examples(page, seed, copies)):
                    if not n or not found:
                        continue
                    alone = costs(found, weights) > 0
                    for at, c in enumerate(smooth):
                        cut = label(found, weights, c)
                        clear = [(x, y, z) for x, y, z in zip(cut, labels, alone, strict=True) if y is not None]
                        sums[at] += (len(clear), sum(x == y for x, y, _ in clear), sum(x != z for x, _, z in clear))
        yield pa.RecordBatch.from_arrays([pa.array(smooth), *(pa.array(sums[:, i]) for i in range(3))], ["smooth", "n", "right", "moved"])

    rows = pages.mapInArrow(run, "smooth double, n long, right long, moved long").groupBy("smooth").sum("n", "right", "moved").collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def sample(pages: DataFrame, id_col: str, html_col: str, max_pages: int) -> DataFrame:
    """(html, seed) of about ``max_pages`` pages, chosen by a hash of their id."""
    picked = pages.select(F.xxhash64(F.col(id_col)).alias("seed"), F.col(html_col).alias("html")).where("html IS NOT NULL")
    share = max_pages / max(1, picked.count())
    draw = F.pmod(F.col("seed"), F.lit(1 << 30)) / float(1 << 30)
    return picked.where(draw < share).select("html", "seed").limit(2 * max_pages)


def train(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 600, max_rows: int = 60_000, copies: int = 2
) -> Model:
    """The model from about ``max_pages`` pages, chosen by a hash of their id.

    Equal feature rows are counted in Spark; at most ``max_rows`` different ones are used, chosen by a hash.

    Blocks that the tree of the whole page marks clearly either way are the examples, as the page has them and as
    ``copies`` forgetful copies have them. The capacity of edges is the one of ``SMOOTH`` that labels most blocks of
    the copies right, the smallest of equals.
    """
    picked = sample(pages, id_col, html_col, max_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, seed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for found, labels in examples(page, seed, copies):
                    rows += [(f.tolist(), y) for f, y in zip(features(found), labels, strict=True) if y is not None]
            f, y = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.list_(pa.float64())), pa.array(y, pa.int32())], ["f", "y"])

    rows = picked.mapInArrow(run, "f array<double>, y int")
    sums = rows.groupBy("f", "y").count().orderBy(F.xxhash64("f", "y"), "f", "y").limit(max_rows).collect()
    table = np.array([r.f for r in sums], float).reshape(len(sums), TEXT + TREE)
    weights = fit(table, np.array([r.y for r in sums]), np.array([r[2] for r in sums], float))
    right = {c: found[1] for c, found in agreement(picked, weights, SMOOTH, copies).items()}
    return Model(weights, max(sorted(right), key=right.get) if any(right.values()) else 1.5)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Model | None = None
) -> DataFrame:
    """(page_id, url, text, n_chars) for every row.

    A null or empty page, and one whose blocks are all boilerplate, has an empty text. Broken markup is read
    as browsers do: unclosed elements end with their parents, a tag without end is text. Repeated rows come
    back as often as they went in, null ids and urls stay null, other columns are not read, an empty table
    gives an empty result. Whole pages are read, however long, in time that grows with their length.
    """
    model = train(pages, id_col, html_col) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, model.weights, model.smooth) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("h"))
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
