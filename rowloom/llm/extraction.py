"""The main text of web pages, by a graphical model over the tree of their blocks.

Every node of a page's tree (``dom.parse``) is a variable: main text or not. A node has a potential from
what it is and holds (element, words of its class and id, length, share of links, place), and each edge one from the
states of parent and child and the kind of the child. Messages go up the tree and down again (sum-product), which gives
each node's exact marginal; the leaves above one half, joined in the order of the page, are the text.

The weights are learned here, by maximum likelihood with the same messages, from labelled pages: pages whose
elements carry ``data-kind="main"`` or ``data-kind="other"``. ``labelled_pages`` makes a set of them by rule, from a
seed; other labelled pages may be given instead.
"""

from __future__ import annotations

import random
from bisect import bisect
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm import dom
from rowloom.llm.common import whole_text

MARK, MAIN = "data-kind", "main"
#: Bytes of pages that are worked on together.
PORTION = 1 << 21
#: Labelled pages that are made, their seed, and the steps and the restraint of learning.
PAGES, SEED, STEPS, RESTRAINT = 1000, 13, 120, 0.0003
#: A feature counts if it is on so many of the labelled pages.
LEAST_PAGES = 4
#: Bounds between the steps of a feature's value: words, their share of the page's, the share of characters in links,
#: the share of the page before a node, short blocks, shares of blocks that are links and that end like sentences.
LENGTHS, SHARES, LINKS = [1, 3, 6, 12, 25, 50, 100, 400], [0.02, 0.1, 0.3, 0.6], [0.05, 0.3, 0.6, 0.9]
PLACES, SHORT, MOST, ENDED = [0.02, 0.3, 0.7, 0.95], [4, 12], [0.3, 0.7], [0.1, 0.4, 0.8]
#: Kinds of edges, by the child.
LEAF, ITEM, TOP, REST = KINDS = range(4)
PAGE = frozenset(["#page", "html", "body"])
ITEMS = dom.IMPLIED | {"pre", "blockquote", "figcaption", "summary", "caption", "address"}


# Words that pages use to name their parts.
MAIN_CUES = "content article post entry story text body main page single prose markdown document".split()
MENU_CUES = "nav menu navbar navigation breadcrumb breadcrumbs topbar links tabs pager pagination".split()
HEAD_CUES = "header masthead banner top branding logo site tagline".split()
FOOT_CUES = "footer copyright colophon legal bottom credits imprint".split()
SIDE_CUES = "sidebar aside widget related rail trending popular recommended archive tags secondary".split()
NOTICE_CUES = "notice cookie consent alert warning message banner popup modal gdpr disclaimer".split()
AD_CUES = "ad ads advert advertisement sponsored sponsor promo promotion adsense banner".split()
FORM_CUES = "form search newsletter subscribe signup login contact".split()
COMMENT_CUES = "comments comment commentlist replies reply responses discussion respond disqus thread".split()
SHARE_CUES = "share social sharing follow byline meta".split()
CUE_GROUPS = {
    "main": MAIN_CUES, "menu": MENU_CUES, "head": HEAD_CUES, "foot": FOOT_CUES, "side": SIDE_CUES, "notice": NOTICE_CUES,
    "advert": AD_CUES, "form": FORM_CUES, "comment": COMMENT_CUES, "share": SHARE_CUES,
}
GROUPS_OF: dict[str, list[str]] = {}
for _group, _cues in CUE_GROUPS.items():
    for _cue in _cues:
        GROUPS_OF.setdefault(_cue, []).append(_group)


@dataclass(frozen=True)
class Model:
    """Weights of features in favour of main text, and of the states (parent, child) per kind of edge."""

    features: dict[str, float]
    edges: np.ndarray


def features_of(tree: dom.Tree) -> list[list[str]]:
    """Names of the features of each node."""
    n = len(tree.parent)
    words, chars, linked, controls, sentences, leaves, links = ([0] * n for _ in range(7))
    before, seen = [0] * n, 0
    for i in range(n):
        before[i] = seen
        if text := tree.text[i]:
            words[i] = text.count(" ") + 1
            chars[i], linked[i], leaves[i] = len(text), tree.linked[i], 1
            sentences[i] = int(text[-1] in ".!?…:\"'”»" and words[i] > 3)
            links[i] = int(2 * linked[i] > chars[i])
            seen += words[i]
        controls[i] = tree.controls[i]
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        for column in (words, chars, linked, controls, sentences, leaves, links):
            column[up] += column[i]
    out, total = [], max(words[0], 1)
    for i in range(n):
        tag = tree.tag[i]
        share = linked[i] / chars[i] if chars[i] else 0
        own = [
            f"is {tag}",
            f"words {bisect(LENGTHS, words[i])}",
            f"share {bisect(SHARES, words[i] / total)}",
            f"links {bisect(LINKS, share)}",
            f"place {bisect(PLACES, before[i] / total)}",
        ]
        if tag == "#text":
            own += [f"{'ends' if sentences[i] else 'stops'} {bisect(SHORT, words[i])}"]
            own += ["copyright"] * ("©" in tree.text[i] or "(c)" in tree.text[i])
        else:
            own += [f"{tag} links {bisect(MOST, links[i] / leaves[i]) if leaves[i] else 3}"]
            own += [f"sentences {bisect(ENDED, sentences[i] / leaves[i]) if leaves[i] else 4}"]
            own += ["controls"] * (4 * controls[i] > leaves[i])
            if tree.cues[i]:
                own += [f"cue {c}" for c in set(tree.cues[i])]
                own += {f"names {g}" for c in tree.cues[i] for g in GROUPS_OF.get(c, ())}
        out.append(own)
    return out


@dataclass
class Forest:
    """Several trees as one, for work on all nodes of a depth at a time."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]  # nodes of depth 1, 2, ...
    node: np.ndarray  # of each feature
    feature: np.ndarray

    @classmethod
    def of(cls, trees: Sequence[dom.Tree], numbers: dict[str, int]) -> Forest:
        parent, kind, depth, node, feature, start = [], [], [], [], [], 0
        for tree in trees:
            for i, names in enumerate(features_of(tree)):
                up = tree.parent[i]
                parent.append(start + up if i else -1)
                depth.append(depth[start + up] + 1 if i else 0)
                tag = tree.tag[i]
                kind.append(LEAF if tag == "#text" else ITEM if tag in ITEMS else TOP if tree.tag[up] in PAGE else REST)
                for name in names:
                    number = numbers.get(name)
                    if number is not None:
                        node.append(start + i)
                        feature.append(number)
            start += len(tree.parent)
        depths = np.array(depth, np.int64)
        order = np.argsort(depths, kind="stable")
        cuts = np.searchsorted(depths[order], np.arange(1, depths.max(initial=0) + 2))
        levels = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        arrays = (np.array(x, np.int64) for x in (node, feature))
        return cls(np.array(parent, np.int64), np.array(kind, np.int64), levels, *arrays)

    def potentials(self, weights: np.ndarray) -> np.ndarray:
        """Log potentials of each node: 0 for the rest, the sum of its features' weights for main text."""
        out = np.zeros((len(self.parent), 2))
        out[:, 1] = np.bincount(self.node, weights[self.feature], len(self.parent))
        return out

    def marginals(self, potentials: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node's states, and of the states (parent, child) of each node and its parent; zero for roots."""
        up = potentials.copy()  # the node's own potential and the messages of its children
        sent = np.zeros_like(up)
        for level in reversed(self.levels):
            both = edges[self.kind[level]] + up[level][:, None, :]
            sent[level] = message = np.logaddexp(both[:, :, 0], both[:, :, 1])
            np.add.at(up, self.parent[level], message)
        belief, pairs = up.copy(), np.zeros((len(up), 2, 2))
        for level in self.levels:
            above = belief[self.parent[level]] - sent[level]  # all but what came from this child
            both = above[:, :, None] + edges[self.kind[level]] + up[level][:, None, :]
            pairs[level] = both
            belief[level] = np.logaddexp(both[:, 0], both[:, 1])
        total = np.logaddexp(belief[:, 0], belief[:, 1])  # the same for all nodes of a tree
        pairs = np.exp(pairs - total[:, None, None])
        pairs[self.parent < 0] = 0
        return np.exp(belief - total[:, None]), pairs


def states_of(tree: dom.Tree) -> np.ndarray:
    """The labels of a labelled page's nodes: leaves by their mark, elements by most of their words."""
    n = len(tree.parent)
    main, words = np.zeros(n), np.zeros(n)
    for i in range(n - 1, -1, -1):
        if tree.text[i]:
            words[i] = tree.text[i].count(" ") + 1
            main[i] = words[i] * (tree.mark[i] == MAIN)
        if i:
            main[tree.parent[i]] += main[i]
            words[tree.parent[i]] += words[i]
    return (2 * main > words).astype(np.int64)


def learn(pages: Sequence[str], steps: int = STEPS, restraint: float = RESTRAINT) -> Model:
    """The model under which the states of the labelled pages are likeliest, weights held small."""
    trees = [dom.parse(p, MARK) for p in pages]
    on_pages = Counter(chain.from_iterable({name for own in features_of(t) for name in own} for t in trees))
    numbers = {name: i for i, name in enumerate(sorted(name for name, n in on_pages.items() if n >= LEAST_PAGES))}
    forest = Forest.of(trees, numbers)
    states = np.concatenate([states_of(t) for t in trees])
    inner = np.nonzero(forest.parent >= 0)[0]
    seen = np.zeros((len(KINDS), 2, 2))
    np.add.at(seen, (forest.kind[inner], states[forest.parent[inner]], states[inner]), 1)
    counts = np.bincount(forest.feature, states[forest.node], len(numbers))
    weights = np.zeros(len(numbers) + seen.size)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        edges = weights[len(numbers) :].reshape(seen.shape)
        node, pairs = forest.marginals(forest.potentials(weights[: len(numbers)]), edges)
        expected = np.zeros_like(seen)
        np.add.at(expected, forest.kind[inner], pairs[inner])
        slope = np.concatenate(
            [counts - np.bincount(forest.feature, node[forest.node, 1], len(numbers)), (seen - expected).ravel()]
        )
        slope = slope / len(pages) - restraint * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights += 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(numbers, weights.tolist())), weights[len(numbers) :].reshape(seen.shape))


class Reader:
    """A model ready for use in a task."""

    def __init__(self, model: Model) -> None:
        self.numbers = {name: i for i, name in enumerate(model.features)}
        self.weights, self.edges = np.array(list(model.features.values()) or [0.0]), model.edges

    def read(self, pages: Sequence[str]) -> list[tuple[str, list[float]]]:
        """The main text of each page, and the marginals of all its blocks of text."""
        trees = [dom.parse(p) for p in pages]
        forest = Forest.of(trees, self.numbers)
        node, _ = forest.marginals(forest.potentials(self.weights), self.edges)
        out, start = [], 0
        for tree in trees:
            own = node[start : start + len(tree.parent), 1].tolist()
            blocks = [(text, p) for text, p in zip(tree.text, own) if text]
            out.append((" ".join([text for text, p in blocks if p > 0.5]), [p for _, p in blocks]))
            start += len(tree.parent)
        return out


@lru_cache(maxsize=1)
def trained_model() -> Model:
    """The model of the pages that ``labelled_pages`` makes."""
    return learn(labelled_pages())


def extract_main_text(
    pages: DataFrame, model: Model | None = None, *, keep: Sequence[str] = ("page_id", "url"), html_column: str = "html"
) -> DataFrame:
    """(row, text, marginals) for every row of ``pages``: ``row`` holds the columns ``keep``.

    ``text`` is the main text: character references decoded, white space inside a block one blank, blocks in the
    order of the page, joined by one blank. ``marginals`` are those of all blocks of text, kept or not.

    A null or empty page, or one without text, gives the empty text. Null ids and repeated rows stay; columns not in
    ``keep`` are not read, whatever their names; an empty table gives no rows. A block at exactly one half is left
    out. Pages are worked on in portions of about ``PORTION`` bytes, a longer page alone, in time and memory that grow
    with their length, however deep or broken.
    """
    own = model or trained_model()
    row = F.struct(*(F.col(c) for c in keep)).alias("row")
    schema = pages.select(row).schema
    kind = schema["row"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(own)
        for batch in batches:
            sizes = np.cumsum([0, *pc.binary_length(batch.column(1)).to_pylist()])
            start = 0
            while start < batch.num_rows:
                stop = max(int(np.searchsorted(sizes, sizes[start] + PORTION, "right")) - 1, start + 1)
                found = reader.read(batch.column(1).slice(start, stop - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array([text for text, _ in found], pa.string()),
                        pa.array([p for _, p in found], pa.list_(pa.float64())),
                    ],
                    ["row", "text", "marginals"],
                )
                start = stop

    return pages.select(row, whole_text(html_column).alias("html")).mapInArrow(
        read, f"row {kind}, text string, marginals array<double>"
    )


# ---- labelled pages, made by rule

class PageMaker:
    """Pages of many layouts, each element marked as main text or not."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choice(["ka", "lo", "mi", "ten", "ra", "su", "vel", "o", "din", "er"]) for _ in range(self.rng.randint(1, 4)))

    def words(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most)))

    def prose(self, least: int, most: int) -> str:
        end = lambda: self.rng.choice([".", ".", ".", "!", "?", ".&nbsp;"])
        return " ".join(self.words(1, 18).capitalize() + end() for _ in range(self.rng.randint(least, most)))

    def linked(self, text: str) -> str:
        return f'<a href="/{self.word()}">{text}</a>'

    def cue(self, names: list[str]) -> str:
        name = self.rng.choice(names)
        extra = self.rng.choice(["", "", "", self.word() + "-", "site-", "block-", "page-", "wp-"])
        if extra == "page-" and names is MAIN_CUES:
            extra = ""
        whole = f"{extra}{name}" if self.rng.random() < 0.7 else f"{name}-{self.rng.choice(['box', 'area', 'list', 'wrap', self.word()])}"
        return f' {self.rng.choice(["class", "class", "id"])}="{whole}"'

    def part(self, kind: str, tags: Sequence[str], cues: list[str], inside: str, plain: float = 0.0) -> str:
        """An element; without a cue only if its tag tells enough, or with the chance ``plain``."""
        tag = self.rng.choice(tags)
        named = self.rng.random() >= (0.5 if tag not in ("div", "section", "ul", "ol", "p", "td") else plain)
        return f'<{tag}{self.cue(cues) if named else ""} {MARK}="{kind}">{inside}</{tag}>'

    def link_list(self) -> str:
        items = [self.linked(self.words(1, 4)) for _ in range(self.rng.randint(2, 9))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.rng.choice([" | ", " ", " &middot; "]).join(items)

    def menu(self) -> str:
        return self.part("other", ["nav", "nav", "div", "ul", "header"], MENU_CUES, self.link_list(), 0.3)

    def header(self) -> str:
        title = self.rng.choice([f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(1, 6)}</p>", self.linked(self.words(1, 3))])
        tagline = self.rng.choice(["", f"<p>{self.prose(1, 1)}</p>", self.link_list()])
        return self.part("other", ["header", "div"], HEAD_CUES, title + tagline)

    def footer(self) -> str:
        inside = self.rng.choice([
            f"&copy; {self.word()}.com &middot; {self.prose(1, 2)}",
            f"<p>&copy; {self.words(1, 4)}. All rights reserved.</p>{self.link_list()}",
            f"{self.link_list()}<p>{self.prose(1, 3)}</p>",
            f"<div>{self.prose(1, 2)}</div><div>{self.link_list()}</div>",
        ])
        return self.part("other", ["footer", "footer", "div"], FOOT_CUES, inside)

    def sidebar(self) -> str:
        inside = f"<h3>{self.words(1, 3)}</h3>" + self.rng.choice([self.link_list(), f"<p>{self.prose(1, 4)}</p>", f"<p>{self.prose(1, 2)}</p>{self.link_list()}"])
        return self.part("other", ["aside", "aside", "div", "section"], SIDE_CUES, inside)

    def advert(self) -> str:
        inside = self.rng.choice([self.prose(1, 3), f"<p>{self.prose(1, 2)}</p>", self.linked(self.words(2, 8)), f"<h4>{self.words(2, 5)}</h4><p>{self.prose(1, 2)}</p>"])
        return self.part("other", ["div", "div", "section", "p", "aside"], AD_CUES, inside)

    def notice(self) -> str:
        inside = self.rng.choice([f"<p>{self.prose(1, 3)}</p>", self.prose(1, 2)]) + self.rng.choice(["", f"<button>{self.words(1, 2)}</button>"])
        return self.part("other", ["div", "div", "section", "p"], NOTICE_CUES, inside)

    def form(self) -> str:
        inside = f"<label>{self.words(1, 3)}</label><input name=q>{self.rng.choice(['', f'<p>{self.prose(1, 2)}</p>'])}<button>{self.words(1, 2)}</button>"
        wrapped = f"<form action=/{self.word()}>{inside}</form>"
        return self.rng.choice([wrapped.replace("<form", f'<form {MARK}="other"', 1), self.part("other", ["div", "section"], FORM_CUES, wrapped)])

    def share(self) -> str:
        return self.part("other", ["div", "ul", "p"], SHARE_CUES, self.rng.choice([self.link_list(), self.words(2, 7)]))

    def comments(self) -> str:
        own = [
            self.rng.choice([f"<li><b>{self.word()}</b> <p>{self.prose(1, 4)}</p></li>", f"<div class=comment><p>{self.prose(1, 5)}</p></div>", f"<article><h4>{self.words(1, 2)}</h4><p>{self.prose(1, 4)}</p></article>"])
            for _ in range(self.rng.randint(1, 6))
        ]
        title = self.rng.choice(["", f"<h3>{self.words(1, 3)}</h3>"])
        return self.part("other", ["section", "div", "ol"], COMMENT_CUES, title + "".join(own) + self.rng.choice(["", self.form()]))

    def block(self) -> str:
        made = self.rng.random()
        if made < 0.66:
            text = self.words(1, 3).capitalize() + "." if self.rng.random() < 0.2 else self.prose(1, 6)
            if self.rng.random() < 0.04:
                text = " ".join([self.word()] * self.rng.randint(5, 300))
            if self.rng.random() < 0.15:
                text += " " + self.linked(self.words(1, 4)) + " " + self.prose(1, 1)
            return self.rng.choice(["<p>%s</p>", "<p>%s</p>", "<p>%s</p>", "<p>%s", "<p><b>%s<br>", "<p><em>%s</em></p>", "<div>%s</div>"]) % text
        if made < 0.76:
            return f"<h{(n := self.rng.randint(2, 4))}>{self.words(1, 8)}</h{n}>"
        if made < 0.82:
            items = [self.rng.choice([self.words(1, 9), self.prose(1, 2), self.linked(self.words(1, 3)) + " " + self.words(2, 9)]) for _ in range(self.rng.randint(2, 6))]
            return f"<{(t := self.rng.choice(['ul', 'ol']))}>" + "".join(f"<li>{i}</li>" for i in items) + f"</{t}>"
        if made < 0.87:
            return f"<blockquote><p>{self.prose(1, 3)}</p></blockquote>"
        if made < 0.91:
            return f"<pre>{self.words(3, 20)}</pre>"
        if made < 0.95:
            rows = "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 6)}</td></tr>" for _ in range(self.rng.randint(1, 5)))
            return f"<table>{rows}</table>"
        return f"<figure><img src=x><figcaption>{self.words(2, 10)}</figcaption></figure>"

    def main(self) -> str:
        head = f"<h1>{self.rng.choice([self.words(2, 9), self.prose(1, 1)])}</h1>"
        if self.rng.random() < 0.2:
            head = f"<header>{head}</header>"
        blocks = [self.block() for _ in range(self.rng.choice([1, 2, 3, 4, 6, 8, 12, 20]))]
        for other in (self.advert, self.notice, self.sidebar, self.share, self.form):
            if self.rng.random() < 0.12:
                blocks.insert(self.rng.randint(0, len(blocks)), other())
        if self.rng.random() < 0.15:
            blocks.append(self.comments())
        inside = head * (self.rng.random() < 0.85) + "".join(blocks)
        for _ in range(self.rng.choice([0, 0, 1, 2])):
            inside = f"<div>{inside}</div>"
        made = self.rng.random()
        if made < 0.4:
            return f'<article{self.cue(MAIN_CUES) if self.rng.random() < 0.4 else ""} {MARK}="main">{inside}</article>'
        if made < 0.55:
            return f'<main {MARK}="main">{inside}</main>'
        return self.part("main", ["div", "div", "section", "td"], MAIN_CUES, inside, 0.25)

    def wrapped(self, parts: list[str]) -> list[str]:
        """The parts in an element that says nothing about them."""
        name = self.rng.choice(["wrapper", "container", "row", "layout", "inner", "col", "grid", "section", "outer"])
        return [f'<div class="{name}">{"".join(parts)}</div>']

    def page(self) -> str:
        chance = lambda p, make: [make()] if self.rng.random() < p else []
        before = chance(0.5, self.header) + chance(0.75, self.menu) + chance(0.3, self.notice) + chance(0.4, self.advert) + chance(0.2, self.form)
        sides = chance(0.4, self.sidebar) + chance(0.25, self.advert)
        after = chance(0.3, self.comments) + chance(0.25, self.share) + chance(0.2, self.advert) + chance(0.25, self.sidebar)
        middle = [self.main()]
        middle[self.rng.choice([0, 1]) : 0] = sides
        if self.rng.random() < 0.3:
            middle = self.wrapped(middle)
        parts = before + middle + after + chance(0.75, self.footer) + chance(0.15, self.notice)
        if self.rng.random() < 0.3:
            parts = self.wrapped(parts)
        body = "".join(self.wrapped([p])[0] if self.rng.random() < 0.1 else p for p in parts)
        head = f"<head><title>{self.words(1, 5)}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
        if self.rng.random() < 0.06:  # nothing but text
            blocks = "".join(self.block() for _ in range(self.rng.randint(1, 6)))
            body = f'<div {MARK}="main">{blocks}</div>' if self.rng.random() < 0.5 else blocks
            return f'<html><body {MARK}="main">{body}</body></html>'
        return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"


def labelled_pages(pages: int = PAGES, seed: int = SEED) -> list[str]:
    """Pages whose elements say, in ``data-kind``, whether they are main text."""
    maker = PageMaker(seed)
    return [maker.page() for _ in range(pages)]
