"""Pages as trees of blocks: what the main-text model reads of a page.

``parse`` builds, in one pass over the page, a tree of block elements whose leaves are the blocks of text. Inline
elements (links, emphasis, images, anything that does not start a new line) belong to the block they stand in. Missing
and crossing end tags are put up with the way browsers do it: a block closes an open paragraph, an item closes the
item before it, an end tag without a start is passed over.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("script style template noscript iframe svg math object canvas audio video title textarea select".split())
RAW = frozenset("script style title textarea iframe noscript".split())
VOID = frozenset("area base col embed hr img br input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end tag may be left out, and what a start tag closes among them.
IMPLIED = frozenset("p li dt dd tr td th thead tbody option".split()) | HEADINGS
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tbody": {"thead", "tbody"},
    "body": {"head"},
}

#: A tag after its ``<`` or ``</``: the name, then anything up to ``>``; quotes count after ``=`` only.
NAME = re.compile(r"[A-Za-z][^\s/>]*+")
REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""")
CUE_ATTRIBUTES = frozenset(["class", "id", "role", "itemprop", "aria-label"])
CUE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Tree:
    """Nodes in the order of the page; a node's parent comes before it. The first is the page itself."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    cues: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    #: Text of a leaf, its white space as one blank; empty for elements.
    text: list[str] = field(default_factory=lambda: [""])
    #: Characters of a leaf's text inside links.
    linked: list[int] = field(default_factory=lambda: [0])
    #: The value of ``mark``, an attribute that labels training pages, as inherited from the nearest ancestor.
    mark: list[str] = field(default_factory=lambda: [""])
    #: Form controls that stand directly in the element.
    controls: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int, tag: str, cues: tuple[str, ...], mark: str) -> int:
        for column, value in ((self.parent, parent), (self.tag, tag), (self.cues, cues), (self.text, ""),
                              (self.linked, 0), (self.mark, mark or self.mark[parent]), (self.controls, 0)):
            column.append(value)
        return len(self.parent) - 1


def one_blank(text: str) -> str:
    return " ".join(text.split())


class Builder:
    def __init__(self, mark: str) -> None:
        self.tree, self.mark = Tree(), mark
        self.open: list[tuple[str, int]] = [("#page", 0)]  # elements that are open, and their nodes
        self.names = Counter(["#page"])
        self.pieces: list[str] = []
        self.linked = 0
        self.link_depth = 0  # how many elements were open when a link began; 0 outside links

    def write(self, text: str) -> None:
        self.pieces.append(text)
        if self.link_depth:
            self.linked += len(text)

    def end_leaf(self) -> None:
        text = one_blank("".join(self.pieces)) if self.pieces else ""
        if text:
            leaf = self.tree.add(self.open[-1][1], "#text", (), "")
            self.tree.text[leaf], self.tree.linked[leaf] = text, min(self.linked, len(text))
        self.pieces, self.linked = [], 0

    def pop(self) -> str:
        self.end_leaf()
        name, _ = self.open.pop()
        self.names[name] -= 1
        if self.link_depth > len(self.open):
            self.link_depth = 0
        return name

    def start(self, name: str, attributes: str) -> None:
        if name in INLINE:
            if name == "a":
                self.link_depth = len(self.open)
            elif name in ("br", "wbr"):
                self.pieces.append("\n" if name == "br" else "")
            return
        if name in ("input", "button", "select", "textarea", "option"):
            self.tree.controls[self.open[-1][1]] += 1
            if name in ("input", "option"):
                return
        self.end_leaf()
        if self.names["p"] and self.open[-1][0] == "p":
            self.pop()
        if name in HEADINGS and self.open[-1][0] in HEADINGS:
            self.pop()
        closes = CLOSED_BY.get(name, ())
        if any(self.names[n] for n in closes):
            at = len(self.open) - 1
            while self.open[at][0] not in closes and self.open[at][0] in IMPLIED:
                at -= 1
            while self.open[at:] and self.open[at][0] in closes:
                self.pop()
        cues, mark = [], ""
        for m in ATTRIBUTE.finditer(attributes) if "=" in attributes else ():
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in CUE_ATTRIBUTES:
                cues += [c.lower() for c in CUE.findall(value)]
            elif self.mark and key == self.mark:
                mark = value
        node = self.tree.add(self.open[-1][1], name, tuple(cues), mark)
        if name not in VOID:
            self.open.append((name, node))
            self.names[name] += 1

    def end(self, name: str) -> None:
        if name == "a":
            self.link_depth = 0
        elif name == "br":
            self.pieces.append("\n")
        elif name not in INLINE and self.names[name]:
            while self.pop() != name:
                pass


def parse(page: str, mark: str = "") -> Tree:
    """The blocks of a page. Time and memory grow with its length, however broken it is."""
    built, at, size = Builder(mark), 0, len(page)
    write, last, unclosed = built.write, page.rfind(">"), set()
    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            sign = size
        if sign > at:
            text = page[at:sign]
            write(html.unescape(text) if "&" in text else text)
        if sign == size:
            break
        at = sign + 1
        if page.startswith("!--", at):
            end = page.find("-->", at + 1)
            at = end + 3 if end >= 0 else size
            continue
        if page.startswith(("!", "?"), at):
            at = page.find(">", at) + 1 or size
            continue
        closing = page.startswith("/", at)
        name_at = NAME.match(page, at + closing)
        if not name_at:
            if closing:  # no name: a comment by the rules
                at = page.find(">", at) + 1 or size
            else:
                write("<")
            continue
        if at > last:  # the page ends inside this tag
            break
        rest = REST.match(page, name_at.end())
        end = rest.end() if rest else last + 1
        name = name_at[0].lower()
        attributes, at = page[name_at.end() : end - 1], end
        if closing:
            built.end(name)
        elif name in HIDDEN and not attributes.endswith("/"):
            if name in ("select", "textarea"):
                built.tree.controls[built.open[-1][1]] += 1
            at = hidden_end(page, name, at, unclosed)
        else:
            built.start(name, attributes)
    while len(built.open) > 1:
        built.pop()
    built.end_leaf()
    return built.tree


def hidden_end(page: str, name: str, at: int, unclosed: set[str]) -> int:
    """Where what follows an element without text of its own begins."""
    if name in RAW:
        found = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(page, at)
        return (page.find(">", found.start()) + 1 or len(page)) if found else len(page)
    depth = 1
    for tag in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*+>", re.IGNORECASE).finditer(page, at) if name not in unclosed else ():
        depth += -1 if tag[1] else not tag[0].endswith("/>")
        if not depth:
            return tag.end()
    unclosed.add(name)  # as if it and its like were empty
    return at
