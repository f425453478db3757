"""A forgiving reader of HTML into a tree of block elements, with the text of each block in page order.

It takes time in proportion to the page, whatever the page holds: where a tag with quotes has no end, what was learned on the
way is kept for the tags after it; open elements are found by name, not by walking up; and which element a new one ends is
known for every node when it is opened.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from html import unescape

# Fixed values of HTML: elements inside a line, without content, with raw content, and what closes an open paragraph.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr picture source input noscript object svg math".split()
    # Parts of drawings and formulas.
    + "g path text tspan textpath circle ellipse line rect polygon polyline defs use symbol marker desc lineargradient"
    " radialgradient stop clippath mask mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover"
    " munderover mtable mtr mtd mstyle mpadded mfenced semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe noembed noframes textarea select title".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# An element of the first kind ends the nearest open one of the second, unless one of the third is nearer.
ENDS = (
    (ENDS_PARAGRAPH, frozenset(["p"]), frozenset("table td th article section div li body".split())),
    (frozenset(["li"]), frozenset(["li"]), frozenset("ul ol menu".split())),
    (frozenset("dt dd".split()), frozenset("dt dd".split()), frozenset(["dl"])),
    (frozenset(["tr"]), frozenset(["tr"]), frozenset("table tbody thead tfoot".split())),
    (frozenset("td th".split()), frozenset("td th".split()), frozenset("tr table".split())),
)
_NOTED = frozenset().union(*(wanted | limits for _, wanted, limits in ENDS))
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_DELIMITER = re.compile("[>\"']")
_NAMES = re.compile(r"\b(class|id|role|data-content)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    names: frozenset[str]
    parent: int
    marked: str | None = None
    size: int = 0
    linked: int = 0
    stops: int = 0


@dataclass
class Page:
    """Nodes in page order, each after its parent; blocks are (node, text) in page order."""

    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


class _Tags:
    """The ends of tags. A tag ends at the first ``>`` outside quotes or, if there is none, at the first one at all."""

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        #: Opening quotes from which no such ``>`` can be reached.
        self.hopeless: set[int] = set()

    def end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose attributes begin at ``at``; -1 if there is none."""
        html, tried, place = self.html, [], at
        while (found := _DELIMITER.search(html, place)) is not None:
            quote = found.start()
            if html[quote] == ">":
                return quote
            tried.append(quote)
            closed = -1 if quote in self.hopeless else html.find(html[quote], quote + 1)
            if closed < 0:
                break
            place = closed + 1
        self.hopeless.update(tried)
        return html.find(">", at)


class _Open:
    """The open elements: the path from the page to the current node."""

    def __init__(self, page: Page):
        self.page = page
        self.at = 0
        self.by_tag: dict[str, list[int]] = defaultdict(list)
        #: Of each node, for each rule of ENDS, the open element that the rule would end there; -1 for none.
        self.ended: list[tuple[int, ...]] = [(-1,) * len(ENDS)]

    def _rise(self, to: int) -> None:
        while self.at != to:
            node = self.page.nodes[self.at]
            self.by_tag[node.tag].pop()
            self.at = node.parent

    def close(self, tag: str) -> None:
        """Close the nearest open element of that name, and those inside it."""
        if self.by_tag.get(tag):
            self._rise(self.page.nodes[self.by_tag[tag][-1]].parent)

    def make_room(self, tag: str) -> None:
        """Close what an element of that name ends."""
        for rule, (enders, _, _) in enumerate(ENDS):
            if tag in enders and (ended := self.ended[self.at][rule]) >= 0:
                self._rise(self.page.nodes[ended].parent)

    def enter(self, node: Node, open_: bool) -> None:
        """Add a child of the current node, and go down to it if it is open."""
        above = self.ended[self.at]
        self.page.nodes.append(node)
        k = len(self.page.nodes) - 1
        if node.tag in _NOTED:
            above = tuple(
                k if node.tag in wanted else -1 if node.tag in limits else above[rule] for rule, (_, wanted, limits) in enumerate(ENDS)
            )
        self.ended.append(above)
        if open_:
            self.by_tag[node.tag].append(k)
            self.at = k


def parse(html: str | None) -> Page:
    page = Page([Node("#page", frozenset(), -1)])
    if not html:
        return page
    path, tags = _Open(page), _Tags(html)
    position, links = 0, 0
    text: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        nonlocal text, linked
        if text:
            block = " ".join(unescape("".join(text)).split())
            if block:
                node = page.nodes[path.at]
                page.blocks.append((path.at, block))
                node.size += len(block)
                node.linked += min(len(block), sum(map(len, linked)))
                node.stops += block.count(".") + block.count(",") + block.count("?") + block.count("!")
            text, linked = [], []

    def read(to: int) -> None:
        if to > position:
            text.append(html[position:to])
            if links:
                linked.append(html[position:to])

    while position < len(html):
        begin = html.find("<", position)
        read(begin if begin >= 0 else len(html))
        if begin < 0:
            break
        position = begin
        if html.startswith("<!--", begin):
            over = html.find("-->", begin + 4)
            position = over + 3 if over >= 0 else len(html)
            continue
        named = _NAME.match(html, begin)
        other = html.startswith(("<!", "<?"), begin)
        over = -1 if begin > tags.last or not (named or other) else tags.end(named.end()) if named else html.find(">", begin)
        if over < 0:  # no markup
            read(begin + 1)
            position = begin + 1
            continue
        position = over + 1
        if other:
            continue
        tag, closing, attributes = named[1].lower(), html[begin + 1] == "/", html[named.end() : over]
        if tag == "a":
            links = 0 if closing else 1
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                after = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, position)
                position = after.end() if after else len(html)
            if tag not in ("select", "textarea"):
                continue
        flush()
        if closing:
            path.close(tag)
            continue
        path.make_room(tag)
        names, marked = set(), None
        for name in _NAMES.finditer(attributes):
            value = name[2] or name[3] or name[4] or ""
            if name[1].lower() == "data-content":
                marked = value
            else:
                names.update(_WORD.findall(value.lower()))
        opens = tag not in VOID and tag not in RAW
        path.enter(Node(tag, frozenset(names), path.at, marked), opens)
        if opens:
            links = 0
    flush()
    for node in reversed(page.nodes[1:]):  # sums over subtrees: children come after their parents
        parent = page.nodes[node.parent]
        parent.size += node.size
        parent.linked += node.linked
        parent.stops += node.stops
    return page
