"""Raw pieces of one product page, found by a small tree walk over the standard HTML parser."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Which open elements a new element closes implicitly.
_CLOSES = {
    "p": ("p",),
    "li": ("li",),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "div": ("p",),
    "table": ("p",),
    "ul": ("p",),
}
# Tags as most pages write them; whatever else, also elements whose content is no markup, goes the general way.
_PLAIN_START = re.compile(r'<([a-z][a-z0-9]*)((?: +[a-z][a-z-]*="[^"<>&]*")*)>')
_PLAIN_ATTRS = re.compile(r'([a-z][a-z-]*)="([^"]*)"')
_PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>")
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
_SCOPES = frozenset(("table", "ul", "ol", "div", "body", "html"))


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict
    children: list = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        """Descendants in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def texts(self) -> list[str]:
        out, stack = [], list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, Node):
                stack.extend(reversed(item.children))
            else:
                out.append(item)
        return out

    def own_texts(self) -> list[str]:
        return [c for c in self.children if isinstance(c, str)]


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.counts = defaultdict(int)

    def _close(self, tags: tuple[str, ...], scopes: frozenset) -> None:
        for t in tags:
            if self.counts[t]:
                break
        else:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                for n in self.open[depth:]:
                    self.counts[n.tag] -= 1
                del self.open[depth:]
                return
            if self.open[depth].tag in scopes:
                return

    def parse_starttag(self, i):
        found = _PLAIN_START.match(self.rawdata, i)
        if found is None or found[1] in _RAW:
            return super().parse_starttag(i)
        self.handle_starttag(found[1], _PLAIN_ATTRS.findall(found[2]))
        return found.end()

    def parse_endtag(self, i):
        found = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if found is None:
            return super().parse_endtag(i)
        self.handle_endtag(found[1])
        return found.end()

    def updatepos(self, i, j):
        """Lines are not counted, as nothing asks for a place."""
        return j

    def handle_starttag(self, tag, attrs):
        # Twice: a new row closes the cell and then the row before it.
        if tag in _CLOSES:
            self._close(_CLOSES[tag], _SCOPES)
            if tag == "tr":
                self._close(("tr",), _SCOPES)
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)
            self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        self._close((tag,), frozenset())

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


@dataclass(frozen=True)
class Mark:
    """An element by tag and one attribute, matched exactly or by containment."""

    tag: str
    attr: str
    value: str
    contains: bool = False

    def matches(self, node: Node) -> bool:
        if node.tag != self.tag or self.attr not in node.attrs:
            return False
        held = node.attrs[self.attr]
        return self.value in held if self.contains else held == self.value

    def find(self, nodes: Iterable[Node]) -> list[Node]:
        tag = self.tag
        return [n for n in nodes if n.tag == tag and self.matches(n)]


@dataclass(frozen=True)
class PageLayout:
    """Where a product page keeps its pieces. The marks of the page layout."""

    name: Mark = Mark("span", "id", "productTitle")
    price: Mark = Mark("span", "id", "priceblock_ourprice")
    histogram: Mark = Mark("table", "id", "histogramTable")
    reviews: Mark = Mark("div", "id", "reviews-summary", contains=True)
    reviews_fallback: Mark = Mark("div", "data-hook", "review")
    rating: Mark = Mark("i", "data-hook", "review-star-rating")
    header: Mark = Mark("a", "data-hook", "review-title")
    posted: Mark = Mark("span", "data-hook", "review-date")
    collapsed: Mark = Mark("div", "data-hook", "review-collapsed")
    hidden: Mark = Mark("span", "data-action", "columnbalancing-showfullreview")
    hidden_attr: str = "data-columnbalancing-showfullreview"
    comments: Mark = Mark("span", "data-hook", "review-comment")
    author: Mark = Mark("span", "class", "profile-name", contains=True)
    plain: Mark = Mark("div", "id", "dpReviews", contains=True)


def _texts(nodes: Iterable[Node], mark: Mark) -> list[str]:
    return [t for node in mark.find(nodes) for t in node.texts()]


def _by_tag(nodes: Iterable[Node]) -> dict[str, list[Node]]:
    out = defaultdict(list)
    for n in nodes:
        out[n.tag].append(n)
    return out


def _review(box: Node, layout: PageLayout) -> dict:
    # Only elements that carry attributes can match; they are listed once for all marks.
    walked = list(box.walk())
    marked = _by_tag(n for n in walked if n.attrs)
    plain = [
        t
        for holder in layout.plain.find(marked[layout.plain.tag])
        for child in holder.children
        if isinstance(child, Node) and child.tag == "div"
        for t in child.own_texts()
    ]
    # The hidden text counts only inside a div of the review, not right below the review itself.
    found = layout.hidden.find(marked[layout.hidden.tag])
    if found:
        inside = [n for d in walked if d.tag == "div" for n in d.walk()]
        found = layout.hidden.find({id(n): n for n in inside if n.attrs}.values())
    hidden = [n.attrs.get(layout.hidden_attr) for n in found]
    return {
        "author": _texts(marked[layout.author.tag], layout.author),
        "rating": _texts(marked[layout.rating.tag], layout.rating),
        "header": _texts(marked[layout.header.tag], layout.header),
        "posted": _texts(marked[layout.posted.tag], layout.posted),
        "collapsed": _texts(marked[layout.collapsed.tag], layout.collapsed),
        "hidden": [h for h in hidden if h is not None],
        "comments": _texts(marked[layout.comments.tag], layout.comments),
        "plain": plain,
    }


def page_pieces(html: str, layout: PageLayout) -> dict:
    """Uncleaned pieces; the cleaning rules are Spark expressions."""
    nodes = list(parse(html).walk())
    marked = [n for n in nodes if n.attrs]
    names = [t for h in nodes if h.tag == "h1" for t in _texts(h.walk(), layout.name)]
    prices = [t for n in layout.price.find(marked) for t in n.own_texts()]
    ratings: dict[str, str] = {}
    for table in layout.histogram.find(marked):
        for row in (n for n in table.walk() if n.tag == "tr"):
            cells = [c for c in row.children if isinstance(c, Node) and c.tag == "td"]
            links = [a for c in cells for a in c.walk() if a.tag == "a"]
            found = [t for a in links for t in a.texts()]
            if len(found) > 1 and found[0]:
                ratings[found[0]] = found[1]
    boxes = layout.reviews.find(marked) or layout.reviews_fallback.find(marked)
    return {
        "names": names,
        "prices": prices,
        "ratings": list(ratings.items()),
        "reviews": [_review(b, layout) for b in boxes],
    }
