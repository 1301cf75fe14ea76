"""Pages as trees: a small tolerant HTML reader, the elements that look like listing cards, and cards by selectors.

Python reads each page once, in Arrow batches; all parsing of prices, dates and titles is left to expressions."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa

from ..functions.titles import CARD_HINTS

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "template"}
_CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "id")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None, number: int):
        self.tag, self.attrs, self.parent, self.children, self.id = tag, attrs, parent, [], number

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(x for x in reversed(node.children) if isinstance(x, Node))

    def text(self, joint: str = " ") -> str:
        """All text of the element."""
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                if part := node.strip():
                    out.append(part)
            elif node.tag not in _HIDDEN:
                todo.extend(reversed(node.children))
        return joint.join(out)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.count = 0
        self.root = self.at = Node("[document]", {}, None, 0)

    def handle_starttag(self, tag, attrs):
        if (drop := _CLOSES.get(tag)) and self.at.tag in drop and self.at.parent:
            self.at = self.at.parent
        self.count += 1
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at, self.count)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def read(html: str) -> Node:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.root


# --- elements whose class looks like a listing card ------------------------------------------------

CARD_TYPE = "source_url string, pos int, card_id int, last int, text string, scopes array<struct<heading:string,link:string,href:string>>, context array<string>"
_SCOPE = pa.struct([("heading", pa.string()), ("link", pa.string()), ("href", pa.string())])
_CARD = pa.schema([("source_url", pa.string()), ("pos", pa.int32()), ("card_id", pa.int32()), ("last", pa.int32()), ("text", pa.string()), ("scopes", pa.list_(_SCOPE)), ("context", pa.list_(pa.string()))])
#: Characters that a card's text may have at most.
MOST_CHARS = 3000


def _absolute(base: str, href: str) -> str:
    try:
        return urljoin(base, href)
    except ValueError:  # a malformed address
        return href


class Page:
    """The elements of a page in order, each with the last element and the range of texts below it, so that no subtree is walked twice."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.parts: list[str] = []
        self.last: dict[int, int] = {}
        self.range: dict[int, tuple[int, int]] = {}
        todo: list[tuple] = [(root, False, None)]
        while todo:
            item, hidden, start = todo.pop()
            if isinstance(item, str):
                if not hidden and (part := item.strip()):
                    self.parts.append(part)
            elif start is None:
                self.nodes.append(item)
                hidden = hidden or item.tag in _HIDDEN
                todo.append((item, hidden, len(self.parts)))
                todo.extend((x, hidden, None) for x in reversed(item.children))
            else:
                self.last[item.id], self.range[item.id] = self.nodes[-1].id, (start, len(self.parts))
        self.headings = [x for x in self.nodes if x.tag in ("h1", "h2", "h3", "h4", "h5")]
        self.links = [x for x in self.nodes if x.tag == "a" and "href" in x.attrs]

    def text(self, node: Node, joint: str = " ", most: int | None = None) -> str:
        """The element's text; ``most``: of a longer one as much as is longer than that."""
        (a, b), size = self.range[node.id], 0
        if most is not None:
            for k in range(a, b):
                size += len(self.parts[k]) + len(joint)
                if size > most + len(joint):
                    b = k + 1
                    break
        return joint.join(self.parts[a:b])

    def first(self, found: list[Node], node: Node) -> Node | None:
        """The first of the elements below a node."""
        k = bisect_right(found, node.id, key=lambda x: x.id)
        return found[k] if k < len(found) and found[k].id <= self.last[node.id] else None

    def scope(self, node: Node, base: str) -> dict:
        heading, link = self.first(self.headings, node), self.first(self.links, node)
        return {"heading": self.text(heading, "") if heading else None, "link": self.text(link, "") if link else None, "href": _absolute(base, link.attrs["href"]) if link else None}


def hinted(html: str, source_url: str | None) -> Iterator[dict]:
    """Elements with a hint in their class: their text (of one that is too long, the start), the last element below, what to look for a title and link
    in (itself, its parent, its grandparent), and the starts of the texts of up to five elements above, outermost first."""
    page = Page(read(html))
    for pos, node in enumerate(x for x in page.nodes if any(h in x.attrs.get("class", "").lower() for h in CARD_HINTS)):
        lineage, up = [], node.parent
        while up and len(lineage) < 5:
            lineage.append(up)
            up = up.parent
        scopes = [page.scope(x, source_url or "") for x in [node, *lineage[:2]]]
        yield {"source_url": source_url, "pos": pos, "card_id": node.id, "last": page.last[node.id], "text": page.text(node, most=MOST_CHARS), "scopes": scopes, "context": [page.text(x, most=60)[:60] for x in reversed(lineage)]}


def hinted_cards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for url, html in zip(batch.column("source_url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if rows := list(hinted(html or "", url)):
                yield pa.RecordBatch.from_pylist(rows, schema=_CARD)


# --- cards by selectors -------------------------------------------------------------------------

_SIMPLE = re.compile(r'(?P<tag>^[a-z][\w-]*)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>\*?=)"(?P<value>[^"]*)")?\]')


def matches(node: Node, selector: str) -> bool:
    """Tag, classes and attributes of one element; commas part alternatives."""
    for one in selector.split(","):
        one, ok, end = one.strip(), True, 0
        for m in _SIMPLE.finditer(one):
            end = m.end()
            if m["tag"]:
                ok &= node.tag == m["tag"]
            elif m["cls"]:
                ok &= m["cls"] in node.attrs.get("class", "").split()
            else:
                have = node.attrs.get(m["attr"])
                ok &= have is not None and (not m["op"] or (m["value"] in have if m["op"] == "*=" else m["value"] == have))
        if ok and end == len(one) and one:
            return True
    return False


def select(node: Node, selector: str) -> Iterator[Node]:
    return (x for x in node.walk() if x is not node and matches(x, selector))


#: How the cards of two sites are found (the first selector with any, else the last), and the parts of a card.
MEETUP_CARDS = (['div[data-testid="event-card"]', "article.event-card", "div.event-card", '[class*="eventCard"]', '[class*="EventCard"]', '[class*="event"], [data-testid*="event"]'], {
    "title": 'h3, h4, [class*="title"]', "date": '[class*="date"], [class*="time"], time', "price": '[class*="price"], [class*="cost"]',
    "venue": '[class*="venue"], [class*="location"]', "description": '[class*="description"], [class*="summary"]', "href": "a",
}, 50)
TICKET_CARDS = (["li.search-main-content__events-list-item, div.search-event-card-wrapper, div.discover-horizontal-event-card", 'article, [data-testid="event-card"]'], {
    "title": 'h3, h2, [class*="title"]', "date": '[class*="date"], [class*="time"], div.event-card-details__status', "price": 'div.event-card__price, [class*="price"]',
    "venue": '[class*="venue"], [class*="location"]', "href": "a.event-card-link, a",
}, 40)

PARTS_TYPE = "source_url string, pos int, title string, date string, price string, venue string, description string, href string"
_PARTS = pa.schema([("source_url", pa.string()), ("pos", pa.int32()), *((x, pa.string()) for x in ("title", "date", "price", "venue", "description", "href"))])


def selected_cards(config: tuple[list[str], dict[str, str], int]):
    cards, parts, most = config

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url, html in zip(batch.column("source_url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = read(html or "")
                found = next((x for s in cards if (x := list(select(root, s)))), [])
                rows = []
                for pos, card in enumerate(found[:most]):
                    row = {"source_url": url, "pos": pos}
                    for name, selector in parts.items():
                        hit = next(select(card, selector), None)
                        row[name] = (hit.attrs.get("href") if name == "href" else hit.text()) if hit else None
                    rows.append(row)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)

    return run
