"""Cells of HTML tables, by the standard library's parser.

Runs inside Python workers, one page at a time. The module is pickled by value,
so the workers of a cluster need no copy of this package.
"""

import sys
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never hold content.
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# An opening tag closes these when they are still open.
CLOSED_BY = {
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "option": ("option",),
    "li": ("li",),
    "p": ("p",),
}
SCOPES = frozenset(("table", "select", "ul", "ol", "html"))
NO_CLASSES = frozenset()
# Cells handed on at a time: what a worker holds is a page and these, however many pages a batch has.
CELLS = 10_000


class Node:
    """An element: tag, attributes, parent and its children in page order."""

    __slots__ = ("tag", "attrs", "classes", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = frozenset((attrs.get("class") or "").split()) if attrs else NO_CLASSES
        self.children = []

    def release(self):
        """Cut the links to and from other elements, so that a page's memory is free at once."""
        self.parent, self.children = None, []

    def inside(self):
        """All elements below, in page order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            yield node
            if node.children:
                todo.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def only_text(self):
        """The text when a single string is all there is inside, else None."""
        node = self
        while isinstance(node, Node):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node

    def matches(self, part):
        tag, ids, classes = part
        return (
            (not tag or self.tag == tag)
            and classes <= self.classes
            and (not ids or self.attrs.get("id") in ids)
        )


class PageTree(HTMLParser):
    """Builds the nodes of a page; `nodes` lists them all in page order."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.nodes = []
        self.feed(html)
        self.close()

    def _add(self, tag, attrs):
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        self.nodes.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        closes = CLOSED_BY.get(tag)
        if closes:
            node = self.at
            while node is not self.root and node.tag not in SCOPES:
                if node.tag in closes:
                    self.at = node.parent
                node = node.parent
        node = self._add(tag, attrs)
        if tag not in VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data):
        children = self.at.children
        if children and isinstance(children[-1], str):
            children[-1] += data
        else:
            children.append(data)


def parse_selector(selector):
    """Descendant selector such as `.a.b table tr` -> [(tag, ids, classes), ...]."""
    parts = []
    for word in selector.split():
        names = word.replace("#", " #").replace(".", " .").split()
        tag = names[0] if names[0][0] not in "#." else ""
        parts.append(
            (
                tag,
                frozenset(n[1:] for n in names if n[0] == "#"),
                frozenset(n[1:] for n in names if n[0] == "."),
            )
        )
    return parts


def select(nodes, parts):
    """Nodes matching the last part whose ancestors match the others in order."""
    for node in nodes:
        if not node.matches(parts[-1]):
            continue
        todo, up = len(parts) - 2, node.parent
        while todo >= 0 and up is not None:
            if up.matches(parts[todo]):
                todo -= 1
            up = up.parent
        if todo < 0:
            yield node


def _cell(node):
    link = next((n for n in node.inside() if n.tag == "a"), None)
    return {
        "text": node.only_text(),
        "link_text": link.only_text() if link else None,
        "href": link.attrs.get("href") if link else None,
    }


def rows_of(page, parts, mode):
    nodes = list(select(page, parts))
    if mode == "nodes":
        return [[_cell(n) for n in nodes]] if nodes else []
    if mode == "first_table":
        nodes = [n for t in nodes[:1] for n in t.inside() if n.tag == "tr"]
    if mode == "children":
        nodes = [
            n
            for t in nodes[:1]
            for body in [t, *(c for c in t.children if isinstance(c, Node) and c.tag == "tbody")]
            for n in body.children
            if isinstance(n, Node) and n.tag == "tr" and n.only_text() is None
        ]
    return [[_cell(n) for n in row.inside() if n.tag in ("td", "th")] for row in nodes]


def page_parser(plan):
    """Batch function for `mapInArrow`: (page_id, html) to one column per table, some `CELLS` at a time.

    `plan` maps a column name to (parsed selector, mode).
    """
    cell = pa.struct([(name, pa.string()) for name in ("text", "link_text", "href")])
    tables = pa.list_(pa.list_(cell))
    schema = pa.schema([("page_id", pa.int64()), *[(name, tables) for name in plan]])

    def handed(ids, out):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(out[n], tables) for n in plan]], schema=schema)

    def run(batches):
        for batch in batches:
            ids, out, held = [], {name: [] for name in plan}, 0
            for page_id, body in zip(batch.column("page_id"), batch.column("html")):
                page = PageTree(body.as_py())
                ids.append(page_id.as_py())
                for name, (parts, mode) in plan.items():
                    out[name].append(rows_of(page.nodes, parts, mode))
                    held += 1 + sum(map(len, out[name][-1]))
                for node in (page.root, *page.nodes):
                    node.release()
                if held >= CELLS:
                    yield handed(ids, out)
                    ids, out, held = [], {name: [] for name in plan}, 0
            if ids or not batch.num_rows:
                yield handed(ids, out)

    return run
