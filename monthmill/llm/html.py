"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+))")
#: The attributes of a tag, up to its end; quoted values may hold ``>``.
_ATTRIBUTES = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noframes xmp".split())
#: Elements that are no part of an article.
_DROPPED = _RAW | frozenset("head noscript template object svg canvas nav header footer aside form button select dialog menu label input".split())
#: Words of class, id and role that name what is no part of an article, and words that say nothing beside them.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies"
    " cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager contentinfo complementary search".split()
)
_NEUTRAL = frozenset(
    "box list area wrap wrapper container block section main top left right bottom inner outer unit slot form item items post posts site page global primary secondary link links icon icons button buttons bar"
    " user reader readers articles news text content body group row col column panel the a b c".split()
)
_BLOCKS = frozenset("address article blockquote body br caption dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li main ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = _BLOCKS - {"br", "option"} | {"nav", "header", "footer", "aside", "form", "menu"}
#: Elements that hold menus of links.
_LISTS = frozenset("ul ol dl div section table menu".split())
#: An open element of the first set ends where one of its values begins.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WALLS = frozenset("html body article main section div td th table ul ol dl blockquote nav header footer aside form".split())
_ENDED = {"p"} | {tag for tags in _SIBLINGS.values() for tag in tags}


class Node:
    """An element: children are nodes and texts in page order."""

    __slots__ = ("tag", "parent", "children", "dropped", "marked", "near", "depth", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: "Node | None", marked: bool = False):
        self.tag, self.parent, self.marked, self.children = tag, parent, marked, []
        self.dropped = tag in _DROPPED
        self.depth = parent.depth + 1 if parent else 0
        self.near: dict[str, Node] = {}


def _is_marked(tag: str, attributes: str) -> bool:
    """Whether a class, id or role is made of marking words and, beside them, neutral ones only.

    ``adBox`` and ``comment-list`` are; ``share-enabled``, ``with-sidebar`` and ``entry-header`` say something else.
    """
    if not attributes or tag in ("html", "body", "main"):
        return False
    for found in _NAMED.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").split():
            words = {w.lower() for w in _PARTS.findall(name) if not w.isdigit()}
            if words & _MARKS and words <= _MARKS | _NEUTRAL and (tag != "article" or words & {"comment", "comments", "reply"}):
                return True
    return False


def parse(page: str) -> Node:
    """The page as a tree, in time linear in its length.

    Unclosed paragraphs and list items end where HTML ends them: ``near`` of a
    node names the open elements that a start tag may end, up to the next
    wall. Stray end tags are passed over by counts of the open elements. After
    a quote that never closes, tags end at the next ``>``.
    """
    root = top = Node("#root", None)
    open_: dict[str, int] = {}
    at, quotes = 0, True

    def close(node: Node) -> Node:
        nonlocal top
        while top is not node.parent:
            open_[top.tag] -= 1
            top = top.parent
        return top

    while at < len(page):
        found = _OPEN.search(page, at)
        if found is None:
            break
        start, rest = found.start(), found.end()
        if found[1]:
            end = page.find("-->", start + 2)
            end = len(page) if end < 0 else end + 3
        elif found[2]:
            end = page.find(">", rest) + 1
        else:
            whole = _ATTRIBUTES.match(page, rest) if quotes else None
            quotes = quotes and whole is not None
            end = whole.end() if whole else page.find(">", rest) + 1
        if not end:
            break  # a tag that never ends is text
        if start > at:
            top.children.append(page[at:start])
        at = end
        if found[4] is None:
            continue
        tag, attributes = found[4].lower(), page[rest : end - 1]
        if found[3]:
            if open_.get(tag):
                node = top
                while node.tag != tag:
                    node = node.parent
                close(node)
            elif tag in ("p", "br"):
                top.children.append(" ")
            continue
        ends = ({"p"} if tag in _CLOSES_P else set()) | _SIBLINGS.get(tag, set())
        closed = max((top.near[e] for e in ends if e in top.near), key=lambda n: n.depth, default=None)
        if closed is not None:
            close(closed)
        child = Node(tag, top, _is_marked(tag, attributes))
        top.children.append(child)
        if tag in _RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(page, at)
            end = page.find(">", stop.end()) + 1 if stop else 0
            at = end or len(page)
        elif tag not in _VOID and not attributes.endswith("/"):
            child.near = {} if tag in _WALLS else top.near
            if tag in _ENDED:
                child.near = {**child.near, tag: child}
            open_[tag] = open_.get(tag, 0) + 1
            top = child
    if at < len(page):
        top.children.append(page[at:])
    return root


def _drop_marked(root: Node) -> None:
    """Marked elements go, unless the page's article is inside them: a main or article element, or the first heading."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if type(c) is Node and not c.dropped]
    holds: set[int] = set()
    heads = [n for n in order if n.tag == "h1"]
    for node in order:
        if (node.tag in ("main", "article") and not node.marked) or (heads and node is heads[-1] and not node.marked):
            while node is not None and id(node) not in holds:
                holds.add(id(node))
                node = node.parent
    for node in order:
        # A comment below a list of comments does not make it an article.
        if node.marked and id(node) not in holds:
            node.dropped = True


def _measure(root: Node) -> list[Node]:
    """Counts of every node that is kept, children before parents; returns the nodes in that order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if type(c) is Node and not c.dropped]
    order.reverse()
    for node in order:
        chars = tags = link_chars = link_tags = 0
        for child in node.children:
            if type(child) is str:
                chars += len(" ".join(child.split()))
            elif not child.dropped:
                chars, tags = chars + child.chars, tags + child.tags + 1
                link_chars, link_tags = link_chars + child.link_chars, link_tags + child.link_tags
        if node.tag == "a":
            link_chars, link_tags = chars, link_tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    return order


def _densities(order: list[Node], body: Node) -> None:
    """Composite text density: characters per tag, less where characters and tags are those of links."""
    linked = body.link_chars / max(1, body.chars)
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        base = math.log(c / max(1, c - node.link_chars) * node.link_chars + linked * c + math.e)
        node.density = c / t * math.log(max(c, 1) / lc * t / lt) / math.log(max(base, 1.0 + 1e-9)) if c and base > 1 else c / t
        node.sum = sum(x.density for x in node.children if type(x) is Node and not x.dropped)


def _text(nodes: list[Node]) -> str:
    out: list[str] = []
    todo: list[Node | str] = list(reversed(nodes))
    while todo:
        node = todo.pop()
        if type(node) is str:
            out.append(entities.unescape(node) if "&" in node else node)
        elif not node.dropped:
            block = node.tag in _BLOCKS
            if block:
                out.append(" ")
                todo.append(" ")
            todo += reversed(node.children)
    return " ".join("".join(out).split())


def _is_menu(node: Node) -> bool:
    """A list or box that is nearly all links has no density of its own."""
    return node.tag in _LISTS and node.link_tags >= 2 and node.link_chars >= 0.8 * node.chars > 0


def _selected(root: Node) -> str:
    """The text of the subtree with the largest sum of child densities, and of others that are dense."""
    order = _measure(root)
    body = next((n for n in reversed(order) if n.tag == "body"), root)
    _densities(order, body)
    for node in order:
        node.dropped = node.dropped or (node is not body and _is_menu(node))
    inside = [n for n in order if n is not root and n.tag != "html" and not n.dropped] or [body]
    best = max(reversed(inside), key=lambda n: n.sum)
    if best.sum <= 0:
        best = body
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    wide = next((n for n in reversed(path) if n.tag in ("article", "main")), best)
    above = {id(n) for n in path[path.index(wide) + 1 :]}
    chosen: list[Node] = []
    todo = [path[-1]]
    while todo:
        node = todo.pop()
        if node is wide or (id(node) not in above and node.density >= threshold > 0):
            chosen.append(node)
        elif id(node) in above:
            todo += [c for c in reversed(node.children) if type(c) is Node and not c.dropped]
    return _text(chosen)


def main_text(page: str | None) -> str:
    """The page's article: the subtree with the largest sum of child densities, widened to the article or main element
    around it, with every other subtree as dense as the least dense node between it and the body.

    Scripts, forms, navigation, headers, footers and asides are no part of it by their kind, marked elements by their
    names (``_is_marked``), lists of links by their density. Names decide only where something else is left: a page
    that is empty without its marked elements is read with them.
    """
    if not page:
        return ""
    root = parse(page)
    _drop_marked(root)
    return _selected(root) or _selected(parse(page))


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every row; null or empty pages have an empty text. Repeated rows give repeated rows.

    A page of any length is read whole, in time linear in its length. Of
    subtrees with equal sums the outer one counts, of two beside each other
    the first. Other columns are ignored; an empty table gives an empty table.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(map(main_text, part.column(2).to_pylist()), pa.string())], names=[key, url, "text"])

    found = pages.select(key, url, html).mapInArrow(run, pages.select(key, url).schema.add("text", "string"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
