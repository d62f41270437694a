"""Main text of web pages by composite text density (operator 5).

A page is parsed into a tree; parts that are no article by their tag, role or class
(menus, headers, footers, sidebars, notices, adverts, forms, comments) are cut off. A class
or id is only a hint: a part that holds the page's article or most of its text stays. For
every remaining node the composite density sets characters against tags, adjusted for
how much of both sits in links. The sum of its children's densities marks the node that
holds most dense children. Of an enclosing article or main element everything is taken
but lists of links that are less dense than the path to that node. Without one, the lowest density on the path from that node up to the body is the threshold:
every part of the body reached through nodes at or above it belongs to the text, so an
article in several sections is not cut down to its densest one.

Defined results: a null, empty or text-free page has the empty text; broken markup is
read as far as it goes (unclosed elements end with their parent, unknown end tags are
ignored); repeated rows are read each for itself; whole pages are read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_rows

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# HTML's own classes of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FOREIGN = {"svg", "math"}
RAW = set("script style textarea title xmp noembed noframes iframe".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - set("body br html caption legend li option tbody td tfoot th thead tr".split())
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "body": ({"head"}, {"html"}),
}
# What is no article, by tag, role and the words of class and id.
NO_TEXT_TAGS = set(
    "script style noscript template head title nav header footer aside form button select "
    "textarea input iframe object embed canvas svg audio video dialog menu xmp noembed noframes "
    "link meta base datalist".split()
)
NO_TEXT_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "form toolbar status".split()
)
NO_TEXT_HINTS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus respond reply replies share sharing social "
    "related recommended widget widgets pagination pager toolbar copyright skip".split()
)
# A hint word after one of these names what a part has, not what it is.
HAVING = set("has have with no not without hide hides show shows".split())
# Parts so named are no wrappers of the main text, however long they are.
BESIDE_HINTS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored comment comments "
    "disqus respond reply replies related recommended".split()
)
# Elements that may be a list of links, and from how many links on.
LISTS = set("ul ol dl div section p table menu".split())
LIST_LINKS = 3
KEPT_TAGS = {"html", "body", "article", "main"}


class Node:
    __slots__ = ("tag", "parent", "cut", "hints", "items", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None, cut: bool, hints: frozenset[str] = frozenset()) -> None:
        self.tag, self.parent, self.cut, self.hints = tag, parent, cut, hints
        self.items: list[str | Node] = []
        self.density = 0.0


def is_cut(tag: str, attributes: str) -> tuple[bool, frozenset[str]]:
    """Whether an element is no article for certain, and the words that hint so."""
    hints: set[str] = set()
    if tag in NO_TEXT_TAGS:
        return True, frozenset()
    if not attributes.strip(" /\t\r\n"):
        return False, frozenset()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            if tag not in KEPT_TAGS:
                return True, frozenset()
        if name == "role" and value.lower() in NO_TEXT_ROLES:
            return True, frozenset()
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True, frozenset()
        if name in ("class", "id"):
            for token in value.split():
                words = [w.lower() for w in HINT_WORD.findall(token)]
                hints.update(w for w, led in zip(words, ["", *words]) if w in NO_TEXT_HINTS and led not in HAVING)
    if tag == "article" and hints & {"comment", "ad", "advert", "related", "promo"}:
        return True, frozenset()
    return False, frozenset() if tag in KEPT_TAGS else frozenset(hints)


def cut_hinted(root: Node) -> None:
    """Cut the hinted nodes, outermost first, but those that hold the main text.

    Such a node holds an article or main with more text than any that is found without
    passing hints; or no such is found elsewhere, and it holds most of the text.
    """
    nodes = _in_order(root)
    hinted = [n for n in nodes if n.hints]
    if not hinted:
        return
    full: dict[Node, int] = {}
    free: dict[Node, int] = {}
    inner: set[Node] = set()
    for node in reversed(nodes):
        own = sum(len("".join(i.split())) for i in node.items if isinstance(i, str))
        below = [c for c in node.items if isinstance(c, Node) and not c.cut]
        full[node] = own + sum(full[c] for c in below)
        free[node] = own + sum(free[c] for c in below if not c.hints)
        if any(c in inner or c.tag in ("article", "main") for c in below):
            inner.add(node)
    open_nodes = [root]
    for node in open_nodes:
        open_nodes += [c for c in node.items if isinstance(c, Node) and not c.cut and not c.hints]
    anchors = {n for n in open_nodes if n.tag in ("article", "main") and free[n]}
    rest = max((free[a] for a in anchors), default=0)
    passed = {root: (False, 0)}  # is in an article; anchors around
    for node in nodes:
        if node.parent is not None:
            if node.parent not in passed:
                continue
            inside, around = passed[node.parent]
            if node.hints:
                holds = node in inner and not inside and full[node] > rest
                most = not node.hints & BESIDE_HINTS and len(anchors) == around and 2 * full[node] > full[root]
                if not holds and not most:
                    node.cut = True
                    continue
            passed[node] = (inside or node.tag == "article", around + (node in anchors))


def parse(page: str) -> Node:
    """Tree of ``page``; comments, declarations and end tags without a start are dropped."""
    root = Node("", None, False)
    stack = [root]
    at = 0

    def close(tags: set[str], bounds: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in bounds:
                return
            if stack[depth].tag in tags:
                del stack[depth:]
                return

    while True:
        m = TAG.search(page, at)
        if m is None:
            break
        if m.start() > at:
            stack[-1].items.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, attributes = tag.lower(), m[3] if m[2] else m[6]
        if m[1] or m[4]:
            if tag == "br":
                stack[-1].items.append(Node("br", stack[-1], False))
            elif tag in BLOCK:
                close({tag}, {"table"} if tag != "table" else set())
            else:
                close({tag}, BLOCK)
            continue
        if tag in ENDS_PARAGRAPH:
            close({"p"}, {"table", "td", "th", "caption", "article", "section", "div", "li", "button"})
        if tag in SIBLINGS:
            close(*SIBLINGS[tag])
        node = Node(tag, stack[-1], *is_cut(tag, attributes))
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            if end is None and tag in ("script", "style"):
                at = len(page)
            elif end is not None:
                node.items.append(page[at : end.start()])
                at = end.end()
        elif tag not in VOID and not (attributes.endswith("/") and any(n.tag in FOREIGN for n in stack)):
            # A slash closes an element only inside drawings and formulas.
            stack.append(node)
    if at < len(page):
        stack[-1].items.append(page[at:])
    return root


def _in_order(root: Node) -> list[Node]:
    """Nodes that are not cut off, parents first."""
    found = [root]
    for node in found:
        found += [c for c in node.items if isinstance(c, Node) and not c.cut]
    return found


def measure(nodes: list[Node]) -> None:
    """Characters, tags and their linked shares of every node, then its density."""
    for node in reversed(nodes):
        node.chars = sum(len("".join(i.split())) for i in node.items if isinstance(i, str))
        node.tags = node.link_chars = node.link_tags = 0
        for child in node.items:
            if isinstance(child, Node) and not child.cut:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    whole = nodes[0]
    share = whole.link_chars / max(1, whole.chars)
    for node in nodes:
        tags, links = max(1, node.tags), max(1, node.link_tags)
        linked, free = max(1, node.link_chars), max(1, node.chars - node.link_chars)
        base = math.log(node.chars / free * linked + share * node.chars + math.e)
        value = node.chars / linked * tags / links
        # The logarithm to that base; a node all of links has at most base many.
        node.density = node.chars / tags * math.log(value) / math.log(max(base, 1.0001)) if value > 1 else 0.0


def _write(node: Node, out: list[str]) -> None:
    """Text pieces of a subtree with a space where a block begins or ends."""
    work: list[str | Node] = [node]
    while work:
        item = work.pop()
        if isinstance(item, str):
            out.append(item)
        elif not item.cut:
            block = item.tag in BLOCK
            if block:
                out.append(" ")
                work.append(" ")
            work.extend(reversed(item.items))
        else:
            out.append(" ")


def cut_link_lists(article: Node, path: list[Node]) -> None:
    """Cut parts of an article that are lists of links by their density.

    These hold several links and little else, and are less dense than every node on the
    path from the densest part up to the article; short plain paragraphs stay.
    """
    threshold = min(n.density for n in path[: path.index(article) + 1])
    for node in _in_order(article)[1:]:
        linked = node.link_tags >= LIST_LINKS and 5 * node.link_chars >= 4 * node.chars
        if linked and node.density < threshold and node.tag in LISTS and node not in path:
            node.cut = True


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    cut_hinted(root)
    nodes = _in_order(root)
    measure(nodes)

    def child_sum(node: Node) -> float:
        return sum(c.density for c in node.items if isinstance(c, Node) and not c.cut)

    best = max(nodes, key=child_sum)
    if child_sum(best) == 0:
        best = next((n for n in nodes if n.tag in ("article", "main")), root)
    path = []
    node = best
    while node is not None:
        path.append(node)
        node = node.parent
    whole = [n for n in path if n.tag in ("article", "main")]
    out: list[str] = []
    if whole:
        cut_link_lists(whole[-1], path)
        _write(whole[-1], out)
    else:
        body = next((n for n in path if n.tag == "body"), root)
        threshold = min(n.density for n in path[: path.index(body) + 1])
        work: list[str | Node] = [body]
        while work:
            item = work.pop()
            if isinstance(item, str):
                out.append(item)
            elif item is best or (item.density >= threshold and item not in path):
                _write(item, out)
            elif item in path:
                out.append(" ")
                work.append(" ")
                work.extend(c for c in reversed(item.items) if isinstance(c, str) or not c.cut)
    return " ".join(html.unescape("".join(out)).split())


def extract(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    def row(_, page_id: int | None, url: str | None, page: str | None) -> Iterator[tuple]:
        text = main_text(page)
        yield page_id, url, text, len(text)

    slim = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).alias("html"),
    )
    return map_rows(slim, slim.columns, row, "page_id long, url string, text string, n_chars long")
