"""Main text of HTML pages by composite text density.

A page is read into a DOM.  Scripts, styles, forms, menus, headers, footers,
sidebars, notices, adverts and reader comments are cut by element or role.
An element is marked if a class or its id is a word for these, whole or as its
last part (``has-sidebar`` and the like tell of the holder).  Marked elements
are cut, save those that hold the core or two thirds of the body's characters;
reader comments, and what lies outside when an article or main element is not
marked, are cut even then.  A marked paragraph is cut if it is below the
threshold or mostly links.  If no text is left, marks cut nothing.  Every node
gets its composite density: characters per tag times the
logarithm of (characters per link character times tags per link tag), in a
base that grows with the node's links against the page's.  The node whose
children's densities have the largest sum is the core.  The least density on
the way from the core up to the body is the threshold.  Within an article or
main element the whole element is the content; otherwise the core is, with
those subtrees beside its way to the body that reach the threshold.  Within
the content, lists of links are cut as menus if the links are short.

Text: character references decoded, white space within a block turned into
one space, blocks trimmed and joined by one line end in page order.

Defined results: a null or empty page, or one without text, gives empty text;
unclosed elements, comments and tags end with the page; a tag without its
``>`` is dropped; ties between cores go to the first in page order; repeated
rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common

# HTML's element names by use.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CUT = frozenset("script style title head nav header footer aside form iframe noscript template button select textarea menu dialog svg math object embed canvas audio video map".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
CUT_WORDS = frozenset("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notification notifications pagination popup promo promoted related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
READER_WORDS = frozenset("comment comments disqus reply replies respond".split())
#: First parts of a class that tell what its element has or lacks.
HOLDER_WORDS = frozenset("has have no not with without hide show".split())
# Elements whose start ends an open element of the same group.
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("table ul ol dl select body".split())
_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)([^>]*>)?""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[^a-z]+")
#: Links of a menu have fewer characters than this, on average.
LABEL = 25
#: Least base of the logarithm; the formula's own base is 1 on a page without links.
LEAST_BASE = 2.0


class Node:
    __slots__ = ("tag", "parent", "depth", "children", "cut", "marks", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False):
        self.tag, self.parent, self.cut = tag, parent, cut
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []
        self.marks: set[str] = set()
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def is_cut(tag: str, attributes: str) -> bool:
    if tag in CUT:
        return True
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name == "role" and value.strip() in CUT_ROLES or name == "aria-hidden" and value == "true":
            return True
    return False


def marks(tag: str, attributes: str) -> set[str]:
    """The words of CUT_WORDS that are a class or the id, or its last part."""
    found: set[str] = set()
    if tag not in ("html", "body", "article", "main"):
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id"):
                for token in (a or b or c).lower().split():
                    parts = [x for x in _PART.split(token) if x]
                    if parts and parts[-1] in CUT_WORDS and parts[0] not in HOLDER_WORDS:
                        found.add(parts[-1])
    return found


def parse(page: str) -> Node:
    """The DOM below a root node; cut elements keep no content.

    Open elements are known by tag, so a tag that closes nothing costs nothing,
    however deep it stands."""
    root = here = Node("#root", None)
    at, n = 0, len(page)
    opened: dict[str, list[Node]] = defaultdict(list)
    scopes, blocks = [root], [root]  # open elements that end a search, and those that are not inline

    def leave(node: Node) -> Node:
        """Close ``node`` and what is open inside it; gives its parent."""
        gone = here
        while True:
            opened[gone.tag].pop()
            if gone.tag in SCOPES:
                scopes.pop()
            if gone.tag not in INLINE:
                blocks.pop()
            if gone is node:
                return node.parent
            gone = gone.parent

    def text(upto: int) -> None:
        if upto > at and not here.cut:
            here.children.append(html.unescape(page[at:upto]))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(n)
            break
        text(m.start())
        at = m.end()
        end, start = m[1], m[2]
        if end:
            end = end.lower()
            if opened[end] and (end in SCOPES or end not in SIBLINGS or opened[end][-1].depth > scopes[-1].depth):
                here = leave(opened[end][-1])
        elif start and m[4]:
            tag = start.lower()
            if tag in ENDS_PARAGRAPH:
                if blocks[-1].tag == "p":
                    here = leave(blocks[-1])
            elif tag in SIBLINGS:
                last = max((opened[x][-1] for x in SIBLINGS[tag] if opened[x]), key=lambda x: x.depth, default=root)
                if last.depth > scopes[-1].depth:
                    here = leave(last)
            child = Node(tag, here, here.cut or is_cut(tag, m[3]))
            if not child.cut:
                child.marks = marks(tag, m[3])
            here.children.append(child)
            if tag in RAW:
                close = re.compile(f"</{tag}", re.I).search(page, at)
                if not child.cut:
                    child.children.append(html.unescape(page[at:close.start() if close else n]))
                at = (page.find(">", close.end()) + 1 or n) if close else n
            elif tag not in VOID:
                here = child
                opened[tag].append(child)
                if tag in SCOPES:
                    scopes.append(child)
                if tag not in INLINE:
                    blocks.append(child)
        elif start:
            at = n
    return root


def measure(root: Node) -> tuple[Node, list[Node]]:
    """Fill in counts, densities and density sums; the body and all kept nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.cut)
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = 0.0
        for c in node.children:
            if isinstance(c, str):
                node.chars += sum(map(len, c.split()))
            elif not c.cut:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.chars if c.tag == "a" else c.link_chars
                node.link_tags += c.link_tags + (c.tag == "a")
    body = next((x for x in order if x.tag == "body"), root)
    share = body.link_chars / max(1, body.chars)
    for node in reversed(order):
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, node.link_tags
        if c:
            base = max(LEAST_BASE, math.log(c / max(1, c - lc) * lc + share * c + math.e))
            node.density = c / t * math.log(max(1.0, c / max(1, lc) * t / max(1, lt))) / math.log(base)
        node.total = sum(x.density for x in node.children if isinstance(x, Node) and not x.cut)
    return body, order


def way_of(root: Node, body: Node, order: list[Node]) -> list[Node]:
    """The core and the nodes that hold it, up to the body."""
    inside = [x for x in order if x is not root]
    core = max(inside, key=lambda x: x.total, default=body)
    if not core.total:
        core = max(inside, key=lambda x: x.density, default=body)
    way = [core]
    while way[-1] is not body and way[-1].parent is not None and way[-1].parent is not root:
        way.append(way[-1].parent)
    return way


def settle(root: Node) -> tuple[Node, list[Node]]:
    """Cut the marked elements that do not hold the page's text; measures of the rest."""
    body, order = measure(root)
    marked = [x for x in order if x.marks]
    if not marked:
        return body, order
    under, within = set(), set()
    for x in order:
        if x.marks or id(x.parent) in under:
            under.add(id(x))
        if x.tag in ("article", "main") or id(x.parent) in within:
            within.add(id(x))
    named = any(x.tag in ("article", "main") and x.chars and id(x) not in under for x in order)
    for x in marked:
        x.cut = x.tag != "p" and (named and id(x) not in within or not READER_WORDS.isdisjoint(x.marks))
    body, order = measure(root)
    way = way_of(root, body, order)
    held, threshold = {id(x) for x in way}, min(x.density for x in way)
    for x in order:
        if x.marks and x.tag == "p":
            x.cut = x.density < threshold or 2 * x.link_chars >= x.chars
        elif x.marks:
            x.cut = id(x) not in held and 3 * x.chars <= 2 * body.chars
    body, order = measure(root)
    if not body.chars:
        for x in marked:
            x.cut = False
        body, order = measure(root)
    return body, order


def content(root: Node) -> list[Node]:
    """The nodes whose text is the main text, in page order."""
    body, order = settle(root)
    if not body.chars:
        return []
    way = way_of(root, body, order)
    core = way[0]
    holders = [x for x in way if x.tag in ("article", "main")]
    if holders:
        return [holders[-1]]
    below = [x for x in order if x.tag in ("article", "main") and 2 * x.chars > core.chars]
    if below and core.tag in ("html", "body", "div", "section"):
        return [below[0]]
    threshold = min(x.density for x in way)
    kept = {id(core)}
    for inner, outer in zip(way, way[1:], strict=False):
        kept.update(id(x) for x in outer.children if isinstance(x, Node) and not x.cut and x is not inner and x.density >= threshold and 2 * x.link_chars < x.chars)
    return [x for x in order if id(x) in kept]


def is_menu(node: Node) -> bool:
    """A block of at least two short links and hardly any other text; longer
    links are references."""
    return node.tag in ("ul", "ol", "div", "table", "section") and node.link_tags >= 2 and node.link_chars >= 0.9 * node.chars and node.link_chars < LABEL * node.link_tags


def block_texts(nodes: list[Node]) -> Iterator[str]:
    """The text of each block, white space as it is."""
    parts: list[str] = []
    for top in nodes:
        stack: list = [top]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x)
            elif x is None:
                yield "".join(parts)
                parts.clear()
            elif x.tag == "br":
                parts.append(" ")
            elif not x.cut and (x is top or not is_menu(x)):
                if x.tag not in INLINE:
                    yield "".join(parts)
                    parts.clear()
                    stack.append(None)
                stack.extend(reversed(x.children))
        yield "".join(parts)
        parts.clear()


def main_text(page: str) -> str:
    blocks = (" ".join(b.split()) for b in block_texts(content(parse(page))))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            found = [main_text(t) for t in common.texts(b, "html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return common.map_arrow(rows, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long", run)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op2: the main text of every page."""
    return extract(common.table(spark, sf_dir, "pages"))
