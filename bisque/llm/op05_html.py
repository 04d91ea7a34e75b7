"""HTML extraction: composite text density.

A page is read into a tree. Every node gets the number of its characters, tags, link characters and link tags, and from these a composite
text density: characters per tag, damped by a logarithm whose base grows with the share of link text. A node's density sum adds its
children's densities. The node with the largest sum is the core of the page; the least density on the path from it up to the body is the
threshold, and the subtrees that reach it outside furniture elements make the main text.

Furniture (navigation, headers and footers of the page, sidebars, notices, adverts, forms, comments, scripts, styles) is recognised by
element and by class, id and role words, and never counts.

Defined results: null or empty html, or a page without text, gives an empty text; unclosed and stray tags are repaired as browsers do in
outline; equal pages give equal texts; an empty table gives an empty result; clashing columns are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import common

#: Elements by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = frozenset("head nav aside footer form script style noscript template iframe object embed button select option textarea input label svg canvas audio video map dialog menu title noembed noframes xmp".split())
ENDS_P = BLOCK - {"br"}
ITEMS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
NAMES = re.compile(
    r"(?:^|[\s_\-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|popup|modal|overlay|alert|newsletter|subscri\w+|nav\w*|menu\w*|breadcrumb\w*|sidebar|side|widget\w*|related|recommend\w*|share|sharing|social|footer|masthead|topbar|toolbar|comment\w*|disqus|respond|replies|reply|pagination|pager|signup|login|skip|copyright|legal|disclaimer)(?=$|[\s_\-])",
    re.I,
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: A word that tells of furniture only where it is the whole name or its last part, or a part of the layout follows: a notice-board is none.
TURNED = re.compile(r"(?:side|notice|alert|share|legal|skip)[\-_](?![\-_]|(?:bar|box|nav|menu|panel|rail|col|column|section|content|wrap|wrapper|container|widget|area|inner|outer|text|message|msg|info|warning|error|link|links|button|buttons|icons|count|tools|this|to)(?=$|[\s_\-]))", re.I)
SPACE = re.compile(r"[ \t\n\r\f\v ]+")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    up: Node | None = None
    furniture: bool = False
    inside: bool = False  # an article or main element, or in one
    parts: list = field(default_factory=list)  # texts and nodes, in page order
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def is_furniture(tag: str, attributes: str, inside: bool) -> bool:
    if tag in FURNITURE:
        return True
    if tag == "header":
        return not inside  # an article's own header holds its title
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.lower() in ROLES or name in ("class", "id") and NAMES.search(TURNED.sub("", value)):
            return True
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def parse(page: str) -> Node:
    root = here = Node("html")
    at, n, body = 0, len(page), None
    opened: dict[str, int] = {}  # open elements by name: stray tags need no walk up a deep tree

    def close(to: Node) -> Node:
        """Close what is open up to and with ``to``."""
        node = here
        while True:
            opened[node.tag] = opened.get(node.tag, 1) - 1
            if node is to:
                return node.up
            node = node.up

    while at < n:
        m = TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            here.parts.append(page[at:stop])
        if not m:
            break
        at = m.end()
        if m[1] is not None:
            here.parts.append(m[1])
            continue
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if m[2]:  # an end tag closes the nearest open element of its name, but no formatting tag closes an article
            node = here if opened.get(tag) else root
            while node is not root and node.tag != tag:
                if node.tag in ("article", "main", "body") and tag not in ("article", "main", "body"):
                    node = root
                    break
                node = node.up
            if node is not root:
                here = close(node)
            continue
        if tag in ("html", "body"):
            if tag == "body" and body is None:
                body = here = Node("body", root)
                opened["body"] = 1
                root.parts.append(body)
            continue
        if tag in ENDS_P and opened.get("p"):  # a block ends an open paragraph, with what is open inside it
            node = here
            while node is not root and node.tag not in ("p", "div", "td", "article", "section", "li", "body"):
                node = node.up
            if node.tag == "p":
                here = close(node)
        if tag in ITEMS and any(opened.get(x) for x in SAME.get(tag, (tag,))):
            node = here
            while node is not root and node.tag not in ITEMS[tag]:
                if node.tag in SAME.get(tag, (tag,)):
                    here = close(node)
                    break
                node = node.up
        node = Node(tag, here, here.furniture or is_furniture(tag, m[4], here.inside), here.inside or tag in ("article", "main"))
        here.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if not m[5] and tag not in VOID:
            here = node
            opened[tag] = opened.get(tag, 0) + 1
    return root


def order(root: Node) -> list[Node]:
    """Every node, parents first; no recursion, so depth is no limit."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.parts) if isinstance(x, Node)]
    return out


def measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        if node.furniture:
            continue
        chars = sum(len(SPACE.sub(" ", entities.unescape(x) if "&" in x else x).strip()) for x in node.parts if isinstance(x, str))
        tags = links = link_tags = 0
        for x in node.parts:
            if isinstance(x, Node) and not x.furniture:
                chars, tags, links, link_tags = chars + x.chars, tags + x.tags + 1, links + x.link_chars, link_tags + x.link_tags
        if node.tag == "a":
            links, link_tags = chars, link_tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, links, link_tags
    top = next((x for x in nodes if x.tag == "body"), nodes[0])
    share = top.link_chars / top.chars if top.chars else 0.0
    for node in reversed(nodes):
        if node.furniture:
            continue
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            node.density = c / t * max(0.0, math.log(max(1.0, c / max(1, lc) * t / lt)) / base) if lc else c / t
        node.total = sum(x.density for x in node.parts if isinstance(x, Node) and not x.furniture)


def extract(page: str | None) -> str:
    if not page:
        return ""
    nodes = order(root := parse(page))
    measure(nodes)
    able = [x for x in nodes if not x.furniture and x.chars]
    if not able:
        return ""
    core = max(able, key=lambda x: x.total)
    if core.total == 0:
        core = max(able, key=lambda x: x.density)
    path, node = [], core
    while node is not None and node is not root:
        path.append(node)
        if node.tag == "body":
            break
        node = node.up
    threshold = min((x.density for x in path), default=0.0)
    # an article or main element around the core is the main subtree as a whole: its title and short blocks belong to it
    whole = next((x for x in reversed(path) if x.tag in ("article", "main")), None)
    inside = next((x for x in path if x.tag == "article"), whole)
    if inside is not None:
        return text_of(inside)
    chosen, on_path = {id(core)}, set(map(id, path))
    for x in path[1:]:
        before = True  # a heading beside the path, ahead of the core, is the title: it is short, whatever its density
        for y in x.parts:
            if not isinstance(y, Node) or y.furniture:
                continue
            if id(y) in on_path:
                before = False
            elif (y.density >= threshold > 0 or before and y.tag == "h1") and y.link_chars * 2 < y.chars:
                chosen.add(id(y))
    if len(chosen) == 1:
        return text_of(core)
    return " ".join(filter(None, (text_of(x) for x in nodes if id(x) in chosen)))


def text_of(top: Node) -> str:
    """Blocks in page order: white space inside one is one space, blocks are joined by one."""
    blocks, line = [], []

    def flush():
        s = SPACE.sub(" ", entities.unescape("".join(line))).strip()
        line.clear()
        if s:
            blocks.append(s)

    todo: list = [top]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif not x.furniture:
            if x.tag in BLOCK:
                flush()
                todo.append(None)
            todo += reversed(x.parts)
    flush()
    return " ".join(blocks)


def extract_main(df: DataFrame, column: str = "html") -> DataFrame:
    """``df`` with ``text``, the main text of the html column, and ``n_chars``."""

    def make():
        def run(pages):
            texts = [extract(p) for p in pages]
            return {"text": texts, "n_chars": list(map(len, texts))}

        return run

    return common.map_text(df, column, "text string, n_chars long", make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main(pages).select("page_id", "url", "text", "n_chars")
