"""Main text of web pages by composite text density.

Every node of the page's tree gets a density: its characters per tag, adjusted by how many of
its characters and tags belong to links. A node's density sum is the sum of its children's
densities. The node with the largest sum holds the main text; the smallest density on the path
from it up to the body is the threshold, and other subtrees above the threshold count as main
text too. What is never text (scripts, menus, forms, adverts, comments of readers ...) is taken
from the tree beforehand.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, by what they mean here.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NOT_TEXT = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video "
    "nav header footer aside form button select textarea input menu dialog".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag closes an open element of these names within the nearest listed scope.
CLOSES = {
    **dict.fromkeys(BLOCKS - {"body", "html", "li", "dd", "dt", "td", "th", "tr"}, ("p",)),
    "li": ("li", "p"),
    "dd": ("dd", "dt", "p"),
    "dt": ("dd", "dt", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
    "option": ("option",),
}
SCOPES = frozenset(
    "html body table ul ol dl article section div main aside nav header footer form button "
    "blockquote td th figure details fieldset".split()
)
#: Class, id and role words of page parts that are not the article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments complementary contentinfo cookie cookies disqus footer header menu nav navbar "
    "navigation newsletter notice notices pagination popup promo promoted related share sharing "
    "sidebar social sponsor sponsored subscribe subscription widget masthead toolbar copyright "
    "consent replies respond".split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(
    r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I
)
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An element: its children are elements and texts in page order."""

    __slots__ = ("chars", "children", "density", "link_chars", "link_tags", "name", "parent", "tags")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent, self.children = name, parent, []


def _is_noise(name: str, attributes: str) -> bool:
    if name in NOT_TEXT:
        return True
    for key, value in _NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and _HIDDEN.search(value):
            return True
        if key in ("class", "id", "role") and name not in ("html", "body", "article", "main"):
            if not NOISE_WORDS.isdisjoint(_WORD.findall(value)):
                return True
    return False


def parse(html: str) -> Node:
    """The tree of a page without the parts that are never text."""
    root = Node("html", None)
    here, at, skipped = root, 0, 0
    stack: list[tuple[str, bool]] = []  # open elements; whether each began a part left out
    raw_end = None
    for match in _MARKUP.finditer(html):
        start = match.start()
        if start < at:
            continue
        name = (match[2] or "").lower()
        if raw_end is not None:
            if not (match[1] and name == raw_end):
                continue
            raw_end = None
        if start > at and not skipped:
            here.children.append(html[at:start])
        at = match.end()
        if not name or not html.endswith(">", 0, at):
            continue  # a comment, a declaration, or a tag that the page's end cuts off
        if match[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is None:
                continue
            while len(stack) > depth:
                here, skipped = _close(stack, here, skipped)
            continue
        for closing in CLOSES.get(name, ()):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == closing:
                    while len(stack) > depth:
                        here, skipped = _close(stack, here, skipped)
                    break
                if stack[depth][0] in SCOPES:
                    break
        if name in VOID:
            if not skipped:
                here.children.append(Node(name, here))
            continue
        noise = _is_noise(name, match[3])
        stack.append((name, noise))
        if noise:
            skipped += 1
        elif not skipped:
            child = Node(name, here)
            here.children.append(child)
            here = child
        if name in RAW and not (match[3].endswith("/") and name not in ("script", "style")):
            raw_end = name
    if at < len(html) and not skipped and raw_end is None:
        here.children.append(html[at:])
    return root


def _close(stack, here, skipped):
    _, noise = stack.pop()
    if noise:
        return here, skipped - 1
    return (here if skipped else here.parent), skipped


def _measure(root: Node) -> list[Node]:
    """Characters, tags and links of every subtree; nodes in page order."""
    order, todo = [], [(root, False)]
    while todo:
        node, linked = todo.pop()
        order.append(node)
        linked = linked or node.name == "a"
        node.tags = node.link_tags = node.chars = node.link_chars = 0
        for child in reversed(node.children):
            if isinstance(child, str):
                count = len("".join(unescape(child).split()))
                node.chars += count
                node.link_chars += count if linked else 0
            else:
                todo.append((child, linked))
    for node in reversed(order):
        above = node.parent
        if above is not None:
            above.chars += node.chars
            above.link_chars += node.link_chars
            above.tags += node.tags + 1
            above.link_tags += node.link_tags + (node.name == "a")
    return order


def _densities(order: list[Node], body: Node) -> None:
    body_links = body.link_chars / max(1, body.chars)
    for node in order:
        chars, links = node.chars, node.link_chars
        if not chars:
            node.density = 0.0
            continue
        tags = max(1, node.tags)
        plain = max(1, chars - links)
        base = math.log(chars / plain * links + body_links * chars + math.e)
        ratio = chars / max(1, links) * tags / max(1, node.link_tags)
        node.density = chars / tags * math.log(max(ratio, 1.0)) / math.log(max(base, 1.0001))


def main_nodes(root: Node) -> tuple[list[Node], float]:
    """Roots of the subtrees that hold the main text, in page order, and the threshold."""
    order = _measure(root)
    body = next((n for n in order if n.name == "body"), root)
    if not body.chars:
        return [], 0.0
    _densities(order, body)

    def density_sum(node: Node) -> float:
        return sum(c.density for c in node.children if isinstance(c, Node)) or node.density

    inside = [n for n in order if n.chars and (n is body or _below(n, body))]
    best = max(inside, key=density_sum)
    while best is not body and (best.name not in BLOCKS or best.name == "p" or best.name in HEADINGS):
        best = best.parent  # a text is made of whole blocks, with the headings beside them
    threshold, node = best.density, best
    while node is not body and node.parent is not None:
        node = node.parent
        threshold = min(threshold, node.density)
    found, todo = [], [body]
    while todo:
        node = todo.pop()
        if node is best or (node is not body and not _below(best, node) and _is_content(node, threshold)):
            found.append(node)
        elif node is body or _below(best, node):
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found, threshold


def _is_content(node: Node, threshold: float) -> bool:
    """A subtree beside the chosen one that is dense and not made of links."""
    return (
        node.density >= threshold
        and 2 * node.link_chars < node.chars
        and (node.name in BLOCKS or node.parent.name in BLOCKS)
    )


def _below(node: Node, above: Node) -> bool:
    while node is not None:
        if node is above:
            return True
        node = node.parent
    return False


def _is_menu(node: Node, threshold: float) -> bool:
    """A sparse part of several links that are most of its text."""
    return (
        node.link_tags > 1 and 2 * node.link_chars > node.chars and node.density < threshold
    )


def blocks_of(nodes: list[Node], threshold: float) -> list[str]:
    """Their texts, one per block: references decoded, white space as single spaces."""
    blocks: list[list[str]] = [[]]
    for top in nodes:
        blocks.append([])
        todo: list = [top]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                blocks[-1].append(item)
            elif item is None:
                blocks.append([])
            elif item.name == "br":
                blocks[-1].append(" ")
            elif item.name in BLOCKS:
                blocks.append([])
                if _is_menu(item, threshold):
                    continue
                todo += [None, *reversed(item.children)]
            else:
                todo += reversed(item.children)
    texts = (" ".join(unescape("".join(parts)).split()) for parts in blocks)
    return [text for text in texts if text]


def main_text(html: str | None) -> str:
    """The main text of one page; empty for null, empty and textless pages."""
    return "\n".join(blocks_of(*main_nodes(parse(html)))) if html else ""


def page_text(html: Column) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array((main_text(p.as_py()) for p in pages), pa.string())

    return extract(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, main ``text`` and its ``n_chars``.

    Null and empty pages have an empty text. Repeated rows are answered each; an empty table
    gives an empty result; other columns are ignored. Nothing of the main text is cut.
    """
    texts = pages.select("page_id", "url", page_text(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
