"""Main text of web pages by composite text density.

Every element of the parsed page is a node and gets its characters per tag, weighed by how much of it is link text. The node whose
children's densities have the largest sum holds the article. The lowest density on the way from it up to the body is the
threshold at which other subtrees count as content too; within the article that the node is part of, all text does that is not mostly links.
Parts that are no article by their kind are cut before. So are parts with a telling name, unless the page's text is mostly theirs.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import lean, ship

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style noscript textarea title template iframe noembed noframes xmp".split())
CUT = frozenset("nav footer aside form button select dialog menu svg math canvas object audio video map datalist head".split())
LANDMARKS = frozenset("html body main article".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "popup modal newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "share sharing social related recommended widget toolbar pagination pager login signup search skip".split())
READERS = frozenset("comment comments respond replies disqus".split())
#: What cuts an element: its kind, a name, or a name of readers' comments.
KIND, NAMED, COMMENTS = 1, 2, 3
#: Elements that a wrapper of the whole page has and a list of comments has not.
HEADS = frozenset("article main h1".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Start tags that end an open element of these kinds, up to the limits after the bar.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"),
    "th": ("td th", "table tr"), "tbody": ("tr td th thead tbody", "table"), "tfoot": ("tr td th thead tbody", "table"), "option": ("option", "select"),
}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

# A tag or quote that never ends takes the rest of the page, as in a browser; so each character is looked at once.
_token = re.compile(r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
_named = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "first", "last", "cut", "gone", "density", "total", "head")

    def __init__(self, tag: str, parent: Node | None, first: int, cut: int):
        self.tag, self.parent, self.first, self.cut = tag, parent, first, cut
        self.children: list[Node] = []
        self.gone: list[tuple[int, int]] = []  # piece ranges of cut children
        self.chars = self.tags = self.link_chars = self.link_tags = self.last = 0
        self.density = self.total = 0.0
        self.head = tag in HEADS


def _cut_by(tag: str, attributes: str, inside: bool) -> int:
    """What says that an element is no part of an article, or 0; ``inside``: within an article or main element."""
    if tag in LANDMARKS:
        return 0
    if tag in CUT or tag in RAW or tag == "header" and not inside:
        return KIND
    found = 0
    for m in _named.finditer(attributes) if attributes else ():
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in ROLES:
                return KIND
            continue
        for name in value.split():
            pieces = re.split(r"[-_]", name)
            last = pieces[-1] if pieces[0] not in ("has", "with", "no", "without") else ""
            if not READERS.isdisjoint((name, pieces[0], last)):
                found = COMMENTS
            elif not found and not NAMES.isdisjoint((name, pieces[0], last)):
                found = NAMED
    return found


def parse(page: str) -> tuple[Node, list[str | None]]:
    """The tree, and the page's pieces in order: text, or None at a block's edge. Nodes know their range of pieces."""
    root = Node("#", None, 0, 0)
    pieces: list[str | None] = []
    stack = [root]
    at = 0
    in_link = inside = 0

    def close(n: int) -> None:
        nonlocal in_link, inside
        while len(stack) > n:
            node = stack.pop()
            node.last = len(pieces)
            if node.tag in BLOCK:
                pieces.append(None)
            in_link -= node.tag == "a"
            inside -= node.tag in ("article", "main")

    def say(text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        n = len(text.strip())
        pieces.append(text)
        stack[-1].chars += n
        if in_link:
            stack[-1].link_chars += n

    position, n = 0, len(page)
    while position < n:
        m = _token.search(page, position)
        if not m:
            break
        if m.start() > at:
            say(page[at:m.start()])
        position = at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCK and tag != "a" and stack[k].tag in BLOCK:
                    break  # emphasis that began outside of the block
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, position)
            position = at = end.end() if end else n
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends where a block begins
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag in ENDS:
            ends, limits = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in limits:
                    break
                if stack[k].tag in ends:
                    close(k)
        if tag in BLOCK:
            pieces.append(None)
        if tag in VOID:
            stack[-1].tags += 1
            continue
        node = Node(tag, stack[-1], len(pieces), _cut_by(tag, m[3], inside > 0))
        stack[-1].children.append(node)
        stack.append(node)
        in_link += tag == "a"
        inside += tag in ("article", "main")
    if at < n:
        say(page[at:])
    close(1)
    root.last = len(pieces)
    return root, pieces


def _spare(nodes: list[Node]) -> None:
    """Takes back the cuts by name of what holds the page's text: a name tells less than where the text is.

    A named part is spared if it has more than half of the text in several blocks, or nearly all of it, and few links, unless the page has an
    article or main element outside of it. A name of readers' comments needs nearly all text and a heading, article or main element inside.
    """
    def masses(left_out: tuple[int, ...]) -> dict[int, tuple[int, int, int]]:
        """Characters of each node, those of its links, and its blocks, without the parts that are cut so."""
        out: dict[int, tuple[int, int, int]] = {}
        for x in reversed(nodes):
            inner = [out[id(c)] for c in x.children if c.cut not in left_out]
            own = (x.chars, x.link_chars, x.tag in BLOCK)
            out[id(x)] = tuple(a + sum(m[k] for m in inner) for k, a in enumerate(own))
        return out

    named = [x for x in nodes if x.cut > KIND]
    if not named:
        return
    for x in reversed(nodes):
        x.head = x.head or any(c.head for c in x.children)
    mass = masses((KIND,))
    page = mass[id(nodes[0])][0]
    for x in named:
        if x.cut == COMMENTS and x.head and mass[id(x)][0] * 10 >= page * 9:
            x.cut = 0
    mass = masses((KIND, COMMENTS))
    page = mass[id(nodes[0])][0]
    marked = [x for x in nodes if x.tag in ("article", "main") and mass[id(x)][0] and not _inside(x, KIND)]
    for x in named:
        chars, links, blocks = mass[id(x)]
        if x.cut == NAMED and links * 2 < chars and (chars * 10 >= page * 9 or chars * 2 > page and blocks > 3) \
                and all(x.first <= m.first and m.last <= x.last for m in marked):
            x.cut = 0


def _inside(x: Node, cut: int) -> bool:
    while x.parent is not None:
        if x.cut == cut:
            return True
        x = x.parent
    return False


def _in_order(root: Node) -> list[Node]:
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(reversed(node.children))
    return nodes


def _weigh(root: Node) -> list[Node]:
    """Sums and densities of all nodes, cut ones left out; gives the nodes, parents first."""
    nodes = _in_order(root)
    _spare(nodes)
    for node in nodes:
        node.gone = [(c.first, c.last) for c in node.children if c.cut]
        node.children = [c for c in node.children if not c.cut]
    nodes = _in_order(root)
    for node in reversed(nodes):
        for c in node.children:
            node.chars += c.chars
            node.tags += c.tags + 1
            node.link_chars += c.link_chars
            node.link_tags += c.link_tags + (c.tag == "a")
    body = next((x for x in nodes if x.tag == "body"), root)
    share = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + share * c + math.e)
            node.density = c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9, base) if base > 1 + 1e-9 else c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9)
            node.density = max(node.density, 0.0)
        node.total = sum(x.density for x in node.children)
    return nodes


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line ends; empty if there is no text."""
    if not page:
        return ""
    root, pieces = parse(page)
    nodes = _weigh(root)
    if not root.chars:
        return ""
    blocks = [x for x in nodes if x.tag in BLOCK or x is root]  # emphasis and links weigh, but an article is made of blocks
    best = max(blocks, key=lambda x: x.total)  # of equals the one nearest the root
    if best.total == 0:
        best = max(blocks, key=lambda x: (x.density, not x.children))
    threshold, node, path = best.density, best, [best]
    while node.tag != "body" and node.parent:
        node = node.parent
        path.append(node)
        threshold = min(threshold, node.density)
    # The article that the node is part of: the nearest element that says so, or else what directly holds the node.
    whole = next((x for x in path if x.tag == "article"), None) or next((x for x in path if x.tag == "main"), None)
    if whole is None:
        whole = best.parent if best.parent is not None and best is not node and best.parent is not node and best.parent.tag in BLOCK else best
    plain = lambda x: x.link_chars * 2 < x.chars
    chosen, todo, above = [best], [node], {id(x) for x in path[1:]}
    within = {id(x) for x in path[:path.index(whole) + 1]}
    while todo:
        x = todo.pop()
        if id(x) in above:
            # Loose text of an article's own belongs to it; that of the nodes above does not.
            chosen.extend(c for c in x.children if id(c) not in above and c is not best and id(x) in within
                          and (plain(c) if whole.tag == "article" else plain(c) and c.density >= threshold) and c.tag in BLOCK)
            todo.extend(c for c in x.children if id(x) not in within or id(c) in above)
        elif x is not best and x.tag in BLOCK and x.density >= threshold and x.total >= best.total / 2:
            chosen.append(x)
    parts = []
    for x in sorted(chosen, key=lambda x: x.first):
        parts.append(None)
        parts.extend(_pieces(x, pieces))
    blocks, now = [], []
    for piece in [*parts, None]:
        if piece is not None:
            now.append(piece)
        elif now:
            if line := " ".join("".join(now).split()):
                blocks.append(line)
            now = []
    return "\n".join(blocks)


def _pieces(node: Node, pieces: list[str | None]) -> list[str | None]:
    """The node's pieces without those of cut descendants, of which an edge stays where they are blocks."""
    out, at = [], node.first
    for first, last in _cut_ranges(node):
        out += pieces[at:first]
        at = last
    return out + pieces[at:node.last]


def _cut_ranges(node: Node) -> list[tuple[int, int]]:
    kept, todo = [], [node]
    while todo:
        x = todo.pop()
        kept.extend(x.gone)
        todo.extend(x.children)
    return sorted(kept)


def extract(pages: DataFrame, *, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """Main text of every whole page: ``id_cols``, ``text`` string, ``n_chars`` long (code points).

    One row per input row; null and empty pages, and pages without text outside menus and the like, give an empty text. Repeated rows
    give equal texts. Of nodes with equal sums the outermost, then first, wins. Other columns are ignored. No shuffle; a task holds
    one batch of pages and one page's tree.
    """
    ship(pages.sparkSession)
    rows = pages.select(*(F.col(c) for c in id_cols), F.col(html_col).cast("string").alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*batch.schema.names[:-1], "text", "n_chars"])

    return rows.mapInArrow(lean(run), schema)
