"""Main-text extraction from HTML by tree scoring.

The page is parsed into a tree of elements.  Each paragraph earns points for its length and its
commas, discounted by its link density; its parent gets them whole and every further ancestor
half of what the one below it got.  The container with the most points after its own link-density
discount marks the article (of equal ones the first in the page).  Where it lies in an article or
main element, the outermost of these is taken whole, headings, lists and short blocks included;
beside it, further such elements, siblings that score a fifth as much, and long paragraphs with
few links are kept.  On other pages the container is taken whole, and from the blocks around it,
up to the body, all but those that are half links or more.  Elements that are furniture by tag,
role or name (menus, headers, footers, side bars, notices, adverts, forms, scripts, comments) are
cut out before scoring and from the result.  A name counts word by word for containers; headings
and paragraphs are furniture only where a whole name says so (``section-header`` is a heading).

Parsing, sums and scores are linear in the page, however deeply it nests: open elements are
found by tag, and sums and points are added up once, from the leaves to the root.

Defined results
    null, empty and text-free html gives an empty text; unclosed and truncated markup is closed
    at the end, odd declarations are comments; a page without any paragraph falls back to its
    body's text blocks; very long pages are read whole; repeated rows give repeated results;
    other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import bounded_batches, map_texts
from quern.sources.documents import Markup

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP = frozenset("head script style noscript template iframe object audio video svg math canvas nav aside footer form button select textarea input datalist dialog menu".split())
BLOCK = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
PARAGRAPH = frozenset("p pre blockquote td li dd".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold running text themselves, besides headings and inline elements.
TEXT = frozenset("p pre blockquote td th li dd dt figcaption summary caption".split())
#: Elements whose content is all main text, furniture apart.
WHOLE = frozenset(("article", "main"))
#: Words of a class or id that mark furniture (names are split at - and _).
FURNITURE = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promoted related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toc toolbar widget".split())
#: Those that mark a heading too, as the whole of a name.
ADDED = frozenset("ad ads advert advertisement adverts comment comments cookie cookies disqus newsletter promo promoted related respond sponsor sponsored subscribe subscription".split())
#: A name of these beside one of the article's words heads the article; one with a word of WITHOUT
#: tells of furniture that is elsewhere, or missing.
HEADS, OWN_HEAD, WITHOUT = frozenset("header banner masthead".split()), frozenset("article content entry post section story".split()), frozenset("has no not with without".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Elements that a stray end tag of an inline element does not close.
HOLDERS = frozenset(("article", "body", "html", "main", "table", "td", "div", "section"))
#: An open element of the key is closed by a start tag of its set.
_INLINE_BLOCKERS = BLOCK - {"html", "body"}
CLOSES = {"p": _INLINE_BLOCKERS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}, "head": {"body"}}
_SPACE = re.compile(r"\s+")
_SPLIT = re.compile(r"[_\-]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _furniture(tag: str, name: str) -> bool:
    """Whether one name of an element marks it as furniture."""
    words = {w for w in _SPLIT.split(name) if w}
    if tag in HEADING:
        return bool(words) and words <= ADDED
    if tag in TEXT or tag not in BLOCK:
        return bool(words) and words <= FURNITURE
    found = words & FURNITURE
    return bool(found) and not words & WITHOUT and not (found <= HEADS and words & OWN_HEAD)


def is_furniture(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element with its content is no main text; ``inside``: inside an article or main."""
    if tag in DROP or tag == "header" and not inside:
        return True
    if tag in ("body", "html", "article", "main", "header"):
        return False
    for key, value in attrs:
        low = (value or "").lower()
        if key == "hidden" or key == "aria-hidden" and low == "true" or key == "style" and _HIDDEN.search(low):
            return True
        if key == "role" and ROLES.intersection(low.split()):
            return True
        if key in ("class", "id") and any(_furniture(tag, name) for name in low.split()):
            return True
    return False


class Node:
    """An element, and what lies below it without furniture: characters, commas, characters in links."""

    __slots__ = ("chars", "children", "commas", "dropped", "linked", "parent", "prose", "score", "tag")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []
        self.score, self.prose = 0.0, False
        self.chars = self.commas = self.linked = 0


class Tree(Markup):
    """Builds the tree; end tags without a partner are ignored, open elements close with their ancestors."""

    def __init__(self):
        super().__init__()
        self.root = Node("#root", None)
        self.open = [self.root]
        #: Places in ``open``: of each tag, of what a start tag could close, of holders.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.holders: list[int] = []

    def handle_starttag(self, tag, attrs):
        # The innermost open block, seen through inline elements, may end here.
        while self.blocks and tag in CLOSES.get(self.open[self.blocks[-1]].tag, ()):
            self._leave(self.blocks[-1])
        inside = any(self.places.get(t) for t in WHOLE)
        at = self.open[-1]
        node = Node(tag, at, is_furniture(tag, attrs, inside))
        at.children.append(node)
        if tag not in VOID:
            here = len(self.open)
            self.open.append(node)
            self.places.setdefault(tag, []).append(here)
            if tag in BLOCK or tag in CLOSES:
                self.blocks.append(here)
            if tag in HOLDERS:
                self.holders.append(here)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        places = self.places.get(tag)
        if places and (tag in BLOCK or not self.holders or self.holders[-1] <= places[-1]):
            self._leave(places[-1])

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def _leave(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()
        for held in (self.blocks, self.holders):
            while held and held[-1] >= place:
                held.pop()


def _size(text: str) -> int:
    return len(_SPACE.sub(" ", text).strip())


def _elements(root: Node) -> list[Node]:
    """The elements that are no furniture, each before what lies in it."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return found


def score_tree(root: Node) -> tuple[Node | None, float]:
    """Fill in sums and scores; the best container and its score (none without a paragraph)."""
    order = _elements(root)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                size = _size(child)
                node.chars += size
                node.commas += child.count(",")
        if node.tag == "a":
            node.linked = node.chars
        points = 0.0
        if node.tag in PARAGRAPH and not node.prose and node.chars:
            points = (1 + node.commas + min(node.chars / 100, 3)) * (1 - node.linked / node.chars)
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.commas += node.commas
            up.linked += node.linked
            up.prose = up.prose or node.prose or node.tag in PARAGRAPH
            if up is not root:
                up.score += points + node.score / 2
    best, most = None, 0.0
    for node in order:
        score = node.score * (1 - node.linked / max(node.chars, 1))
        if score > most:
            best, most = node, score
    return best, most


def _pieces(node: Node) -> list[list[Node | str]]:
    """A node's children: each block by itself, what runs between blocks together."""
    out: list[list[Node | str]] = []
    run = False
    for child in node.children:
        block = isinstance(child, Node) and (child.tag in BLOCK or child.dropped or bool(child.score))
        if run and not block:
            out[-1].append(child)
        else:
            out.append([child])
        run = not block
    return out


def _density(piece: list[Node | str]) -> float:
    """The share of a piece's characters that is inside links."""
    chars = sum(_size(c) if isinstance(c, str) else c.chars for c in piece if isinstance(c, str) or not c.dropped)
    linked = sum(c.linked for c in piece if isinstance(c, Node) and not c.dropped)
    return linked / chars if chars else 1.0


def _blocks(node: Node) -> list[str]:
    """The text of each block below a node, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        if text := _SPACE.sub(" ", "".join(run)).strip():
            out.append(text)
        run.clear()

    stack: list[Node | str | None] = [node]
    while stack:
        at = stack.pop()
        if at is None:
            flush()
        elif isinstance(at, str):
            run.append(at)
        elif at.tag == "br":
            run.append(" ")
        elif not at.dropped:
            block = at.tag in BLOCK
            if block:
                flush()
                stack.append(None)
            stack.extend(reversed(at.children))
    flush()
    return out


def extract(html: str) -> str:
    tree = Tree()
    tree.read(html)
    best, most = score_tree(tree.root)
    if best is None:
        return "\n".join(_blocks(tree.root))
    whole, up = None, best
    while up is not None:
        if up.tag in WHOLE:
            whole = up
        up = up.parent
    at = whole or best
    while at.parent is not None:
        kept: list[Node | str] = []
        for piece in _pieces(at.parent):
            if len(piece) == 1 and piece[0] is at:
                kept.append(at)
                continue
            density, (first, *more) = _density(piece), piece
            strong = False
            if not more and isinstance(first, Node):
                strong = first.score * (1 - density) >= most / 5 or first.tag in WHOLE or first.tag == "p" and density < 0.25 and first.chars > 80
            if strong or whole is None and density < 0.5:
                kept += piece
            else:
                kept.append(Node("div", at.parent))  # keeps its neighbours apart
        at.parent.children = kept
        at = at.parent
        if whole is not None:
            break
    return "\n".join(_blocks(at))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    bounded_batches(pages.sparkSession)

    def row(html: str) -> tuple:
        text = extract(html)
        return text, len(text)

    return map_texts(pages, row, [("text", pa.string()), ("n_chars", pa.int64())], "text string, n_chars long", ["page_id", "url"], "html")
