"""Main text of HTML pages by composite text density.

Every node gets its characters per tag, adjusted for links: with characters
``C``, tags ``T``, link characters ``LC`` and link tags ``LT`` of the node and
``LCb``, ``Cb`` of the body,

    density = C / T * ln(C * T / (LC * LT)) / ln(ln(LC * C / (C - LC) + C * LCb / Cb + e**e))

(zero counts divide as one).  The node whose children's densities have the
largest sum holds the text.  The smallest density on its path to the body is
the threshold: beside that path, nodes and runs of bare text at or above it
and headings belong to the text too.  An ``article`` or ``main`` element on
that path belongs to the text as a whole and bounds it: outside the outermost
of them only sibling ``article`` elements at or above the threshold are added,
so a story in several parts stays together.

Menus, footers, sidebars, notices, adverts, forms and comments, by element,
role or class, count for nothing in the search; of a header inside an article
only the headings count.  A class or id that is made of junk words and of
words for layout makes junk of its element.  One that merely holds a junk word
("social-history") makes junk of a block only below the threshold, and never
of an inline element.  No class or id makes junk of a wrapper: see
``_lift_wrappers``.  Labels and buttons in the middle of a sentence are text.

Null and empty pages, and pages without text, give the empty string.  Pages
that repeat are extracted each.  Only the page is read, other columns may have
any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import reachable, slices

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
ENDED_BY = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "option": frozenset({"option"}),
    "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
    "tbody": frozenset({"tr", "td", "th", "tbody", "thead"}), "tfoot": frozenset({"tr", "td", "th", "tbody", "thead"}),
}
HOLDS = frozenset("ul ol dl table select article section div body html main aside nav footer header form td th".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg object canvas".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What never belongs to an article.
JUNK = frozenset("head nav footer aside form menu input select fieldset dialog audio video map".split()) | RAW
CONTROLS = frozenset("button label".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
JUNK_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "notice notices alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead "
    "comment comments respond disqus share sharing social related newsletter subscribe subscription signup login search "
    "pagination pager widget toolbar hidden".split()
)

#: Words that name a place of the layout, not what stands there.
PLACES = frozenset(
    "a an the container box wrapper wrap area list block section group row column col left right top bottom main site page global "
    "primary secondary post posts item items inner outer bar link links unit slot panel content reader readers user entry".split()
)

#: Readers' comments often hold more text than the story.
TALK = frozenset("comment comments respond disqus".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


class Node:
    __slots__ = ("tag", "parent", "children", "junk", "named", "weak", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, junk: bool):
        self.tag, self.parent, self.junk = tag, parent, junk
        self.named: frozenset[str] = frozenset()  # words of class and id that alone make it junk
        self.weak = False  # they stand in names that say something else as well
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_junk(tag: str, attributes: str, inside: Node) -> bool:
    if tag in JUNK:
        return True
    if tag in CONTROLS and not (inside.tag == "p" and any(isinstance(c, str) and c.strip() for c in inside.children)):
        return True
    if tag == "header":  # a page's header; of an article's own one the headings stay
        node: Node | None = inside
        while node is not None and node.tag not in ("article", "main"):
            node = node.parent
        if node is None:
            return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    return _hidden(attributes)


def _hidden(attributes: str) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and JUNK_ROLES.intersection(value.split()):
            return True
    return False


def _junk_names(tag: str, attributes: str) -> tuple[frozenset[str], bool]:
    """The words of class and id that name junk, and whether they only stand in names that say something else as well."""
    found: frozenset[str] = frozenset()
    weak = True
    if not attributes or tag in ("body", "html", "article", "main"):
        return found, False
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id"):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                parts = {x for x in _NAME_PARTS.split(name) if x and not x.isdigit()}
                if parts & JUNK_NAMES:
                    found |= parts & JUNK_NAMES
                    weak &= not parts <= JUNK_NAMES | PLACES
    return found, weak and bool(found)


def parse(html: str) -> Node:
    """The element tree; text stands as it is in the page, references not yet decoded."""
    root = Node("html", None, False)
    at = root
    headers: list[Node] = []
    place, lower = 0, None
    while (m := _TAG.search(html, place)) is not None:
        if m.start() > place:
            at.children.append(html[place : m.start()])
        place = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        attributes = m[3] or m[6] or ""
        if m[1] or m[4]:
            node: Node | None = at
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            elif tag == "p":
                at.children.append(Node("p", at, False))
            continue
        if tag in ("html", "body") and (tag == "html" or any(isinstance(c, Node) and c.tag == "body" for c in root.children)):
            continue
        if tag == "body":
            at = root  # whatever of the head was left open ends
        closes = frozenset({"p"}) if tag in ENDS_PARAGRAPH else ENDED_BY.get(tag)
        if closes:
            node = at
            while node is not None and node.tag not in closes and node.tag not in HOLDS:
                node = node.parent
            if node is not None and node.tag in closes and node.parent is not None:
                at = node.parent
                if tag in ("tr", "tbody", "tfoot"):  # a row ends the cell and the row before
                    while at.tag in closes and at.parent is not None:
                        at = at.parent
        new = Node(tag, at, _is_junk(tag, attributes, at))
        if tag == "header" and not new.junk:
            headers.append(new)
        if not new.junk:
            names, new.weak = _junk_names(tag, attributes)
            if not new.weak or tag in BLOCKS:
                new.named = names
            new.junk = bool(new.named)
        at.children.append(new)
        if tag in RAW and not attributes.endswith("/"):
            if lower is None:
                lower = html.lower() if len(html.lower()) == len(html) else html
            end = lower.find(f"</{tag}", place)
            stop = html.find(">", end) if end >= 0 else -1
            place = len(html) if stop < 0 else stop + 1
        elif tag not in VOID and not attributes.endswith("/"):
            at = new
    if place < len(html):
        at.children.append(html[place:])
    for header in headers:
        header.children = _headings(header)
    return root


def _headings(header: Node) -> list[Node | str]:
    """The headings below an article's header; the rest of it is no text of the article."""
    out: list[Node | str] = []
    waiting: list[Node | str] = list(reversed(header.children))
    while waiting:
        item = waiting.pop()
        if isinstance(item, Node) and not item.junk:
            if item.tag in HEADINGS:
                item.parent = header
                out.append(item)
            else:
                waiting.extend(reversed(item.children))
    return out


def _lift_wrappers(root: Node) -> None:
    """Elements that are junk by name alone are not junk if they wrap the article.

    They do if they hold a ``main`` element; an ``article`` element, unless they
    stand in one; or, unless they are named after comments, more than half of
    the page's text outside links.  The last two hold only while no ``article``
    or ``main`` with text stands elsewhere in the open.  Outer elements are
    decided first, those inside them if they are lifted.
    """
    order: list[Node] = []
    waiting = [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(c for c in node.children if isinstance(c, Node) and (c.named or not c.junk))
    if not any(n.named for n in order):
        return
    plain: dict[int, int] = {}
    holds: dict[int, set[str]] = {}
    for node in reversed(order):
        text, held = 0, set()
        for c in node.children:
            if isinstance(c, str):
                text += len(c.strip())
            elif c.named or not c.junk:
                text += plain[id(c)] if c.tag != "a" else 0
                held |= holds[id(c)]
        if node.tag in ("article", "main") and text:
            held = held | {node.tag}
        plain[id(node)], holds[id(node)] = text, held
    shown = 0  # article and main elements with text in the open
    level = [(root, 0, False)]  # with the number of such elements around, and whether one is an article
    while level:
        wrappers: list[tuple[Node, int, bool]] = []
        while level:
            node, around, inside = level.pop()
            if node.tag in ("article", "main") and plain[id(node)]:
                shown, around, inside = shown + 1, around + 1, inside or node.tag == "article"
            for c in node.children:
                if isinstance(c, Node) and c.named:
                    wrappers.append((c, around, inside))
                elif isinstance(c, Node) and not c.junk:
                    level.append((c, around, inside))
        for node, around, inside in wrappers:
            held, alone = holds[id(node)], shown == around
            most = 2 * plain[id(node)] > plain[id(root)] and not node.named & TALK
            if "main" in held or (alone and (most or ("article" in held and not inside))):
                node.junk, node.named = False, frozenset()
                level.append((node, around, inside))


def _weigh(node: Node, body_share: float) -> None:
    """Density from the counts of the node."""
    c, t = node.chars, max(node.tags, 1)
    if c:
        plain = max(c - node.link_chars, 1)
        gain = math.log(max(c * t / (max(node.link_chars, 1) * max(node.link_tags, 1)), 1.0))
        node.density = c / t * gain / math.log(math.log(node.link_chars * c / plain + c * body_share + math.e**math.e))


def _count(node: Node) -> None:
    """Counts of a node from those of its children; junk counts for nothing."""
    for c in node.children:
        if isinstance(c, str):
            node.chars += len(c.strip())
        elif not c.junk:
            node.chars += c.chars
            node.tags += c.tags + 1
            node.link_chars += c.chars if c.tag == "a" else c.link_chars
            node.link_tags += c.link_tags + (c.tag == "a")


def _measure(root: Node, body_share: float | None = None) -> None:
    """Counts of every node, children first; junk below the root counts for nothing."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(c for c in node.children if isinstance(c, Node) and not c.junk)
    for node in reversed(order):
        _count(node)
    if body_share is None:
        body_share = root.link_chars / root.chars if root.chars else 0.0
    for node in order:
        _weigh(node, body_share)
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.junk)


def _pieces(children: list[Node | str], above: Node, body_share: float) -> list[Node]:
    """The nodes among the children; bare text makes one node with the inline elements and line breaks around it."""
    out: list[Node] = []
    run: list[Node | str] = []

    def end() -> None:
        if any(isinstance(c, str) and c.strip() for c in run):
            whole = Node("span", above, False)
            whole.children = list(run)
            _count(whole)
            _weigh(whole, body_share)
            out.append(whole)
        else:
            out.extend(c for c in run if isinstance(c, Node))
        run.clear()

    for c in children:
        if isinstance(c, str) or c.tag == "br" or c.tag not in BLOCKS:
            run.append(c)
        else:
            end()
            out.append(c)
    end()
    return out


def _path(root: Node) -> list[Node]:
    """From the node with the largest sum of its children's densities up to the root."""
    best, waiting = root, [root]
    while waiting:
        node = waiting.pop()
        if node.total > best.total:
            best = node
        waiting.extend(c for c in node.children if isinstance(c, Node) and not c.junk)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def _threshold(path: list[Node]) -> float:
    return min(n.density for n in [n for n in path if n.tag != "html"] or path)


def _open_weak(nodes: list[Node], threshold: float, body_share: float) -> None:
    """Blocks below the nodes that a name hides, though it says something else as well, are text from the threshold on."""
    waiting = list(nodes)
    while waiting:
        node = waiting.pop()
        if node.junk:
            if not (node.weak and node.named):
                continue
            _measure(node, body_share)
            if node.density < threshold:
                continue
            node.junk = False
        waiting.extend(c for c in node.children if isinstance(c, Node))


def _chosen(root: Node) -> list[Node]:
    """The nodes whose text is the article, in page order."""
    path = _path(root)
    threshold = _threshold(path)
    body_share = root.link_chars / root.chars if root.chars else 0.0
    bounds = [k for k, n in enumerate(path) if n.tag in ("article", "main")]
    inner, outer = (bounds[0], bounds[-1]) if bounds else (0, len(path))
    out = [path[inner]]

    def belongs(c: Node, outside: bool) -> bool:
        if c.junk or not c.chars:
            return False
        return c.density >= threshold if outside else c.density >= threshold or c.tag in HEADINGS

    for level, (node, above) in enumerate(zip(path[inner:], path[inner + 1 :]), inner):
        at = next(k for k, c in enumerate(above.children) if c is node)
        outside = level >= outer
        before, after = (
            [c for c in _pieces(part, above, body_share) if belongs(c, outside) and (not outside or c.tag == "article")]
            for part in (above.children[:at], above.children[at + 1 :]))
        out = before + out + after
    _open_weak(out, threshold, body_share)
    return out


def _blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks below a node, references decoded and white space folded."""
    run: list[str] = []
    waiting: list[Node | str | None] = [node]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            run.append(item)
            continue
        if item is None or item.tag in BLOCKS:
            if run:
                yield " ".join(unescape("".join(run)).split())
                run = []
        if item is not None and not item.junk:
            if item.tag in BLOCKS:
                waiting.append(None)
            waiting.extend(reversed(item.children))
    if run:
        yield " ".join(unescape("".join(run)).split())


def main_text(html: str | None) -> str:
    """The article of a page."""
    if not html:
        return ""
    root = parse(html)
    _lift_wrappers(root)
    _measure(root)
    return " ".join(b for node in _chosen(root) for b in _blocks(node) if b)


def extract(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), into: str = "text") -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` of every page."""
    slim = df.select(*keep, F.col(html).alias("_html"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_html"):
                texts = [main_text(x) for x in part.column("_html").to_pylist()]
                arrays = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], [*keep, into, "n_chars"])

    return reachable(slim).mapInArrow(run, f"{types}, `{into}` string, n_chars long")
