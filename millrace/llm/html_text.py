"""Main text of web pages by composite text density.

A page becomes a tree of elements, built leniently: what HTML closes by implication is closed, what
is never closed ends with its parent. For every node the number of characters below it is divided by
the number of tags, and weighted by how few of those characters stand in links, relative to the body: the
composite text density. A node's density sum is the sum over its children. From the node with the
largest sum the path up to the body gives the threshold, the least density on it; the main text is the subtree
with the largest sum among nodes that reach the threshold, blocks in page order.

Left out everywhere, before any density is counted: scripts, styles and other markup that is not
read, menus, and elements whose name or role, or one of whose classes or id, as a whole, says
footer, notice, advert or comments, whatever they hold but for one case below. Forms and what is called a header, a sidebar or another
part that pages also wrap around their text go where a paragraph stands beside them, outside of all these; where
none does, they hold the main text. So does what is called comments, if the page's only h1 and all its paragraphs
stand in it. Headings and headers that hold a heading only stay. A
part of a class ("has-sidebar", "no-comments") says nothing: density decides on such elements. The last h1
before a main text that has none is its title.

Pages are read in one pass. A tag ends at the first ``>`` outside of quoted values; once a page has shown a tag
that ends nowhere, at the first ``>`` at all, and where there is none the rest is text.

Defined cases: a null or empty page, or one without text, has the empty text; repeated rows are
extracted each; other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import ship

#: Element names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNREAD = frozenset(
    "script style noscript template head title svg math iframe object canvas audio video map "
    "select textarea button datalist option".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CUT = frozenset("nav menu aside footer dialog search".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "status toolbar tablist".split()
)
#: Code points of an element's own text from which it is a paragraph, whatever its name.
PARAGRAPH = 80
#: Classes and ids, as wholes, that name a part around the main text. A hyphen stands for an underscore or none, too.
AROUND = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs header masthead banner footer "
    "sidebar aside rail widget widgets ad ads adv advert adverts advertisement advertisements "
    "advertising sponsor sponsored sponsors promo promos promotion promoted cookie cookies consent "
    "gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup "
    "login form search comment comments commentlist disqus respond replies reply related "
    "recommended share sharing social toolbar pagination pager skip copyright "
    "main-nav site-nav top-nav nav-bar nav-menu nav-links main-navigation site-navigation "
    "main-menu site-menu top-menu side-menu menu-bar page-header site-header main-header top-header "
    "header-top header-bar top-bar page-footer site-footer main-footer footer-bottom footer-links "
    "side-bar left-sidebar right-sidebar sidebar-left sidebar-right sidebar-inner widget-area "
    "ad-banner ad-box ad-slot ad-unit ad-container ad-wrapper ads-box top-ad side-ad sponsored-content "
    "sponsored-links promo-box promo-banner cookie-notice cookie-banner cookie-bar cookie-consent "
    "cookie-policy consent-banner gdpr-banner site-notice alert-banner alert-box newsletter-signup "
    "newsletter-box newsletter-form subscribe-form subscribe-box login-form search-form search-box "
    "comment-list comments-area comments-section comment-section comment-form comment-respond user-comments disqus-thread "
    "related-posts related-articles related-links related-stories recommended-posts share-buttons "
    "share-bar share-links social-links social-share social-media social-buttons sharing-buttons skip-link "
    "copyright-notice".split()
)
#: Those of them that are also found around the main text itself.
WRAPPERS = frozenset(
    "header masthead banner rail aside sidebar widget widgets widget-area form modal popup overlay "
    "page-header site-header main-header top-header header-top left-sidebar right-sidebar "
    "sidebar-left sidebar-right sidebar-inner side-bar".split()
)
#: Those of them that hold reader comments; a whole article may be called so, too.
COMMENTS = frozenset("comment comments commentlist comment-list comments-area comments-section comment-section".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
LISTS = frozenset("ul ol menu dl table".split())
INSIDE_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption body html".split())
KEEPS = frozenset("article main body html".split())

TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
ATTRIBUTES = re.compile(r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+(?![a-z])")


class Node:
    __slots__ = ("name", "parent", "children", "cut", "called", "wraps", "talk", "chars", "paragraphs", "titles", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, name: str, parent: Node | None, cut: bool):
        self.name, self.parent, self.cut = name, parent, cut
        self.called = self.wraps = self.talk = False
        self.children: list[Node | str] = []


def is_around(name: str, attributes: str) -> bool:
    """Whether an element is a part around the main text, by its name, its role or as hidden."""
    if name in CUT:
        return True
    if not attributes or name in KEEPS:
        return False
    for key, value in NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key == "role" and value.lower() in ROLES:
            return True
    return False


def called_around(name: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether a whole class or id names a part around the main text, whether only such as also wrap it, or comments."""
    if name == "form":
        return True, True, False
    if not attributes or name in KEEPS or name in HEADINGS:
        return False, False, False
    names = {
        "-".join(w.lower() for w in WORD.findall(token))
        for key, value in NAMED.findall(attributes)
        if key.lower() in ("class", "id")
        for token in value.strip("\"'").split()
    } & AROUND
    return bool(names), names <= WRAPPERS, names <= WRAPPERS | COMMENTS


def count_paragraphs(root: Node) -> list[Node]:
    """Characters, paragraphs and titles of every kept node; parents come first in the list."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if not node.cut:
            order.append(node)
            waiting += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        texts = [c for c in node.children if isinstance(c, str)]
        own = sum(len(" ".join(html.unescape(c).split())) for c in texts)
        kept = [c for c in node.children if isinstance(c, Node) and not c.cut]
        node.chars = own + sum(c.chars for c in kept)
        node.paragraphs = sum(c.paragraphs for c in kept)
        node.titles = sum(c.titles for c in kept) + (node.name == "h1" and node.chars > 0)
        if own >= PARAGRAPH or node.name == "p" and node.chars:
            node.paragraphs += 1
    return order


def cut_called(root: Node) -> None:
    """Cuts what is called a part around, if it is no heading-only header and does not wrap the main text."""
    order = count_paragraphs(root)
    for node in order:
        if node.talk and node.titles and node.paragraphs:
            if (node.titles, node.paragraphs) == (root.titles, root.paragraphs):
                continue
        if node.called and not node.wraps and not (node.name == "header" and all_heading(node)):
            node.cut = True
    order = count_paragraphs(root)
    # Paragraphs outside of all forms, headers and the like.
    plain, waiting = 0, [root]
    while waiting:
        node = waiting.pop()
        inner = [c for c in node.children if isinstance(c, Node) and not c.cut]
        plain += node.paragraphs - sum(c.paragraphs for c in inner)
        waiting += [c for c in inner if not c.called]
    called = [n for n in order if n.called]
    most = max((n.paragraphs for n in called), default=0)
    for node in called:
        if node.name == "header" and all_heading(node):
            continue
        node.cut = bool(plain) or node.paragraphs < most or not most and node.name == "form"


class Opened:
    """The open elements of a page, with the depths of each name's and of the blocks'."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.name, []).append(len(self.nodes))
        if node.name in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        """Closes all elements from a depth on."""
        while len(self.nodes) > depth:
            name = self.nodes.pop().name
            self.depths[name].pop()
            if name in BLOCKS:
                self.blocks.pop()

    def last(self, names) -> int:
        """The depth of the innermost open element of some names, 0 if there is none."""
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def imply(self, name: str) -> None:
        """Closes what the start of an element closes."""
        if name in INSIDE_P and self.blocks and self.nodes[self.blocks[-1]].name == "p":
            self.cut(self.blocks[-1])
        if name in CLOSED_BY:
            names = CLOSED_BY[name]
            depth = self.last(names)
            if depth > self.last(LISTS):
                # A row closes its cells and itself.
                while self.nodes[depth - 1].name in names:
                    depth -= 1
                self.cut(depth)
        if name in HEADINGS and self.nodes[-1].name in HEADINGS:
            self.cut(len(self.nodes) - 1)

    def end(self, name: str) -> bool:
        """Closes the innermost element of a name; not one beyond a block, if it is inline."""
        depth = self.last((name,))
        if not depth or name not in BLOCKS and self.blocks and self.blocks[-1] > depth:
            return False
        self.cut(depth)
        return True


def tokens(page: str):
    """Texts, and ``(closing, name, attributes, end)`` of each tag. The end of raw text may be sent back."""
    at, begun, quoted = 0, 0, True
    while found := TAG.search(page, at):
        comment, other, closing, name = found.groups()
        attributes, end = "", -1
        if comment:
            end = page.find("-->", found.end())
            end = end + 3 if end >= 0 else len(page)
        elif other:
            end = page.find("]]>" if page.startswith("[CDATA[", found.end()) else ">", found.end())
            end = len(page) if end < 0 else page.index(">", end) + 1
        else:
            inside = ATTRIBUTES.match(page, found.end()) if quoted else None
            # Only one tag of a page is looked through to its end in vain.
            quoted = inside is not None
            end = inside.end() if inside else page.find(">", found.end()) + 1
            if not end:
                break
            attributes = page[found.end() : end - 1]
        if found.start() > begun:
            yield page[begun : found.start()]
        at = begun = end
        if name:
            sent = yield closing, name.lower(), attributes, end
            if sent is not None:
                at = begun = sent
                yield
    if begun < len(page):
        yield page[begun:]


def parse(page: str) -> Node:
    root = Node("html", None, False)
    opened = Opened(root)
    found = tokens(page)
    for token in found:
        here = opened.nodes[-1]
        if isinstance(token, str):
            here.children.append(token)
            continue
        closing, name, attributes, at = token
        if closing:
            if not opened.end(name) and name == "p":
                here.children.append(Node("p", here, False))
            continue
        if name in ("html", "body"):
            continue
        opened.imply(name)
        here = opened.nodes[-1]
        node = Node(name, here, name in UNREAD or is_around(name, attributes))
        node.called, node.wraps, node.talk = called_around(name, attributes)
        here.children.append(node)
        if name in VOID or attributes.endswith("/") and name in ("svg", "math", "path"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            found.send(end.end() if end else len(page))
            continue
        opened.push(node)
    return root


def measure(root: Node) -> list[Node]:
    """Counts of every kept node, children before parents."""
    order, waiting = [], [(root, False)]
    while waiting:
        node, in_link = waiting.pop()
        if node.cut:
            continue
        linked = in_link or node.name == "a"
        node.link_tags = linked
        order.append(node)
        waiting += [(c, linked) for c in node.children if isinstance(c, Node)]
    order.reverse()
    for node in order:
        linked = bool(node.link_tags)
        node.chars, node.tags, node.link_chars, node.link_tags = 0, 0, 0, int(node.name == "a")
        for child in node.children:
            if isinstance(child, str):
                n = len(" ".join(html.unescape(child).split()))
                node.chars += n
                node.link_chars += n if linked else 0
            elif not child.cut:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
    body = order[-1]
    spread = body.link_chars / max(body.chars, 1)
    for node in order:
        c, lc, t, lt = node.chars, node.link_chars, max(node.tags, 1), max(node.link_tags, 1)
        node.density = 0.0
        if c:
            # One is added to the base, so that it is one also on a page without links.
            base = 1 + math.log(c / max(c - lc, 1) * lc + spread * c + math.e)
            linked = c / max(lc, 1) * t / lt
            node.density = max(c / t * math.log(linked, base), 0.0)
    for node in order:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node) and not c.cut)
    return order


def main_node(root: Node) -> Node:
    """The subtree with the largest density sum among nodes that reach the path's threshold."""
    order = measure(root)
    best = max(order, key=lambda n: n.sum)
    if not best.sum:
        best = max(order, key=lambda n: n.density)
    threshold, node = best.density, best
    while node.parent is not None:
        node = node.parent
        if node.density:
            threshold = min(threshold, node.density)
    able = [n for n in order if n.density >= threshold]
    top = max(able, key=lambda n: n.sum) if able else best
    # Of elements that hold nothing else than this one, and of a block's own inline parts, the
    # outer is the same text; an article or main around it is what the page itself calls its text.
    node = top
    while node.parent is not None:
        node = node.parent
        if node.name in ("article", "main") or node.chars == top.chars or top.name not in BLOCKS:
            top = node
        if node.name in ("article", "main"):
            break
    return top


def blocks(top: Node) -> list[str]:
    """Texts of the blocks of a subtree, in page order, white space as single blanks."""
    found: list[str] = []
    parts: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(text)
        parts.clear()

    waiting: list = [top]
    while waiting:
        node = waiting.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            parts.append(node)
        elif node.name == "br":
            parts.append(" ")
        elif not node.cut and not (node.name == "header" and not only_heading(node)):
            if node.name in BLOCKS:
                end()
                waiting.append(None)
            waiting += reversed(node.children)
    end()
    return found


def only_heading(header: Node) -> bool:
    return any(isinstance(c, Node) and c.name in HEADINGS for c in header.children)


def all_heading(header: Node) -> bool:
    """Whether all text of a header stands in headings."""
    return header.chars == sum(
        c.chars for c in header.children if isinstance(c, Node) and not c.cut and c.name in HEADINGS
    )


def title_before(root: Node, top: Node) -> Node | None:
    """The last kept h1 before a subtree that has none."""
    title, waiting = None, [root]
    while waiting:
        node = waiting.pop()
        if node is top:
            break
        if node.name == "h1" and node.chars:
            title = node
        waiting += [c for c in reversed(node.children) if isinstance(c, Node) and not c.cut]
    waiting = [top]
    while waiting:
        node = waiting.pop()
        if node.name == "h1":
            return None
        waiting += [c for c in node.children if isinstance(c, Node) and not c.cut]
    return title


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    for node in root.children:
        # A page's own header, as opposed to an article's, is not part of the text.
        if isinstance(node, Node) and node.name == "header":
            node.cut = True
    cut_called(root)
    top = main_node(root)
    title = title_before(root, top)
    return "\n".join([*(blocks(title) if title else []), *blocks(top)])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [extract(p) for p in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
