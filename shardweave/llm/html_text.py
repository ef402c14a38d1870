"""Main text of web pages by composite text density.

Every node of the DOM gets a density: its characters per tag, lowered where much of the text is link
text. The sum of its children's densities tells where dense blocks are gathered: the subtree with the
largest sum is the core of the article. The lowest density on the path from that core up to the body is
the threshold; every other node that reaches it gives its own core as well. Where the page marks its article,
that is kept whole, and other nodes count only within the page's main part. What the mark-up itself names
as no article text (menus, forms, adverts, comments and so on) is cut before, for it can be dense too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr nobr".split()
)
# Elements whose text is never the article's.
CUT = frozenset(
    "script style noscript template head title nav footer aside form button input select option textarea label"
    " iframe object embed svg canvas video audio map dialog menu xmp noembed noframes".split()
)
# Words of class and id, and values of role, that mark what is no article text.
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion outbrain"
    " taboola nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets"
    " footer foot colophon masthead topbar toolbar comment comments commentlist disqus respond replies reply"
    " reviews cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations"
    " pagination pager copyright disclaimer legal search searchbox skip skiplink".split()
)
# Of these, what also an article element can be called that is a reader's.
READERS = frozenset("comment comments commentlist respond replies reply reviews".split())
# Names of a page's own head, and words before a word of the list above that turn it into a layout ("has-sidebar").
HEADS = frozenset("header site-header page-header global-header main-header top-header".split())
LAYOUT = frozenset("has with no without not is".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
# Elements that gather blocks; a core that is a single block stands for the gathering around it.
GATHERING = frozenset("article main section div body td table tbody tr center blockquote html".split())
# A marked article with less than this part of the text (1 / MARKED) is taken for a teaser.
MARKED = 4
# An open element that the start of another one closes (p by any block; the rest by their own kind).
CLOSED_BY_KIND = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
LISTED = frozenset("li dd dt tr td th option thead tbody tfoot p".split())
SCOPE = frozenset("html body table td th div section article main ul ol dl aside nav header footer form".split())

OPENING = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
NAME_END, PLAIN = re.compile(r"[\s/>]|\Z"), re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMES = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An element. ``cut`` says that its text is not the article's, ``soft`` that this is so only while it holds
    less than half of the page's text, ``holds`` that an article is inside; ``near`` is the nearest of it and the
    elements around it that a block may close, ``article`` and ``gathering`` the nearest of these kinds."""

    __slots__ = (
        "tag", "parent", "children", "cut", "soft", "holds", "near", "article", "gathering", "articles",
        "chars", "tags", "link_chars", "link_tags", "density", "sum", "best",
    )

    def __init__(self, tag: str, parent: "Node | None", cut: bool = False, soft: bool = False):
        self.tag, self.parent, self.cut, self.soft, self.holds = tag, parent, cut, soft, False
        self.children: list[Node | str] = []
        self.near = self if tag in SCOPE or tag in LISTED or parent is None else parent.near


class Tags:
    """The tags of a page one after the other, in time that grows with its length, however broken it is.

    A tag that is never closed is text. Where the quick pattern has failed once, tags are looked for step by step,
    and places from which none can end are remembered, so that no part of the page is searched again and again.
    """

    def __init__(self, html: str):
        self.html, self.failed, self.name_end = html, False, -1
        self.dead: set[int] = set()
        self.last = {mark: html.rfind(mark) for mark in "\"'>"}

    def next(self, at: int) -> tuple[int, int, str | None, str, str]:
        """(start, end, name, slash, attributes) of the next tag; the name is None for a comment or the like, and for
        the end of the page."""
        html = self.html
        while match := OPENING.search(html, at):
            start = match.start()
            if html[start + 1] in "!?":
                return start, COMMENT.match(html, start).end(), None, "", ""
            if self.last[">"] < start:
                break
            if not self.failed:
                tag = TAG.match(html, start)
                if tag:
                    return start, tag.end(), tag[2], tag[1], tag[3]
                self.failed = True
            slash = html.startswith("/", start + 1)
            if self.name_end < start:
                self.name_end = NAME_END.search(html, start + 2).start()
            if self.name_end <= start + 1 + slash:
                self.name_end = NAME_END.search(html, start + 2 + slash).start()
            end = self.closing(self.name_end)
            if end >= 0:
                return start, end + 1, html[start + 1 + slash : self.name_end], "/" if slash else "", html[self.name_end : end]
            at = start + 1
        return len(html), len(html), None, "", ""

    def closing(self, at: int) -> int:
        """Where the tag ends whose attributes begin here, -1 if it never does."""
        html, visited = self.html, []
        while at < len(html) and at not in self.dead:
            visited.append(at)
            at = PLAIN.match(html, at).end()
            if at == len(html) or self.last[html[at]] == at and html[at] != ">":
                break
            if html[at] == ">":
                return at
            at = html.find(html[at], at + 1) + 1
        self.dead.update(visited)
        return -1


def names_of(attributes: str, tag: str) -> tuple[bool, bool]:
    """Whether the attributes of an element say that it is no article text, and whether only a part of a name does."""
    part = False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
        if name in ("class", "id") and tag not in ("body", "html"):
            marks = READERS if tag in ("article", "main") else CUT_NAMES
            for mark in unescape(value).split():
                words = NAMES.findall(mark)
                if mark in HEADS and tag not in ("article", "main") or len(words) == 1 and words[0] in marks:
                    return True, False
                before = LAYOUT.isdisjoint
                part = part or any(word in marks and before(words[:k]) for k, word in enumerate(words))
        elif name == "role" and value in CUT_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        elif name == "style" and HIDDEN.search(value):
            return True, False
    return part, part


def parse(html: str) -> Node:
    """The DOM of a page. Wrong nesting is mended: an end tag closes up to its element or is ignored,
    and inline elements left open end with their block."""
    root = here = Node("html", None)
    at, low, tags = 0, None, Tags(html)
    inline: Counter[str] = Counter()  # inline elements that are open in the innermost block
    opened: Counter[str] = Counter()  # blocks that are open, by tag
    outside: list[Counter[str]] = []  # what ``inline`` was in the blocks around the open one

    def left(node: Node) -> Node:
        """Close an element and those open inside it; what is open then is the element around it."""
        nonlocal here, inline
        last = None
        while last is not node:
            last, here = here, here.parent
            if last.tag in INLINE:
                inline[last.tag] -= 1
            else:
                opened[last.tag] -= 1
                inline = outside.pop()
        return here

    while at < len(html):
        start, end, tag, slash, attributes = tags.next(at)
        if start > at:
            here.children.append(html[at:start])
        at = end
        if tag is None:
            if html.startswith("<![CDATA[", start):
                here.children.append(html[start + 9 : end].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if slash:
            node = here if (inline if tag in INLINE else opened)[tag] else root
            while node.parent is not None and node.tag != tag:
                if tag in INLINE and node.tag not in INLINE:  # a stray end of an inline element stays in its block
                    node = root
                    break
                node = node.parent
            if node.parent is not None:
                left(node)
            elif tag in ("p", "br"):
                here.children.append(Node(tag, here))
            continue
        if tag == "html" or tag == "body" and opened["body"]:
            continue
        if tag not in INLINE and tag not in VOID or tag == "hr":
            kinds = CLOSED_BY_KIND.get(tag)
            node = here.near
            while node is not None:
                above = node.parent
                if node.tag == "p" or kinds and node.tag in kinds:
                    left(node)
                    if node.tag == "p" or node.tag == tag:
                        break
                elif node.tag in SCOPE or not kinds:
                    break
                node = above.near if above is not None else None
            if tag == "body":
                here, inline = root, Counter()
                opened.clear()
                outside.clear()
        named, part = names_of(attributes, tag) if attributes else (False, False)
        soft = part or tag == "form" and not named
        cut = tag in CUT or named
        if tag in ("article", "main") and not named:
            above = here  # what holds the article is no side matter, whatever it is called
            while above is not None and not above.holds:
                if above.tag not in CUT and above.tag != "header" or above.tag == "form":
                    above.cut = False
                above.holds, above = True, above.parent
        if tag == "header":
            cut = cut or not (opened["article"] or opened["main"])
        node = Node(tag, here, cut, soft)
        here.children.append(node)
        if tag in VOID or attributes.endswith("/") and tag in ("path", "use", "rect", "circle"):
            continue
        if tag in RAW:
            if low is None:
                low = html.lower() if len(html.lower()) == len(html) else _ascii_lower(html)
            end = low.find(f"</{tag}", at)
            at = len(html) if end < 0 else end
            close = html.find(">", at)
            at = len(html) if end < 0 or close < 0 else close + 1
            continue
        if tag in INLINE:
            inline[tag] += 1
        else:
            opened[tag] += 1
            outside.append(inline)
            inline = Counter()
        here = node
    return root


def _ascii_lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def _up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def in_order(root: Node, every: bool = False) -> list[Node]:
    """All nodes that are not cut (or only softly, with ``every``), parents first, without recursion (pages can nest
    deeply)."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(c for c in reversed(node.children) if type(c) is Node and (not c.cut or every and c.soft))
    return found


def spare(root: Node) -> None:
    """Give back what a form or a part of a name would cut, where it holds at least half of the page's text."""
    nodes = in_order(root, every=True)
    if not any(node.cut for node in nodes):
        return
    for node in reversed(nodes):
        node.chars = sum(
            (0 if c.isspace() else len(c)) if type(c) is str else c.chars for c in node.children if type(c) is str or not c.cut or c.soft
        )
    for node in nodes:
        if node.soft and 2 * node.chars >= root.chars:
            node.cut = False


def weigh(root: Node) -> list[Node]:
    """Set characters, tags, density and density sum of every node; returns the nodes, parents first."""
    nodes = in_order(root)
    for node in nodes:
        above = node.parent if node is not root else None
        node.article = node if node.tag in ("article", "main") else above and above.article
        node.gathering = node if node.tag in GATHERING else above and above.gathering
    for node in reversed(nodes):
        node.articles = (node.tag == "article") + sum(c.articles for c in node.children if type(c) is Node and not c.cut)
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if type(child) is str:
                node.chars += len(child) if not child.isspace() else 0
            elif not child.cut:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, 1
    balance = root.link_chars / root.chars if root.chars else 0.0
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, node.tags or 1, node.link_chars, node.link_tags
        if not c:
            node.density = 0.0
        else:
            # Characters per tag, times the logarithm of the same to a base that grows with the share of links.
            plain = max(c - lc, 1)
            base = math.log(c / plain * lc + balance * c + math.e)
            node.density = c / t * max(math.log(c / max(lc, 1) * t / max(lt, 1)), 0.0) / base if lc else c / t
        node.sum = 0.0
        node.best = node
        for child in node.children:
            if type(child) is Node and not child.cut:
                node.sum += child.density
                if child.best.sum > node.best.sum:
                    node.best = child.best
        # A node's own text counts like a dense child, else an article that is one block loses to its parts.
        own = sum(len(c) for c in node.children if type(c) is str and not c.isspace())
        node.sum += own
        if node.best is not node and node.sum >= node.best.sum:
            node.best = node
    return nodes


def gathered(node: Node) -> Node:
    """The gathering that a core stands for: its article if the page marks one, else the nearest around it."""
    return node.article or node.gathering or node


def region(whole: Node, root: Node) -> Node:
    """The page's main part: the outermost main around its article, else what all articles have in common."""
    mains = [n for n in _up(whole) if n.tag == "main"]
    if mains:
        return mains[-1]
    return next(node for node in _up(whole) if node.articles == root.articles)


def cores(root: Node) -> set[int]:
    """Identities of the subtrees that hold the main text."""
    nodes = weigh(root)
    if not root.chars:
        return set()
    # Where the page marks its article, that is the body that counts, unless it has little of the text.
    marked = max((n for n in nodes if n.tag in ("article", "main")), key=lambda n: n.chars, default=root)
    core = (marked if marked.chars * MARKED >= root.chars else root).best
    threshold = min(n.density for n in _up(core) if n.parent is not None) if core.parent is not None else root.density
    whole = gathered(core)
    chosen = {id(whole)}
    if whole.tag in ("article", "main"):  # the page says what its article is
        above = {id(n) for n in _up(whole)}
        for node in in_order(region(whole, root)):
            if id(node) not in above and node.density >= threshold and node.chars:
                core = gathered(node.best)
                # A block that stands beside the articles, as a lead does, speaks for itself only.
                chosen.add(id(node.best if id(core) in above else core))
        return chosen
    for node in nodes:
        if node.parent is not None and node.tag not in ("html", "body") and node.density >= threshold and node.chars:
            chosen.add(id(gathered(node.best)))
    return chosen


def blocks(root: Node, chosen: set[int]) -> list[str]:
    """The text blocks below the chosen nodes in page order, white space made single."""
    found: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = SPACES.sub(" ", unescape("".join(run))).strip()
        if text:
            found.append(text)
        run.clear()

    stack: list[tuple[Node | str | None, bool]] = [(root, False)]
    while stack:
        item, inside = stack.pop()
        if item is None:
            end()
        elif type(item) is str:
            if inside:
                run.append(item)
        elif not item.cut:
            inside = inside or id(item) in chosen
            block = item.tag not in INLINE
            if block:
                end()
                stack.append((None, False))
            stack.extend((child, inside) for child in reversed(item.children))
    end()
    return found


def main_text(html: str | None) -> str:
    """The main text of one page, empty if there is none."""
    if not html:
        return ""
    root = parse(html)
    spare(root)
    return " ".join(blocks(root, cores(root)))


def extract(html: Column) -> Column:
    """STRING: the main text of a page's HTML; null and empty pages give an empty text."""

    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page) for page in batch.to_pylist()], pa.string())

    return run(html)


def extracted(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` with ``text``, the main text, in place of a column of that name.

    One row in, one row out, without a shuffle: repeated pages stay, an empty table stays empty, and one
    page of any length is in memory at a time beside its Arrow batch.
    """
    return df.withColumn("text", extract(F.col(html)))
