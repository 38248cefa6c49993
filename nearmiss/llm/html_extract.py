"""Main text of web pages by tree scoring.

A page is parsed into a tree. Every paragraph gives points for its length and its
commas to its ancestors, less the farther up; an element's points are discounted by
the share of its text that lies in links. The best element and those siblings that
score well or read like prose are kept.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import arrow_batch, text_slices

TYPES = {"page_id": pa.int64(), "url": pa.string(), "text": pa.string(), "n_chars": pa.int64()}
SCHEMA = "page_id long, url string, text string, n_chars long"

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul option".split()
)
#: A start tag of the key ends open elements of these names, up to the nearest container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("article aside body div dl footer form header html main nav ol section table ul".split())

#: Elements that never hold main text.
DROPPED = RAW | frozenset(
    "head nav header footer aside form button select option datalist dialog menu object audio video canvas svg math "
    "label input applet frame frameset".split()
)
#: Roles that never hold main text.
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog alert tooltip".split()
)
#: Words of a class or id that stand for what is beside the text.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay comment comments reply replies disqus respond sidebar "
    "side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead toolbar share sharing social "
    "related recommended newsletter subscribe subscription signup login widget pagination pager contentinfo "
    "complementary search form toc skip".split()
)
#: Words that say no more than where or how: with these alone beside them, the former still count.
FRAME = frozenset(
    "area bar block box bottom button buttons center column container fixed global holder inner item items left "
    "link links list outer page panel primary region right row secondary section site slot small space sticky thread "
    "top unit wrap wrapper".split()
)
#: Words that keep an element in spite of the former, unless one of these names stands there, too.
KEPT = frozenset("article body main content text story post entry".split())
STRONG = frozenset("comment comments reply ad ads cookie notice".split())
#: Never judged by their names.
SAFE = frozenset("html body main p h1 h2 h3 h4 h5 h6 pre".split())
#: Share of links from which an element of doubtful name goes, and what its name costs it.
DOUBT_LINKS, DOUBT = 1 / 3, -10.0

PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption div section article main body".split())
PRIOR = {"article": 25.0, "main": 20.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
         "ol": -3.0, "ul": -3.0, "dl": -3.0, "th": -5.0}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>")
#: Length up to which every tag is looked for. Longer ones are, too, until the vain looks have cost
#: a few times the page: a page of unclosed quotes would cost its square otherwise.
TAG_CHARS, VAIN = 4096, 4
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "beside", "doubt", "score", "chars", "linked")

    def __init__(self, tag: str, parent: Node | None, beside: bool, doubt: bool = False):
        self.tag, self.parent, self.beside, self.doubt = tag, parent, beside, doubt
        self.children: list = []
        self.score, self.chars, self.linked = 0.0, 0, 0


def judge(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is beside the text by its tag, role or name, and whether its name
    only hints at it: then its links decide.

    A name counts as a whole: all words of one class or id stand for things beside the text
    (``cookie-notice``), or with words of place and form only (``sidebar-left``). A name
    with any other word in it (``side-effects``) is a hint.
    """
    if tag in DROPPED:
        return True, False
    if tag in SAFE or not attributes:
        return False, False
    doubt = kept = strong = whole = False
    for m in ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in ROLES:
                return True, False
            continue
        for name in value.split():
            words = set(WORD.findall(name))
            kept = kept or bool(words & KEPT)
            if words & BESIDE:
                if words <= BESIDE | FRAME | KEPT:
                    whole = True
                    strong = strong or bool(words & STRONG)
                else:
                    doubt = True
    if tag == "article":
        return strong, False
    beside = whole and (strong or not kept)
    return beside, not beside and (doubt or whole)


class Tags:
    """Finds the next tag, comment or declaration of a page; linear in the page."""

    def __init__(self, html: str):
        self.html, self.vain = html, VAIN * len(html)
        self.last = html.rfind(">")

    def find(self, at: int) -> tuple[int, int, re.Match | None]:
        """Where the next one begins and ends, and the match of a tag; (end, end, None) if none does."""
        html = self.html
        while True:
            i = html.find("<", at)
            if i < 0:
                return len(html), len(html), None
            if html.startswith("<!--", i):
                close = html.find("-->", i + 4)
                return i, close + 3 if close >= 0 else len(html), None
            if i > self.last:  # nothing is closed any more
                at = i + 1
                if html.find("<!--", at) < 0:
                    return len(html), len(html), None
                continue
            m = TAG.match(html, i, i + TAG_CHARS)
            if m is None and self.vain > 0 and i + TAG_CHARS < len(html):
                m = TAG.match(html, i)
                if m is None and html[i + 1 : i + 2].isalpha():
                    self.vain -= len(html) - i
            if m is not None:
                return i, m.end(), m
            if html[i + 1 : i + 2] in ("!", "?", "/"):
                return i, html.find(">", i) + 1, None
            at = i + 1


class Open:
    """How many elements of each name are open, in all and since the nearest container, so that
    an end tag that closes nothing costs no walk up the tree."""

    def __init__(self):
        self.all: Counter = Counter()
        self.scopes = [Counter()]

    def enter(self, node: Node) -> None:
        self.all[node.tag] += 1
        self.scopes[-1][node.tag] += 1
        if node.tag in CONTAINERS:
            self.scopes.append(Counter())

    def leave(self, node: Node, until: Node) -> None:
        """Closes the open elements from ``node`` up to ``until``, itself included."""
        while True:
            if node.tag in CONTAINERS:
                self.scopes.pop()
            self.all[node.tag] -= 1
            self.scopes[-1][node.tag] -= 1
            if node is until:
                return
            node = node.parent


def parse(html: str) -> Node:
    """The tree of a page; children are nodes and strings with references decoded.

    Unclosed and stray tags are mended: a block ends an open ``p``, an end tag closes
    the nearest open element of its name, one without any is skipped.
    """
    root = Node("html", None, False)
    here, at, end, tags, open_ = root, 0, len(html), Tags(html), Open()

    def text(until: int) -> None:
        if until > at:
            piece = html[at:until]
            here.children.append(entities.unescape(piece) if "&" in piece else piece)

    while at < end:
        start, stop, m = tags.find(at)
        text(start)
        at = stop
        if m is None:
            continue
        tag = m[2].lower()
        if m[1]:
            # an inline element's end doesn't reach out of its container
            if (open_.all if tag in BLOCK else open_.scopes[-1])[tag] > 0:
                found = here
                while found.tag != tag or found.parent is None:
                    found = found.parent
                open_.leave(here, found)
                here = found.parent
            continue
        if tag in VOID:
            here.children.append(Node(tag, here, tag in DROPPED))
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
            at = close.end() if close else end
            continue
        if tag in BLOCK:
            ends = ENDS.get(tag, frozenset()) | {"p"}
            while any(open_.scopes[-1][e] > 0 for e in ends):
                found = here
                while found.tag not in ends:
                    found = found.parent
                open_.leave(here, found)
                here = found.parent
        node = Node(tag, here, *judge(tag, m[3]))
        here.children.append(node)
        open_.enter(node)
        here = node
    return root


def measure(root: Node) -> list[Node]:
    """Counts characters and linked characters of every element and gives out the points;
    the elements in page order."""
    order: list[Node] = []
    stack = [(root, False)]
    while stack:  # no recursion: pages can be nested deeper than Python's stack
        node, linked = stack.pop()
        order.append(node)
        linked = linked or node.tag == "a"
        for child in reversed(node.children):
            if isinstance(child, Node) and not child.beside:
                stack.append((child, linked))
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        node.chars += own
        node.linked += own if linked else 0
    for node in reversed(order):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    for node in order:
        if node.tag not in PARAGRAPHS:
            continue
        texts = [c for c in node.children if isinstance(c, str)]
        inline = [c for c in node.children if isinstance(c, Node) and c.tag not in BLOCK and not c.beside]
        length = sum(len(t.strip()) for t in texts) + sum(c.chars for c in inline)
        if not length:
            continue
        commas = sum(t.count(",") for t in texts)
        points = min(length / 25, 1.0) + commas + min(length / 100, 3.0)
        # loose text in a container counts for the container itself
        up, level = (node.parent if node.tag not in CONTAINERS else node), 0
        while up is not None and level < 5:
            up.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    for node in order:
        density = node.linked / max(node.chars, 1)
        if node.score:
            node.score = (node.score + PRIOR.get(node.tag, 0.0) + DOUBT * node.doubt) * (1 - density)
        if node.doubt and density >= DOUBT_LINKS:
            node.beside, node.score = True, 0.0
    return order


def blocks(node: Node) -> Iterator[str]:
    """The texts of the blocks below a node in page order, white space made one space."""
    held: list[str] = []
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            held.append(x)
            continue
        if x is None or x.tag in BLOCK:
            if line := " ".join("".join(held).split()):
                yield line
            held.clear()
            if x is None:
                continue
        elif x.tag == "br":
            held.append(" ")
        if x.beside:
            continue
        if x.tag in BLOCK:
            stack.append(None)
        stack.extend(reversed(x.children))
    if line := " ".join("".join(held).split()):
        yield line


def main_text(html: str | None) -> str:
    """The main text of a page; empty for null, empty or text-free pages."""
    if not html:
        return ""
    order = measure(parse(html))
    best = max(order, key=lambda n: n.score)  # the first of equals
    if best.score <= 0:
        best = order[0]
    else:
        up = best
        while up is not None:  # an article is kept whole, not its best section alone
            if up.tag in ("article", "main"):
                best = up
                break
            up = up.parent
    kept = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body"):
        least = max(10.0, 0.2 * best.score)
        kept = []
        for x in best.parent.children:
            if x is best:
                kept.append(x)
            elif isinstance(x, Node) and not x.beside:
                density = x.linked / max(x.chars, 1)
                prose = x.tag == "p" and (x.chars > 80 and density < 0.25 or 0 < x.chars <= 80 and density == 0)
                heading = x.tag in ("h1", "h2") and density < 0.25
                if x.score >= least or prose or heading:
                    kept.append(x)
    return " ".join(line for node in kept for line in blocks(node))


def extract_main_text(pages: DataFrame, *, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Null, empty and text-free pages give an empty text. Repeated rows stay repeated,
    null ids and URLs stay null, an empty table gives no rows; other columns are not
    read. Of elements with equal points the first in the page wins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(2).to_pylist()
            for lo, hi in text_slices(sources):
                texts = [main_text(x) for x in sources[lo:hi]]
                part = batch.slice(lo, hi - lo)
                yield arrow_batch(
                    {"page_id": part.column(0), "url": part.column(1), "text": texts, "n_chars": [len(t) for t in texts]},
                    TYPES,
                )

    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return slim.mapInArrow(run, SCHEMA)
