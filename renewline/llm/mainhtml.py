"""Main text of web pages by composite text density.

A page is parsed into a tree; parts that are never article text (scripts, styles,
menus, forms, and elements whose class or id names them as boilerplate) are left out.
For every node the density of characters per tag is computed and adjusted by its links:

    density = (chars / tags) * log_b((chars * tags) / (link chars * link tags))
    b = ln(chars * link chars / other chars + body link chars * chars / body chars + e)

with counts of 0 taken as 1. A node's sum is the sum of its children's densities. The
node with the largest sum is the core of the article. The smallest density on the path
from it up to the body, the body left out, is the threshold: beside the core, every
subtree that hangs off that path and reaches the threshold belongs to the article too,
and so do headings, of which only the first rank counts right below the body.

Article and main elements are a weight and a check on that. Beside the core, parts
within a marked element count ``MARK_WEIGHT`` times their density. Where marked parts
hold most of the text chosen, all of them that were chosen stay and the rest goes.

The text comes block by block in page order, character references decoded, white space
within a block as one blank, blocks joined by two line breaks. Null and empty pages,
and pages without text, give an empty text; broken markup is closed as browsers do.
"""

from __future__ import annotations

import html as html_lib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import small_batches

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag of the same name.
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "caption tbody td tfoot th thead tr ul".split()
)
#: They mark the article.
MARKS = ("article", "main")
#: Density of a part within a marked element, as compared with the threshold.
MARK_WEIGHT = 4.0
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Never article text.
SKIPPED = frozenset(
    "head script style template noscript iframe noembed noframes svg canvas object embed audio video map "
    "nav aside footer form button select option textarea input menu dialog".split()
)
#: An open element of the second set ends where one of the first starts.
CLOSES = {
    "p": frozenset(["p"]),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
    "tbody": frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]),
}
#: Implied ends don't reach beyond these.
SCOPE = frozenset("article aside body blockquote div footer header html main nav section table td th ul ol dl form".split())

#: Classes and ids that name boilerplate as a whole.
BOILERPLATE = frozenset(
    "ad ads adv adsense footer nav notice notices alert overlay topbar toolbar masthead search pagination pager "
    "skip-link widget tags toc signup login subscribe site-footer page-footer site-header page-header respond".split()
)
#: And those that name it as one of their words, as in comments-area or post-comments.
BOILERPLATE_WORDS = frozenset(
    "advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments "
    "commentlist disqus cookie cookies consent gdpr popup modal menu navbar navigation sidebar related recommended "
    "promo promotion share sharing social newsletter sponsor sponsored".split()
)
#: A class that starts with one of these tells about the page, not about the part.
STATES = frozenset("has with without no is not".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
#: A tag that the page breaks off in.
_BROKEN = re.compile(r"<(?:/?[A-Za-z][^<>]*|!-?-?[^>]*)\Z")


class Node:
    __slots__ = ("name", "parent", "children", "skipped", "suspect", "marked", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, name: str, parent: Node | None, skipped: bool):
        self.name, self.parent, self.skipped = name, parent, skipped
        self.suspect = self.marked = False
        self.children: list[Node | str] = []


def _never(name: str, attributes: str, parent: Node) -> bool:
    """Whether an element is left out with all it holds."""
    if name in SKIPPED:
        return True
    if name == "header":
        return not _inside(parent, MARKS)
    for key, value in _attributes(name, attributes):
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _suspect(name: str, attributes: str, parent: Node) -> bool:
    """Whether class, id or role name an element as boilerplate; it stays if it holds the article."""
    for key, value in _attributes(name, attributes):
        if key == "role" and value in ROLES:
            return True
        if key in ("class", "id"):
            for part in re.split(r"[\s_]+", value):
                words = part.split("-")
                if part in BOILERPLATE or words[0] not in STATES and not BOILERPLATE_WORDS.isdisjoint(words):
                    return True
                if part == "header" and not _inside(parent, MARKS):
                    return True
    return False


def _attributes(name: str, attributes: str) -> list[tuple[str, str]]:
    if not attributes or name in ("html", "body", *MARKS):
        return []
    found = _ATTRIBUTE.finditer(attributes)
    return [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in found]


def _inside(node: Node | None, names: tuple[str, ...]) -> bool:
    while node is not None:
        if node.name in names:
            return True
        node = node.parent
    return False


def parse(page: str) -> Node:
    """The tree of a page, below a root of its own. Skipped parts hold no text."""
    root = here = Node("html", None, False)
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and not here.skipped:
            text = page[at:stop]
            here.children.append(_BROKEN.sub("", text) if not m else text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            here = _close(here, name)
            continue
        if name in ("html", "body") and here.name == "html":
            if name == "body":
                here = _open(here, name, False)
            continue
        here = _imply(here, name)
        skipped = here.skipped or _never(name, m[3], here)
        if name in VOID or m[3].endswith("/") and name not in BLOCK and name not in RAW:
            if name in ("br", "hr", "wbr", "img") and not skipped:
                here.children.append(" " if name != "wbr" else "")
                if name == "hr":
                    here.children.append(Node("hr", here, False))
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            body = page[at : closing.start() if closing else end]
            if not skipped:
                _open(here, name, False).children.append(body)
            tail = page.find(">", closing.start()) if closing else end
            at = tail + 1 if tail >= 0 else end
            continue
        suspect = not skipped and _suspect(name, m[3], here)
        here = _open(here, name, skipped)
        here.suspect = suspect
    _prune(root)
    return root


def _prune(root: Node) -> None:
    """Take out suspect elements, unless the page marks its article within them."""
    order = _nodes(root)
    for node in reversed(order):
        node.marked = node.name in MARKS or any(isinstance(c, Node) and c.marked for c in node.children)
    for node in order:
        node.children = [c for c in node.children if isinstance(c, str) or not c.suspect or c.marked]


def _open(here: Node, name: str, skipped: bool) -> Node:
    node = Node(name, here, skipped)
    if not skipped:
        here.children.append(node)
    return node


def _imply(here: Node, name: str) -> Node:
    """Close what the start of ``name`` ends: items of the same list, paragraphs by any block."""
    ends = CLOSES.get(name, frozenset())
    if name in BLOCK:
        ends = ends | {"p"}
    node = here
    while node.parent is not None and (node.name not in SCOPE or node.name in ends):
        if node.name in ends:
            here = node.parent
        node = node.parent
    return here


def _close(here: Node, name: str) -> Node:
    """The parent of the nearest open element of this name; a stray end tag changes nothing."""
    node = here
    while node.parent is not None:
        if node.name == name:
            return node.parent
        if node.name in SCOPE and name not in SCOPE:
            return here
        node = node.parent
    return here


def _measure(root: Node) -> None:
    """Counts of every node, children before parents, then densities and sums."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, Node):
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
            else:
                node.chars += len("".join(child.split()))
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    all_chars, all_links = max(1, root.chars), root.link_chars
    for node in reversed(order):
        chars, links = node.chars, node.link_chars
        if not chars:
            node.density = 0.0
        else:
            tags = max(1, node.tags)
            base = math.log(chars * links / max(1, chars - links) + all_links * chars / all_chars + math.e)
            share = chars * tags / (max(1, links) * max(1, node.link_tags))
            node.density = chars / tags * math.log(max(1.0, share)) / math.log(max(base, 1.0001))
        node.sum = sum(c.density for c in node.children if isinstance(c, Node))


def _nodes(node: Node) -> list[Node]:
    out, stack = [], [node]
    while stack:
        here = stack.pop()
        out.append(here)
        stack += [c for c in reversed(here.children) if isinstance(c, Node)]
    return out


def _marks(root: Node) -> list[Node]:
    """The outermost article and main elements that hold text, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.name in MARKS and node.chars:
            found.append(node)
        else:
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    # Within a main element, a single article is the closer mark.
    if len(found) == 1 and found[0].name == "main":
        inner = [n for n in _nodes(found[0]) if n.name == "article" and n.chars]
        if len(inner) == 1:
            return inner
    return found


def select(root: Node) -> list[Node]:
    """Subtrees that make up the article, in page order."""
    chosen = _dense(root)
    marks = _marks(root)
    within = {id(n) for mark in marks for n in _nodes(mark)}
    starts = {id(mark) for mark in marks}
    kept: list[Node] = []
    for node in chosen:
        # A part outside the marks is cut down to those it holds.
        kept += [node] if id(node) in within else [n for n in _nodes(node) if id(n) in starts]
    if 2 * sum(n.chars for n in kept) > sum(n.chars for n in chosen):
        return kept
    return chosen


def _dense(root: Node) -> list[Node]:
    """The core and what reaches the threshold beside it, in page order."""
    core = max(_nodes(root), key=lambda n: (n.sum, n.chars))
    path = [core]
    threshold = core.density
    while path[-1] is not root:
        path.append(path[-1].parent)
        if path[-1].name not in ("html", "body"):
            threshold = min(threshold, path[-1].density)

    def belongs(child: Node | str, parent: Node, weight: float) -> bool:
        ranks = ("h1",) if parent.name in ("html", "body") else HEADINGS
        return isinstance(child, Node) and child.chars > 0 and (child.density * weight >= threshold or child.name in ranks)

    before: list[Node] = []
    after: list[list[Node]] = []
    weight = 1.0
    for parent, inner in zip(reversed(path), reversed(path[:-1])):
        if parent.name in MARKS:
            weight = MARK_WEIGHT
        at = next(i for i, child in enumerate(parent.children) if child is inner)
        before += [c for c in parent.children[:at] if belongs(c, parent, weight)]
        after.append([c for c in parent.children[at + 1 :] if belongs(c, parent, weight)])
    return [*before, core, *(c for group in reversed(after) for c in group)]


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks of the subtrees; white space is one blank, empty blocks go."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", html_lib.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append(text)

    for top in nodes:
        end()
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                held.append(item)
            elif item.name in BLOCK:
                end()
                stack.append(None)
                stack += reversed(item.children)
            else:
                stack += reversed(item.children)
    end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    return "\n\n".join(blocks(select(root)))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Columns ``page_id``, ``url``, ``text`` and ``n_chars``, one row per page."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches):
        for batch in batches:
            texts = pa.array([main_text(page) for page in batch.column(2).to_pylist()], pa.string())
            yield pa.record_batch([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    found = rows.mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
