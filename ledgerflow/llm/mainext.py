"""Main text of web pages by composite text density.

The page is parsed to a tree.  For every node C is its characters, T its tags,
LC and LT those inside links; its composite density is

    C / T * log_base((C / LC) * (T / LT)),
    base = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

(zeros below a bar count as 1), so text in few tags and outside links is dense.
The node with the largest sum of its children's densities is the main content;
the threshold is the least density on the path from the body to it, and every
subtree that holds content outside links, is at least that dense and isn't part
of the page's furniture belongs to the result, wherever it lies.  Afterwards the
densest node is widened to the innermost article or main element around it,
which is on that path; nothing else depends on these elements.

Furniture (scripts, styles, forms, navigation, headers and footers of the page,
asides, and blocks whose class, id or role names an advert, a menu, a notice, a
side bar or comments) is taken out before densities are computed.  Names are hints:
words of a state (``with-sidebar``, ``nav-open``) don't count, and a form, a page header
or a block that is taken for furniture by its name stays if an article or main element lies in
it.  It also stays if it holds most of the page's text outside links and no such
element lies elsewhere, but for comments.  Names don't take out main elements and articles, which
carry the page's state in theirs, but for articles inside others and those named a comment.

Null and empty pages give an empty text; pages without markup are one block.
Of equal sums the first node in page order is taken.  Repeated rows are
extracted one by one; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>",
    re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head script style noscript template title iframe object embed svg canvas math button select "
                    "textarea input option nav aside menu dialog audio video".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul br".split())
#: What a start tag closes, up to the element that bounds the search.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"thead", "tbody", "tfoot"},
          "tbody": {"thead", "tbody", "tfoot"}, "tfoot": {"thead", "tbody", "tfoot"}}
BOUNDS = frozenset("ul ol dl table select html body".split())
CLOSE_P = BLOCK - {"br", "body", "html"}
#: Whole words of a class, id or role that name furniture.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|menu|menubar|nav|navbar|navigation|breadcrumbs?|sidebar|"
    r"side-bar|complementary|contentinfo|footer|comments?|disqus|respond|replies|cookies?|consent|gdpr|notices?|notifications?|alerts?|announcements?|disclaimer|newsletter|subscribe|"
    r"popup|modal|share|sharing|social|related|widget|search|login|signup|pagination|pager|skip-?link)(?:$|[\s_-])", re.I)
#: Words that do so outside an article only: inside, they name the head of the text.
PAGE_HEAD = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar|top-bar|navbar-brand)(?:$|[\s_-])", re.I)
#: Names of an article that is a reader's comment ("comments-open" is a state of the page's own).
COMMENT = re.compile(r"(?:^|\s)(?:comment|reply)(?:[_-](?:\d+|body|item|entry|content))?(?:$|\s)", re.I)
#: Words of a class that tell the state of a page or block.
STATE = re.compile(r"(?<!\S)(?:(?:has|with|without|no|is|js|show|hide)[_-]\S+|\S+[_-](?:open|opened|closed|fixed|sticky|visible|active|"
                   r"enabled|disabled|collapsed|expanded|on|off))(?!\S)", re.I)
#: Names of reader comments.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|respond|replies)(?:$|[\s_-])", re.I)
#: How sure it is that an element is furniture: not at all; unless it holds an article, or
#: most of the page; unless it holds an article; quite.
KEPT, HINT, STRONG_HINT, SURE = range(4)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "hint", "furniture", "size", "articles", "chars", "tags", "link_chars", "link_tags", "density",
                 "total")

    def __init__(self, tag: str, parent: Node | None, hint: int = KEPT):
        self.tag, self.parent, self.children, self.hint, self.furniture = tag, parent, [], hint, hint == SURE
        self.size = self.articles = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _hint(tag: str, attributes: str, node: Node) -> int:
    if tag in DROPPED:
        return SURE
    if tag == "footer":
        return SURE
    found = KEPT
    if tag == "header" and not _in_article(node):
        found = STRONG_HINT  # an article's header carries its headline
    elif tag == "form":
        found = HINT
    if attributes and tag not in ("html", "body", "main"):
        own = tag == "article" and not _in_article(node, ("article",))
        for name, *values in _NAMED.findall(attributes):
            value = next((v for v in values if v), "")
            name = name.lower()
            if not own and (name == "hidden" or name == "aria-hidden" and value.lower() == "true"):
                return SURE
            if name not in ("class", "id", "role"):
                continue
            if own:
                if COMMENT.search(value):
                    return SURE
                continue
            if name == "class":
                value = STATE.sub("", value)
            if COMMENTS.search(value):
                found = max(found, STRONG_HINT)
            elif FURNITURE.search(value) or PAGE_HEAD.search(value) and not _in_article(node) and not re.search(
                    "article|post|entry|content|story", value, re.I):
                found = max(found, HINT)
    return found


def settle(root: Node) -> None:
    """Decide which of the elements that look like furniture are."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.furniture]
    for node in reversed(order):  # children first
        for c in node.children:
            if isinstance(c, str):
                node.size += len(c)
            elif not c.furniture:
                node.size += c.size
                node.articles += c.articles
        if node.tag == "a":
            node.size = 0
        elif node.tag in ("article", "main") and node.hint == KEPT:
            node.articles += 1
    for node in order:
        if node.hint:
            most = node.hint == HINT and 2 * node.size > root.size and not root.articles
            node.furniture = not (node.articles or most)


def _in_article(node: Node | None, tags: tuple[str, ...] = ("article", "main")) -> bool:
    while node is not None and node.tag not in tags:
        node = node.parent
    return node is not None


def parse(page: str) -> Node:
    """The tree of a page; strings are text, :class:`Node` elements.  Malformed
    markup is closed the way browsers do for paragraphs, lists and tables."""
    root = Node("html", None)
    body = at = Node("body", root)
    root.children.append(body)
    end, size, hints = 0, len(page), False

    def text(s: str) -> None:
        if s:
            at.children.append(html.unescape(s) if "&" in s else s)

    while (m := MARKUP.search(page, end)) is not None:
        text(page[end:m.start()])
        end = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:  # end tag
            if tag in ("html", "body"):
                continue
            node = at
            while node is not body and node.tag != tag:
                node = node.parent
                if tag not in BLOCK and node.tag in BLOCK:
                    break  # an inline end tag doesn't close blocks
            if node is not body and node.tag == tag:
                at = node.parent
            continue
        if tag in ("html", "body"):
            continue
        attributes = m[3] or m[6] or ""
        if tag in CLOSE_P:
            node = at
            while node is not body and node.tag != "p" and (node.tag not in BLOCK):
                node = node.parent
            if node.tag == "p":
                at = node.parent
        if tag in CLOSES:
            node, target = at, None
            while node is not body and node.tag not in BOUNDS:
                if node.tag in CLOSES[tag]:
                    target = node
                node = node.parent
            if target is not None:
                at = target.parent
        if at.tag == "head" and tag not in DROPPED and tag not in VOID:
            at = body
        node = Node(tag, at, _hint(tag, attributes, at))
        hints |= 0 < node.hint < SURE
        at.children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*+[^>]*+>", re.I).search(page, end)
            inside = page[end:close.start() if close else size]
            if tag == "textarea" or tag == "title":
                node.children.append(html.unescape(inside))
            end = close.end() if close else size
            continue
        if not attributes.endswith("/") or tag in BLOCK:
            at = node
    text(page[end:])
    if hints:
        settle(root)
    return root


def _walk(root: Node) -> Iterator[Node]:
    """Nodes outside furniture in page order, without recursion."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.furniture]


def measure(root: Node) -> Node:
    """Set densities and their sums; returns the node of the largest sum."""
    order = list(_walk(root))
    for node in reversed(order):
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(_WHITE.sub("", c))
            elif not c.furniture:
                node.chars += c.chars
                node.link_chars += c.link_chars
                node.tags += c.tags + 1
                node.link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            inner = c / max(lc, 1) * (t / max(lt, 1))
            node.density = c / t * (math.log(max(inner, 1.0)) / math.log(base) if base > 1 else math.log(max(inner, 1.0)))
    best = root
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.furniture)
        # text directly inside counts like a child of one tag
        own = sum(len(_WHITE.sub("", c)) for c in node.children if isinstance(c, str))
        node.total += own
        if node.total > best.total:
            best = node
    return best


def main_text(page: str | None) -> str:
    """Blocks of the main content in page order, one per line."""
    if not page:
        return ""
    root = parse(page)
    best = measure(root)
    path, node = [], best
    while node is not None and node.tag != "html":
        path.append(node.density)
        node = node.parent
    threshold = min(path, default=0.0)
    # the article around the densest node lies on that path: it comes whole
    frame = best
    while frame is not None and frame.tag not in ("article", "main"):
        frame = frame.parent
    best = frame or best
    chosen: list[Node] = []
    stack = [root.children[0]]
    inside = set()
    node = best
    while node is not None:
        inside.add(id(node))
        node = node.parent
    while stack:
        node = stack.pop()
        if node is best or id(node) not in inside and node.density >= threshold and node.chars > node.link_chars:
            chosen.append(node)
        else:
            stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.furniture]
    return "\n".join(_blocks(chosen or [best]))


def _blocks(nodes: list[Node]) -> list[str]:
    """Text of the nodes, cut at block elements, white space of a block joined."""
    out: list[str] = []
    parts: list[str] = []

    def cut() -> None:
        line = _WHITE.sub(" ", "".join(parts)).strip()
        if line:
            out.append(line)
        parts.clear()

    for node in nodes:
        cut()
        stack: list = [node]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item is None:
                cut()
            elif not item.furniture:
                if item.tag in BLOCK:
                    cut()
                    stack.append(None)
                stack += reversed(item.children)
        cut()
    return out


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(x.as_py()) for x in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()),
                     pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
