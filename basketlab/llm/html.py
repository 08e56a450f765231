"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that are never part of an article
(by tag, role or the words of their class and id) are taken out, unless they
hold the page's main element or, on a page without one, most of its text; if
nothing is left, only tags and roles count. For every
node that is left the link-adjusted characters per tag are computed, with C, T
characters and tags, LC, LT those inside links, and nLC = C - LC:

    density = C/T * log( C/LC * T/LT ),  base  ln( C/nLC * LC + LCb/Cb * C + e )

where LCb/Cb is the link share of the whole body and zero counts stand for 1.
The node whose children's densities sum highest holds the article. The least
density on its path up to the body is the threshold: subtrees beside that path
that reach it belong to the text too.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

TEXTS = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
                      T.StructField("widened", T.BooleanType())])

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
          "tfoot": {"tr", "td", "th", "thead", "tbody"}}
#: An element that an implied end tag doesn't reach through.
SCOPES = frozenset("table ul ol dl select body html article section main div blockquote td th".split())

#: Words that make a class say what a page has or lacks, not what it is.
STATES = frozenset("no not has have with without is".split())
#: Words that also name parts of an article, if those hold paragraphs.
WEAK_WORDS = frozenset("overlay modal popup header banner widget widgets".split())
DROPPED_TAGS = frozenset("""head script style title noscript template iframe object embed applet svg math canvas nav
aside footer button select option input textarea dialog menu audio video map noembed noframes xmp""".split())
DROPPED_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu
menubar toolbar""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
DROPPED_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors
promo promos promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header
masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup
login share sharing social related recommended recommendations widget widgets toolbar pagination pager copyright
""".split())


class Node:
    __slots__ = ("tag", "parent", "items", "words", "role", "hidden", "block", "chars", "tags", "links", "link_chars",
                 "density", "drop", "core")

    def __init__(self, tag: str, parent, attrs: str = ""):
        self.tag, self.parent, self.items = tag, parent, []
        self.words, self.role, self.hidden = (), "", False
        self.block = tag in BLOCKS
        self.drop = self.core = False
        self.links = 0
        if attrs and tag != "a":
            for m in _ATTR.finditer(attrs):
                name, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    for token in value.split():
                        words = [w.lower() for w in _WORD.findall(token)]
                        if words and words[0] not in STATES:
                            self.words = (*self.words, *words)
                elif name == "role":
                    self.role = value.strip().lower()
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (
                        name == "style" and "display:none" in value.replace(" ", "").lower()):
                    self.hidden = True


def parse(html: str) -> Node:
    """The root of the tree; items are nodes and strings in page order."""
    root = Node("html", None)
    stack, at, n = [root], 0, len(html)

    def close(tags, scopes) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scopes:
                return

    while at < n:
        m = _MARKUP.search(html, at)
        if m is None:
            stack[-1].items.append(unescape(html[at:]))
            break
        if m.start() > at:
            stack[-1].items.append(unescape(html[at:m.start()]))
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag in ("html", "body"):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag == "html":
            continue
        if tag == "body" and any(x.tag == "body" for x in stack):
            continue
        if tag == "body":
            del stack[1:]
        if tag in BLOCKS:
            close({"p"}, SCOPES - {"p"})
        if tag in CLOSES:
            scopes = SCOPES - CLOSES[tag]
            for _ in range(3 if tag in ("tr", "tbody", "tfoot") else 1):
                close(CLOSES[tag], scopes)
        attrs = m["attrs"] or m["attrs2"] or ""
        node = Node(tag, stack[-1], attrs)
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
    return root


def preorder(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node)]
    return out


def _prune(nodes: list[Node], body: Node, by_words: bool) -> None:
    """Marks ``drop``. A form or a class's words take out no node that holds
    the article's own element or a main heading, nor one with more than half
    of the text beside links on a page that has neither. ``chars`` must be of
    whole subtrees."""
    for node in reversed(nodes):
        if node.tag in ("article", "main", "h1") and not COMMENT_WORDS & {*node.words}:
            node.core = True
        if node.core and node.parent is not None:
            node.parent.core = True
    paragraphs = {id(x.parent) for x in nodes if x.tag == "p" and x.chars > x.link_chars}
    within = set()
    for node in nodes:
        if id(node.parent) in within or node.tag in ("article", "main"):
            within.add(id(node))
        if node.tag in ("html", "body"):
            continue
        holds = node.core or (not body.core and 2 * (node.chars - node.link_chars) > body.chars - body.link_chars)
        words = {*node.words}
        named = DROPPED_WORDS & words
        if named <= WEAK_WORDS and id(node) in within and id(node) in paragraphs and 3 * node.link_chars < node.chars:
            named = frozenset()
        node.drop = (node.tag in DROPPED_TAGS or (node.tag == "header" and id(node) not in within and not node.core)
                     or node.hidden or node.role in DROPPED_ROLES or (node.tag == "form" and by_words and not holds)
                     or (by_words and bool(COMMENT_WORDS & words)) or (by_words and bool(named) and not holds))


def _count(nodes: list[Node]) -> None:
    """Characters and tags of each subtree, dropped nodes left out."""
    for node in reversed(nodes):
        node.chars = node.link_chars = node.links = 0
        node.tags = 1
        for x in node.items:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            elif not x.drop:
                node.chars += x.chars
                node.tags += x.tags
                node.links += x.links
                node.link_chars += x.link_chars
        if node.tag == "a":
            node.links, node.link_chars = node.links + 1, node.chars


def composite_density(chars: int, tags: int, link_chars: int, links: int, body_share: float) -> float:
    if not chars:
        return 0.0
    base = log(chars / max(1, chars - link_chars) * link_chars + body_share * chars + e)
    if base <= 1 + 1e-12:  # no link on the page
        return chars / tags
    return chars / tags * log(chars / max(1, link_chars) * tags / max(1, links)) / log(base)


def _menu(node: Node) -> bool:
    """All its text is links, three or more."""
    return node.links >= 3 and node.link_chars == node.chars


def selected(root: Node, by_words: bool = True) -> tuple[Node, set[int], bool]:
    """The subtree of the article, ids of the nodes beside its path which
    belong to the text as well, and whether the article's own element replaced
    a smaller subtree that the densities chose."""
    nodes = preorder(root)
    _count(nodes)  # of the whole body: nothing is dropped yet
    body = next((x for x in nodes if x.tag == "body"), root)
    share = body.link_chars / max(1, body.chars)
    _prune(nodes, body, by_words)
    _count(nodes)
    live = {id(body)}
    for node in nodes:
        node.density = composite_density(node.chars, node.tags, node.link_chars, node.links, share)
        if id(node) != id(body) and node.parent is not None and id(node.parent) in live and not node.drop:
            live.add(id(node))
    best, top = body, -1.0
    for node in nodes:
        if id(node) not in live:
            continue
        total = sum(float(len("".join(x.split()))) if isinstance(x, str) else 0.0 if x.drop else x.density
                    for x in node.items)
        if total > top:
            best, top = node, total
    # The article's own element holds its heading and short parts too.
    node = chosen = best
    while node is not None and node is not body:
        if node.tag in ("article", "main"):
            best = node
        node = node.parent
    path, node = [], best
    while node is not None and node is not body:
        path.append(node)
        node = node.parent
    threshold = min((x.density for x in [*path, body]), default=0.0)
    beside = set()
    for node in path:
        beside |= {id(x) for x in node.parent.items if isinstance(x, Node) and x is not node and not x.drop
                   and x.chars and x.density >= threshold and 2 * x.link_chars < x.chars}
    return best, beside, best is not chosen


def main_text(html: str) -> str:
    """The article's blocks in page order, joined by a line feed; white space
    inside a block is one space; empty if there is none."""
    return extracted(html)[0]


def extracted(html: str) -> tuple[str, bool]:
    """The text, and whether it was widened to the article's own element."""
    for by_words in (True, False):
        root = parse(html)
        best, beside, widened = selected(root, by_words)
        if text := _blocks(root, best, beside):
            return text, widened
    return "", False


def _blocks(root: Node, best: Node, beside: set[int]) -> str:
    blocks, words = [], []
    # (node or text, inside the selection, inside an article's own element); None ends a block.
    todo: list = [(root, False, False)]
    while todo:
        x, inside, own = todo.pop()
        if x is None:
            if words:
                blocks.append(" ".join("".join(words).split()))
            words = []
        elif isinstance(x, str):
            if inside:
                words.append(x)
        elif not x.drop:
            inside = inside or x is best or id(x) in beside
            own = own or x.tag in ("article", "main")
            # A list of links is a menu, unless it is the article's.
            if inside and not own and x is not best and x.block and _menu(x):
                continue
            if x.tag == "br":
                words.append(" ")
            if x.block:
                todo.append((None, inside, own))
            todo += [(y, inside, own) for y in reversed(x.items)]
            if x.block:
                todo.append((None, inside, own))
    if words:
        blocks.append(" ".join("".join(words).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, *, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points) and widened (the
    article's own element replaced a smaller choice). Null html is
    empty, null ids and urls stay null, broken or cut markup is read as far
    as it goes, repeated rows are extracted each, an empty table gives no
    rows, other columns play no part."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = [extracted(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in found], pa.string()),
                 pa.array([len(t) for t, _ in found], pa.int64()), pa.array([w for _, w in found])], names=TEXTS.names)

    common.python_ready(pages.sparkSession)
    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"),
                        common.text_or_empty(html_col)).mapInArrow(run, TEXTS)
