"""Main text of web pages by site style trees.

Pages of one host are merged into a tree whose nodes are paths of tags and classes. For every node
the pages are counted by presentation (the sequence of its child tags) and by content (a digest of
all text below it). A branch that looks and reads alike on most pages has little entropy and so
little importance; if the node above it is important, it is cut from every page of the host. The
branches right below the body are also held against the one with most text: menus, footers and adverts
that take turns are cut where they are clearly less important than it, whatever their names are. So is
what a page itself declares to be no content, which hosts of few pages need: navigation, headers,
footers, sidebars, forms, scripts, notices, adverts, comments. Declared noise has nodes of its own in
the tree, but is no part of the content around it. Where a page marks its article, only that is read; an article is never
cut as a whole, however often it is copied. Inside it only what reads the same on nearly all pages is
cut, and only where it reads so; inline elements are never cut by themselves.

Counts are combined per task before they are shuffled, so a host that fills a third of the table is
a few rows per node and task. What a host loses is a short list of path hashes, joined to its pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged
from stayrate.llm.url_filter import host_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|textarea|title|xmp|noembed|noframes)(?=[\s/>])[^>]*>"
    r".*?(?:</\1\s*>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr svg iframe noscript template".split()
)
#: Elements whose insides are no part of the page around them.
APART = frozenset("svg iframe noscript template".split())
END_TAGS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in APART}
#: Opening tags that end an open svg, and the svg elements in which they do not.
HTML_ONLY = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HTML_IN_SVG = frozenset(("foreignobject", "desc"))
#: Elements that an opening tag of the same group closes.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
SCOPES = APART | set("ul ol dl table article section main body div td th blockquote nav footer aside".split())
#: What a page declares not to be its text: elements, roles, and words of class and id.
NOISE_TAGS = frozenset(
    "nav header footer aside form script style noscript template head title menu button select "
    "textarea input iframe svg canvas object embed audio video dialog option datalist".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar header masthead footer comment comments reply replies disqus share sharing social related "
    "recommended newsletter subscribe login signup pagination pager widget toolbar skip".split()
)
WORD = re.compile(r"[a-z]+")
#: Never cut as a whole.
ROOTS = frozenset(("", "html", "body", "main", "article"))
#: Blocks that can be a page's menu, footer or advert when they stand right below one of ROOTS.
BRANCHES = frozenset("div section nav header footer aside menu ul ol dl table form".split())
NODE = ("host", "path", "above")
TREE = "path long, above long, guard int, kind string, value long, chars long"
#: What may be cut of a node: all of it, also by comparison with the branches beside it; all of it;
#: its commonest content only; nothing.
BRANCH, FREE, IN_ARTICLE, KEPT = -1, 0, 1, 2
READ = "text string, n_chars long"


@dataclass(slots=True)
class Node:
    tag: str
    path: int
    parent: Node | None
    noise: bool
    article: bool
    within: str  # the innermost of APART and HTML_IN_SVG
    children: list[str] = field(default_factory=list)
    own: list[str] = field(default_factory=list)
    chars: int = 0


def _hash(*parts: object) -> int:
    value = xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _declared_noise(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in NOISE_TAGS:
        return not (tag == "header" and in_article)  # an article's own header holds its title
    if not attributes:
        return False
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or "display:none" in style or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if tag in ("body", "html", "main"):
        return False
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return not NOISE_WORDS.isdisjoint(WORD.findall(named.lower()))


def _attributes(raw: str) -> dict[str, str]:
    if not raw.strip(" /"):
        return {}
    found = ATTRIBUTE.findall(raw)
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in reversed(found)}


@lru_cache(maxsize=1 << 14)
def _look(tag: str, raw: str) -> tuple[str, bool, tuple[bool, bool]]:
    """Sorted classes, whether an article, and whether noise outside and inside of an article."""
    attributes = _attributes(raw)
    names = " ".join(sorted(attributes.get("class", "").split()))
    article = tag == "article" or attributes.get("role") == "article"
    return names, article, tuple(_declared_noise(tag, attributes, i) for i in (False, True))


@lru_cache(maxsize=1 << 16)
def _path(above: int, tag: str, names: str) -> int:
    return _hash(above, tag, names)


def walk(source: str) -> Iterator[tuple[str, Node, str | None]]:
    """("text", node, text), ("break", node, None) and ("end", node, None) in page order."""
    root = Node("", _hash("root"), None, False, False, "")
    stack, at = [root], 0
    last_ends: dict[str, int] = {}
    while (found := source.find("<", at)) >= 0:
        if found > at:
            yield "text", stack[-1], source[at:found]
        token = TOKEN.match(source, found)
        if not token:
            yield "text", stack[-1], "<"
            at = found + 1
            continue
        at = token.end()
        if token[1]:
            stack[-1].children.append(token[1].lower())
            opened = source.index(">", found) + 1
            if stack[-1].within == "svg" and source[opened - 2] == "/":
                at = opened
            continue
        tag = (token[2] or "").lower()
        if not tag:
            if token[0].startswith("<![CDATA["):
                yield "text", stack[-1], token[0][9:].removesuffix("]]>")
            continue
        if token[0][1] == "/":
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), 0)
            if depth:
                while len(stack) > depth:
                    yield "end", stack.pop(), None
            continue
        if tag in HTML_ONLY:
            while stack[-1].within == "svg":
                yield "end", stack.pop(), None
        empty = token[3].endswith("/") and (tag in APART or stack[-1].within == "svg")
        if not empty and tag in APART and tag != "svg":  # without an end tag it would take the rest
            if tag not in last_ends:
                last_ends[tag] = max((m.start() for m in END_TAGS[tag].finditer(source, at)), default=-1)
            empty = last_ends[tag] < at
        if empty:
            stack[-1].children.append(tag)
            continue
        if tag in VOID:
            stack[-1].children.append(tag)
            if tag not in INLINE:
                yield "break", stack[-1], None
            continue
        closes = CLOSED_BY.get(tag, ())
        if not closes and tag not in INLINE:
            closes = ("p",)  # a block ends an open paragraph
        for depth in range(len(stack) - 1, 0, -1) if closes else ():
            if stack[depth].tag in closes:
                while len(stack) > depth:
                    yield "end", stack.pop(), None
                break
            if stack[depth].tag in SCOPES:
                break
        above = stack[-1]
        above.children.append(tag)
        names, article, noise = _look(tag, token[3])
        node = Node(
            tag, _path(above.path, tag, names), above, above.noise or noise[above.article],
            above.article or article,
            tag if tag in APART or (above.within and tag in HTML_IN_SVG) else above.within,
        )
        yield "break" if tag not in INLINE else "inline", above, None
        stack.append(node)
    if at < len(source):
        yield "text", stack[-1], source[at:]
    while stack:
        yield "end", stack.pop(), None


def _contents(events: Iterable[tuple[str, Node, str | None]]) -> Iterator[tuple[Node, int]]:
    """Nodes, each with a digest of all text below it, at their end.

    Of declared noise only the topmost nodes are given; its text is no part of what is around it.
    """
    for event, node, text in events:
        if event == "text":
            node.own.append(" ".join(text.split()))
            node.chars += len(node.own[-1])
        elif event == "end":
            parts = [part for part in node.own if part]
            value = _hash(*parts)
            above = node.parent
            if parts and above and node.noise == above.noise:
                above.own.append(str(value))
                above.chars += node.chars
            if not (node.noise and above and above.noise):
                yield node, value


def _guard(node: Node) -> int:
    whole = node.article and not (node.parent and node.parent.article)
    if whole or node.tag in ROOTS or node.tag in INLINE:
        return KEPT
    if node.article:
        return IN_ARTICLE
    return BRANCH if node.tag in BRANCHES and node.parent.tag in ROOTS else FREE


def page_tree(source: str) -> set[tuple[int, int, int, str, int, int]]:
    """(path, path above, guard, kind, value, characters) of the nodes of one page."""
    found = set()
    for node, content in _contents(walk(source)):
        above = node.parent.path if node.parent else 0
        place = (node.path, above, _guard(node))
        found.add((*place, "style", _hash(*node.children), 0))
        found.add((*place, "content", content, node.chars))
    return found


def page_text(
    source: str, cut: frozenset[int], same: frozenset[tuple[int, int]] = frozenset()
) -> str:
    """The text of the page's articles, else of its whole body, without noise and cut branches.

    ``cut`` holds paths, ``same`` paths with the content that is cut there.
    """
    everywhere: list[list[str]] = [[]]
    articles: list[list[str]] = [[]]
    seen_article = False
    lost: set[int] = set()  # cut paths and those below them
    events = walk(source)
    gone: set[int] = set()  # numbers of the nodes of ``same`` and those below them
    if same:
        events = list(events)
        gone = {id(node) for node, content in _contents(events) if (node.path, content) in same}
    for event, node, text in events:
        seen_article |= node.article and not node.noise
        if cut and (node.path in cut or (node.parent and node.parent.path in lost)):
            lost.add(node.path)
        if gone and node.parent and id(node.parent) in gone:
            gone.add(id(node))
        if event == "text":
            if not (node.noise or node.path in lost or id(node) in gone):
                everywhere[-1].append(text)
                if node.article:
                    articles[-1].append(text)
        elif node.within:
            continue
        elif event == "break" or (event == "end" and node.tag not in INLINE):
            everywhere.append([])
            articles.append([])
    blocks = articles if seen_article else everywhere
    joined = (" ".join(html.unescape("".join(block)).split()) for block in blocks if block)
    return " ".join(block for block in joined if block)


def style_trees(pages: DataFrame) -> DataFrame:
    """Counts of each presentation and content of a node over the pages (host, html) of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], ([], [], [], [], [], [])
            for i, source in enumerate(batch.column(1)):
                for entry in page_tree(source.as_py()):
                    rows.append(i)
                    for column, x in zip(columns, entry):
                        column.append(x)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            host = batch.column(0).take(pa.array(rows, pa.int32()))
            names = ["host", "path", "above", "guard", "kind", "value", "chars"]
            yield pa.RecordBatch.from_arrays([host, *arrays], names=names)

    nodes = pages.mapInArrow(run, f"host string, {TREE}")
    counts = (F.count(F.lit(1)).alias("n"), F.max("guard").alias("guard"), F.max("chars").alias("chars"))
    return nodes.groupBy(*NODE, "kind", "value").agg(*counts)


def unimportant(
    trees: DataFrame,
    least: float,
    least_pages: int,
    of_content: float = 0.9,
    nearly_all: float = 0.9,
    beside: float = 0.75,
) -> DataFrame:
    """(host, cut, same): the branches that hardly differ between at least ``least_pages`` pages.

    The importance of a node weighs the entropies of its contents and presentations, on the scale on
    which something different on every page is 1. A branch is cut if it has less than ``least`` and
    the node above it at least half of the scale. That scale grows with the host, so inside an article
    the commonest content must also have a share of ``nearly_all``, and only it is cut (``same``).
    A branch right below the body is also cut if the branch beside it that holds most text of the host
    has at least half of the scale and it has less than ``beside`` of that one's importance.
    """
    # -Σ n/m log(n/m) = log m - Σ n log n / m: two sums, so nothing is joined back to the values.
    m, n = F.sum("n"), F.col("n")
    entropy = F.greatest(F.log(m) - F.sum(n * F.log(n)) / m, F.lit(0.0))
    weight = F.when(F.col("kind") == "content", of_content).otherwise(1 - of_content)
    nodes = trees.groupBy(*NODE, "kind").agg(
        (entropy / F.log(F.greatest(m, F.lit(2)))).alias("entropy"), m.alias("m"),
        F.max("guard").alias("guard"), F.max(F.struct("n", "value")).alias("top"),
        F.sum(n * F.col("chars")).alias("size"),
    )
    content = F.col("kind") == "content"
    nodes = nodes.groupBy(*NODE).agg(
        F.sum(weight * F.col("entropy")).alias("importance"),
        F.max(F.when(content, F.col("m"))).alias("m"),
        F.max(F.when(content, F.col("top"))).alias("top"),
        F.max(F.when(content, F.col("size"))).alias("size"),
        F.max("guard").alias("guard"),
    )
    nodes = staged(nodes, "importance").where(F.col("m") >= least_pages)
    above = nodes.select("host", F.col("path").alias("above"), F.col("importance").alias("around"))
    common = (F.col("guard") <= FREE) | (
        (F.col("guard") == IN_ARTICLE) & (F.col("top.n") >= nearly_all * F.col("m"))
    )
    low = nodes.where(common & (F.col("importance") < least))
    low = low.join(above.where("around >= 0.5"), ["host", "above"], "left_semi")
    largest = F.max(F.struct("size", "importance", "path")).alias("main")
    main = nodes.groupBy("host", "above").agg(largest).where("main.importance >= 0.5")
    less = (F.col("path") != F.col("main.path")) & (F.col("importance") < beside * F.col("main.importance"))
    turns = nodes.where(F.col("guard") == BRANCH).join(main, ["host", "above"]).where(less).drop("main")
    low = low.unionByName(turns)
    free = F.col("guard") <= FREE
    same = F.struct("path", F.col("top.value").alias("content"))
    return low.groupBy("host").agg(
        F.collect_set(F.when(free, F.col("path"))).alias("cut"),
        F.collect_set(F.when(~free, same)).alias("same"),
    )


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: float = 0.2,
    least_pages: int = 8,
) -> DataFrame:
    """One row per page: id, url, text, n_chars.

    A null or empty page has an empty text; pages with null urls form a host of their own. Pages
    that repeat are returned as often as they occur; other columns are ignored.
    """
    source = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        host_of(url_col).alias("host"), source.alias("html"),
        F.struct(F.col(id_col).alias("id"), F.col(url_col).alias("url")).alias("page"),
    )
    cut = staged(unimportant(style_trees(rows.select("host", "html")), least, least_pages), "cut")
    joined = rows.join(cut, "host", "left").select("page", "html", "cut", "same")
    kind = joined.schema["page"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                page_text(
                    source.as_py(), frozenset(cut.as_py() or ()),
                    frozenset((s["path"], s["content"]) for s in same.as_py() or ()),
                )
                for source, cut, same in zip(batch.column(1), batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page", "text", "n_chars"],
            )

    out = joined.mapInArrow(run, f"page {kind}, {READ}")
    return out.select(
        F.col("page.id").alias(id_col), F.col("page.url").alias(url_col), "text", "n_chars"
    )
