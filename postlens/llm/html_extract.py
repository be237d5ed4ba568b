"""Main text of web pages from a style tree of each site."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .common import slices
from .url_filter import url_host

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody"
    " td tfoot th thead tr ul".split()
)
# Parts that never hold main text, whatever the site's other pages say.
NO_TEXT = frozenset(
    "script style noscript template head title iframe object svg math canvas audio video nav footer aside form button"
    " select textarea input menu dialog datalist".split()
)
# Leave no gap in the line they stand in.
UNSEEN = frozenset("script style noscript template".split())
NO_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsors sponsored promo promos promotion banner"
    " banners cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe"
    " subscription signup login sidebar side rail menu menus nav navbar navigation breadcrumb breadcrumbs pagination"
    " pager footer masthead comment comments commentlist disqus respond reply replies share sharing social related"
    " recommended recommendations widget widgets toolbar search searchbox form skip".split()
)
# Classes by which a part is cut whatever lies in it: comments of readers.
READER_WORDS = frozenset("comment comments commentlist comment-list comments-area comments-list disqus respond".split())
# Classes by which an article of its own is no main text.
ASIDE_ARTICLES = READER_WORDS | frozenset("reply ad advert advertisement sponsored promo".split())
# Parts that hold lines of text: here a listed word must be a class of its own.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figure figcaption caption em strong b i".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MAIN_WORDS = frozenset("article post entry content story main".split())
# Opening one of these closes an open one of the same set.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
_SIBLINGS |= {"th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
_WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}}
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_NUMBER = re.compile(r"(?<![a-z0-9])[0-9a-f]{8,}(?![a-z0-9])|[0-9]{3,}")
_CLOSES_P = BLOCKS - {"body", "html", "option", "caption", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}


class Node:
    """``noise`` is never main text; ``doubt`` says that a name or a form speaks against the node, which
    holds unless the page's main article lies in it."""

    __slots__ = ("tag", "key", "children", "noise", "main", "doubt")

    def __init__(self, tag: str, key: str, noise: bool = False, main: bool = False, doubt: bool = False):
        self.tag, self.key, self.noise, self.main, self.doubt = tag, key, noise, main, doubt
        self.children: list[Node | str] = []


def _node(tag: str, attrs: list[tuple[str, str | None]]) -> Node:
    named = {k: v or "" for k, v in attrs}
    marks = f"{named.get('class', '')} {named.get('id', '')}".strip()
    words = {w.lower() for w in _SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", marks).lower())} if marks else set()
    classes = set(named.get("class", "").lower().split())
    role = named.get("role", "").lower()
    article = tag in ("article", "main") or role in ("main", "article")
    hidden = "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
    noise = (tag in NO_TEXT and tag != "form") or role in NO_TEXT_ROLES or hidden
    doubt = tag == "form"
    if tag not in ("body", "html") and marks:
        if article:
            noise = noise or bool(classes & ASIDE_ARTICLES)
        elif tag in TEXT_TAGS:
            noise = noise or bool(classes & NO_TEXT_WORDS)
        else:
            noise = noise or bool((classes | {named.get("id", "").lower()}) & READER_WORDS)
            doubt = doubt or bool(words & NO_TEXT_WORDS)
    main = (article or bool(words & MAIN_WORDS)) and not noise and not doubt
    # Long numbers and digests differ from page to page where the style is one; short ones tell columns apart.
    return Node(tag, tag + ("." + _NUMBER.sub("#", "-".join(marks.lower().split())) if marks else ""), noise, main, doubt)


class Dom(HTMLParser):
    """Lenient tree of a page: unknown or missing end tags are mended as browsers do, roughly."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", "")
        self.open = [self.root]
        self.wrapped = False
        self.feed(html)
        self.close()
        if self.wrapped:
            _settle(self.root)
        else:
            _reject(self.root)

    def _shut(self, tags: set[str] | frozenset[str], walls: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                del self.open[at:]
                return
            if self.open[at].tag in walls:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            self._shut({"p"}, BLOCKS - {"p"})
        if tag in _SIBLINGS:
            self._shut(_SIBLINGS[tag], _WALLS.get(tag, {"table"}))
        node = _node(tag, attrs)
        self.open[-1].children.append(node)
        # Only where text of weight lies in a doubtful part is there something to weigh.
        if tag in ("article", "main", "p") and any(x.doubt for x in self.open):
            self.wrapped = True
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        walls = {"table", "article", "body"} if tag not in BLOCKS else {"body"} if tag not in ("body", "html") else set()
        self._shut({tag}, walls - {tag})

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _nodes(root: Node) -> Iterator[tuple[Node, list[Node]]]:
    """Every node outside noise with those around it."""
    todo: list[tuple[Node, list[Node]]] = [(root, [])]
    while todo:
        node, above = todo.pop()
        if node.noise:
            continue
        yield node, above
        inner = [*above, node]
        todo.extend((x, inner) for x in reversed(node.children) if not isinstance(x, str))


def _reject(root: Node) -> None:
    for node, _ in _nodes(root):
        node.noise = node.doubt


def _settle(root: Node) -> None:
    """Doubts become noise, but not around the page's main article: the largest one, if it has a quarter
    of the page's text. Without one, a form that holds half of the text is the page itself."""

    def size(node: Node) -> int:
        return len(_text_of(node))

    whole = size(root)
    articles = [(node, above) for node, above in _nodes(root) if node.main and (node.tag in ("article", "main"))]
    if articles:
        best, around = max(articles, key=lambda x: size(x[0]))
        cleared = around if 4 * size(best) >= whole else []
    else:
        cleared = [node for node, _ in _nodes(root) if node.tag == "form" and 2 * size(node) >= whole]
    for node in cleared:
        node.doubt = False
    _reject(root)


def parse(html: str | None) -> Node:
    return Dom(html or "").root


def _is_noise(node: Node, inside: bool) -> bool:
    """Never part of the main text; ``inside`` says whether the node lies in a marked main part."""
    return node.noise or (node.tag == "header" and not inside)


def _text_of(node: Node, cut: Callable[[Node], bool] = lambda x: x.noise) -> str:
    parts, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
        elif not cut(item):
            todo.extend(reversed(item.children))
    return " ".join("".join(parts).split())


def style_nodes(root: Node) -> Iterator[tuple[str, Node, bool]]:
    """(path of keys, node, whether its children lie in a main part) of every block outside noise, parents first."""
    todo = [("", root, False)]
    while todo:
        path, node, inside = todo.pop()
        inside = inside or node.main
        for child in reversed(node.children):
            if not isinstance(child, str) and not _is_noise(child, inside):
                todo.append((f"{path}/{child.key}" if child.tag in BLOCKS else path, child, inside))
        if node.tag in BLOCKS:
            yield path, node, inside


def _features(root: Node) -> Iterator[tuple[str, int, int]]:
    """(path, kind, hash): kind 0 for the order of the blocks inside, kind 1 for text of a leaf."""
    for path, node, inside in style_nodes(root):
        blocks = [x.key for x in node.children if not isinstance(x, str) and x.tag in BLOCKS and not _is_noise(x, inside)]
        # Repeats of one block are one style: three paragraphs look like four.
        order = [x for i, x in enumerate(blocks) if i == 0 or x != blocks[i - 1]]
        yield path, 0, xxhash.xxh3_64_intdigest(" ".join(order))
        if not blocks:
            text = _text_of(node, lambda x: _is_noise(x, inside))
            if text:
                yield path, 1, xxhash.xxh3_64_intdigest(text)


def importances(styles: Iterable[tuple[str, int, float, int]], decay: float = 0.9) -> dict[str, float]:
    """Composite importance of each path of one site from (path, pages, entropy, kind) rows.

    A node of presentation counts by how its inner styles vary over the pages, a leaf by how its text
    does: what is the same on every page has importance 0. A node mixes its own importance with that
    of its inner nodes, weighted by their pages; the more inner nodes, the less its own counts.
    """
    shown, content, pages = {}, {}, {}
    for path, count, value, kind in styles:
        (content if kind == 1 else shown)[path] = value
        pages[path] = max(pages.get(path, 0), count)
    inner = defaultdict(list)
    for path in shown:
        inner[path.rpartition("/")[0]].append(path)
    out: dict[str, float] = {}
    for path in sorted(pages, key=lambda x: -x.count("/")):
        below = inner.get(path, [])
        if not below:
            out[path] = content.get(path, shown.get(path, 0.0))
            continue
        weight = decay ** len(below)
        total = sum(pages[x] for x in below)
        mixed = sum(out[x] * pages[x] for x in below) / total
        own = max(shown.get(path, 0.0), content.get(path, 0.0))
        out[path] = (1 - weight) * own + weight * mixed
    return out


def main_text(root: Node, weak: frozenset[str] = frozenset()) -> str:
    """Text blocks in page order, without parts that hold no main text and without ``weak`` paths.

    If the page marks its article, only what lies in it counts; if not, its main container; if there
    is none, the whole body. Weak paths cut parts of a marked article, but neither all of it nor all
    its text: if nothing were left, they do not count.
    """
    blocks: list[list[str]] = [[]]

    def collect(path: str, node: Node, inside: bool, weak: frozenset[str]) -> None:
        todo: list[tuple[str, Node | str | None, bool]] = [(path, node, inside)]
        while todo:
            path, item, inside = todo.pop()
            if item is None:
                blocks.append([])
            elif isinstance(item, str):
                blocks[-1].append(item)
            elif _is_noise(item, inside) or (item is not node and path in weak and item.tag in BLOCKS):
                if item.tag in BLOCKS:
                    blocks.append([])
                elif item.tag not in UNSEEN:
                    blocks[-1].append(" ")
            elif item.tag == "br":
                blocks[-1].append(" ")
            else:
                block = item.tag in BLOCKS
                if block:
                    blocks.append([])
                    todo.append((path, None, inside))
                for child in reversed(item.children):
                    key = not isinstance(child, str) and child.tag in BLOCKS
                    todo.append((f"{path}/{child.key}" if key else path, child, inside or item.main))

    def outermost(test, weak: frozenset[str]) -> list[tuple[str, Node]]:
        found, todo = [], [("", root)]
        while todo:
            path, node = todo.pop()
            if node.noise or (path in weak and node.tag in BLOCKS):
                continue
            if test(node):
                found.append((path, node))
                continue
            for child in reversed(node.children):
                if not isinstance(child, str):
                    todo.append((f"{path}/{child.key}" if child.tag in BLOCKS else path, child))
        return found

    def joined() -> str:
        lines = (" ".join("".join(x).split()) for x in blocks)
        return "\n\n".join(x for x in lines if x)

    tests = (lambda x: x.tag == "article", lambda x: x.tag == "main" or x.main, lambda x: x is root)
    held, around = (
        sum(len(_text_of(node)) for _, node in outermost(lambda x, t=tag: x.tag == t, frozenset()))
        for tag in ("article", "main")
    )
    # Small articles in a main part are teasers: there the part itself is the text.
    if 2 * held < around:
        tests = tests[1:]
    for test in tests:
        marked = test(_ARTICLE)
        places = outermost(test, frozenset() if marked else weak)
        if any(_text_of(node) for _, node in places):
            for path, node in places:
                collect(path, node, test(node) and node is not root, weak)
            if marked and weak and not joined():
                for path, node in places:
                    collect(path, node, True, frozenset())
            break
    return joined()


_ARTICLE = Node("article", "article")


def _stats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        roots = [parse(x) for x in part["_html"]]
        # Pages of a host with one main text are copies, whatever stands around it.
        copies = [xxhash.xxh3_64_intdigest(main_text(x)) - (1 << 63) for x in roots]
        styles = [sorted((path, kind, value - (1 << 63)) for path, kind, value in set(_features(x))) for x in roots]
        flat = [x for page in styles for x in page]
        kinds = (pa.string(), pa.int32(), pa.int64())
        columns = [pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds)]
        values = pa.StructArray.from_arrays(columns, ["path", "kind", "hash"])
        starts = pa.array(np.cumsum([0, *map(len, styles)]), pa.int32())
        arrays = [pa.array(part["_host"], pa.string()), pa.array(copies, pa.int64()), pa.ListArray.from_arrays(starts, values)]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "copy", "styles"])


def _extract(keep: list[str], noise_below: float, site_from: float):
    def run(pages: pd.DataFrame, styles: pd.DataFrame) -> pd.DataFrame:
        scores = importances(zip(styles["path"], styles["pages"], styles["value"], styles["kind"]))
        # A site whose pages are all alike says nothing about what is noise.
        known = max(scores.values(), default=0.0) >= site_from
        weak = frozenset(x for x, value in scores.items() if known and value < noise_below)
        out = pages[keep].copy()
        out["text"] = [main_text(parse(x), weak) for x in pages["_html"]]
        out["n_chars"] = out["text"].str.len().astype("int64")
        return out

    return run


def extract_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 16,
    noise_below: float = 0.1,
    site_from: float = 0.3,
    group_pages: int = 250,
) -> DataFrame:
    """(id, url, text, n_chars) for each row of ``pages``.

    The DOMs of a host's pages merge into a style tree: blocks with the same chain of tags, classes
    and ids are one node. Entropies over the host's pages give each node an importance
    (``importances``); branches on at least ``min_pages`` pages of a host whose importance is below
    ``noise_below`` are cut out of each page, unless no node of the site reaches ``site_from``. Parts
    that name themselves as menus, adverts, forms, comments and so on are cut on every host and are
    no nodes of the tree, unless the page's main article lies in them: names are evidence against a part,
    never against the article. Articles that hold less than half of a main part are teasers in it. Pages of a host with the same main text, before branches are cut, count as
    one page. A marked article is never cut as a whole, nor all its text.

    Null html is empty; a page without main text gets an empty text. Pages without a host share one
    tree. Repeated rows and null ids are rows like any other. White space is what Unicode calls so.

    Copies and node counts are combined in the map tasks. Pages travel once, dealt by host and a salt so that a
    group holds about ``group_pages`` of them; the small tree of the host goes to each of its groups.
    """
    rows = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), url_host(F.col(url_col)).alias("_host")
    )
    parsed = rows.select("_host", "_html").mapInArrow(
        _stats, "host string, copy long, styles array<struct<path: string, kind: int, hash: long>>"
    )
    # Of copies that differ in their styles, the same one counts in every run.
    single = parsed.groupBy("host", "copy").agg(F.min("styles").alias("styles"))
    counted = single.select("host", F.explode("styles").alias("style")).select("host", "style.*")
    counts = counted.groupBy("host", "path", "kind", "hash").agg(F.count("*").alias("c"))
    nodes = counts.groupBy("host", "path", "kind").agg(
        F.sum("c").alias("pages"), F.sum(F.col("c") * F.ln("c")).alias("same"), F.max("c").alias("most")
    )
    # Entropy of a presentation style over its variants, and of a text over the pages that show it.
    spread = F.when(F.col("pages") > 1, 1 - F.col("same") / F.col("pages") / F.ln("pages")).otherwise(1.0)
    # Stored, so that its size is known and pages need not be dealt by host alone.
    sizes = rows.groupBy("_host").agg(F.ceil(F.count("*") / group_pages).cast("int").alias("_salts"))
    sizes = materialize(sizes, "site_sizes")
    # Rare paths decide nothing, so only frequent ones are copied to the host's groups.
    styles = nodes.filter(F.col("pages") >= min_pages).select("host", "path", "kind", "pages", spread.alias("value"))
    styles = styles.join(sizes, F.col("host") == F.col("_host")).select(
        F.col("host").alias("_host"), F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), "path", "kind", "pages", "value"
    )
    dealt = rows.join(sizes, "_host").withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), "_salts").cast("int"))
    kinds = {x: rows.schema[x].dataType.simpleString() for x in ("_id", "_url")}
    schema = f"_id {kinds['_id']}, _url {kinds['_url']}, text string, n_chars long"
    made = (
        dealt.groupBy("_host", "_salt")
        .cogroup(styles.groupBy("_host", "_salt"))
        .applyInPandas(_extract(["_id", "_url"], noise_below, site_from), schema)
    )
    return made.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
