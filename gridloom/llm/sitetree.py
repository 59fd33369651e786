"""Main text of web pages with a style tree per site.

The element trees of all pages of a host are merged: elements with the same path
of tags and class names are one node.  Every node gets two measures over the
pages that have it, each an entropy between the pages relative to its greatest
possible value, which is taken for ``FEW_PAGES`` pages where there are more, so that
an entropy does not fall only because a host has many pages:

* presentation: how much the sequences of child elements differ between pages;
* content: how much the text blocks right in it differ.

Templates repeat the same few texts and shapes, so their nodes have entropies
near zero.  The importance of a node is its content entropy; for a node with
inner elements it is averaged with its presentation entropy where that is greater,
so a fixed layout does not speak against the text in it.  Copies and near copies of a
page count once (a page with an article by its article), and a node seen on fewer than
``MIN_PAGES`` different pages is not judged.  A text block is judged by the lowest node around it alone:
a branch goes from the pages of the host if all below it is of low importance, and
a wrapper never takes important text with it.  Inside the page's article nothing goes
for being repeated.  Nodes that HTML or their class name declares to be
navigation, forms, notices and the like are of no importance on any page (inside an
article only by whole class names of widgets, and headings never by their id), and if
a page declares one article, or several that hold most of its important text, nothing
outside of it is.  Several with less, such as teasers, are judged like other nodes.

What is left is text: character references decoded, white space inside a block
turned into one blank, blocks in page order with an empty line between.

Null and empty html give an empty text; a null or odd url belongs to the host
without a name.  Repeated pages are each returned.  An empty table gives an empty
result.  Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.llm.common import Scratch, batches, table

MIN_PAGES = 5
FEW_PAGES = 100
LOW = 0.4
#: Removed nodes are broadcast up to this number, else joined to the pages.
MAX_BROADCAST_NODES = 200_000

# Elements and names that HTML and common usage define.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg object select title annotation annotation-xml".split())
#: What these hold is no markup, also where their end is missing.
RAW_TO_THE_END = frozenset("script style textarea".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul caption optgroup option".split()
)
NO_TEXT = frozenset("head nav aside footer form button dialog menu fieldset".split())
CLOSES_P = BLOCKS - {"html", "body", "optgroup", "option"}
CLOSED_BY_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PARAGRAPH = frozenset({"p"})
SCOPES = frozenset("ul ol dl table div article section body html".split())
NO_TEXT_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead banner topbar footer sidebar aside widget "
    "widgets ad ads advert adverts advertisement adsense sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup signin login search "
    "share sharing social related recommended recommendations comment comments reply replies respond disqus pagination "
    "pager skip copyright toolbar".split()
)
#: Class names that stand for widgets inside an article too; only whole ones count there.
WIDGET_NAMES = frozenset(
    "ad ads ad-banner ad-box ad-container ad-label ad-slot ad-unit ad-wrapper adsbygoogle adsense advert adverts advertisement "
    "advertisements advertising sponsor sponsored promo promotion comment comments comment-form comment-list comment-respond "
    "comments-area comments-list comments-section reply replies respond disqus disqus-thread share sharing share-bar "
    "share-button share-buttons share-links share-tools sharedaddy social social-bar social-buttons social-icons social-links "
    "social-media social-share addthis addtoany notice notices cookie cookies cookie-banner cookie-bar cookie-consent "
    "cookie-notice consent gdpr newsletter newsletter-form newsletter-signup subscribe".split()
)
#: Their ids are made from titles and tell nothing about what they are.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section a span p li dt dd".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus".split())
WHOLE = frozenset("html body main article".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_OPENING = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_LONG_NUMBER = re.compile(r"\d{3,}")
_NAMES = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _number(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "replace")) - (1 << 63)


@dataclass(slots=True)
class Element:
    tag: str
    path: int  # a running number of the tags and names from the page down
    silent: bool  # of no importance on any page
    article: bool
    top: Element | None  # the outermost article around it, itself included
    inside: bool  # it is no page of its own: some element is around it
    shape: list[str] = field(default_factory=list)  # child elements, runs as one


@dataclass(slots=True)
class Block:
    text: str
    at: Element


def _opened(tag: str, attributes: str, up: Element) -> Element:
    names: dict[str, str] = {}
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            names.setdefault(name.lower(), "".join(values))
    labels = f"{names.get('class', '')} {names.get('id', '')}"
    inside = up.article
    named = names.get("class", "") if tag in TITLED else labels
    words = {word.lower() for word in _NAME_PARTS.findall(named)} | set(_NAMES.findall(named.lower()))
    if inside:
        telling = {name.replace("_", "-") for name in names.get("class", "").lower().split()} & WIDGET_NAMES
    elif words & {"has", "with", "no", "without"}:  # names of a layout, not of a part
        telling = set()
    else:
        telling = words & (COMMENT_NAMES if tag in WHOLE else NO_TEXT_NAMES)
    silent = (
        up.silent
        or tag in NO_TEXT
        or (tag == "header" and not inside)
        or bool(telling)
        or ("header" in words and not inside and tag not in WHOLE)
        or names.get("role", "").lower() in NO_TEXT_ROLES
        or "hidden" in names
        or names.get("aria-hidden", "").lower() == "true"
        or "display:none" in names.get("style", "").replace(" ", "").lower()
    )
    article = inside or tag in ("article", "main") or names.get("role", "").lower() in ("main", "article")
    # Long numbers name one page's element, not the template's.
    style = ".".join([tag, *sorted({_LONG_NUMBER.sub("#", word) for word in labels.split()})])
    if not up.shape or up.shape[-1] != style:
        up.shape.append(style)
    article = article and not silent
    path = xxhash.xxh64_intdigest(style.encode("utf-8", "replace"), up.path)
    own = Element(tag, path, silent, article, up.top if article else None, True)
    if article and own.top is None:
        own.top = own
    return own


class _Tags:
    """Tags of a page from left to right, each character looked at a bounded number of times.

    A quote that is not closed before the page ends would have every later tag look for
    its end in vain; once that happens, tags of the page end at the next ``>``.
    """

    def __init__(self, page: str) -> None:
        self.page, self.quotes = page, True
        self.last = page.rfind(">")

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """Start, end, whether it closes, name (None of comments and declarations), attributes."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            mark = page[start + 1 : start + 2]
            if mark == "!":
                for begin, stop in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                    if page.startswith(begin, start):
                        end = page.find(stop, start + len(begin))
                        return start, end + len(stop) if end >= 0 else len(page), False, None, ""
            if start < self.last:
                if mark in ("!", "?"):
                    return start, page.index(">", start) + 1, False, None, ""
                found = _OPENING.match(page, start)
                if found:
                    after = found.end()
                    end = after + 1 if page[after] == ">" else self._end(after)
                    return start, end, mark == "/", found[1], page[after : end - 1]
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        page, first = self.page, at
        while self.quotes:
            found = _QUOTE_OR_END.search(page, at)
            if found is None:
                break
            if found[0] == ">":
                return found.end()
            at = page.find(found[0], found.end()) + 1
            if not at:
                break
        self.quotes = False
        return page.index(">", first) + 1


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """Text blocks in page order, silent ones left out, and the elements that were opened."""
    root = Element("", 1, False, False, None, False)
    elements, blocks, held = [], [], []
    # The open elements, and per tag the depths at which it is open.
    stack, depths, block_depths = [root], defaultdict(list), [0]
    at, unclosed = 0, set()
    tags = _Tags(page)

    def ended() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text and not stack[-1].silent:
            blocks.append(Block(text, stack[block_depths[-1]]))

    def leave(depth: int) -> None:
        """Closes the element at a depth and all inside it."""
        while len(stack) > depth:
            tag = stack.pop().tag
            depths[tag].pop()
            if tag in BLOCKS:
                block_depths.pop()

    def deepest(names: set[str] | frozenset[str]) -> int:
        depth = 0
        for name in names:
            if (own := depths.get(name)) and own[-1] > depth:
                depth = own[-1]
        return depth

    def close(names: set[str] | frozenset[str], stop: frozenset[str]) -> None:
        """Closes the nearest open element of ``names``, unless one of ``stop`` is nearer."""
        depth = deepest(names)
        if depth and (not stop or depth >= deepest(stop)):
            ended()
            leave(depth)

    while (found := tags.next(at)) is not None:
        start, end, closes, name, attributes = found
        now = stack[-1]
        if start > at and not now.silent:
            held.append(html.unescape(page[at:start]))
        at = end
        if name is None:
            continue
        tag = name.lower()
        if closes:
            if tag in BLOCKS:
                close({tag}, frozenset())
            elif not now.silent or now.tag == tag:
                depth = depths[tag][-1] if depths[tag] else 0
                if depth > block_depths[-1]:
                    if stack[depth].silent:
                        ended()
                    leave(depth)
            continue
        if tag in RAW:
            if attributes.endswith("/") or tag in unclosed:
                continue
            finish = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if finish:
                at = finish.end()
            elif tag in RAW_TO_THE_END:
                at = len(page)
            else:
                unclosed.add(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                ended()
            elif tag == "br":
                held.append(" ")
            continue
        if tag in CLOSES_P:
            close(PARAGRAPH, SCOPES)
        if tag in CLOSED_BY_LIKE:
            close(CLOSED_BY_LIKE[tag], SCOPES)
        now = stack[-1]
        opened = _opened(tag, attributes, now)
        if tag in BLOCKS or opened.silent != now.silent:
            ended()
        if tag in BLOCKS:
            block_depths.append(len(stack))
        depths[tag].append(len(stack))
        stack.append(opened)
        elements.append(opened)
    if at < len(page) and not stack[-1].silent:
        held.append(html.unescape(page[at:]))
    ended()
    return blocks, elements


def _judged(block: Block) -> bool:
    """Text right in the page itself has no node that could be judged."""
    return block.at.inside and block.at.tag not in ("html", "body")


def _page_key(blocks: list[Block]) -> int:
    """One number for copies and near copies, which share their longest blocks, half of the text.

    It is taken of the article or, without one, of all blocks.
    """
    texts = sorted([b.text for b in _scope(blocks, blocks) or blocks], key=lambda text: (-len(text), text))
    half, chosen = sum(map(len, texts)) / 2, []
    for text in texts:
        chosen.append(text)
        half -= len(text)
        if half <= 0:
            break
    return _number(*chosen)


_FEATURES = "node long, inner boolean, presentation boolean, feature long, page long"


def _features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page adds to the tree of its host."""
    for batch in batches(rows, 8 << 20):
        out: set[tuple[int, bool, bool, int, int]] = set()
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            host = host_of(url)
            blocks, _ = parse(page or "")
            judged = [block for block in blocks if _judged(block)]
            if not judged:
                continue
            key = _page_key(blocks)
            seen: dict[int, tuple[int, bool]] = {}
            for block in judged:
                node = block.at
                if node.path not in seen:
                    inner = any(style.split(".")[0] in BLOCKS for style in node.shape)
                    number = _number(host, str(node.path))
                    seen[node.path] = (number, inner)
                    out.add((number, inner, True, _number(*node.shape), key))
                out.add((*seen[node.path], False, _number(block.text), key))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*out, strict=True)], ["node", "inner", "presentation", "feature", "page"]
            )


def node_importance(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """node, pages and importance of every node with text of its own."""
    features = pages.select("url", "html").mapInArrow(_features, _FEATURES)
    # A copy of a page has the same key and adds nothing.  All sums are made in
    # parts before a shuffle, so a host with most of the pages is no hot key.
    once = features.groupBy("node", "presentation", "feature", "page").agg(F.max("inner").alias("inner"))
    counted = scratch.settle(once)
    c = F.col
    # Near copies may differ at a node, so its pages are not the sum over its features.
    pages_of = counted.groupBy("node", "page").agg(F.max("inner").alias("inner"))
    pages_of = pages_of.groupBy("node").agg(F.count("*").alias("pages"), F.max("inner").alias("inner"))
    # Features are spread over the pages: the mean of log(pages / pages with the feature)
    # is the entropy where a page has one feature, and 0 for a list that all pages share.
    spread = (
        counted.groupBy("node", "presentation", "feature").agg(F.count("*").alias("n"))
        .groupBy("node").pivot("presentation", [True, False])
        .agg(F.sum(c("n") * F.log(c("n"))).alias("nlogn"), F.sum("n").alias("n"))
    )

    def entropy(kind: str) -> Column:
        between = F.log("pages") - c(f"{kind}_nlogn") / c(f"{kind}_n")
        return F.when(c("pages") > 1, F.least(F.lit(1.0), between / F.log(F.least("pages", F.lit(FEW_PAGES))))).otherwise(1.0)

    presentation, content = entropy("true"), entropy("false")
    importance = F.when(c("inner"), F.greatest((presentation + content) / 2, content)).otherwise(content)
    return spread.join(pages_of, "node").select("node", "pages", importance.alias("importance"))


def low_nodes(importance: DataFrame) -> DataFrame:
    """Nodes whose blocks are removed, unless they stand in the page's article."""
    return importance.where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LOW)).select("node")


def _scope(blocks: list[Block], stay: list[Block]) -> list[Block]:
    """The blocks of the page's article: of the only one, or of several with most of the important text."""
    inside = [block for block in blocks if block.at.article]
    articles = {id(block.at.top) for block in inside}
    if len(articles) > 1:
        outside = sum(len(block.text) for block in stay if not block.at.article)
        if sum(len(block.text) for block in stay if block.at.article) <= outside:
            return []
    return inside


def main_text(page: str, host: str, low: frozenset[int] | set[int]) -> str:
    blocks, _ = parse(page)
    judged: dict[int, bool] = {}

    def important(block: Block) -> bool:
        path = block.at.path
        if path not in judged:
            judged[path] = _judged(block) and _number(host, str(path)) in low
        return not judged[path]

    stay = [block for block in blocks if not low or important(block)]
    return "\n\n".join(block.text for block in _scope(blocks, stay) or stay)


def _extracted(rows: Iterator[pa.RecordBatch], low: frozenset[int] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 8 << 20):
        urls, pages = batch.column("url").to_pylist(), batch.column("html").to_pylist()
        lows = [low] * len(urls) if low is not None else [set(x or ()) for x in batch.column("low").to_pylist()]
        texts = [main_text(page or "", host_of(url), own) for url, page, own in zip(urls, pages, lows, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def _own_nodes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 8 << 20):
        out = set()
        for key, url, page in zip(*(batch.column(c).to_pylist() for c in ("_page", "url", "html")), strict=True):
            host = host_of(url)
            paths = {block.at.path for block in parse(page or "")[0] if _judged(block)}
            out |= {(key, _number(host, str(path))) for path in paths}
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*sorted(out), strict=True)], ["_page", "node"])


def extract(pages: DataFrame, most_broadcast: int = MAX_BROADCAST_NODES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    scratch = Scratch(pages.sparkSession, "sitetree")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    low = scratch.settle(low_nodes(node_importance(pages, scratch)))
    schema = "page_id long, url string, text string, n_chars long"
    found = low.limit(most_broadcast + 1).collect()  # at most so many numbers
    if len(found) <= most_broadcast:
        return pages.mapInArrow(partial(_extracted, low=frozenset(r.node for r in found)), schema)
    # A page's nodes are bounded by its own length.
    named = scratch.settle(pages.withColumn("_page", F.monotonically_increasing_id()))
    per_page = (
        named.mapInArrow(_own_nodes, "_page long, node long").join(low, "node", "left_semi")
        .groupBy("_page").agg(F.collect_list("node").alias("low"))
    )
    joined = named.join(per_page, "_page", "left").select("page_id", "url", "html", "low")
    return joined.mapInArrow(partial(_extracted, low=None), schema)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
