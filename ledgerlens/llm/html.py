"""Main text of web pages by the container paths that the pages of a host agree on."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.text import stored

# A path wins if this share of its host's pages name it as their best.
WINNING = 0.25
# A page is read by a winning path if that holds this share of the text that its own best one holds.
FAIR = 0.5
# Up to so many hosts' paths, some hundreds of bytes each, are broadcast.
BROADCAST_HOSTS = 200_000

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " search section summary table tbody tfoot thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
# Within these, an element of the kind above belongs to another list or table.
SCOPES = frozenset("table ul ol dl menu select body html article section div".split())
# Elements and words in classes and ids that mark what is not the article.
OUTSIDE_TAGS = frozenset(
    "head nav footer aside form button select dialog menu object canvas audio video map datalist search"
    " annotation annotation-xml".split()
)
OUTSIDE_WORDS = frozenset(
    "nav navbar navigation menu sidebar side footer ad ads adv advert advertisement adverts sponsor sponsored"
    " promo promotion banner cookie cookies consent notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup share sharing social related recommended recommendations comment comments"
    " disqus reply replies breadcrumb breadcrumbs pagination pager widget toolbar login search skip tags"
    " copyright masthead gdpr paywall".split()
)
HEADER_WORDS = frozenset(["header", "topbar"])
GOOD_TAGS = frozenset(["article", "main"])
GOOD_WORDS = frozenset("article content post entry story text main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_MARKED = re.compile(r"\b(class|id|role|style|hidden|itemprop)\b", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ARTICLE, _OUTSIDE, _HEADER = 0, 1, 2


@dataclass(slots=True)
class Node:
    """An element: its parent's place, and what it is to the article."""

    tag: str
    parent: int
    path: int
    kind: int
    weight: float
    block: bool
    score: float = 0.0


@dataclass(slots=True)
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: Text and the place of the element that holds it, in page order.
    pieces: list[tuple[str, int]] = field(default_factory=list)


@lru_cache(maxsize=4096)
def _described(tag: str, attributes: str) -> tuple[str, int, float]:
    """An element's generalised name, kind and weight as a container."""
    name, words, hidden = tag, set(), False
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                hidden = True
            elif key == "role":
                words.add(value.lower().replace("contentinfo", "footer").replace("complementary", "sidebar"))
            elif key != "style":
                words.update(w.lower() for w in _NAME.findall(value))
                if key == "class":
                    name += "." + ".".join(sorted(re.sub(r"\d+", "0", w) for w in value.split()))
    container = tag in ("html", "body", *GOOD_TAGS)
    if tag in OUTSIDE_TAGS or hidden or (words & OUTSIDE_WORDS and (not container or tag == "article" and words & {"comment", "comments", "related", "teaser"})):
        return name, _OUTSIDE, 0.0
    if tag == "header" or words & HEADER_WORDS and not container:
        return name, _HEADER, 0.0
    weight = 0.5 if tag in ("html", "body") else 3.0 if tag in GOOD_TAGS else 1.5 if words & GOOD_WORDS else 1.0
    return name, _ARTICLE, weight


class _Open:
    """The open elements, with the depths of each tag, of blocks and of cells; no look at it takes a search."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes, self.stack = nodes, [0]
        self.depths: dict[str, list[int]] = {}
        self.blocks, self.cells = [0], [0]

    def push(self, node: int) -> None:
        tag = self.nodes[node].tag
        for depths in self._lists(tag):
            depths.append(len(self.stack))
        self.stack.append(node)

    def _lists(self, tag: str) -> Iterator[list[int]]:
        yield self.depths.setdefault(tag, [])
        if tag in BLOCKS:
            yield self.blocks
        elif tag in ("td", "th"):
            yield self.cells

    def cut(self, depth: int) -> None:
        """End all elements from a depth on."""
        while len(self.stack) > depth:
            for depths in self._lists(self.nodes[self.stack.pop()].tag):
                depths.pop()

    def last(self, tags) -> int:
        """The greatest depth of an element of these tags, 0 if there is none."""
        return max((own[-1] for tag in tags if (own := self.depths.get(tag))), default=0)

    def before_block(self) -> None:
        """A block ends an open paragraph, with all that is open in it."""
        depth = max(self.blocks[-1], self.cells[-1])
        if depth and self.nodes[self.stack[depth]].tag == "p":
            self.cut(depth)

    def before_member(self, tag: str) -> None:
        """A member of a list or table ends the one before, of the same list or table."""
        while (depth := self.last(CLOSED_BY[tag])) > self.last(SCOPES):
            self.cut(depth)
            if tag != "tr":
                break

    def close(self, tag: str) -> None:
        depth = self.last((tag,))
        # A stray end inside a block ends nothing outside.
        if depth and (tag in BLOCKS or depth > self.blocks[-1]):
            self.cut(depth)


def parse(html: str) -> Page:
    """Elements and texts of a page, however broken its markup is."""
    page = Page()
    nodes, pieces = page.nodes, page.pieces
    nodes.append(Node("", -1, 0, _ARTICLE, 0.5, True))
    opened = _Open(nodes)
    stack = opened.stack
    at, end = 0, len(html)
    lower = None

    def text(upto: int) -> None:
        if upto > at:
            piece = html[at:upto]
            pieces.append((unescape(piece) if "&" in piece else piece, stack[-1]))

    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            text(end)
            break
        text(token.start())
        at = token.end()
        tag = (token[2] or token[5] or "").lower()
        if not tag:
            if token[0].startswith("<![CDATA["):
                pieces.append((token[0][9:].removesuffix("]]>"), stack[-1]))
            continue
        if token[1] or token[4]:
            opened.close(tag)
            if tag == "br":
                pieces.append((" ", stack[-1]))
            continue
        attributes = token[3] or token[6] or ""
        if tag in BLOCKS:
            opened.before_block()
        if tag in CLOSED_BY:
            opened.before_member(tag)
        if tag in RAW:
            if lower is None:
                lower = html.lower()
            if len(lower) != end:  # a letter whose lower case is longer
                close = re.compile(f"</{tag}", re.I).search(html, at)
                found = close.start() if close else -1
            else:
                found = lower.find(f"</{tag}", at)
            if not attributes.endswith("/"):
                at = end if found < 0 else found
            continue
        if tag in VOID:
            if tag == "br":
                pieces.append((" ", stack[-1]))
            elif tag == "hr":
                _mark(nodes, pieces, stack[-1])
            continue
        parent = nodes[stack[-1]]
        if tag == "a" and not _MARKED.search(attributes):
            attributes = ""  # links differ in their targets, which tell nothing
        name, kind, weight = _described(tag, attributes)
        if parent.kind == _OUTSIDE or kind == _ARTICLE and parent.kind == _HEADER and tag not in HEADINGS:
            kind = parent.kind
        path = xxhash.xxh64_intdigest(f"{parent.path}>{name}") if tag in BLOCKS else parent.path
        nodes.append(Node(tag, stack[-1], path, kind, weight, tag in BLOCKS))
        if tag in ("td", "th"):
            pieces.append((" ", stack[-1]))
        opened.push(len(nodes) - 1)
        if tag in BLOCKS:
            # Even an empty block parts the texts around it.
            pieces.append(("", stack[-1]))
        if attributes.endswith("/") and tag not in BLOCKS:
            opened.cut(len(stack) - 1)
    return page


def _mark(nodes: list[Node], pieces: list[tuple[str, int]], parent: int) -> None:
    """An empty block."""
    nodes.append(Node("hr", parent, nodes[parent].path, nodes[parent].kind, 0.0, True))
    pieces.append(("", len(nodes) - 1))


def _blocks(page: Page, inside: list[bool] | None) -> Iterator[tuple[str, int, int]]:
    """Text, innermost block element and link characters of each block of the article."""
    nodes = page.nodes
    owner: list[int] = []
    link: list[bool] = []
    for i, node in enumerate(nodes):
        owner.append(i if node.block else owner[node.parent])
        link.append(node.tag == "a" or node.parent >= 0 and link[node.parent])
    parts: list[str] = []
    last, linked = -1, 0
    for text, at in page.pieces:
        node = nodes[at]
        block = owner[at]
        if block != last:
            if parts and (joined := " ".join("".join(parts).split())):
                yield joined, last, linked
            parts, last, linked = [], block, 0
        if node.kind == _ARTICLE and (inside is None or inside[at]):
            parts.append(text)
            if link[at]:
                linked += len(text)
    if parts and (joined := " ".join("".join(parts).split())):
        yield joined, last, linked


def best_path(page: Page) -> int | None:
    """The path of the container that holds most of the page's text.

    A block counts its characters outside of links to its container, and half as
    much to the next one up; menus, adverts and the like count nothing.
    """
    nodes = page.nodes
    for text, at, linked in _blocks(page, None):
        value = max(0, len(text) - 3 * linked)
        holder = nodes[at].parent if nodes[at].tag in ("p", "li", "blockquote", "pre", *HEADINGS) else at
        for share in (1.0, 0.5, 0.25):
            if holder < 0:
                break
            nodes[holder].score += share * value
            holder = nodes[holder].parent
    best = max(range(len(nodes)), key=lambda i: (nodes[i].score * nodes[i].weight, -i), default=0)
    return nodes[best].path if nodes[best].score * nodes[best].weight > 0 else None


def extract(html: str | None, winners: list[int], losers: list[int] = ()) -> tuple[str, int | None]:
    """A page's article, and the path it was found by.

    The path is the page's own best one, or else the winning one that holds most
    of the page's text: if its own best is a loser, one that the host's pages
    have often and do not vote for, or if the winner holds at least FAIR of what
    the page's own holds.
    """
    if not html:
        return "", None
    page = parse(html)
    own = best_path(page)
    if own is None:
        return "", None
    text = _within(page, own)
    if not winners or own in winners:
        return text, own
    score = dict.fromkeys(winners, 0.0)
    for node in page.nodes:
        if node.block and node.path in score:
            score[node.path] += node.score * node.weight
    known = max(winners, key=lambda p: (score[p], -p))
    agreed = _within(page, known)
    fair = own in losers or len(agreed) >= FAIR * len(text)
    return (agreed, known) if agreed and fair else (text, own)


def _within(page: Page, path: int) -> str:
    """The text of the containers of a path."""
    inside: list[bool] = []
    for node in page.nodes:
        inside.append(node.block and node.path == path or node.parent >= 0 and inside[node.parent])
    return "\n".join(text for text, _, _ in _blocks(page, inside))


def _signed(path: int) -> int:
    return path - (1 << 64) if path >= 1 << 63 else path


def _host():
    return F.coalesce(F.lower(F.try_parse_url(F.col("url"), F.lit("HOST"))), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, winners and losers: container paths that at least WINNING of the host's pages have.

    Each page votes once, for a hash of the tags and classes that lead to its
    best container, digits made alike. Winners get WINNING of the votes, so
    there are 4 at most; losers hold text on so many pages, but do not win.
    Votes are counted before they are moved.
    """

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            votes, there = Counter(), Counter()
            for host, html in zip(batch["host"], batch["html"]):
                page = parse(html or "")
                best = best_path(page)
                if best is not None:
                    votes[host, best] += 1
                    there.update({(host, node.path) for node in page.nodes if node.block and node.score > 0})
            keys = list(votes | there)
            if not keys:
                continue
            yield pd.DataFrame(
                {
                    "host": [host for host, _ in keys],
                    "path": pd.array([_signed(path) for _, path in keys], "Int64"),
                    "n": pd.array([votes[key] for key in keys], "Int64"),
                    "there": pd.array([there[key] for key in keys], "Int64"),
                }
            )

    votes = (
        pages.select(_host().alias("host"), "html")
        .mapInPandas(vote, "host string, path long, n long, there long")
        .groupBy("host", "path")
        .agg(F.sum("n").alias("n"), F.sum("there").alias("there"))
    )
    votes = stored(votes, "votes")
    whole = votes.groupBy("host").agg(F.sum("n").alias("of"))
    wins = F.col("n") >= F.col("of") * WINNING
    return (
        votes.join(whole, "host")
        .filter(wins | (F.col("there") >= F.col("of") * WINNING))
        .groupBy("host")
        .agg(
            F.sort_array(F.collect_list(F.when(wins, F.col("path")))).alias("winners"),
            F.sort_array(F.collect_list(F.when(~wins, F.col("path")))).alias("losers"),
        )
    )


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars and the path hash it was found by.

    White space in a block becomes one space, blocks are joined by a line feed;
    elements that end a line in a browser are blocks, a line break or a table
    cell is white space. Headings stay, also those in a header inside the
    article. Null, empty and textless pages give an empty text. Pages without a
    valid url vote together and, like pages of a layout that few of the host's
    pages have, are read by their own best container. The time and memory that a
    page takes grow with its size, also where tags are left open. Formulas are
    text, but for their annotations. Repeated rows are pages each. Only
    page_id, url and html are read, so other columns cannot clash; an empty
    table gives an empty result.
    """
    known = stored(host_paths(pages), "host-paths")
    if known.count() <= BROADCAST_HOSTS:
        known = F.broadcast(known)

    def unsigned(paths) -> list[int]:
        return [] if paths is None else [int(p) % (1 << 64) for p in paths]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, paths = [], []
            for html, winners, losers in zip(batch["html"], batch["winners"], batch["losers"]):
                text, path = extract(html, unsigned(winners), unsigned(losers))
                texts.append(text)
                paths.append(None if path is None else _signed(path))
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                    "path": pd.array(paths, "Int64"),
                }
            )

    return (
        pages.select("page_id", "url", "html", _host().alias("host"))
        .join(known, "host", "left")
        .select(F.col("page_id").cast("long"), "url", "html", "winners", "losers")
        .mapInPandas(read, "page_id long, url string, text string, n_chars long, path long")
    )
