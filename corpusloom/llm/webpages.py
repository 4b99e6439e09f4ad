"""Main text of web pages through consensus paths of their hosts.

Every page is parsed leniently and its containers are scored: from the page's body the search goes down to a child container
as long as nothing is left behind but links, short labels and what is a menu, notice, advert or the like; an article or a main that
has most of the text is gone to whatever is beside it, and nothing below an article is. The path of what it ends at (tags with their
classes, digits generalised) is the page's vote. Spark counts the votes of each host, and each page is extracted again from the
first of its host's winning paths that it has.

A class or an id is a sign only. One made of nothing but words such as sidebar, footer or comments, with neutral ones such as list,
drops its element, unless that holds most of the articles, or, without one outside of it, most of the page's text that isn't linked,
with a heading or with no other text left. One that has other
words, too (with-sidebar, social-policy, page-header), drops it only where most of its text is linked, or where it is
small, has no heading and is outside any article. A page with text outside of menus and scripts is never empty: where all of it
would go by such signs, they don't count, and neither do forms, asides and footers.

Votes are counted before they are shuffled, so a host of very many pages costs one row a task. A host keeps at most
1 / SHARE paths. Winners are sent to the pages where their measured number is small, and else joined by host and salt;
either way the pages of a hot host stay in many tasks.

Defined cases: a null page is empty and has no text; a null or unreadable url belongs to the host ''; markup that never
ends is read to the end; a page without any of its host's paths, or without text there, is extracted by its own vote;
repeated rows each get their result; an empty table gives no rows; other columns are ignored; markup of any depth takes
time and memory in proportion to its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_batches, durable, octets, table

#: An article or a main with so much of its parent's text is gone to, whatever is beside it.
MOST = 0.57
#: Words from which text that stands bare in a container is more than a label.
LABEL_WORDS = 5
#: A small part of a page's text.
SMALL = 0.1
#: Paths with less than this share of a host's votes aren't tried.
SHARE = 0.1
#: Bytes of hosts and their paths up to which they are sent to all tasks; a host has at most 1 / SHARE paths.
SENT_BYTES = 8 << 20
SALTS = 32

_EVENT = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>[^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Blocks that are text however short they are.
_SOLID = _HEADINGS | {"p", "li", "blockquote", "pre", "dd", "dt", "figcaption"}
_CONTAINER = frozenset(("html", "body", "main", "article", "section", "div", "td", "center"))
#: Never text of a page.
_NEVER = frozenset((
    "script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "button", "select", "textarea", "nav", "head", "title",
    "menu", "noembed", "noframes",
))
_DROPPED = _NEVER | {"aside", "footer", "dialog"}
_DROPPED_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"))
#: Words of classes and ids, fixed values: those that tell what isn't main text, of them those of reader comments and of headers,
#: and those that tell nothing.
_SIGNS = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|menu|nav|navbar|navigation|breadcrumbs?"
    r"|sidebar|side|footer|header|masthead|comments?|disqus|repl(?:y|ies)|respond|share|sharing|social|related|recommend\w*"
    r"|newsletter|subscribe|signup|popup|modal|widgets?|pagination|pager|toolbar"
)
_COMMENTS = frozenset(("comment", "comments", "disqus", "reply", "replies", "respond"))
_NEUTRAL = frozenset((
    "", "area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "card", "cards", "col", "column", "container", "fixed", "form",
    "global", "group", "holder", "icon", "icons", "inner", "item", "items", "js", "label", "left", "link", "links", "list", "main", "message",
    "outer", "overlay", "panel", "popular", "posts", "primary", "region", "right", "row", "secondary", "section", "site", "slot", "strip", "text", "this",
    "thread", "title", "tools", "top", "unit", "us", "wrap", "wrapper", "zone",
))
#: What an open element of a kind is closed by, and the elements that hide it from that.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tr", "td", "th", "thead", "tbody"), ("table",)),
    "tfoot": (("tr", "td", "th", "thead", "tbody"), ("table",)),
}


@dataclass(slots=True)
class Container:
    """path: the number of its path in the page; label: the tag with its classes; mass: unlinked characters; solid: blocks that are more
    than labels or links; headed: whether a heading stands in it."""

    path: int
    label: str
    parent: int
    main: bool = False
    mass: int = 0
    solid: int = 0
    headed: bool = False


@dataclass(slots=True)
class Sign:
    """An element whose names tell that it may be no main text. parent: the sign around it; plain: nothing else is in its names;
    comments: reader comments; inside: in an article or a main; mass, linked: characters in it; main: those in articles in it."""

    parent: int
    plain: bool
    comments: bool
    inside: bool
    mass: int = 0
    linked: int = 0
    main: int = 0
    headed: bool = False


class Block(NamedTuple):
    """container, text; plain and linked: its characters outside and inside links; tag; sign around it; sign around its article, or -2."""

    container: int
    text: str
    plain: int
    linked: int
    tag: str
    sign: int
    home: int

    @property
    def solid(self) -> bool:
        """Whether it is more than a label or links."""
        return self.plain > 0 and (self.tag in _SOLID or len(self.text.split(" ", LABEL_WORDS)) >= LABEL_WORDS)


@dataclass
class Page:
    """Containers, parents first, blocks of text, and the level and container of the first heading of the highest level.

    Paths are numbered, and kept as (number of the parent's path, label), so that deep markup doesn't repeat them.
    """

    containers: list[Container] = field(default_factory=lambda: [Container(0, "", -1)])
    blocks: list[Block] = field(default_factory=list)
    signs: list[Sign] = field(default_factory=list)
    heading: tuple[str, int] | None = None
    paths: dict[tuple[int, str], int] = field(default_factory=dict)

    def add(self, parent: int, label: str, main: bool) -> int:
        path = self.paths.setdefault((self.containers[parent].path, label), len(self.paths) + 1)
        self.containers.append(Container(path, label, parent, main))
        return len(self.containers) - 1

    def judge(self) -> None:
        """Takes out the blocks of elements that are dropped by their names, and sums up what is left by container."""
        for b in self.blocks:
            if b.sign >= 0:
                self.signs[b.sign].mass += b.plain
                self.signs[b.sign].linked += b.linked
                self.signs[b.sign].headed |= b.tag in ("h1", "h2")
            if b.home >= 0:
                self.signs[b.home].main += b.plain
        for s in reversed(self.signs):
            if s.parent >= 0:
                up = self.signs[s.parent]
                up.mass, up.linked, up.main, up.headed = up.mass + s.mass, up.linked + s.linked, up.main + s.main, up.headed or s.headed
        total = sum(b.plain for b in self.blocks)
        articles = sum(b.plain for b in self.blocks if b.home > -2)
        rest = any(b.sign < 0 and b.solid for b in self.blocks)
        gone: list[bool] = []
        for s in self.signs:
            gone.append(s.parent >= 0 and gone[s.parent] or _goes(s, total, articles, rest))
        self.blocks = [b for b in self.blocks if b.sign < 0 or not gone[b.sign]]
        for b in self.blocks:
            at = self.containers[b.container]
            at.mass += b.plain
            at.solid += b.solid
            if b.tag in _HEADINGS and b.plain:
                at.headed = True
                if self.heading is None or b.tag < self.heading[0]:
                    self.heading = b.tag, b.container

    def path(self, at: int) -> str:
        """The path of a container as text."""
        labels = []
        while at:
            labels.append(f"/{self.containers[at].label}")
            at = self.containers[at].parent
        return "".join(reversed(labels))

    def number(self, path: str) -> int:
        """The number of a path given as text; -1 if the page has none such."""
        number = 0
        for label in path.split("/")[1:]:
            number = self.paths.get((number, label), -1)
        return number


class Stack:
    """The open elements: tag, container, whether in what is dropped, in a link, the sign around it and around its article (-2:
    it is in none); and where each tag is open."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int, bool, bool, int, int]] = [("", 0, False, False, -1, -2)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.containers: list[int] = []

    def push(self, tag: str, *rest) -> None:
        place = len(self.open)
        self.open.append((tag, *rest))
        if tag in self.places:
            self.places[tag].append(place)
        else:
            self.places[tag] = [place]
        if tag in _BLOCK:
            self.blocks.append(place)
        if tag in _CONTAINER:
            self.containers.append(place)

    def cut(self, place: int) -> None:
        """Closes all from ``place`` on."""
        while len(self.open) > place:
            tag = self.open.pop()[0]
            self.places[tag].pop()
            if tag in _BLOCK:
                self.blocks.pop()
            if tag in _CONTAINER:
                self.containers.pop()

    def last(self, tags: tuple[str, ...]) -> int:
        """The place of the innermost of ``tags``; 0 if none is open."""
        found = 0
        for tag in tags:
            places = self.places.get(tag)
            if places and places[-1] > found:
                found = places[-1]
        return found

    def holds_block(self, place: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] >= place

    def block(self) -> str:
        """The innermost block's tag."""
        return self.open[self.blocks[-1]][0] if self.blocks else ""


def _label(tag: str, names: str) -> str:
    """The tag with its classes, their digits generalised; a slash only parts labels."""
    kinds = sorted({re.sub(r"\d+", "#", x).replace("/", "|") for x in names.split()})
    return ".".join([tag, *kinds])


def _dropped(tag: str, attributes: dict[str, str], inside: bool, all_text: bool) -> bool:
    """Whether an element is no text of a page, whatever it holds."""
    if tag in (_NEVER if all_text else _DROPPED) or (tag == "header" and not inside and not all_text):
        return True
    if not attributes or all_text:
        return False
    if attributes.get("role") in _DROPPED_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return bool(re.search(r"display\s*:\s*none", attributes.get("style", "")))


@lru_cache(maxsize=10_000)
def _sign(names: str) -> tuple[bool, bool] | None:
    """(plain, comments) if the classes or the id ``names`` tell that their element may be no main text."""
    found = None
    for name in names.split():
        words = [w for w in re.split(r"[-_\d]+", name.lower()) if w]
        hits = [w for w in words if _SIGNS.fullmatch(w)]
        if hits and words[0] not in ("no", "without"):
            plain = all(w in _NEUTRAL for w in words if w not in hits) and not ("main" in words and words[-1] == "side")
            found = plain or bool(found and found[0]), (plain and not _COMMENTS.isdisjoint(hits)) or bool(found and found[1])
    return found


def _told(tag: str, attributes: dict[str, str]) -> tuple[bool, bool] | None:
    """What the tag, the classes and the id of an element tell of it, as ``_sign`` does."""
    if tag == "form" or attributes.get("role") == "form":
        return True, False
    told = [t for t in (_sign(attributes.get("class", "")), _sign(attributes.get("id", ""))) if t]
    return (any(t[0] for t in told), any(t[1] for t in told)) if told else None


def _goes(s: Sign, total: int, articles: int, rest: bool) -> bool:
    """Whether a sign drops its element, on a page with ``total`` characters outside links, so many in articles, and solid text outside
    of all signs or not."""
    if s.linked >= max(s.mass, 1):
        return True
    if not s.plain:
        return not s.inside and not s.main and not s.headed and s.mass < SMALL * total
    if articles and not s.inside:
        return s.comments or 2 * s.main < articles
    return s.comments or 2 * s.mass <= total or (rest and not s.headed)


def parse(source: str, all_text: bool = False) -> Page:
    """Containers and blocks of text of a page, without what is never main text; or, with ``all_text``, all but menus and scripts."""
    page = Page()
    stack = Stack()
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = "".join(pieces) if len(pieces) > 1 else pieces[0]
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            pieces.clear()
            if text:
                _, at, _, _, sign, home = stack.open[-1]
                page.blocks.append(Block(at, text, max(0, len(text) - linked), min(len(text), linked), stack.block(), sign, home))
        linked = 0

    def cut(place: int) -> None:
        if stack.holds_block(place):
            flush()
        stack.cut(place)

    def close(tags: tuple[str, ...], walls: tuple[str, ...]) -> None:
        place = stack.last(tags)
        if not place:
            return
        wall = stack.last(walls)
        if "table" not in walls and stack.containers:
            wall = max(wall, stack.containers[-1])
        if place >= wall:
            cut(place)

    at, n = 0, len(source)
    while at < n:
        if source[at] != "<":
            after = source.find("<", at)
            after = n if after < 0 else after
            text, tag = source[at:after], None
            at = after
        else:
            m = _EVENT.match(source, at)
            at = m.end()
            tag = m["tag"] or m["tag2"]
            text = m["cdata"] or (m[0] if m[0] == "<" else "")
        if tag is None:
            if text and not stack.open[-1][2]:
                pieces.append(text)
                if stack.open[-1][3]:
                    linked += len(text)
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            place = stack.last((tag,))
            # An inline end doesn't reach out of its container.
            if place and (tag in _BLOCK or not stack.containers or place > stack.containers[-1]):
                cut(place)
            elif tag == "p" and not place:
                flush()
            continue
        if tag == "br":
            if not stack.open[-1][2]:
                pieces.append("\n")
            continue
        rest = m["rest"] if m["tag"] else m["rest2"]
        attributes = (
            {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest and not rest.isspace() else {}
        )
        if tag in _BLOCK:
            flush()
            close(("p",), ("button", "td", "th", "table"))
            if tag in _CLOSES:
                close(*_CLOSES[tag])
        if tag in _VOID:
            continue
        _, own, drop, link, sign, home = stack.open[-1]
        main = tag in ("article", "main") or attributes.get("role") == "main"
        drop = drop or _dropped(tag, attributes, home > -2, all_text)
        if not drop and not all_text and not main and tag not in ("html", "body"):
            told = _told(tag, attributes)
            # A heading is one whatever its class, and so is what is named a header in an article.
            if told and not (tag in _HEADINGS and not told[0]):
                page.signs.append(Sign(sign, *told, home > -2))
                sign = len(page.signs) - 1
        if main:
            home = sign
        if tag in _CONTAINER and not drop:
            own = page.add(own, _label(tag, attributes.get("class", "")), main)
        stack.push(tag, own, drop, link or tag == "a", sign, home)
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            if not drop and tag == "xmp":
                pieces.append(html.escape(source[at : end.start() if end else n]))
            at = end.start() if end else n
    flush()
    page.judge()
    return page


def vote(page: Page) -> str:
    """The path of the container that the search for the main text ends at; '' is the whole page."""
    mass, solid = [c.mass for c in page.containers], [c.solid for c in page.containers]
    headed, main = [c.headed for c in page.containers], [c.main for c in page.containers]
    children: list[list[int]] = [[] for _ in mass]
    for k in range(len(mass) - 1, 0, -1):
        up = page.containers[k].parent
        mass[up] += mass[k]
        solid[up] += solid[k]
        headed[up], main[up] = headed[up] or headed[k], main[up] or main[k]
        children[up].append(k)
    title = set()  # the containers that hold the page's heading
    k = page.heading[1] if page.heading else -1
    while k >= 0:
        title.add(k)
        k = page.containers[k].parent
    at, inside = 0, False
    while children[at]:
        inside = inside or page.containers[at].main
        best = max(children[at], key=lambda k: (mass[k] * (1 + main[k]), -k))
        all_there = 0 < solid[best] == solid[at]
        if not mass[best] or not (all_there or (main[best] and mass[best] >= MOST * mass[at])):
            break
        if inside and (not main[best] or mass[best] < mass[at] or page.containers[at].label.split(".")[0] == "article"):
            break
        # A heading outside is that of the site only where an article or main below has its own.
        if at in title and best not in title and not (main[best] and headed[best]):
            break
        at = best
    return page.path(at)


def text_of(page: Page, path: str) -> str:
    """The blocks in containers with ``path``, in page order."""
    number = page.number(path)
    chosen: list[bool] = []
    for c in page.containers:
        chosen.append(c.path == number or (c.parent >= 0 and chosen[c.parent]))
    return "\n".join(b.text for b in page.blocks if chosen[b.container])


def extract(source: str, paths: list[str]) -> str:
    """The text in the first of ``paths`` that the page has text in; else in what the page itself votes for; else all there is."""
    page = parse(source)
    for path in paths:
        if text := text_of(page, path):
            return text
    return text_of(page, vote(page)) or text_of(parse(source, all_text=True), "")


def host(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths) from ``pages`` (url, html): the paths with SHARE of a host's votes or more, most votes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [vote(parse(raw.decode())) if raw else None for raw in octets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.string())], names=["host", "path"])

    bounded_batches(pages.sparkSession)
    votes = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string")
    counts = durable(votes.filter("path IS NOT NULL").groupBy("host", "path").count())
    # Totals are joined, so that the paths of a host with very many don't meet in one task.
    totals = durable(counts.groupBy("host").agg(F.sum("count").alias("total")))
    best = counts.join(totals, "host").filter(F.col("count") / F.col("total") >= SHARE)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), "path")))
    return best.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def _extracted(rows: DataFrame) -> DataFrame:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(3).to_pylist()
            texts = [extract(raw.decode(), p or []) if raw else "" for raw, p in zip(octets(batch.column(2)), paths, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema=schema)

    return rows.select("page_id", "url", "html", "paths").mapInArrow(run, "page_id bigint, url string, text string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    winners = durable(host_paths(pages))
    keyed = pages.withColumn("host", host(F.col("url")))
    size = winners.agg(F.sum(F.octet_length(F.array_join("paths", "")) + F.octet_length("host") + 64)).first()[0] or 0
    if size <= SENT_BYTES:
        joined = keyed.join(F.broadcast(winners), "host", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(winners.withColumn("salt", salts), ["host", "salt"], "left")
    return _extracted(joined).withColumn("n_chars", F.length("text").cast("bigint"))


def op8_pages_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
