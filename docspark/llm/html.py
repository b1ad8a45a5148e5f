"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is a path of block elements, with the
child sequences (presentation) and the texts (content) that the host's pages show there.  The
importance of a node joins two entropies: that of its presentations over the pages, and that
of its texts, high where every page has texts of its own and low where pages repeat them.
Nodes of low importance are removed from every page of the host.

A tree can't tell a menu whose words differ on every page from content, so what the markup
itself says is a presentation's prior: menus, page headers and footers, sidebars, notices,
adverts, forms, scripts and reader comments have no importance, and what a page marks as its
article is always important.  A page with an article or a main part keeps nothing else; of the
main part, what lies outside its articles is judged by the tree.  Blocks of mere links on pages
without either have no importance.

Defined results: a null or empty page has an empty text; a page without a host is a host of
its own kind; unclosed and stray tags are read as browsers read them; repeated rows are
extracted alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# A host's tree says something from this many pages on.
MIN_PAGES = 5
LOW_IMPORTANCE = 0.35
# Weight of the content against the presentations, for each presentation of a node.
GAMMA = 0.9
# Pages of one host are dealt to this many groups.
SALTS = 32

# The elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript template title textarea svg".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre
    search section select summary table tbody td tfoot th thead tr ul""".split()
)
NOISE = frozenset(
    """head nav footer aside form button select menu dialog search audio video canvas object map fieldset
    datalist annotation annotation-xml""".split()
)
# Words of class, id and role attributes that name what is no content.
NOISE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored nav navbar
    navigation menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices
    notification popup modal overlay newsletter subscribe subscription signup login comment comments respond disqus
    discussion share sharing social related recommended recommendations widget toolbar pagination pager search form
    contentinfo complementary alert dialog skip""".split()
)
# Inside an article a class has to be such a word, or made of such words and of these.
LAYOUT_WORDS = frozenset(
    """area bar block box button buttons container content footer form header icons inline inner item items large link
    links list outer panel post posts row section slot small thread title top unit wrap wrapper zone""".split()
)
# Headings and sections get their ids from their titles.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
# Of these, the ones that make an article element no article.
NO_ARTICLE = frozenset("ad ads comment comments promo related recommended respond sponsored widget".split())
# Words with which a class says what a wrapper has beside its content, as in has-sidebar.
BESIDE = frozenset("has no with without".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "legend", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
# A start tag closes an open element of these, inside the same list or table.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z]+")
# Where elements whose content is no markup end.
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Element:
    tag: str
    path: int  # of a running hash, so that deep pages take no more room
    block: bool
    noise: bool
    landmark: str  # article, main or nothing
    link: bool
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    """Blocks (path, noise, landmark, share of links, text) and presentations by path."""

    blocks: list[tuple[int, bool, str, float, str]] = field(default_factory=list)
    styles: dict[int, set[str]] = field(default_factory=dict)


@lru_cache(50_000)
def key_of(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@dataclass(frozen=True)
class Attributes:
    words: frozenset[str]  # of class, id and role
    names: frozenset[str]  # classes and roles as they stand, and the id unless it may be a title
    role: str
    hidden: bool


@lru_cache(20_000)
def _attributes(tag: str, source: str) -> Attributes:
    words: set[str] = set()
    names: set[str] = set()
    role, hidden = "", False
    for name, value in _ATTRIBUTE.findall(source):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            words.update(_WORD.findall(value))
            if name != "id" or tag not in TITLED:
                names.update(value.split())
        if name == "role":
            role = value
        hidden |= name == "hidden" or (name == "aria-hidden" and value == "true")
        hidden |= name == "style" and bool(_HIDDEN.search(value))
        if name == "itemprop" and value == "articlebody":
            role = "article"
    return Attributes(frozenset(words), frozenset(names), role, hidden)


def _names_noise(names: frozenset[str]) -> bool:
    """Whether one of the names says nothing but what is no content, as in comment-list."""
    for name in names:
        words = set(_WORD.findall(name))
        if words & NOISE_WORDS and words <= NOISE_WORDS | LAYOUT_WORDS:
            return True
    return False


class Reader:
    """Walks the tags of one page and collects its blocks."""

    def __init__(self) -> None:
        self.page = Page()
        self.root = Element("", 0, True, False, "", False)
        self.open = [self.root]
        self.text: list[str] = []
        self.linked = 0

    def read(self, html: str) -> Page:
        at = 0
        while found := _TOKEN.search(html, at):
            self._chars(html[at : found.start()])
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:
                self._end(tag)
                continue
            source = found[3] or found[6] or ""
            if tag == "svg" and source.endswith("/"):
                continue
            self._start(tag, source)
            if tag in RAW:  # its content is neither markup nor text
                close = _RAW_ENDS[tag].search(html, at)
                end = _TOKEN.match(html, close.start()) if close else None
                at = end.end() if end else len(html)
                self._end(tag)
        self._chars(html[at:])
        while len(self.open) > 1:
            self._pop()
        self._flush()
        return self.page

    def _chars(self, text: str) -> None:
        if text:
            self.text.append(unescape(text) if "&" in text else text)
            if self.open[-1].link:
                self.linked += len(text)

    def _flush(self) -> None:
        """The text so far is a block of the element that is open now."""
        text = " ".join("".join(self.text).split())
        if text:
            top = self._block()
            share = min(1.0, self.linked / len(text))
            self.page.blocks.append((top.path, self.open[-1].noise, top.landmark, share, text))
        self.text, self.linked = [], 0

    def _block(self) -> Element:
        return next(e for e in reversed(self.open) if e.block)

    def _start(self, tag: str, source: str) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "button", "td", "th", "article", "section", "div"})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        block = tag in BLOCK
        if block:
            self._flush()
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        up = self.open[-1]
        own = _attributes(tag, source)
        words, role = own.words, own.role
        landmark = up.landmark
        if tag == "article" or role == "article":
            landmark = "article"
        elif (tag == "main" or role == "main") and not landmark:
            landmark = "main"
        noise = up.noise or tag in RAW or tag in NOISE or own.hidden
        noise |= tag == "header" and up.landmark != "article"
        if tag == "article":
            noise |= bool(words & NO_ARTICLE)
        elif up.landmark == "article":
            noise |= _names_noise(own.names)
        elif tag not in ("html", "body", "main") and not words & BESIDE:
            noise |= bool(words & NOISE_WORDS)
        noise |= "header" in words and tag != "header" and up.landmark != "article"
        path = up.path
        if block:
            path = key_of(f"{up.path}/{tag}.{'.'.join(sorted(words))}")
            above = self._block()
            if not above.children or above.children[-1] != tag:
                above.children.append(tag)
        elif noise and not up.noise:
            # Noise inside a line of text is cut out of it.
            self._hold()
        self.open.append(Element(tag, path, block, noise, landmark, up.link or tag == "a"))

    def _hold(self) -> None:
        self.held = (self.text, self.linked)
        self.text, self.linked = [], 0

    def _end(self, tag: str) -> None:
        if tag == "br" or tag == "p" and not any(e.tag == "p" for e in self.open):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                break
            # An inline end tag does not reach out of its block, nor a block's out of a cell.
            if self.open[i].block and tag not in BLOCK or self.open[i].tag in ("td", "th", "table") and tag in ("p", "li", "div"):
                return
        else:
            return
        while len(self.open) > i:
            self._pop()

    def _close(self, tags: set[str], until: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i].tag in until:
                return

    def _pop(self) -> None:
        top = self.open[-1]
        if top.block:
            self._flush()
            self.page.styles.setdefault(top.path, set()).add(" ".join(top.children))
        elif top.noise and not self.open[-2].noise:
            self.text, self.linked = self.held
        self.open.pop()


def read(html: str) -> Page:
    return Reader().read(html)


def candidates(page: Page) -> tuple[list[tuple[int, str]], list[bool]]:
    """The blocks (path, text) that the markup allows, and which of them it marks as article."""
    plain = [b for b in page.blocks if not b[1]]
    kept = [b for b in plain if b[2]] or [b for b in plain if b[3] < 0.8]
    return [(path, text) for path, _, _, _, text in kept], [b[2] == "article" for b in kept]


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Presentations and contents of each page's nodes: (host, node, value, style)."""
    for batch in batches:
        rows: list[tuple[int, int, int, bool]] = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            page = read(html.as_py() or "")
            own = key_of(host)
            for path, styles in page.styles.items():
                rows.append((own, path, key_of("|".join(sorted(styles))), True))
            for path, text in {(b[0], b[4]) for b in page.blocks}:
                rows.append((own, path, _long(text), False))
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.bool_()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "node", "value", "style"])


def _long(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _page_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, texts, certain, hosts = [], [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            blocks, sure = candidates(read(html.as_py() or ""))
            nodes.append([path for path, _ in blocks])
            texts.append([text.encode("utf-8", "replace").decode() for _, text in blocks])
            certain.append(sure)
            hosts.append(key_of(host))
        yield pa.RecordBatch.from_pydict(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "host": pa.array(hosts, pa.int64()),
                "nodes": pa.array(nodes, pa.list_(pa.int64())),
                "texts": pa.array(texts, pa.list_(pa.string())),
                "certain": pa.array(certain, pa.list_(pa.bool_())),
            }
        )


def _sited(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"), "html")


def importance(pages: DataFrame) -> DataFrame:
    """Importance of every node of every host's style tree: (host, node, pages, importance)."""
    rows = _sited(pages).mapInArrow(_tree_rows, "host long, node long, value long, style boolean")
    seen = rows.groupBy("host", "node", "value", "style").agg(F.count(F.lit(1)).alias("n"))
    nodes = seen.groupBy("host", "node").agg(
        F.sum(F.when(F.col("style"), F.col("n"))).alias("pages"),
        F.count(F.when(F.col("style"), 1)).alias("styles"),
        F.sum(F.when(F.col("style"), F.col("n") * F.log("n"))).alias("style_logs"),
        F.count(F.when(~F.col("style"), 1)).alias("texts"),
        F.sum(F.when(~F.col("style"), F.log("n"))).alias("text_logs"),
    )
    m = F.col("pages")
    presentation = (F.log(m) - F.col("style_logs") / m) / F.log(m)
    content = 1 - F.coalesce(F.col("text_logs") / F.col("texts"), F.lit(0.0)) / F.log(m)
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    value = F.when(m > 1, (1 - weight) * presentation + weight * content).otherwise(1.0)
    return nodes.select("host", "node", "pages", value.alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page (page_id, url, html), blocks joined by line breaks."""
    low = importance(pages).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LOW_IMPORTANCE))
    removed = low.groupBy("host").agg(F.collect_set("node").alias("removed"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    removed = removed.select("host", salts.alias("salt"), "removed")
    schema = "page_id long, url string, host long, nodes array<long>, texts array<string>, certain array<boolean>"
    rows = _sited(pages).mapInArrow(_page_rows, schema)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    rows = rows.join(removed, ["host", "salt"], "left")
    kept = F.filter(
        F.arrays_zip("nodes", "texts", "certain"),
        lambda b: b["certain"] | F.col("removed").isNull() | ~F.array_contains("removed", b["nodes"]),
    )
    text = F.array_join(F.transform(kept, lambda b: b["texts"]), "\n")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
