"""Main text of web pages: site template removal.

A first pass reads every page into its blocks of text and its element
subtrees, each with a hash of all it holds. Counted are the subtrees that can
be template as a whole: containers with text (``nav``, ``footer``, ``div``, ``section``,
``ul``, ``table`` and so on), and bare text beside other blocks outside ``article`` and
``main``. Those elements themselves, single paragraphs, headings, list items and
table cells are never counted, nor, inside ``article`` and ``main``, a container
around a single block: an article's lines may well recur. Spark counts in how
many different surroundings on a host each subtree occurs; those found in many
are the site's template, and a second pass deletes what lies in them.

The surroundings of a subtree are the longest block of its page outside it, in
``article`` or ``main`` if there is one. A container of a copied article recurs
with the rest of the article around it, so it counts once, as equal pages
do; inside ``article`` and ``main``, surroundings that differ in digits only are the same.

As an addition to the counts, for what does not recur, what a page declares as no article text
(menus, headers, footers, asides, forms, parts named or labelled as adverts,
notices, comments and so on) is left out too, and a page with an ``article`` or
``main`` element is only read inside it. Names say nothing about ``html``,
``body``, ``main`` and ``article`` or about an element with more than half of
the page's text, and a page with less than a fifth of its text in ``article``
and ``main`` is read whole. ``declared=False`` leaves all to the counts. A page that keeps no
block in a counted subtree has its text after the first pass and does not wait for the verdict.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import map_texts, with_fields, written

#: Element names by what they mean for the text.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                    "strike strong sub sup time tt u var wbr img br".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
_NO_TEXT = frozenset("head script style title noscript template select option textarea input iframe svg canvas audio video object".split())
_ASIDE = frozenset("nav footer aside form button menu dialog".split())
_CONTENT = frozenset(("article", "main"))
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt tr figcaption".split())
#: Never counted by themselves.
_PARTS = _PROSE | frozenset("html body head article main td th thead tbody tfoot caption".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key closes an open element of the named kinds, up to one of the bounds.
_CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
           "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
           "option": (("option",), ("select",))}
#: Words in class or id, and roles, of parts that are no article text.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu submenu "
    "sidebar sidenav aside footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing comment comments disqus reply replies respond breadcrumb breadcrumbs related recommended recommendations pagination "
    "pager widget toolbar skip copyright disclaimer masthead".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_TELLS = re.compile(r"\b(?:class|id|role|hidden|style)\b", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_DIGITS = re.compile("[0-9]+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Elements whose names say nothing about their text.
_WHOLE = frozenset("html body main article".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _declared(attributes: str) -> tuple[bool, bool, bool]:
    """Whether attributes say that an element is no article text by role or hiding; whether by name;
    whether they name it a header."""
    aside = named = header = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name in ("class", "id"):
            words = [w.lower() for w in _WORDS.findall(value)]
            named |= not _NAMES.isdisjoint(words)
            header |= "header" in words
        elif name == "role":
            aside |= value.lower() in _ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            aside = True
        elif name == "style":
            aside |= bool(_HIDDEN.search(value))
    return aside, named, header


class _Element:
    __slots__ = ("tag", "node", "hash", "drop", "aside", "named", "content", "header")

    def __init__(self, tag, node, drop, aside, named, content, header):
        self.tag, self.node, self.drop, self.aside = tag, node, drop, aside
        self.named, self.content, self.header = named, content, header
        self.hash = xxhash.xxh3_64(tag)


class Page:
    """A page's kept blocks (``texts``), its subtrees (``parent``, ``hashes``, ``countable``, in page order,
    parents first), each kept block's subtree (``at``), (hash, surroundings) of the subtrees that are
    counted (``counted``): those that hold a block, and the hashes of those that hold a kept one (``open``)."""

    def __init__(self, source: str, declared: bool = True):
        self.parent: list[int] = []
        self.hashes: list[int] = []
        self.countable: list[bool] = []
        self._inside: list[bool] = []                 # in article or main
        self._bare: set[int] = set()
        self.blocks: list[tuple[list, int, bool, bool]] = []
        self._named: list[tuple[int, bool]] = []       # elements left out by name: the one around, whether headings stay
        self._open: list[_Element] = [_Element("", -1, False, False, -1, False, False)]
        self._count: dict[str, int] = {}
        self._text: list[tuple[str, int, bool]] = []
        self._container = False
        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            if not m:
                self._say(source[at:])
                break
            self._say(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag = name.lower()
            if m[1] or m[4]:
                self._close(tag)
                continue
            attributes = m[3] or m[6] or ""
            self._start(tag, attributes)
            if tag in _RAW:
                stop = re.compile(f"</{tag}", re.I).search(source, at)
                self._open[-1].hash.update(source[at:stop.start() if stop else end])
                at = stop.start() if stop else end
        self._break()
        while len(self._open) > 1:
            self._pop()
        everything = self._blocks()
        keep = [(kept, node, content) for _, kept, node, content in everything if kept]
        if not declared:
            keep = [(whole, node, content) for whole, _, node, content in everything]
        elif self._container:
            inside = [b for b in keep if b[2]]
            if 5 * sum(len(b[0]) for b in inside) >= sum(len(b[0]) for b in keep):
                keep = inside
        self.texts, self.at = [b[0] for b in keep], [b[1] for b in keep]
        self.counted = self._counted([(whole, node, content) for whole, _, node, content in everything])
        self.open = sorted({self.hashes[i] for i in self._around(self.at) if self.countable[i]})

    def _blocks(self) -> list[tuple[str, str, int, bool]]:
        """(text, text without what is declared to be none of the article's, subtree, whether in article or main) of the blocks."""
        size, total = [0] * len(self._named), 0
        for parts, *_ in self.blocks:
            for text, i, aside in parts:
                n = 0 if aside else len("".join(text.split()))
                total += n
                if i >= 0:
                    size[i] += n
        for i in range(len(size) - 1, -1, -1):
            if self._named[i][0] >= 0:
                size[self._named[i][0]] += size[i]
        out, gone = [], []                             # gone: whether an element's text, its headings too, goes
        for (up, stay), n in zip(self._named, size):
            small = 2 * n <= total
            above = gone[up] if up >= 0 else (False, False)
            gone.append((above[0] or small, above[1] or (small and not stay)))
        clean = lambda parts: " ".join(html.unescape("".join(parts)).split())
        held = [0] * len(self.parent)                  # a subtree's blocks
        for parts, node, content, heading in self.blocks:
            whole = clean(t for t, _, _ in parts)
            if whole:
                if node in self._bare:
                    self.hashes[node] = xxhash.xxh3_64_intdigest("#" + whole) - (1 << 63)
                if any(aside or i >= 0 for _, i, aside in parts):
                    kept = clean(t for t, i, aside in parts if not aside and (i < 0 or not gone[i][heading]))
                else:
                    kept = whole
                out.append((whole, kept, node, content))
                if node >= 0:
                    held[node] += 1
        for i in range(len(held) - 1, -1, -1):
            if self.parent[i] >= 0:
                held[self.parent[i]] += held[i]
            if self._inside[i] and held[i] < 2:
                self.countable[i] = False
        return out

    def _around(self, nodes: list[int]) -> set[int]:
        """The subtrees that hold one of ``nodes``, themselves included."""
        holds: set[int] = set()
        for i in nodes:
            while i >= 0 and i not in holds:
                holds.add(i)
                i = self.parent[i]
        return holds

    def _counted(self, blocks: list[tuple[str, int, bool]]) -> list[tuple[int, int]]:
        end = list(range(1, len(self.parent) + 1))     # a subtree's nodes are those from its own to before its end
        for i in range(len(self.parent) - 1, -1, -1):
            if self.parent[i] >= 0:
                end[self.parent[i]] = max(end[self.parent[i]], end[i])
        order = sorted(blocks, key=lambda b: (not b[2], -len(b[0]), b[0]))
        out, first, k = set(), {}, 0                   # first: the first block in order outside, of what holds the very first
        i = order[0][1] if order else -1
        while i >= 0:
            while k < len(order) and i <= order[k][1] < end[i]:
                k += 1
            first[i], i = k, self.parent[i]
        for i in self._around([b[1] for b in blocks]):
            if self.countable[i]:
                k = first.get(i, 0)
                around = order[k][0] if k < len(order) else ""
                if self._inside[i]:
                    around = _DIGITS.sub("0", around)
                out.add((self.hashes[i], xxhash.xxh3_64_intdigest(around) - (1 << 63)))
        return sorted(out)

    def _say(self, text: str) -> None:
        if text:
            top = self._open[-1]
            top.hash.update(text)
            if not top.drop:
                self._text.append((text, top.named, top.aside))

    def _break(self) -> None:
        """The end of a block."""
        if self._text:
            parts, self._text = self._text, []
            if any(not t.isspace() for t, _, _ in parts):
                top = next(e for e in reversed(self._open) if e.tag not in _INLINE)
                heading = top.tag in _HEADING
                if top.header and not heading:         # of an article's header only the headings stay
                    parts = [(t, i, True) for t, i, _ in parts]
                node = top.node
                if top.tag not in _PROSE:              # bare text, a subtree of its own
                    node = self._node(top.node, not top.content, top.content)
                    self._bare.add(node)
                self.blocks.append((parts, node, top.content, heading))

    def _node(self, parent: int, countable: bool, inside: bool) -> int:
        self.parent.append(parent)
        self.hashes.append(0)
        self.countable.append(countable)
        self._inside.append(inside)
        return len(self.parent) - 1

    def _start(self, tag: str, attributes: str) -> None:
        inline = tag in _INLINE
        if not inline:
            self._break()
            if self._count.get("p"):
                self._until(("p",), ("article", "section", "div", "td", "button", "table"))
        if tag in _CLOSES:
            self._until(*_CLOSES[tag])
        if tag == "br":
            self._text.append((" ", self._open[-1].named, self._open[-1].aside))
        if tag in _VOID:
            self._open[-1].hash.update(tag)
            return
        top = self._open[-1]
        aside, named, headed = _declared(attributes) if attributes and _TELLS.search(attributes) else (False, False, False)
        if tag in _WHOLE:
            aside, named, headed = aside and tag in _CONTENT, False, False
        header = top.header or (tag == "header" and top.content)
        aside = top.aside or tag in _ASIDE or aside or (tag == "header" and not top.content)
        within = top.named
        if named or (headed and tag != "header" and tag not in _HEADING):
            within = len(self._named)
            self._named.append((top.named, not named and top.content))
        content = top.content or (tag in _CONTENT and not aside)
        self._container |= content
        node = top.node
        if not inline:
            node = self._node(top.node, tag not in _PARTS, top.content)
        self._open.append(_Element(tag, node, top.drop or tag in _NO_TEXT, aside, within, content, header))
        self._count[tag] = self._count.get(tag, 0) + 1

    def _pop(self) -> None:
        e = self._open.pop()
        self._count[e.tag] -= 1
        digest = e.hash.intdigest()
        if e.tag not in _INLINE:
            self.hashes[e.node] = digest - (1 << 63)
        self._open[-1].hash.update(digest.to_bytes(8, "little"))

    def _until(self, tags: tuple, bounds: tuple) -> None:
        """Closes the nearest open element of ``tags`` unless one of ``bounds`` is nearer."""
        for i in range(len(self._open) - 1, 0, -1):
            tag = self._open[i].tag
            if tag in tags:
                self._break()
                while len(self._open) > i:
                    self._pop()
                return
            if tag in bounds:
                return

    def _close(self, tag: str) -> None:
        inline = tag in _INLINE
        if not inline:
            self._break()
        if not self._count.get(tag):
            return
        for i in range(len(self._open) - 1, 0, -1):
            e = self._open[i]
            if e.tag == tag:
                while len(self._open) > i:
                    self._pop()
                return
            if inline and e.tag not in _INLINE:
                return                                # an inline end tag doesn't end the blocks in between


_PARSED = "counted array<struct<hash:long,around:long>>, open array<long>, text string, page binary"
_COUNTED = pa.list_(pa.struct([("hash", pa.int64()), ("around", pa.int64())]))


def parse(df: DataFrame, declared: bool = True) -> DataFrame:
    """(row struct, the counted subtrees, the open ones, and the text or, if some are open, the packed blocks and
    subtrees of a :class:`Page`) of every row (row, text)."""
    def pack(p: Page) -> bytes:
        return zlib.compress(pickle.dumps((p.parent, p.hashes, p.countable, p.texts, p.at)), 3)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pages = [Page(t or "", declared) for t in batch.column("text").to_pylist()]
        counted = pa.array([[{"hash": h, "around": a} for h, a in p.counted] for p in pages], _COUNTED)
        own = [counted, pa.array([p.open for p in pages], pa.list_(pa.int64())),
               pa.array([None if p.open else "\n".join(p.texts) for p in pages], pa.string()),
               pa.array([pack(p) if p.open else None for p in pages], pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column("row"), *own], ["row", "counted", "open", "text", "page"])

    return map_texts(df, run, with_fields(df.schema["row"], _PARSED))


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_pages: int = 5, declared: bool = True) -> DataFrame:
    """(id, url, text) of every row of ``df``. A subtree is template if it occurs in at least ``min_pages``
    different surroundings on its host, however many pages the host has. With ``declared`` what pages declare
    to be no article text goes too.

    A null or empty page, or one without article text, gives an empty text; pages without a url (or
    with one that names no host) count as one host; a null id or url stays null; repeated rows are returned as
    often as they come, and equal pages count once; an empty table gives an empty result; other columns are not read."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    src = df.select(F.struct(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
                             F.col(f"`{url_col}`").alias("url"), host.alias("host")).alias("row"),
                    F.col(f"`{html_col}`").cast("string").alias("text"))
    pages = written(parse(src, declared).select("row.*", "counted", "open", "text", "page"), "pages")

    trees = pages.select("host", F.explode("counted").alias("c")).select("host", "c.*")
    seen = trees.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    template = written(seen.where(F.col("n") >= min_pages).select("host", "hash"), "template")
    waits = pages.where(F.col("page").isNotNull())
    marked = (waits.select("rid", "host", F.explode("open").alias("hash")).join(template, ["host", "hash"])
              .groupBy("rid").agg(F.collect_set("hash").alias("template")))

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for page, found in zip(batch.column("page").to_pylist(), batch.column("template").to_pylist()):
            parent, hashes, countable, texts, at = pickle.loads(zlib.decompress(page))
            if found:
                found, gone = set(found), []
                for up, h, c in zip(parent, hashes, countable):
                    gone.append((up >= 0 and gone[up]) or (c and h in found))
                texts = [t for t, i in zip(texts, at) if i < 0 or not gone[i]]
            out.append("\n".join(texts))
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, pa.string())], ["id", "url", "text"])

    joined = waits.select("rid", "id", "url", "page").join(marked, "rid", "left").drop("rid")
    cleaned = map_texts(joined, clean, StructType([joined.schema["id"], joined.schema["url"], *StructType.fromDDL("text string")]))
    return pages.where(F.col("page").isNull()).select("id", "url", "text").unionByName(cleaned)
