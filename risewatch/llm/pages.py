"""Main text of web pages with site template removal.

Pass 1 parses each page (in tasks) and hashes the subtree of every element that holds text, whatever it is. Spark counts in
how many pages of a host a subtree occurs, and with how many different rests: the other kept text of the innermost article
or main element around it, or of the page. Subtrees that recur across many pages with many rests are the host's template;
inside an article they must also stand on half of the host's pages, as articles quote each other. Pass 2 deletes the
template, and what is by its nature no main text (menus, forms, adverts, comments, ...), and joins the remaining blocks. An
article that a site shows on many pages stays whole: within it the rest of each part is the same on all of them, and what
holds an article or main element counts only on pages whose rest is longer (a teaser).

What is no main text by nature is told by tags, roles, and names: a class or id counts if all its words are such names
("cookie-notice", "site-header"), so "no-sidebar" or "article-header" say nothing. If names would leave a page without any
text, they are not followed on that page.

Between the passes the blocks are stored compressed, without markup, in buckets: pass 2 reads them where they lie, and only
hashes are shuffled to them. A host's pages are never gathered. A page takes time and
memory in proportion to its length, however it nests or whatever it leaves open.

Defined cases: null or empty html gives empty text; broken markup is closed as browsers do for paragraphs and list items,
otherwise at the enclosing end; quotes count after an equals sign only; a tag that never ends takes the rest of the page; a
page without host has the host ""; repeated page ids stay separate rows; equal pages give equal texts; other columns play
no part.
"""

from __future__ import annotations

import html as references
import itertools
import json
import re

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risewatch.llm.langid import host_of
from risewatch.llm.shared import map_batches, settle, settle_by, with_row

#: A subtree is template if it is in at least this many pages of the host with as many rests; within articles in this share too.
MIN_PAGES, MIN_SHARE = 5, 0.5
#: Parsed pages lie in so many buckets of their row number.
BUCKETS = 32

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
#: The rest of a tag: a quoted value only after an equals sign. Nothing is tried twice.
_REST = re.compile(r"((?>=\s*(?>\"[^\"]*\"|'[^']*')|[^>])*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_CLOSES_P = _BLOCK - frozenset("td th tr tbody thead tfoot caption li dd dt body html summary figcaption".split()) | {"p"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A sibling is looked for up to the element that holds such items.
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Elements, roles and words of classes and ids that are no main text.
_NO_TEXT = frozenset("head nav aside footer form script style noscript template iframe svg math canvas object audio video button select textarea input dialog menu".split())
_NO_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NO_WORD = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead topbar comment comments commentlist disqus respond replies reply share sharing social related recommended pagination pager toolbar skip widget".split()
)
#: Words that may stand beside them in a name.
_PLAIN_WORD = frozenset("site global main left right top bottom box boxes list bar section area wrapper wrap container inner outer block links link items item panel buttons button icons posts stories articles slot unit reader user".split())


class _Node:
    __slots__ = ("blocks", "content", "digest", "hidden", "holds", "named", "number", "parent", "parts", "scope", "tag")

    def __init__(self, tag: str, parent: _Node | None, hidden: bool = False, named: bool = False, content: bool = False, scope: _Node | None = None) -> None:
        self.tag, self.parent, self.hidden, self.named, self.content, self.parts = tag, parent, hidden, named, content, xxhash.xxh64(tag)
        #: the innermost article or main element around this one (or the page); whether this one is or holds such an element
        self.scope, self.holds, self.digest = scope, False, 0
        #: numbers of the first block inside and of the first after it; number among the elements over kept blocks
        self.blocks, self.number = (0, 0), -1


def _is_name(value: str) -> bool:
    """Whether one of these names says that an element is no main text."""
    for name in value.lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if any(w in _NO_WORD for w in words) and all(w in _NO_WORD or w in _PLAIN_WORD for w in words):
            return True
    return False


def _kind(tag: str, attributes: str, in_content: bool) -> tuple[bool, bool]:
    """Whether an element is hidden or no main text by tag or role, and whether by name."""
    hidden, named = tag in _NO_TEXT or tag == "header" and not in_content, False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in _NO_ROLE:
            hidden = True
        elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            named |= _is_name(value)
        elif name in ("class", "id") and tag == "article":
            named |= not {"comment", "comments", "reply"}.isdisjoint(re.split(r"[^a-z]+", value.lower()))
    return hidden, named


class Page:
    """A parsed page.

    blocks: (text, number of the element around it) in page order, of text that tags and roles leave. elements: (number of
    the parent or -1, hash, whether a name says it is no main text) of the elements over them, parents first. subtrees:
    hash -> (rest, inside an article, over blocks) of all elements with text that can be template. rest: a hash of the other
    blocks in the innermost article or main element around it, or in the page.
    """

    def __init__(self, page: str | None) -> None:
        page = page or ""
        self.top = _Node("", None)
        self.stack, self.open, self.closed = [self.top], {}, []
        self.found: list[tuple[str, _Node]] = []
        self.held: list[str] = []
        self._read(page)
        self._close(1)
        self._flush()
        self.top.blocks = (0, len(self.found))
        self._number()
        self._weigh()

    def _flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held.clear()
            if text:
                self.found.append((text, self.stack[-1]))

    def _close(self, to: int) -> None:
        while len(self.stack) > to:
            if self.stack[-1].tag in _BLOCK:
                self._flush()
            node = self.stack.pop()
            self.open[node.tag].pop()
            node.digest = node.parts.intdigest() - (1 << 63)
            node.parts = None
            node.parent.parts.update(node.digest.to_bytes(8, "little", signed=True))
            node.parent.holds |= node.holds
            node.blocks = (node.blocks[0], len(self.found))
            self.closed.append(node)

    def _text(self, part: str) -> None:
        if part:
            self.stack[-1].parts.update(part)
            if not self.stack[-1].hidden:
                self.held.append(references.unescape(part))

    def _last(self, tags) -> int:
        """Depth of the innermost open element with one of these tags, 0 if there is none."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            start = page.find("<", at)
            if start < 0:
                self._text(page[at:])
                return
            self._text(page[at:start])
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                at = stop + 3 if stop >= 0 else end
                continue
            if page[start + 1 : start + 2] in ("!", "?"):
                stop = page.find(">", start)
                at = stop + 1 if stop >= 0 else end
                continue
            tag = _TAG.match(page, start)
            if not tag:
                self._text("<")
                at = start + 1
                continue
            rest = _REST.match(page, tag.end())
            if not rest:
                return
            at, name = rest.end(), tag[2].lower()
            if tag[1]:
                if name in _BLOCK:
                    self._flush()
                if self.open.get(name):
                    self._close(self.open[name][-1])
            else:
                at = self._element(name, rest[1], page, at)

    def _element(self, name: str, attributes: str, page: str, at: int) -> int:
        """Opens an element; returns where to read on."""
        if name in _CLOSES_P and (depth := self._last(["p"])) > self._last(["table", "button", "object"]):
            self._close(depth)
        if name in _SIBLINGS and (depth := self._last(_SIBLINGS[name])) > self._last(_SCOPE[name]):
            self._close(depth)
        if name in _BLOCK:
            self._flush()
        top = self.stack[-1]
        if name in _VOID or attributes.rstrip().endswith("/") and name not in _BLOCK:
            top.parts.update(f"<{name}>")
            if name == "br" and not top.hidden:
                self.held.append(" ")
            return at
        hidden, named = _kind(name, attributes, top.content)
        whole = name in ("article", "main")
        scope = top if top is self.top or top.tag in ("article", "main") and not top.hidden else top.scope
        node = _Node(name, top, top.hidden or hidden, top.named or named, top.content or whole and not top.hidden, scope)
        node.holds = whole and not node.hidden
        node.blocks = (len(self.found), 0)
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append(node)
        if name in _RAW:
            stop = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
            node.parts.update(page[at : stop.start() if stop else len(page)])
            at = stop.end() if stop else len(page)
            self._close(len(self.stack) - 1)
        return at

    def _number(self) -> None:
        """Elements over blocks, parents before what they hold."""
        self.blocks, self.elements = [], []
        for text, node in self.found:
            chain = []
            while node is not self.top and node.number < 0:
                chain.append(node)
                node = node.parent
            for node in reversed(chain):
                node.number = len(self.elements)
                self.elements.append([node.parent.number, node.digest, node.named])
            self.blocks.append((text, chain[0].number if chain else node.number))

    def _weigh(self) -> None:
        sums = [0, *itertools.accumulate(0 if x.named else xxhash.xxh64_intdigest(t) for t, x in self.found)]
        lengths = [0, *itertools.accumulate(0 if x.named else len(t) for t, x in self.found)]
        self.subtrees: dict[int, tuple[int, bool, bool]] = {}
        counted = set()
        for node in self.closed:
            (a, b), (first, last) = node.blocks, node.scope.blocks
            if node.tag in ("html", "body", "head") or node.tag in _RAW or a == b and not node.hidden:
                continue
            if not node.holds or lengths[last] - lengths[first] > 2 * (lengths[b] - lengths[a]):
                rest = ((sums[last] - sums[first] - sums[b] + sums[a]) & (1 << 64) - 1) - (1 << 63)
                before = self.subtrees.get(node.digest, (rest, False, False))
                self.subtrees[node.digest] = (before[0], before[1] or node.scope is not self.top, before[2] or a < b)
                counted.add(node.number)
        for number, element in enumerate(self.elements):
            if number not in counted:
                element[1] = None


def left(blocks: list, elements: list, gone: set) -> str:
    """The blocks that are under no element whose hash is in gone, nor under one whose name tells; names unless nothing is left."""
    away = []
    for parent, digest, _ in elements:
        away.append(parent >= 0 and away[parent] or digest is not None and digest in gone)
    kept = [(text, number) for text, number in blocks if number < 0 or not away[number]]
    told = [text for text, number in kept if number < 0 or not elements[number][2]]
    return "\n\n".join(told or [text for text, _ in kept])


def _parse_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    pack = zstandard.ZstdCompressor(level=3).compress
    subtrees, packed = [], []
    for html in batch.column(4).to_pylist():
        page = Page(html)
        subtrees.append([{"hash": h, "rest": rest, "inside": inside, "over": over} for h, (rest, inside, over) in sorted(page.subtrees.items())])
        packed.append(pack(json.dumps([page.blocks, page.elements]).encode()))
    kind = pa.list_(pa.struct({"hash": pa.int64(), "rest": pa.int64(), "inside": pa.bool_(), "over": pa.bool_()}))
    return pa.record_batch([*batch.columns[:4], pa.array(subtrees, kind), pa.array(packed, pa.binary())], names=["row", "page_id", "url", "host", "subtrees", "packed"])


def _text_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    unpack = zstandard.ZstdDecompressor().decompress
    pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
    texts = [left(*json.loads(unpack(packed)), set(removed or ())) for packed, removed in pairs]
    return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def recurring(parsed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """row, hash, over: the subtrees that recur across the pages of a host with different rests; parsed has row, host, subtrees (distinct per page)."""
    sizes = parsed.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = parsed.select("host", F.explode("subtrees").alias("x")).groupBy("host", "x.hash")
    counts = counts.agg(F.count("*").alias("pages"), F.bool_or("x.inside").alias("inside")).where(F.col("pages") >= min_pages)
    enough = ~F.col("inside") | (F.col("pages") >= F.col("host_pages") * min_share)
    often = settle(counts.join(sizes, "host").where(enough).select("host", "hash"))
    each = parsed.select("row", "host", F.explode("subtrees").alias("x")).select("row", "host", "x.hash", "x.rest", "x.over")
    found = settle(each.join(often, ["host", "hash"], "left_semi"))
    template = found.select("host", "hash", "rest").distinct().groupBy("host", "hash").agg(F.count("*").alias("rests")).where(F.col("rests") >= min_pages)
    return found.join(settle(template.select("host", "hash")), ["host", "hash"], "left_semi").select("row", "hash", "over")


def parsed_pages(pages: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """row, page_id, url, host, subtrees, packed of every page, stored in buckets of row."""
    rows = with_row(pages.select(F.col("page_id"), F.col("url"), host_of(F.col("url")).alias("host"), F.col("html"))).select("row", "page_id", "url", "host", "html")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:4])
    parsed = map_batches(rows, _parse_batch, f"{kinds}, subtrees array<struct<hash:long,rest:long,inside:boolean,over:boolean>>, packed binary")
    return settle_by(parsed, "row", buckets)


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    parsed = parsed_pages(pages)
    # pages meet only what is to go from text that would be kept
    on_page = recurring(parsed, min_pages, min_share).where("over")
    removed = settle(on_page.groupBy("row").agg(F.collect_list("hash").alias("removed")))  # at most a page's own subtrees
    # the hashes of a bucket's pages are hashed in memory and its blocks stream past: they are neither shuffled nor sorted
    joined = parsed.select("row", "page_id", "url", "packed").join(removed.hint("shuffle_hash"), "row", "left")
    joined = joined.select("page_id", "url", "packed", "removed")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields[:2])
    return map_batches(joined, _text_batch, f"{kinds}, text string, n_chars long")
