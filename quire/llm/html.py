"""Main text of web pages: a suffix array over each host's pages, checked against the page's own markup.

A page is read into blocks, and the tokens of all its blocks are its stream. The streams of a host's pages
form suffix arrays, in which a substring of ``run`` tokens or more that a share of the host's distinct pages
holds is boilerplate; blocks that such substrings cover are repeated, and the unique ones stay. The check
that follows takes out what a page's tags, roles and class names call a menu, notice, advert, form, comment
list and so on, and on a page that names its article or main part keeps what is inside: a line that many
articles of a host share is theirs. Only what the markup of most pages that hold it calls something else
goes from there too.

A host may hold a third of all pages, so its pages are dealt into groups of about GROUP, each with an array of
its own. A substring that a share of all pages holds is held by that share of some group's, so the groups' arrays
find all candidates; a second reading counts each exactly over the whole host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join, tune
from .urls import host_of

#: Tokens of the shortest substring that counts as boilerplate.
RUN = 8
#: A substring is boilerplate if this share of its host's distinct pages has it, and so many pages at least.
SHARE, LEAST = 0.25, 3
#: Distinct pages of one suffix array on average, where a host has more.
GROUP = 128
#: Hosts, and keys of all hosts, that are broadcast at most; more are joined by a shuffle.
HOSTS, KEYS = 500_000, 1_000_000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content isn't markup.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Elements that are never part of an article.
DROPPED = RAW | frozenset("aside audio button canvas datalist dialog embed footer form head input menu nav noscript object option search select svg template video".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class names and ids that mark what isn't part of an article.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies"
    " copyright discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall"
    " popup promo promoted promotion recommendations recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe"
    " subscription toolbar topbar widget widgets".split()
)
REGION = ("article", "main")
#: What an open paragraph, list item and so on ends at, though it isn't closed.
_ENDS = {"li": ("li", ("ul", "ol", "menu")), "dd": ("dd", ("dl",)), "dt": ("dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("td", ("tr", "table")), "option": ("option", ("select",))}


@dataclass
class Block:
    text: str
    dropped: bool
    region: str | None  # article, main or none


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)

    def kept(self) -> list[Block]:
        """Blocks of the article, else of the main part, else all; without the dropped ones."""
        own = [b for b in self.blocks if not b.dropped]
        for r in REGION:
            if inside := [b for b in own if b.region == r]:
                return inside
        return own

    def named(self) -> bool:
        return any(b.region and not b.dropped for b in self.blocks)


def _drops(tag: str, attrs: str, region: str | None) -> bool:
    if tag in DROPPED or tag == "header" and region is None:
        return True
    if not attrs or tag in ("html", "body", *REGION) and "comment" not in attrs:
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name in ("class", "id") and (DROPPED_NAMES & {x.lower() for x in _NAME.findall(unescape(value))} or region is None and "header" in re.split(r"[^a-z]+", value.lower())):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def read_page(html: str) -> Page:
    """The blocks of a page in order. Bad markup ends where browsers end it; nothing is left out."""
    page, parts = Page(), []
    stack: list[tuple[str, bool, str | None]] = []  # tag, dropped, region
    at = 0

    def close() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            _, dropped, region = stack[-1] if stack else ("", False, None)
            page.blocks.append(Block(text, dropped, region))

    def pop(tag: str, within: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    def add(text: str) -> None:
        if text:
            parts.append(unescape(text) if "&" in text else text)

    while m := _TAG.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                close()
            if tag not in VOID:
                dropped = stack[-1][1] if stack else False
                i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
                if i >= 0:
                    if (stack[i - 1][1] if i else False) != dropped:
                        close()
                    del stack[i:]
            continue
        if tag in BLOCK:
            close()
            if tag not in ("br", "hr"):
                pop("p", ("article", "aside", "body", "button", "div", "main", "section", "td", "th"))
        if tag in _ENDS:
            pop(*_ENDS[tag])
            if tag == "dt":
                pop("dt", ("dl",))
        if tag in VOID:
            continue
        up_dropped, up_region = stack[-1][1:] if stack else (False, None)
        dropped = up_dropped or _drops(tag, m[3], up_region)
        region = up_region if up_region == "article" else tag if tag in REGION and not dropped else up_region
        if dropped != up_dropped:
            close()
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(html, at)
            at = end.end()
            continue
        if not m[3].rstrip().endswith("/") or tag in BLOCK:
            stack.append((tag, dropped, region))
    add(html[at:])
    close()
    return page


def stream(page: Page) -> np.ndarray:
    """A hash of each token of the page's blocks."""
    return np.array([xxhash.xxh32_intdigest(t) for b in page.blocks for t in b.text.split()], np.uint32)


def own_tokens(page: Page) -> np.ndarray:
    """Whether the page's markup puts each token of the stream in its article or main part."""
    kept = {id(b) for b in page.kept()} if page.named() else set()
    return np.array([id(b) in kept for b in page.blocks for _ in b.text.split()], bool)


def windows(tokens: np.ndarray, run: int = RUN) -> np.ndarray:
    """A key of each run of so many tokens."""
    n = max(0, len(tokens) - run + 1)
    key = np.zeros(n, np.uint64)
    for j in range(run):
        key = (key ^ tokens[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def all_of(flags: np.ndarray, run: int) -> np.ndarray:
    """Whether all flags of each run are set."""
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[run:] - sums[:-run] == run


def suffix_array(x: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(order, long): the suffixes of x in order, and whether each but the first shares run items or more with the one before.

    Prefixes are doubled: suffixes that are equal so far are ordered by the rank of what follows, until none are.
    """
    n = len(x)
    order = np.argsort(x, kind="stable")
    new = np.concatenate(([True], x[order][1:] != x[order][:-1]))
    rank = np.empty(n, np.int64)
    levels, h = [], 1
    while True:
        start = np.flatnonzero(new)
        rank[order] = np.repeat(start, np.diff(np.append(start, n)))
        if h <= run:
            levels.append((h, rank.copy()))
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        sub = order[tied]
        after = sub + h
        key = rank[sub] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[tied] = sub[by]
        new[tied] = np.concatenate(([True], key[by][1:] != key[by][:-1]))
        h *= 2
    # The rank by h items is equal where h items are; run is a sum of such h.
    a, b, long, left = order[:-1], order[1:], np.ones(max(0, n - 1), bool), run
    for h, r in levels[::-1]:
        while left >= h:
            inside = (a < n) & (b < n)
            long &= inside & (r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)])
            a, b, left = a + h, b + h, left - h
    return order, long


def shared_runs(streams: list[np.ndarray], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(keys, pages): the runs of so many tokens that the streams hold, and how many of the streams hold each."""
    lengths = np.array([len(t) for t in streams], np.int64)
    if not lengths.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    x = np.full(int(ends[-1]) + 1, -1, np.int64)
    x[np.setdiff1d(np.arange(len(x)), ends)] = np.concatenate(streams)
    x[ends] = -1 - np.arange(len(ends))  # no two streams end alike, so no substring goes over an end
    page = np.repeat(np.arange(len(streams)), lengths + 1)
    order, long = suffix_array(x, run)
    interval = np.cumsum(np.concatenate(([0], ~long)))
    whole = ends[page[order]] - order >= run
    order, interval = order[whole], interval[whole]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = np.unique(interval * len(streams) + page[order]) // len(streams)
    first = np.unique(interval, return_index=True)[1]
    return windows(x.view(np.uint64), run)[order[first]], np.unique(held, return_counts=True)[1]


def joined(rows: DataFrame, side: DataFrame, few: bool, counted: DataFrame | None = None) -> DataFrame:
    return rows.join(F.broadcast(side), "host") if few else salted_join(rows, side, "host", counted)


def streams_of(pages: DataFrame) -> DataFrame:
    """(host, page, tokens): the streams of pages (host, page, html). A task gives each of its distinct pages once."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            host, page, tokens = [], [], []
            for h, p, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (mark := xxhash.xxh64_intdigest(h, p % (1 << 64))) not in seen:
                    seen.add(mark)
                    host.append(h)
                    page.append(p)
                    tokens.append(stream(read_page(html)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(tokens, pa.binary())], names=["host", "page", "tokens"])

    return pages.select("host", "page", "html").mapInArrow(each, "host string, page bigint, tokens binary")


def candidates(pages: DataFrame, hosts: DataFrame, few: bool, run: int = RUN) -> DataFrame:
    """(host, keys): of runs that SHARE of a group's pages hold; hosts: (host, of), of distinct pages."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: dict[int, bytes]) -> np.ndarray:
            key, n = shared_runs([np.frombuffer(t, np.uint32) for t in held.values()], run)
            return key[n >= max(SHARE * len(held), LEAST if len(held) == of else 1)]

        def batch(host: str, key: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([host] * len(key), pa.string()), pa.array(key)], names=["host", "key"])

        at, of, held = None, 0, {}
        for b in batches:
            for h, part, n, p, t in zip(*(b.column(c).to_pylist() for c in ("host", "part", "of", "page", "tokens")), strict=True):
                if (h, part) != at:
                    if held:
                        yield batch(at[0], found(held))
                    at, of, held = (h, part), n, {}
                held[p] = t
        if held:
            yield batch(at[0], found(held))

    # Hosts of fewer pages than LEAST have no boilerplate.
    dealt = joined(streams_of(pages), hosts.where(F.col("of") >= LEAST), few, pages.select("host"))
    dealt = dealt.withColumn("part", F.expr(f"pmod(page, cast(ceil(of / {GROUP}) as bigint))"))
    grouped = dealt.repartition("host", "part").sortWithinPartitions("host", "part").mapInArrow(each, "host string, key bigint")
    return cut(grouped.groupBy("host").agg(F.array_sort(F.collect_set("key")).alias("keys")))


def _few(keys: DataFrame) -> bool:
    return (keys.agg(F.sum(F.size("keys")), F.count("*")).first()[0] or 0) <= KEYS


def repeats(pages: DataFrame, hosts: DataFrame, few: bool, run: int = RUN) -> DataFrame:
    """(host, keys, stray): the runs that SHARE of the host's distinct pages hold, LEAST at least; and those of them that
    LEAST pages hold inside their articles, but most of the pages that hold them elsewhere."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, key, page, inside = [], [], [], []
            for h, p, html, asked in zip(*(b.column(c).to_pylist() for c in ("host", "page", "html", "keys")), strict=True):
                read = read_page(html)
                mine = windows(stream(read), run)
                hit = np.isin(mine, np.array(asked, np.int64))
                own = all_of(own_tokens(read), run)[hit] if hit.any() else hit[:0]
                for k in (found := np.unique(mine[hit])).tolist():
                    key.append(k)
                host += [h] * len(found)
                page += [p] * len(found)
                inside += np.isin(found, mine[hit][own]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(key, pa.int64()), pa.array(page, pa.int64()), pa.array(inside, pa.bool_())], names=["host", "key", "page", "inside"])

    asked = candidates(pages, hosts, few, run)
    found = joined(pages.select("host", "page", "html"), asked, _few(asked), pages.select("host")).mapInArrow(each, "host string, key bigint, page bigint, inside boolean")
    held = found.groupBy("host", "key", "page").agg(F.max("inside").alias("inside")).groupBy("host", "key").agg(F.count("*").alias("n"), F.count_if("inside").alias("own"))
    shared = joined(cut(held), hosts, few).where((F.col("n") >= SHARE * F.col("of")) & (F.col("n") >= LEAST))
    stray = (F.col("own") >= LEAST) & (2 * F.col("own") < F.col("n"))
    return cut(shared.groupBy("host").agg(F.array_sort(F.collect_set("key")).alias("keys"), F.array_sort(F.collect_set(F.when(stray, F.col("key")))).alias("stray")))


def covered(page: Page, keys: list[int], run: int = RUN) -> list[bool]:
    """Whether the runs with these keys cover the whole of each block."""
    hit = np.isin(windows(stream(page), run), np.array(keys, np.int64))
    ends = np.cumsum([len(b.text.split()) for b in page.blocks])
    over = np.zeros((int(ends[-1]) if len(ends) else 0) + run + 1, np.int64)
    over[np.flatnonzero(hit)] += 1
    over[np.flatnonzero(hit) + run] -= 1
    bare = np.concatenate(([0], np.cumsum(np.cumsum(over) <= 0)))
    return [bool(bare[e] == bare[s]) for s, e in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def main_text(html: str, keys: list[int] | None = None, stray: list[int] | None = None, run: int = RUN) -> str:
    """keys, stray: of the page's host, as of repeats(). What would be left empty by them stays."""
    page = read_page(html)
    if keys and (not page.named() or stray):
        gone = {id(b) for b, c in zip(page.blocks, covered(page, stray if page.named() else keys, run), strict=True) if c}
        own = page.kept() if page.named() else [b for b in page.blocks if not b.dropped]
        return " ".join([b.text for b in own if id(b) not in gone] or [b.text for b in page.kept()])
    return " ".join(b.text for b in page.kept())


def extracted(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of pages (page_id, url, html).

    A null html is empty, and an empty page has an empty text. A null url has the empty host. Copies of a
    page aren't distinct pages, so they don't make each other boilerplate; repeated rows get one text. An
    empty table gives no rows.
    """
    tune(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.xxhash64(html).alias("page"), html.alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    hosts = cut(rows.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of")))
    few = hosts.limit(HOSTS + 1).count() <= HOSTS
    shared = repeats(rows, hosts, few, run)
    small = _few(shared)
    side = shared if small else hosts.select("host").join(shared, "host", "left")
    judged = rows.join(F.broadcast(side), "host", "left") if small else joined(rows, side, small, rows.select("host"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h, k, s, run) for h, k, s in zip(*(b.column(c).to_pylist() for c in ("html", "keys", "stray")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return judged.select("page_id", "url", "html", "keys", "stray").mapInArrow(each, f"page_id {kind}, url string, text string, n_chars bigint")
