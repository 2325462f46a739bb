"""Main text of web pages: page structure, and what repeats across the pages of a host.

A page becomes blocks of text. What stands in menus, headers, footers, sidebars, notices, adverts, forms, comments and the
like is not kept, scripts, styles and markup never are. All blocks also form one token stream a page; a suffix array over
the streams of a host shows which long runs of tokens stand on a good part of its distinct pages, and a block that such
runs cover, or that stands on as many pages as a whole, is boilerplate, however it is marked up and inside of articles too.
A mark of an article asks for more pages, no more.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare
from sensorloom.llm.tokens import constants, grams, mix, ramp, words
from sensorloom.session import written

#: Tokens of a long run, part of a block's tokens that runs must cover.
RUN, COVER = 8, 0.8
#: Part of the distinct pages of a host that must hold a run or block, how many at least, and how many inside an article.
SHARE, PAGES, ARTICLE_PAGES = 0.5, 3, 6
#: Pages of a host whose streams are sorted in one suffix array; larger hosts are cut into shards.
SHARD_PAGES = 2_000
#: Hosts of more than one shard that are sent to all tasks (about 50 bytes each).
HOSTS_SENT = 500_000

# Elements without text, elements that end a line of text, elements and names of page furniture.
SILENT = frozenset("script style noscript template iframe svg math object head title select option button textarea canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = frozenset("nav header footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header "
    "masthead footer sidebar aside widget related recommended share sharing social cookie cookies consent gdpr notice notification alert "
    "popup modal overlay newsletter subscribe subscription signup login search comment comments reply replies respond disqus discussion "
    "pagination pager toolbar copyright legal skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
MAIN_NAMES = frozenset("article main content post entry story".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in SILENT}
_SPLIT = re.compile(r"[^a-z]+")
# what an opening tag closes by itself
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_ENDS |= {name: {"p"} for name in BLOCKS - {"br", "p", "li", "dt", "dd", "tr", "td", "th", "html", "body"}}


@dataclass
class Block:
    text: str
    article: bool
    furniture: bool


def blocks(source: str) -> list[Block]:
    """Blocks of visible text in page order, white space as single spaces, character references decoded once.

    An element is an article by its name, ``main`` or a name in MAIN_NAMES of its class or id; of nested ones inside
    furniture (a comment's article) none counts. Missing end tags are closed by what follows them. Text cut off inside
    a tag or comment is left out.
    """
    out: list[Block] = []
    open_: list[tuple[str, bool, bool]] = []
    piece: list[str] = []
    article, furniture = 0, 0
    at, size = 0, len(source)

    def flush() -> None:
        text = " ".join(html.unescape("".join(piece)).split())
        piece.clear()
        if text:
            out.append(Block(text, article > 0 and not furniture, furniture > 0))

    def close(k: int) -> None:
        nonlocal article, furniture
        for _, a, f in open_[k:]:
            article -= a
            furniture -= f
        del open_[k:]

    while at < size:
        start = source.find("<", at)
        if start < 0:
            piece.append(source[at:])
            break
        if start > at:
            piece.append(source[at:start])
        tag = _TAG.match(source, start)
        if not tag:
            if re.match(r"[a-zA-Z/!?]", source[start + 1 : start + 2]) and source.find(">", start) < 0:
                break
            piece.append("<")
            at = start + 1
            continue
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name in BLOCKS:
                flush()
            if name == "p" and not any(n == "p" for n, _, _ in open_):
                continue
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    close(k)
                    break
                if name not in BLOCKS and open_[k][0] in BLOCKS:
                    break
            continue
        if name in SILENT:
            if name in ("head", "title", "select", "option", "button", "object"):
                flush()
            end = _CLOSE[name].search(source, at)
            if end:
                at = end.end()
            elif name in ("script", "style", "template", "textarea", "iframe"):
                break
            continue
        if name in BLOCKS:
            flush()
        if name in VOID or tag[3].endswith("/") and name not in BLOCKS:
            continue
        ends = _ENDS.get(name)
        if ends:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] in ends:
                    close(k)
                    break
                if open_[k][0] in BLOCKS:
                    break
        is_article, is_furniture = name in ("article", "main"), name in FURNITURE
        if tag[3] and (not is_furniture):
            named, role, hidden = set(), "", False
            for m in _NAMED.finditer(tag[3]):
                value = (m[2] or m[3] or m[4] or "").lower()
                key = m[1].lower()
                if key in ("class", "id"):
                    named.update(_SPLIT.split(value))
                elif key == "role":
                    role = value.strip()
                elif key == "hidden" or value == "true":
                    hidden = True
            if name not in ("html", "body", "article", "main"):
                is_furniture = bool(named & NAMES) or role in ROLES or hidden
                is_article = not is_furniture and (bool(named & MAIN_NAMES) or role in ("main", "article"))
            else:
                is_furniture = name == "article" and bool(named & {"comment", "comments", "reply", "replies", "related"})
                is_article &= not is_furniture
        # a header inside an article is the article's own
        if is_furniture and name == "header" and article and not furniture:
            is_furniture = False
        open_.append((name, is_article and not furniture, is_furniture))
        article += is_article and not furniture
        furniture += is_furniture
    flush()
    return out


def main_text(page: list[Block], repeated: set[int]) -> str:
    """All blocks that are neither furniture nor repeated on the host."""
    return " ".join(b.text for i, b in enumerate(page) if not b.furniture and i not in repeated)


def suffix_array(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of a stream of numbers, and the length of the common beginning with the suffix before.

    Prefix doubling: ranks of 1, 2, 4, ... tokens by sorting pairs of ranks; then one pass for the lengths."""
    n = len(stream)
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    step = 1
    order = np.argsort(rank, kind="stable")
    while n and rank.max() < n - 1:
        second = np.full(n, -1, np.int64)
        second[:-step] = rank[step:]
        order = np.lexsort((second, rank))
        new = np.append(0, (np.diff(rank[order]) != 0) | (np.diff(second[order]) != 0)).cumsum()
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
    return order, _neighbour_lengths(stream, order)


def _neighbour_lengths(stream: np.ndarray, order: np.ndarray, most: int = 64) -> np.ndarray:
    """Common beginning of each suffix with the one before it in order, counted up to ``most`` tokens."""
    n = len(stream)
    out = np.zeros(n, np.int64)
    a, b = order[:-1], order[1:]
    going = np.arange(n - 1) if n > 1 else np.zeros(0, np.int64)
    for k in range(most):
        x, y = a[going] + k, b[going] + k
        inside = (x < n) & (y < n)
        going = going[inside]
        going = going[stream[x[inside]] == stream[y[inside]]]
        if not len(going):
            break
        out[going + 1] = k + 1
    return out


@dataclass
class Streams:
    """Tokens of all pages of a batch in a row, each page ended by a token that occurs once only.

    page: page of each token (ends included); ends: place of each page's end; spot: place of each word; block: block of
    each word; owner: page of each block; size: words of each block."""

    tokens: np.ndarray
    page: np.ndarray
    ends: np.ndarray
    spot: np.ndarray
    block: np.ndarray
    owner: np.ndarray
    size: np.ndarray


def _streams(batch: pa.RecordBatch) -> Streams:
    column = column_of(batch, "blocks")
    w = words(column.flatten())
    n, size = batch.num_rows, w.counts()
    owner = np.repeat(np.arange(n), np.asarray(pa.compute.list_value_length(column)))
    block = np.repeat(np.arange(len(size)), size)
    of_word = owner[block]
    length = np.bincount(of_word, minlength=n)
    ends = np.cumsum(length) + np.arange(n)
    spot = np.arange(len(of_word)) + of_word
    tokens = np.empty(len(of_word) + n, np.uint64)
    tokens[spot] = w.hashes
    tokens[ends] = np.arange(n, dtype=np.uint64)
    return Streams(tokens, np.repeat(np.arange(n), length + 1), ends, spot, block, owner, size)


def _whole(s: Streams) -> np.ndarray:
    """Hash of each block as a whole."""
    total = np.zeros(len(s.size), np.uint64)
    if len(s.spot):
        np.add.at(total, s.block, s.tokens[s.spot] * constants(int(s.size.max()), 17)[ramp(s.size)])
    return mix(total + s.size.astype(np.uint64))


def _pages_of(key: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how many distinct pages have each."""
    order = np.lexsort((page, key))
    key, page = key[order], page[order]
    fresh = np.append(True, key[1:] != key[:-1])[: len(key)]
    once = fresh | np.append(True, page[1:] != page[:-1])[: len(key)]
    at = np.flatnonzero(fresh)
    return key[at], np.add.reduceat(once.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


#: Kinds of rows: number of pages of a shard, blocks, runs.
_TOTAL, _BLOCK, _RUN = 0, 1, 2


def _shard_runs(run_length: int, share: float, least: int):
    """Long runs and blocks of a shard with the number of distinct pages that hold them; equal pages are one.

    Suffixes that begin with the same run stand together in the suffix array: a group begins where the common beginning
    with the suffix before is shorter than a run. Where the host is one shard, only what enough pages hold is returned."""

    def run(group: pa.Table) -> pa.Table:
        batch = group.combine_chunks().to_batches()[0]
        batch = batch.take(pa.array(np.unique(column_of(batch, "content").to_numpy(), return_index=True)[1]))
        s, n = _streams(batch), batch.num_rows
        left = s.ends[s.page] - np.arange(len(s.tokens))
        order, common = suffix_array(s.tokens)
        long = left[order] >= run_length
        group_of = np.cumsum(common < run_length)
        order, group_of = order[long], group_of[long]
        starts = np.flatnonzero(np.append(True, np.diff(group_of) > 0)) if len(order) else np.zeros(0, np.int64)
        runs = grams(s.tokens, run_length)[order[starts]] if len(order) else np.zeros(0, np.uint64)
        held = _pages_of(group_of, s.page[order])[1]
        filled = s.size > 0
        whole, on = _pages_of(_whole(s)[filled], s.owner[filled])
        kind = np.repeat([_TOTAL, _BLOCK, _RUN], [1, len(whole), len(runs)]).astype(np.int32)
        key = np.concatenate([np.zeros(1, np.uint64), whole, runs]).view(np.int64)
        pages = np.concatenate([[n], on, held]).astype(np.int64)
        if group["shards"][0].as_py() == 1:
            enough = (kind != _TOTAL) & (pages >= max(least, share * n))
            kind, key, pages = kind[enough], key[enough], pages[enough]
        return pa.table({"host": pa.array([group["host"][0].as_py()] * len(key), pa.string()), "kind": kind, "run": key, "pages": pages})

    return run


def _cleaned(run_length: int, cover: float, inside: int):
    """Main text of the pages of a shard, given the runs that several pages of the host hold."""

    def run(pages: pa.Table, runs: pa.Table) -> pa.Table:
        names = ["page", "url", "text", "n_chars", "outside_blocks", "repeated_blocks"]
        if not pages.num_rows:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.table([pa.array([], k) for k in kinds], names)
        batch = pages.combine_chunks().to_batches()[0]
        s = _streams(batch)
        key, kind, held = runs["run"].to_numpy().view(np.uint64), runs["kind"].to_numpy(), runs["pages"].to_numpy()
        every, whole = grams(s.tokens, run_length), _whole(s)

        def boilerplate(least: int) -> np.ndarray:
            covered = np.zeros(len(s.tokens), bool)
            hit = np.flatnonzero(np.isin(every, key[(kind == _RUN) & (held >= least)]))
            for k in range(run_length):
                covered[hit + k] = True
            part = np.bincount(s.block[covered[s.spot]], minlength=len(s.size))
            return ((part >= cover * s.size) | np.isin(whole, key[(kind == _BLOCK) & (held >= least)])) & (s.size > 0)

        boiler = np.where(column_of(batch, "article").flatten().to_numpy(zero_copy_only=False).astype(bool), boilerplate(inside), boilerplate(0))
        count = np.asarray(pa.compute.list_value_length(column_of(batch, "blocks"))).astype(np.int64)
        first = np.cumsum(count) - count
        texts, removed, around = [], [], []
        for i in range(batch.num_rows):
            repeated = set(np.flatnonzero(boiler[first[i] : first[i] + count[i]]).tolist())
            page = [Block(*b) for b in zip(*(column_of(batch, c)[i].as_py() for c in ("blocks", "article", "furniture")))]
            texts.append(main_text(page, repeated))
            removed.append(len(repeated))
            around.append(sum(not b.article for b in page))
        columns = [column_of(batch, "page"), column_of(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.table([*columns, pa.array(around, pa.int64()), pa.array(removed, pa.int64())], names)

    return run


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of every page."""
    for batch in batches:
        pages = [blocks(source or "") for source in column_of(batch, "html").to_pylist()]
        keep = ["page", "url", "host", "shard"]
        columns = [column_of(batch, k) for k in keep]
        columns.append(pa.array([[b.text for b in page] for page in pages], pa.list_(pa.string())))
        columns += [pa.array([[getattr(b, k) for b in page] for page in pages], pa.list_(pa.bool_())) for k in ("article", "furniture")]
        yield pa.RecordBatch.from_arrays(columns, [*keep, "blocks", "article", "furniture"])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the pages that have any; pages of a host with equal blocks once in a task."""
    known: set[tuple[str, int]] = set()
    for batch in batches:
        rows, texts, contents = [], [], []
        hosts = column_of(batch, "host").to_pylist()
        for i, source in enumerate(column_of(batch, "html").to_pylist()):
            own = [b.text for b in blocks(source or "")]
            content = int.from_bytes(hashlib.blake2b("\n".join(own).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)
            if own and (hosts[i], content) not in known:
                known.add((hosts[i], content))
                rows.append(i)
                texts.append(own)
                contents.append(content)
        at = pa.array(rows, pa.int64())
        columns = [column_of(batch, k).take(at) for k in ("host", "shards")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(contents, pa.int64()), pa.array(texts, pa.list_(pa.string()))], ["host", "shards", "content", "blocks"])


_PARSED = "page bigint, url string, host string, shard int, blocks array<string>, article array<boolean>, furniture array<boolean>"


def extracted(
    pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", run: int = RUN, cover: float = COVER, shard_pages: int = SHARD_PAGES,
    share: float = SHARE, least: int = PAGES, inside: int = ARTICLE_PAGES,
) -> DataFrame:
    """Columns page_id, url, text, n_chars, outside_blocks, repeated_blocks of every row given.

    A null page is empty and has no text. Pages whose url has no host form one host. Pages of a host with equal blocks
    are one for the question how many pages hold a run; ``share`` of the distinct ones and ``least`` of them must
    (``inside`` for blocks of an article). A host
    of more than ``shard_pages`` pages is cut into shards by hash of the content; each has its own suffix array, and the
    counts of its runs are then added over the host, so the result does not depend on the shards. Other columns are left alone; an empty table gives an empty one.
    """
    prepare(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1))
    rows = pages.select(F.col(key).cast("bigint").alias("page"), F.col(url).alias("url"), host.alias("host"), F.col(source).alias("html"))
    large = rows.groupBy("host").agg(F.ceil(F.count("*") / shard_pages).cast("int").alias("shards")).filter("shards > 1")
    large = written(large, "hosts")
    # one row for a host that is cut: sent to all tasks, or joined by a shuffle where there are very many
    send = F.broadcast if large.limit(HOSTS_SENT + 1).count() <= HOSTS_SENT else lambda table: table
    rows = rows.join(send(large), "host", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
    streams = rows.select("host", "shards", "html").mapInArrow(_distinct, "host string, shards int, content bigint, blocks array<string>")
    streams = streams.withColumn("shard", F.pmod(F.xxhash64("content"), F.col("shards")).cast("int"))
    seen = streams.groupBy("host", "shard").applyInArrow(_shard_runs(run, share, least), "host string, kind int, run bigint, pages bigint")
    seen = written(seen, "seen")
    totals = seen.filter(F.col("kind") == _TOTAL).groupBy("host").agg(F.sum("pages").alias("total"))
    # hosts of one shard have no total: their runs are chosen already
    counts = seen.filter(F.col("kind") != _TOTAL).groupBy("host", "kind", "run").agg(F.sum("pages").alias("pages")).filter(F.col("pages") >= least)
    shared = counts.join(send(totals), "host", "left").filter(F.col("total").isNull() | (F.col("pages") >= F.col("total") * share))
    shards = F.sequence(F.lit(0), F.coalesce("shards", F.lit(1)) - 1)
    runs = shared.join(send(large), "host", "left").select("host", F.explode(shards).alias("shard"), "kind", "run", "pages")
    deal = F.pmod(F.xxhash64(F.coalesce("page", F.lit(0)), F.lit("shard")), F.col("shards")).cast("int")
    texts = rows.withColumn("shard", deal).select("page", "url", "host", "shard", "html").mapInArrow(_parsed, _PARSED)
    out = texts.groupBy("host", "shard").cogroup(runs.groupBy("host", "shard")).applyInArrow(
        _cleaned(run, cover, inside), "page bigint, url string, text string, n_chars bigint, outside_blocks bigint, repeated_blocks bigint"
    )
    return out.withColumnRenamed("page", key)
