"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed (a run of words) are brought together; for each such pair the longest
common runs that do not overlap are marked, longest first, until none of the least length is left. Because tiles may
lie in any order, a passage whose sentences were shuffled is covered like one that was copied as it stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare, slices, text_of
from sensorloom.llm.tokens import Words, grams, mix, words
from sensorloom.session import written

#: A seed that more items than this have is common: it brings a document and an item together only where the item's other
#: seeds cannot.
COMMON = 64
#: Seeds of a benchmark up to this many go to every task; a larger benchmark is joined by a shuffle. Same rows either way.
SEEDS_SENT = 2_000_000


@dataclass(frozen=True)
class Tiling:
    """least: words of the shortest tile, and of a seed. coverage: part of an item's words that tiles must cover.

    A seed is a run of ``least`` words; an item of fewer words is one seed as a whole."""

    least: int = 5
    coverage: float = 0.8


def seeds(w: Words, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``least`` words, and the text of each; a shorter text gives none here."""
    every = grams(w.hashes, least)
    owner = w.owners()
    inside = owner[: len(every)] == owner[len(owner) - len(every) :] if len(every) else np.zeros(0, bool)
    return every[inside], owner[: len(every)][inside]


def _short_seed(w: Words, i: int) -> np.ndarray:
    """Seed of an item with fewer words than a tile: its words, by their number."""
    part = w.hashes[w.offsets[i] : w.offsets[i + 1]]
    return mix(grams(part, len(part)) ^ np.uint64(len(part)))


_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64


class _Rolling:
    """Karp-Rabin hashes of all runs of a text, of any length, from one pass over its words."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(text * up[:-1], out=self.sums[1:])
        self.free = np.ones(n, bool)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the runs of this length whose words are all free, and their hashes."""
        taken = np.concatenate([[0], np.cumsum(~self.free)])
        starts = np.flatnonzero(taken[length:] == taken[: len(taken) - length])
        return starts, (self.sums[starts + length] - self.sums[starts]) * self.down[starts]


def _meeting(item: _Rolling, doc: _Rolling, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and hashes of free runs of this length whose hashes occur on both sides."""
    a, ours = item.windows(length)
    b, theirs = doc.windows(length)
    known = np.unique(ours)
    at = np.searchsorted(known, theirs)
    hit = known[np.minimum(at, len(known) - 1)] == theirs if len(known) else np.zeros(len(theirs), bool)
    b, theirs = b[hit], theirs[hit]
    keep = np.isin(ours, theirs)
    return a[keep], ours[keep], b, theirs


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start in item, start in doc, words): greedy tiling of the item by runs of the document.

    Each round finds the greatest length at which a free run of the item meets one of the document, by halving and running
    Karp-Rabin hashes, and marks all runs of that length, compared word by word (ties: first in the item, then in the
    document). A round costs about as much as the two texts are long, however often words repeat; the lengths fall
    from round to round, so there are at most about sqrt(2 * len(item)) of them.
    """
    n, m = len(item), len(doc)
    least = min(least, n)
    found: list[tuple[int, int, int]] = []
    if not n or m < least:
        return found
    ours, theirs = _Rolling(item), _Rolling(doc)
    most = min(n, m)
    while most >= least and len(_meeting(ours, theirs, least)[0]):
        low, high = least, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(_meeting(ours, theirs, middle)[0]):
                low = middle
            else:
                high = middle - 1
        found += _marked(item, doc, ours, theirs, low)
        most = low - 1
    return found


def _marked(item: np.ndarray, doc: np.ndarray, ours: _Rolling, theirs: _Rolling, length: int) -> list[tuple[int, int, int]]:
    """Tiles of this length, which are no longer free afterwards."""
    a, hash_a, b, hash_b = _meeting(ours, theirs, length)
    order = np.argsort(hash_b, kind="stable")
    b, hash_b = b[order], hash_b[order]
    ends = dict(zip(*(x.tolist() for x in (hash_a, np.searchsorted(hash_b, hash_a, "right")))))
    at = dict(zip(*(x.tolist() for x in (hash_a, np.searchsorted(hash_b, hash_a, "left")))))
    places, open_ = b.tolist(), np.ones(len(doc), bool)
    found, next_ = [], 0
    for x, h in zip(a.tolist(), hash_a.tolist()):
        if x < next_:
            continue
        # places before this one are taken, and stay so
        k = at[h]
        while k < ends[h] and not open_[places[k]]:
            k += 1
        at[h] = k
        # equal hashes of other words: the next place of the same hash may be right
        while k < ends[h] and not (open_[places[k]] and (item[x : x + length] == doc[places[k] : places[k] + length]).all()):
            k += 1
        if k == ends[h]:
            continue
        y = places[k]
        ours.free[x : x + length] = theirs.free[y : y + length] = False
        open_[max(0, y - length + 1) : y + length] = False
        found.append((x, y, length))
        next_ = x + length
    return found


def _item_seeds(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words(column_of(batch, "text"))
            seed, owner = seeds(w, least)
            short = np.flatnonzero((w.counts() > 0) & (w.counts() < least))
            seed = np.concatenate([seed, *[_short_seed(w, i) for i in short]])
            owner = np.concatenate([owner, short])
            ids = column_of(batch, "item").take(pa.array(owner))
            total = pa.array(w.counts()[owner].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), ids, total], ["seed", "item", "total"])

    return run


def _doc_seeds(least: int, widths: list[int], wanted: np.ndarray | None):
    """Seeds of documents, those of ``wanted`` only where given; distinct within a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(column_of(part, "text"))
                seed, owner = seeds(w, least)
                for width in widths:
                    more, of = seeds(w, width)
                    seed = np.concatenate([seed, mix(more ^ np.uint64(width))])
                    owner = np.concatenate([owner, of])
                if wanted is not None and len(seed):
                    at = np.searchsorted(wanted, seed)
                    hit = wanted[np.minimum(at, len(wanted) - 1)] == seed if len(wanted) else np.zeros(len(seed), bool)
                    seed, owner = seed[hit], owner[hit]
                if len(seed):
                    order = np.lexsort((seed, owner))
                    seed, owner = seed[order], owner[order]
                    fresh = np.append(True, (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1]))
                    seed, owner = seed[fresh], owner[fresh]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), column_of(part, "id").take(pa.array(owner))], ["seed", "id"]
                )

    return run


def _tiled(rule: Tiling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, v = words(column_of(batch, "text")), words(column_of(batch, "item_text"))
            spans, covered, total = [], [], []
            for i in range(batch.num_rows):
                item, doc = v.hashes[v.offsets[i] : v.offsets[i + 1]], w.hashes[w.offsets[i] : w.offsets[i + 1]]
                got = sorted(tiles(item, doc, rule.least))
                covered.append(sum(t[2] for t in got))
                total.append(len(item))
                spans.append([{"item_word": t[0], "doc_word": t[1], "words": t[2]} for t in got])
            kind = pa.list_(pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "id"),
                    column_of(batch, "item"),
                    pa.array(total, pa.int32()),
                    pa.array(covered, pa.int32()),
                    pa.array(spans, kind),
                ],
                ["id", "item", "item_words", "covered_words", "tiles"],
            )

    return run


def _telling(index: DataFrame, rule: Tiling, common: int) -> DataFrame:
    """The rows of the index that bring pairs together, with ``more``: places that common seeds may add to those found.

    A pair needs enough places of the item. Where the common seeds alone are too few for that, a pair that is covered has
    another seed too, so the common ones need not be joined: all of them are taken to be there, and the tiling decides.
    """
    shared = index.groupBy("seed").agg((F.count("*") > common).alias("common"))
    marked = index.join(shared, "seed")
    usual = F.sum(F.when(F.col("common"), F.col("times")).otherwise(0))
    items = marked.groupBy("item").agg(usual.alias("more"), F.max("total").alias("of"))
    enough = F.col("more") * rule.least >= rule.coverage * F.col("of")
    items = items.select("item", enough.alias("enough"), F.when(enough, 0).otherwise(F.col("more")).alias("more"))
    return marked.join(items, "item").filter("enough or not common").select("seed", "item", "times", "total", "more")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    rule: Tiling = Tiling(),
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    seeds_sent: int = SEEDS_SENT,
    common: int = COMMON,
) -> DataFrame:
    """Pairs of a document and a benchmark item whose words it covers to at least ``rule.coverage``.

    Columns: the ids, item_words, covered_words, coverage (double), tiles (item_word, doc_word, words of each). Null
    texts are empty; an empty document or item is in no pair. Repeated rows give repeated pairs only once; rows that
    share an id are looked at one by one, the best covered counts. Rows without an id are left out (the id is all that
    a pair carries). Other columns are left alone; empty tables give an empty table.
    """
    spark = docs.sparkSession
    prepare(spark)
    plain = docs.select(F.col(key).cast("bigint").alias("id"), text_of(text).alias("text")).filter("id is not null")
    items = benchmark.select(F.col(item_key).cast("bigint").alias("item"), text_of(item_text).alias("text"))
    items = items.filter("item is not null").distinct()
    index = items.mapInArrow(_item_seeds(rule.least), "seed bigint, item bigint, total int")
    index = written(index.groupBy("seed", "item").agg(F.count("*").alias("times"), F.min("total").alias("total")), "seeds")
    index = written(_telling(index, rule, common), "telling")
    # at most least - 1 different widths
    widths = [r["total"] for r in index.select("total").filter(F.col("total") < rule.least).distinct().collect()]
    wanted = None
    if index.limit(seeds_sent + 1).count() <= seeds_sent:
        wanted = index.select("seed").distinct().toPandas()["seed"].to_numpy(dtype=np.int64).view(np.uint64)
        wanted = np.sort(wanted)
    found = plain.mapInArrow(_doc_seeds(rule.least, widths, wanted), "seed bigint, id bigint")
    # tiles that cover c words hold c / least places of the item where a seed begins, at least
    met = found.join(index, "seed").groupBy("id", "item").agg(
        (F.sum("times") + F.min("more")).alias("times"), F.min("total").alias("total")
    )
    pairs = written(met.filter(F.col("times") * rule.least >= rule.coverage * F.col("total")).select("id", "item"), "pairs")
    near = pairs.join(items.withColumnRenamed("text", "item_text"), "item")
    tiled = near.join(plain, "id").select("id", "item", "text", "item_text")
    kind = "id bigint, item bigint, item_words int, covered_words int, tiles array<struct<item_word:int,doc_word:int,words:int>>"
    scored = tiled.mapInArrow(_tiled(rule), kind)
    scored = scored.withColumn("coverage", F.col("covered_words") / F.col("item_words"))
    scored = scored.filter(F.col("coverage") >= rule.coverage)
    best = scored.groupBy("id", "item").agg(F.max(F.struct("coverage", "covered_words", "item_words", "tiles")).alias("b"))
    return best.select(F.col("id").alias(key), F.col("item").alias(item_key), "b.*")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, rule: Tiling = Tiling(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that cover no benchmark item, with all their columns. Rows without an id stay."""
    leaked = written(contamination(docs, benchmark, rule, key, text).select(F.col(key).alias("_leaked")).distinct(), "leaks")
    return docs.join(leaked, F.col(key) == F.col("_leaked"), "left_anti")
