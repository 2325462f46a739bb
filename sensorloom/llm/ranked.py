"""Exact ranked lexical search by two trees.

1. Items are taken in blocks of bounded text. A block's terms are its vocabulary; documents become the counts of these
   terms, from which N, L, df and the weights follow. A score is the sum, over the item's terms, of the term's weight times
   the document's coordinate, all integers.
2. A tree over items: similar ones side by side, every node with the greatest weight of each term below it. A tree over
   documents: sorted by the terms that count most in them, cut into leaves, every node with the greatest coordinate of
   each term below it.
3. The product of two nodes' maxima is never less than a score of any pair below them. Where it is less than the weakest
   kth score of the items there, the pair of nodes is dropped with all pairs below; leaves that remain are scored exactly.
4. The kth scores start from a first look, in which every item is scored against the one leaf of each batch with the
   highest bound: the kth best of some documents is never above the kth best of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, slices, text_of
from sensorloom.llm.tokens import NO_LETTERS, words
from sensorloom.session import written

#: Documents of a leaf and leaves of a batch (the root of a tree over documents) and of a node between these.
LEAF, BATCH, MIDDLE = 32, 64, 8
#: Children of a node of the tree over items.
FAN = 4
#: Bytes of text of the items that are taken as one block.
BLOCK_BYTES = 1 << 20
#: Candidates a task holds before it cuts them to the best of each item.
HELD = 50_000
_NO_ID = (1 << 63) - 1


@dataclass
class ItemTree:
    """Levels of nodes, items first: terms (places in the vocabulary), greatest weights and where each node begins."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @property
    def items(self) -> int:
        return len(self.levels[0][2]) - 1


def arranged(terms: list[np.ndarray], seed: int = 1) -> np.ndarray:
    """An order in which similar items are neighbours: halved along the main direction, again and again."""
    if not terms:
        return np.zeros(0, int)
    # 64 random signs a term stand for its direction
    size = max((int(t.max()) for t in terms if len(t)), default=0) + 1
    sign = np.random.default_rng(seed).choice([-1.0, 1.0], (size, 64))
    x = np.array([sign[t].sum(axis=0) / math.sqrt(max(len(t), 1)) for t in terms])

    def halved(part: np.ndarray) -> list[int]:
        if len(part) <= FAN:
            return part.tolist()
        y = x[part] - x[part].mean(axis=0)
        main = np.linalg.svd(y, full_matrices=False)[2][0]
        part = part[np.argsort(y @ main, kind="stable")]
        return halved(part[: len(part) // 2]) + halved(part[len(part) // 2 :])

    return np.array(halved(np.arange(len(terms))))


def item_tree(terms: list[np.ndarray], weight: np.ndarray) -> ItemTree:
    """The tree over items in the given order."""
    ptr = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *terms]).astype(np.int64)
    levels = [(flat, weight[flat], ptr)]
    while len(levels[-1][2]) - 1 > 1:
        flat, value, ptr = levels[-1]
        n = len(ptr) - 1
        owner = np.repeat(np.arange(n) // FAN, np.diff(ptr))
        levels.append(maxima(owner, flat, value, -(-n // FAN)))
    return ItemTree(levels)


def maxima(owner: np.ndarray, terms: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greatest value of every term of each of n owners: terms, values, and where each owner begins."""
    order = np.lexsort((-value, terms, owner))
    owner, terms, value = owner[order], terms[order], value[order]
    first = np.ones(len(terms), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])
    owner, terms, value = owner[first], terms[first], value[first]
    return terms, value, np.searchsorted(owner, np.arange(n + 1))


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over runs of the given lengths along the last axis; empty runs give 0."""
    out = np.zeros((*values.shape[:-1], len(lengths)), np.int64)
    some = np.flatnonzero(lengths)
    if len(some):
        starts = (np.cumsum(lengths) - lengths)[some]
        out[..., some] = np.add.reduceat(values, starts, axis=-1)
    return out


def _take(ptr: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of the nodes, and how many each has."""
    lengths = np.diff(ptr)[nodes]
    return np.repeat(ptr[nodes] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum()), lengths


def survivors(tree: ItemTree, peak: np.ndarray, floor: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Items among the ``alive`` ones (sorted) that may reach their ``floor`` at documents with these maxima.

    From the top of the tree down; a node's floor is the least of its living items. ``peak`` is indexed by term."""
    for level in range(len(tree.levels) - 1, -1, -1):
        if not len(alive):
            return alive
        terms, value, ptr = tree.levels[level]
        nodes, of = np.unique(alive // FAN**level, return_inverse=True)
        at, lengths = _take(ptr, nodes)
        bound = _sums(value[at] * peak[terms[at]], lengths)
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(least, of, floor[alive])
        alive = alive[(bound >= least)[of]]
    return alive


class Best:
    """The best ``top`` documents of every item so far: highest score first, then least id. ``floor`` is the kth score."""

    def __init__(self, floor: np.ndarray, top: int):
        self.floor, self.top = floor.copy(), top
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: documents x items."""
        d, i = np.nonzero(scores >= self.floor[items])
        if len(d):
            self.parts.append((items[i], scores[d, i], docs[d]))
            self.held += len(d)
            if self.held > HELD:
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        item, score, doc = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*self.parts) if self.parts else ([], [], [])))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.top - 1
        self.floor[item[full]] = np.maximum(self.floor[item[full]], score[full])
        keep = place < self.top
        self.parts, self.held = [(item[keep], score[keep], doc[keep])], 0
        return self.parts[0]


@dataclass
class Leaf:
    docs: np.ndarray
    ptr: np.ndarray
    terms: np.ndarray
    value: np.ndarray
    top_terms: np.ndarray
    top_value: np.ndarray

    def scores(self, tree: ItemTree, items: np.ndarray) -> np.ndarray:
        """Documents x items, exact."""
        matrix = np.zeros((len(self.docs), len(self.top_terms) + 1), np.int64)
        matrix[np.repeat(np.arange(len(self.docs)), np.diff(self.ptr)), np.searchsorted(self.top_terms, self.terms)] = self.value
        terms, weight, ptr = tree.levels[0]
        at, lengths = _take(ptr, items)
        wanted = terms[at]
        place = np.searchsorted(self.top_terms, wanted)
        place[(place == len(self.top_terms)) | (self.top_terms[np.minimum(place, len(self.top_terms) - 1)] != wanted)] = len(self.top_terms)
        return _sums(matrix[:, place] * weight[at], lengths)


def _leaves(batch: pa.RecordBatch) -> Iterator[Leaf]:
    get = lambda name, k: column_of(batch, name)[k].values.to_numpy()
    for k in range(batch.num_rows):
        yield Leaf(*(get(n, k) for n in ("docs", "ptr", "terms", "value", "top_terms", "top_value")))


def _peak(leaves: list[Leaf], size: int) -> np.ndarray:
    peak = np.zeros(size, np.int64)
    for leaf in leaves:
        peak[leaf.top_terms] = np.maximum(peak[leaf.top_terms], leaf.top_value)
    return peak


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Leaf]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH):
            yield list(_leaves(batch.slice(first, BATCH)))


def _first_look(tree: ItemTree, size: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(np.ones(tree.items, np.int64), top)
        terms, weight, ptr = tree.levels[0]
        for leaves in _batches(batches):
            bounds = np.array([_sums(weight * _peak([leaf], size)[terms], np.diff(ptr)) for leaf in leaves])
            choice = bounds.argmax(axis=0)
            for k, leaf in enumerate(leaves):
                items = np.flatnonzero((choice == k) & (bounds[k] >= best.floor))
                if len(items):
                    best.add(items, leaf.docs, leaf.scores(tree, items))
        yield _ranked(best)

    return run


def _ranked(best: Best) -> pa.RecordBatch:
    item, score, doc = best.cut()
    return pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(score), pa.array(doc)], ["item", "score", "doc"])


def _search(tree: ItemTree, size: int, floor: np.ndarray, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(floor, top)
        every = np.arange(tree.items)
        for leaves in _batches(batches):
            alive = survivors(tree, _peak(leaves, size), best.floor, every)
            for first in range(0, len(leaves) if len(alive) else 0, MIDDLE):
                middle = leaves[first : first + MIDDLE]
                near = survivors(tree, _peak(middle, size), best.floor, alive)
                for leaf in middle if len(near) else ():
                    items = survivors(tree, _peak([leaf], size), best.floor, near)
                    if len(items):
                        best.add(items, leaf.docs, leaf.scores(tree, items))
        yield _ranked(best)

    return run


def _counted(vocabulary: np.ndarray):
    """Number of terms of each text, and the counts of those in the (sorted) vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = len(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(column_of(part, "text"), NO_LETTERS)
                place = np.searchsorted(vocabulary, w.hashes)
                hit = np.flatnonzero((place < v) & (vocabulary[np.minimum(place, v - 1)] == w.hashes)) if v else np.zeros(0, int)
                found, tf = np.unique(w.owners()[hit] * max(v, 1) + place[hit], return_counts=True)
                ptr = np.searchsorted(found // max(v, 1), np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [column_of(part, "id"), pa.array(w.counts()), _lists(ptr, found % max(v, 1), pa.int32()), _lists(ptr, tf, pa.int32())],
                    ["id", "n", "terms", "tf"],
                )

    return run


def _lists(ptr: np.ndarray, flat: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(flat, kind))


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column_of(batch, name).flatten().to_numpy().astype(np.int64)


def _holding(size: int):
    """Documents that hold each term, of the whole task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_flat(batch, "terms"), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    return run


def _valued(weight: np.ndarray, n_docs: int, n_terms: int):
    """Coordinates of the documents, and the two terms that count most in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array([50 + 50 * n * n_docs // n_terms for n in column_of(batch, "n").to_pylist()], np.int64)
            ptr = column_of(batch, "terms").offsets.to_numpy()
            ptr = (ptr - ptr[0]).astype(np.int64)
            terms, tf = _flat(batch, "terms"), _flat(batch, "tf")
            owner = np.repeat(np.arange(len(m)), np.diff(ptr))
            value = 1_000_000_000 * tf // (1000 * tf + 20 * m[owner])
            order = np.lexsort((terms, -value * weight[terms], owner))
            begin = ptr[:-1]
            most = terms[order[begin]]
            next_ = np.where(np.diff(ptr) > 1, terms[order[np.minimum(begin + 1, len(terms) - 1)]], -1)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "id"), pa.array(most), pa.array(next_), _lists(ptr, terms, pa.int32()), _lists(ptr, value, pa.int32())],
                ["id", "most", "next", "terms", "value"],
            )

    return run


_LEAVES = "docs array<bigint>, ptr array<int>, terms array<int>, value array<int>, top_terms array<int>, top_value array<int>"


def _leafed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every LEAF rows in a row as one leaf with the maxima of its coordinates."""
    for batch in batches:
        n = batch.num_rows
        ptr = column_of(batch, "terms").offsets.to_numpy()
        ptr = (ptr - ptr[0]).astype(np.int64)
        terms, value = _flat(batch, "terms"), _flat(batch, "value")
        cuts = np.append(np.arange(0, n, LEAF), n)
        leaf = np.repeat(np.arange(n) // LEAF, np.diff(ptr))
        top_terms, top_value, top_ptr = maxima(leaf, terms, value, len(cuts) - 1)
        # each leaf has one more pointer than documents, counted from its own start
        own = np.concatenate([np.zeros(0, np.int64), *(ptr[a : b + 1] - ptr[a] for a, b in zip(cuts, cuts[1:]))])
        yield pa.RecordBatch.from_arrays(
            [
                _lists(cuts, column_of(batch, "id").to_numpy(), pa.int64()),
                _lists(cuts + np.arange(len(cuts)), own, pa.int32()),
                _lists(ptr[cuts], terms, pa.int32()),
                _lists(ptr[cuts], value, pa.int32()),
                _lists(top_ptr, top_terms, pa.int32()),
                _lists(top_ptr, top_value, pa.int32()),
            ],
            ["docs", "ptr", "terms", "value", "top_terms", "top_value"],
        )


_FOUND = "item int, score bigint, doc bigint"


def _block(docs: DataFrame, texts: list[str], top: int) -> DataFrame | None:
    """The best documents for the items of one block: item (place in ``texts``), rank, doc, score."""
    w = words(pa.array(texts, pa.string()), NO_LETTERS)
    vocabulary = np.unique(w.hashes)
    terms = [np.unique(np.searchsorted(vocabulary, w.hashes[a:b])) for a, b in zip(w.offsets, w.offsets[1:])]
    counted = written(docs.mapInArrow(_counted(vocabulary), "id bigint, n bigint, terms array<int>, tf array<int>"), "counted")
    n_docs, n_terms = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    some = counted.filter("size(terms) > 0")
    held = some.select("terms").mapInArrow(_holding(len(vocabulary)), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for r in held.collect():  # a number for each term of the block at most
        df[r["term"]] = r["df"]
    if not df.any():
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    order = arranged(terms)
    tree = item_tree([terms[i] for i in order], weight)
    valued = some.mapInArrow(_valued(weight, n_docs, n_terms), "id bigint, most bigint, next bigint, terms array<int>, value array<int>")
    sorted_ = valued.repartitionByRange("most", "next", "id").sortWithinPartitions("most", "next", "id")
    leaves = written(sorted_.mapInArrow(_leafed, _LEAVES), "leaves")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    look = leaves.mapInArrow(_first_look(tree, len(vocabulary), top), _FOUND)
    kth = look.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).filter(F.col("rank") == top)
    floor = np.ones(tree.items, np.int64)
    for r in kth.collect():  # a number for each item of the block at most
        floor[r["item"]] = max(1, r["score"])
    found = leaves.mapInArrow(_search(tree, len(vocabulary), floor, top), _FOUND)
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    place = docs.sparkSession.createDataFrame([(k, int(i)) for k, i in enumerate(order)], "item int, place int")
    return ranked.join(place, "item").select(F.col("place").alias("item"), "rank", "doc", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = 50, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``top`` documents of every item with a score above 0: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z lower-cased; null texts
    have none. Equal scores are ranked by ascending id, a null id (it takes the place of the greatest 64-bit integer) last.
    Repeated documents are ranked one by one, each row of ``items`` gets a list of its own; items that match nothing have
    no row, and empty tables give none. Other columns are left alone. Ids are integers.
    """
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_NO_ID)).alias("id"), text_of(text).alias("text"))
    asked = items.select(F.col(item_key).alias("item_id"), text_of(item_text).alias("text"))
    asked = written(asked.groupBy("item_id", "text").agg(F.count("*").alias("copies")), "items")
    size = asked.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        rows = asked.filter(F.col("block") == block).orderBy("item_id", "text").collect()  # of bounded text
        part = _block(plain, [r["text"] for r in rows], top) if rows else None
        if part is None:
            continue
        names = [(k, r["item_id"], r["copies"]) for k, r in enumerate(rows)]
        names = spark.createDataFrame(names, f"item int, item_id {items.schema[item_key].dataType.simpleString()}, copies bigint")
        part = part.join(names, "item").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        part = part.select(F.col("item_id").alias(item_key), "rank", F.nullif(F.col("doc"), F.lit(_NO_ID)).alias(key), "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = items.schema[item_key].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_key}` {kind}, rank int, `{key}` bigint, score bigint")
    return found
