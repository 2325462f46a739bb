"""Near-duplicate documents by min-max hashing, with links confirmed on the full sets.

1. Every text becomes the set of its shingles, and that a signature: under each permutation both the least and the
   greatest value are kept, so one hash evaluation gives two values of the signature.
2. Texts with equal sets become one node (copies are never compared). Nodes that agree on a band of the signature
   are joined to the least of them; the components of these links are clusters that may hold near-duplicates.
3. Inside a cluster the full sets decide. Clusters beyond a size are cut into blocks which share one pivot; what a
   block and the pivot do not connect is compared with all other blocks. Only links that join two parts are emitted,
   never all pairs.
4. The components of the confirmed links are the groups; the least id of each is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare, slices, text_of
from sensorloom.llm.graph import components
from sensorloom.llm.tokens import constants, mix, shingle_sets, words
from sensorloom.session import written

#: Shingles that a block of a cluster may hold (a longer text is a block of its own): 64-bit each.
BLOCK_SHINGLES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Texts are linked when 100 * intersection >= percent * union of their sets of distinct shingles.

    ``bands`` times ``rows`` values make a signature, half of them minima and half maxima. A pair at similarity s is
    missed with probability (1 - s**rows)**bands: 8e-6 at 0.85 for 20 bands of 5, 2e-6 at 0.8 for 25 of 4.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 4

    @property
    def values(self) -> int:
        return self.bands * self.rows


#: Fixed by the contract of the query: three words, 85 percent.
STRICT = Rule(shingle=3, percent=85, bands=20, rows=5)
#: The usual rule: five words, 0.8 or more.
USUAL = Rule()


def min_max_signature(sets: np.ndarray, at: np.ndarray, values: int) -> np.ndarray:
    """values x texts: first the minima, then the maxima, under values/2 permutations of 32 bits. No set may be empty."""
    half = values // 2
    short = (sets >> np.uint64(32)).astype(np.uint32)
    factor, add = constants(half, 21), constants(half, 22)
    out = np.empty((2 * half, len(at) - 1), np.uint32)
    starts = at[:-1]
    for i in range(half):
        v = short * np.uint32((factor[i] >> np.uint64(32)) | np.uint64(1)) + np.uint32(add[i] >> np.uint64(32))
        np.minimum.reduceat(v, starts, out=out[i])
        np.maximum.reduceat(v, starts, out=out[half + i])
    return out


def _describe(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = constants(rule.rows, 31)
        for batch in batches:
            for part in slices(batch, "text"):
                sets, at = shingle_sets(words(column_of(part, "text")), rule.shingle)
                n = np.diff(at)
                have = np.flatnonzero(n)
                one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                bands = np.zeros((len(n), rule.bands), np.uint64)
                if len(have):
                    starts = at[:-1][have]
                    one[have] = np.add.reduceat(mix(sets + np.uint64(1)), starts)
                    two[have] = np.add.reduceat(mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                    signature = min_max_signature(sets, np.append(starts, len(sets)), rule.values)
                    for b in range(rule.bands):
                        rows = signature[b * rule.rows : (b + 1) * rule.rows].astype(np.uint64)
                        bands[have, b] = mix((rows * weight[:, None]).sum(axis=0, dtype=np.uint64) + np.uint64(b))
                flat = pa.array(bands.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        column_of(part, "id").cast(pa.int64()),
                        pa.array(n.astype(np.int64)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * rule.bands), flat),
                    ],
                    ["id", "n", "one", "two", "bands"],
                )

    return run


def forest(sets: np.ndarray, at: np.ndarray, percent: int, part: np.ndarray | None = None, asks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) of a spanning forest of the texts whose sets are similar enough, found breadth first.

    A text that is taken up is compared only with those not reached yet, so a dense group costs about one comparison
    a text. With ``part`` and ``asks``: only texts that ask are taken up, and are compared with all texts of other
    parts until the parts have met.
    """
    n = len(at) - 1
    if n < 2:
        return []
    _, flat = np.unique(sets, return_inverse=True)
    size = np.diff(at)
    mark = np.zeros(flat.max() + 1 if len(flat) else 1, bool)
    links: list[tuple[int, int]] = []

    def similar(i: int, others: np.ndarray, held: np.ndarray, held_at: np.ndarray) -> np.ndarray:
        own = flat[at[i] : at[i + 1]]
        mark[own] = True
        common = np.add.reduceat(mark[held].astype(np.int64), held_at)
        mark[own] = False
        return 100 * common >= percent * (size[i] + size[others] - common)

    def gather(others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([flat[at[j] : at[j + 1]] for j in others]), np.concatenate([[0], np.cumsum(size[others])[:-1]])

    if part is None:
        rest = np.arange(n)
        held, held_at = gather(rest)
        reached = np.zeros(n, bool)
        for seed in range(n):
            if reached[seed]:
                continue
            reached[seed] = True
            queue = [seed]
            while queue:
                open_ = ~reached[rest]
                left = int(open_.sum())
                if not left:
                    return links
                if left < 0.7 * len(rest):
                    rest = rest[open_]
                    held, held_at = gather(rest)
                    open_ = np.ones(len(rest), bool)
                i = queue.pop()
                found = rest[similar(i, rest, held, held_at) & open_]
                reached[found] = True
                links += [(i, int(j)) for j in found]
                queue += found.tolist()
        return links
    root = {p: p for p in np.unique(part).tolist()}

    def top(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    everyone = np.arange(n)
    held, held_at = gather(everyone)
    for i in np.flatnonzero(asks):
        for j in everyone[similar(i, everyone, held, held_at)]:
            p, q = top(part[i].item()), top(part[j].item())
            if p != q:
                root[max(p, q)] = min(p, q)
                links.append((int(i), int(j)))
    return links


_LINKS = "u bigint, v bigint"


def _links_of(rule: Rule, parts: bool):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        ids = group["node"].to_numpy()
        piece = group.combine_chunks()
        sets, at = shingle_sets(words(piece["text"]), rule.shingle)
        full = np.diff(at) > 0
        ids, at = ids[full], np.append(at[:-1][full], len(sets))
        extra = (piece["part"].to_numpy()[full], piece["asks"].to_numpy(zero_copy_only=False)[full]) if parts else ()
        links = forest(sets, at, rule.percent, *extra)
        u = np.array([ids[i] for i, _ in links], np.int64)
        v = np.array([ids[j] for _, j in links], np.int64)
        return pa.table({"u": u, "v": v})

    return run


def _confirmed(docs: DataFrame, sets: DataFrame, clusters: DataFrame, rule: Rule, block_shingles: int) -> DataFrame:
    """Links that the full sets confirm, enough to connect all that is connected. docs: id, text; clusters: node, root."""
    sized = clusters.join(sets.select(F.col("rep").alias("node"), "n"), "node")
    sizes = sized.groupBy("root").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"))
    members = sized.join(sizes, "root").select(
        "node", "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    )
    members = written(members, "members")
    texts = written(docs.join(members, docs["id"] == members["node"]).select("node", "root", "blocks", "block", "text"), "texts")
    # every block also holds the pivot: the least node of its cluster
    pivots = texts.filter("blocks > 1 and node = root").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = texts.unionByName(pivots).select("root", "block", "node", "text")
    links = written(dealt.groupBy("root", "block").applyInArrow(_links_of(rule, False), _LINKS), "links")
    large = texts.filter("blocks > 1")
    if large.isEmpty():
        return links
    # what is not in the largest part of its cluster asks all other blocks
    joined = components(links)
    parts = members.filter("blocks > 1").join(joined.withColumnRenamed("root", "part"), "node", "left")
    parts = parts.select("node", "root", "blocks", F.coalesce("part", "node").alias("part"))
    counts = parts.groupBy("root", "part").agg(F.count("*").alias("c"))
    main = counts.groupBy("root").agg(F.min(F.struct(-F.col("c"), "part"))["part"].alias("main"))
    parts = written(parts.join(main, "root").withColumn("asks", F.col("part") != F.col("main")), "parts")
    asking = parts.filter("asks").join(sets.select(F.col("rep").alias("node"), "n"), "node")
    chunks = asking.groupBy("root").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("chunks"))
    known = large.join(parts.select("node", "part", "asks"), "node").join(chunks, "root")
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")
    all_blocks, all_chunks = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("chunks") - 1)
    ask = known.filter("asks").select("root", F.explode(all_blocks).alias("block"), chunk.alias("chunk"), "node", "text", "part", "asks")
    answer = known.select("root", "block", F.explode(all_chunks).alias("chunk"), "node", "text", "part", F.lit(False).alias("asks"))
    more = ask.unionByName(answer).groupBy("root", "block", "chunk").applyInArrow(_links_of(rule, True), _LINKS)
    return links.unionByName(more)


def near_duplicates(
    docs: DataFrame, rule: Rule = USUAL, key: str = "doc_id", text: str = "text", block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """One row for each row given: the id, n_shingles, component_id (least id reachable by links) and kept.

    Texts without words (null, empty, blank) have no shingles and are linked with nothing. Rows that share an id are
    one node. A row without an id is linked with nothing: its component is null and it is kept. Ids are integers.
    Other columns are left alone; an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(key).cast("bigint").alias("id"), text_of(text).alias("text"))
    schema = "id bigint, n bigint, one bigint, two bigint, bands array<bigint>"
    described = written(plain.mapInArrow(_describe(rule), schema), "signatures")
    some = described.filter("n > 0 and id is not null")
    sets = some.groupBy("n", "one", "two").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    sets = written(sets, "sets")
    banded = sets.select("rep", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("rep").alias("hub"), F.count("*").alias("c")).filter("c > 1").drop("c")
    near = banded.join(hubs, "band").filter("rep != hub").select(F.col("rep").alias("u"), F.col("hub").alias("v"))
    clusters = components(near)
    links = _confirmed(plain.filter("id is not null"), sets, clusters, rule, block_shingles)
    # copies of a set: all its ids hang on the least
    same = some.join(sets.drop("bands"), ["n", "one", "two"]).filter("id != rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    groups = components(links.unionByName(same)).select(F.col("node").alias("id"), "root")
    return (
        described.join(groups, "id", "left")
        .select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )


def deduplicated(docs: DataFrame, rule: Rule = USUAL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of documents that are kept, with all their columns; one row for each id among rows of equal ids.

    Rows without an id stay as they are."""
    kept = near_duplicates(docs, rule, key, text).filter("kept").select(F.col(key).alias("_kept_id")).distinct()
    known = docs.join(kept, F.col(key) == F.col("_kept_id"), "left_semi").dropDuplicates([key])
    return known.unionByName(docs.filter(F.col(key).isNull()))
