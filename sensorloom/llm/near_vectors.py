"""Near-duplicate vectors: all pairs at a cosine threshold, by PCA-ordered comparison of tiles.

1. Vectors are turned to length one and rotated to their principal axes, so that the leading coordinates hold most of a
   product. A rotation changes no product.
2. Equal vectors of a label are one class, compared once. Classes are sorted by label and leading coordinates and cut into
   tiles. A tile knows the box of its leading coordinates and the greatest norm of what follows them.
3. Which pairs of tiles of a label can hold a link is found down a tree over the tiles: a pair of nodes whose boxes and
   residual norms bound every product below the threshold is dropped with all below it.
4. A pair of tiles is one group: products of the leading coordinates are accumulated first, and a pair stops as soon as
   what is left, bounded by the product of suffix norms (Cauchy-Schwarz), cannot lift it to the threshold.
5. A group returns, for each class with links, their number and one edge of a spanning forest: never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of
from sensorloom.llm.graph import components
from sensorloom.llm.vectors import axes, finite, products, runs, unit
from sensorloom.session import written

#: Classes of a tile: a pair of tiles needs a matrix of this size squared.
TILE = 2048
#: Leading coordinates that make the boxes of tiles, and those by which classes are sorted.
BOX, SORTED = 8, 4
#: Children of a node of the tree over tiles, and the number of nodes from which another level is worth it.
FAN, TOP = 8, 64
#: Products that are nearer to the threshold than this are decided again on the vectors as given.
NEAR = 1e-9
#: Share of a block that may still reach the threshold, below which single pairs are gone on with.
SPARSE = 0.02
#: Pairs of a block whose remaining coordinates are multiplied at once.
_PAIRS = 1 << 15


def _steps(d: int) -> list[int]:
    """Ends of the runs of coordinates: 8, 16, 32, ... d."""
    ends, k = [], 8
    while k < d:
        ends.append(k)
        k *= 2
    return [*ends, d]


def suffix_norms(y: np.ndarray, ends: list[int]) -> np.ndarray:
    """For every row and end, the norm of the coordinates from there on."""
    squares = np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.column_stack([squares[:, e] if e < y.shape[1] else np.zeros(len(y)) for e in ends]))


def linked(a: np.ndarray, b: np.ndarray, x: np.ndarray, z: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b`` (unit vectors in rotated coordinates) whose product is ``least`` or more.

    ``x`` and ``z`` are the same vectors as given: they decide where the rotated product is within NEAR of the threshold.
    """
    ends = _steps(a.shape[1])
    sa, sb = suffix_norms(a, ends), suffix_norms(b, ends)
    rows, cols = np.arange(len(a)), np.arange(len(b))
    s = np.zeros((len(a), len(b)))
    begin, found = 0, []
    for k, end in enumerate(ends):
        s += a[rows, begin:end] @ b[cols, begin:end].T
        begin = end
        alive = s + sa[rows, k, None] * sb[None, cols, k] >= least - NEAR
        r, c = alive.any(axis=1), alive.any(axis=0)
        if not r.any():
            return np.zeros(0, int), np.zeros(0, int)
        rows, cols, s, alive = rows[r], cols[c], s[np.ix_(r, c)], alive[np.ix_(r, c)]
        if end == ends[-1] or alive.sum() < SPARSE * alive.size:
            i, j = np.nonzero(alive)
            found = [(rows[i[p : p + _PAIRS]], cols[j[p : p + _PAIRS]], s[i[p : p + _PAIRS], j[p : p + _PAIRS]]) for p in range(0, len(i), _PAIRS)]
            rest = ends[k + 1 :]
            break
    out = []
    for i, j, p in found:
        at = begin
        for n, end in enumerate(rest, len(ends) - len(rest)):
            p = p + np.einsum("ij,ij->i", a[i, at:end], b[j, at:end])
            keep = p + sa[i, n] * sb[j, n] >= least - NEAR
            i, j, p, at = i[keep], j[keep], p[keep], end
        close = np.flatnonzero(np.abs(p - least) <= NEAR)
        keep = p >= least
        for q in close:
            keep[q] = cosine(x[i[q]], z[j[q]]) >= least
        out.append((i[keep], j[keep]))
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def cosine(x: np.ndarray, z: np.ndarray) -> float:
    x, z = x / np.abs(x).max(), z / np.abs(z).max()
    return float(x @ z / (np.sqrt(x @ x) * np.sqrt(z @ z)))


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes a neighbour nearer to the root of its tree, or -1, of a spanning forest of the links (i, j).

    No link may come twice."""
    to, of = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.argsort(of, kind="stable")
    to, at = to[order], np.searchsorted(of[order], np.arange(n + 1))
    parent, seen = np.full(n, -1), np.zeros(n, bool)
    for root in np.flatnonzero(np.diff(at)):
        if seen[root]:
            continue
        seen[root], queue = True, [root]
        while queue:
            node = queue.pop()
            fresh = to[at[node] : at[node + 1]]
            fresh = fresh[~seen[fresh]]
            seen[fresh], parent[fresh] = True, node
            queue += fresh.tolist()
    return parent


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(table.num_rows, -1)


def _rotated(x: np.ndarray, turns: dict[int, np.ndarray]) -> np.ndarray:
    y = unit(x)
    return y @ turns[x.shape[1]] if x.shape[1] in turns else y


def _compared(turns: dict[int, np.ndarray], least: float):
    def run(group: pa.Table) -> pa.Table:
        a = group["a"][0].as_py()
        mine = np.asarray(group["tile"]) == a
        both = [group.filter(pa.array(mine)), group.filter(pa.array(~mine))]
        if a == group["b"][0].as_py():
            both[1] = both[0]
        x, z = _matrix(both[0]), _matrix(both[1])
        i, j = linked(_rotated(x, turns), _rotated(z, turns), x, z, least)
        size = len(x)
        if both[0] is both[1]:
            i, j = i[i < j], j[i < j]
            nodes = both[0]
        else:
            j = j + size
            nodes = pa.concat_tables(both)
        n = np.asarray(nodes["n"])
        links = np.zeros(len(n), np.int64)
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        parent = forest(i, j, len(n))
        some = np.flatnonzero(links)
        picked = nodes.select(["one", "two", "rep"]).take(pa.array(some))
        rep = np.asarray(nodes["rep"])
        near = pa.array(rep[parent[some].clip(0)], pa.int64(), mask=parent[some] < 0)
        return picked.append_column("near", near).append_column("links", pa.array(links[some]))

    return run


def _led(turns: dict[int, np.ndarray]):
    """Adds the box coordinates and the norm of the others."""

    def run(batches):
        for batch in batches:
            for part, x in runs(batch, "v"):
                y = _rotated(x, turns)
                lead = np.zeros((len(y), BOX))
                lead[:, : y.shape[1]] = y[:, :BOX]
                rest = np.sqrt((y[:, BOX:] ** 2).sum(axis=1))
                columns = [*part.columns, pa.array(lead.tolist(), pa.list_(pa.float64())), pa.array(rest)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "lead", "rest"])

    return run


def _cut(size: int):
    """Adds the number of the tile in the task to rows sorted by label and number of components."""

    def run(batches):
        tile, held, last = -1, 0, None
        for batch in batches:
            keys = list(zip(column_of(batch, "label").to_pylist(), column_of(batch, "d").to_pylist()))
            out = np.empty(len(keys), np.int64)
            for k, key in enumerate(keys):
                if tile < 0 or key != last or held == size:
                    tile, held, last = tile + 1, 0, key
                out[k] = tile
                held += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "nth"])

    return run


def _reach(a: str, b: str) -> Column:
    """Bound of every product of a vector of one box with one of another."""
    sides = ", ".join(f"{a}.{p}[i] * {b}.{q}[i]" for p in ("lo", "hi") for q in ("lo", "hi"))
    return F.expr(f"aggregate(sequence(0, {BOX - 1}), {a}.rest * {b}.rest, (s, i) -> s + greatest({sides}))")


def _box(keys: list[str], rows: DataFrame, lead: str | None = None) -> DataFrame:
    """Boxes of groups of rows, of vectors (``lead``) or of boxes."""
    low = [F.min(F.col(lead or "lo")[i]) for i in range(BOX)]
    high = [F.max(F.col(lead or "hi")[i]) for i in range(BOX)]
    return rows.groupBy(*keys).agg(F.array(*low).alias("lo"), F.array(*high).alias("hi"), F.max("rest").alias("rest"))


def tile_pairs(tiles: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), a <= b, of tiles of one label whose boxes allow a product of ``least``. tiles: label, d, tile, lo, hi, rest."""
    last = tiles.agg(F.max("tile")).first()[0] or 0
    levels = [tiles.withColumnRenamed("tile", "node")]
    while (last := last // FAN) >= TOP // FAN and last:
        up = _box(["label", "d", "node"], levels[-1].withColumn("node", F.floor(F.col("node") / FAN).cast("bigint")))
        levels.append(written(up, "nodes"))
    pairs = None
    for nodes in reversed(levels):
        a, b = nodes.alias("p"), nodes.alias("q")
        same = (F.col("p.label") == F.col("q.label")) & (F.col("p.d") == F.col("q.d"))
        below = (F.col("p.node") <= F.col("q.node")) & (_reach("p", "q") >= least - NEAR)
        if pairs is None:
            found = a.join(b, same & below)
        else:
            parent = lambda side: F.floor(F.col(f"{side}.node") / FAN).cast("bigint")
            left = pairs.alias("w").join(a, (F.col("w.label") == F.col("p.label")) & (F.col("w.d") == F.col("p.d")) & (F.col("w.a") == parent("p")))
            found = left.join(b, same & (F.col("w.b") == parent("q")) & below)
        pairs = found.select("p.label", "p.d", F.col("p.node").alias("a"), F.col("q.node").alias("b"))
        pairs = written(pairs, "pairs")
    return pairs


def near_vectors(rows: DataFrame, least: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label", tile: int = TILE) -> DataFrame:
    """One row for each row given: the id, n_links (rows linked directly), component_id (least id reachable) and kept.

    Rows of one label with a cosine of ``least`` or more are linked (0 < least <= 1). A row is linked with nothing, and is
    kept, if its id or label is null, its vector is null, empty or zero or holds a null or non-finite component; vectors of different
    lengths are not compared. Without an id the component is null. Rows that share an id count one by one as links
    and are one node of the components. Other columns are left alone; an empty table gives an empty one.
    """
    plain = rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    sound = finite("v") & F.exists("v", lambda x: x != 0) & F.col("label").isNotNull() & F.col("id").isNotNull()
    # 128 bits stand for a label and vector
    marked = plain.withColumn("ok", F.coalesce(sound, F.lit(False))).withColumns(
        {"one": F.when(F.col("ok"), F.xxhash64("label", "v")), "two": F.when(F.col("ok"), F.xxhash64(F.lit(1), "v", "label"))}
    )
    classes = marked.filter("ok").groupBy("one", "two").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    classes = written(classes.withColumn("d", F.size("v")), "classes")
    turns = {d: axes(m[:d, :d]) for d, m in products(classes, "v", True).items()}
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    led = classes.mapInArrow(_led(turns), f"{schema}, lead array<double>, rest double")
    # cells with a side of about half the distance that the threshold allows
    side = max((2 - 2 * least) ** 0.5 / 2, 1e-3)
    cells = [F.floor(F.col("lead")[i] / side) for i in range(SORTED)]
    order = ["label", "d", *cells, "one", "two"]
    sorted_ = led.repartitionByRange(*order).sortWithinPartitions(*order)
    schema += ", lead array<double>, rest double"
    cut = sorted_.mapInArrow(_cut(tile), f"{schema}, nth bigint").withColumn("part", F.spark_partition_id())
    cut = written(cut, "tiles")
    # one row a task: where its tiles begin in the numbering of all
    ends = cut.groupBy("part").agg((F.max("nth") + 1).alias("c")).orderBy("part").collect()
    starts = np.cumsum([0, *(r["c"] for r in ends)]).tolist()
    begins = rows.sparkSession.createDataFrame([(r["part"], s) for r, s in zip(ends, starts)], "part int, begin bigint")
    cut = cut.join(begins, "part").withColumn("tile", F.col("begin") + F.col("nth"))
    tiles = written(_box(["label", "d", "tile"], cut, "lead"), "boxes")
    pairs = tile_pairs(tiles, least).select("a", "b")
    dealt = pairs.withColumn("tile", F.explode(F.array_distinct(F.array("a", "b"))))
    dealt = cut.select("tile", "one", "two", "rep", "n", "v").join(dealt, "tile")
    found = dealt.groupBy("a", "b").applyInArrow(_compared(turns, least), "one bigint, two bigint, rep bigint, near bigint, links bigint")
    found = written(found, "links")
    edges = found.filter("near is not null").select(F.col("rep").alias("u"), F.col("near").alias("v"))
    # an id on several rows joins the classes of these
    again = marked.filter("ok").groupBy("id").agg(F.count("*").alias("c")).filter("c > 1")
    twice = marked.filter("ok").join(again, "id", "left_semi").join(classes.select("one", "two", "rep"), ["one", "two"])
    twice = twice.filter("id != rep").select(F.col("id").alias("u"), F.col("rep").alias("v")).distinct()
    roots = components(edges.unionByName(twice)).select(F.col("node").alias("rep"), "root")
    counts = found.groupBy("one", "two").agg(F.sum("links").alias("links"))
    known = classes.select("one", "two", "rep", "n").join(counts, ["one", "two"], "left").join(roots, "rep", "left")
    known = known.select(
        "one", "two", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id")
    )
    # written, so that a class with many copies can be split in the join
    known = written(known, "known")
    return (
        marked.select("id", "one", "two")
        .join(known, ["one", "two"], "left")
        .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )
