"""Integer k-means with exact results, its distances filtered in PCA-rotated coordinates.

Vectors become integers, floor(scale * x), and all that decides is integer arithmetic: distances, sums, floors. The
rotation only saves work: of every vector the leading principal coordinates and the norm of the rest are stored once. For a
centroid, the distance of the leading coordinates plus the squared difference of the rest norms is never more than the true
distance, so a centroid whose bound lies above the best verified distance is left alone; all others are verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of
from sensorloom.llm.vectors import axes, finite, products, runs
from sensorloom.session import written

#: Leading coordinates that are stored.
LEAD = 16
#: Greatest integer component: squared distances of 64 components stay within 64 bits.
GREATEST = 1 << 27
#: Relative slack of the bounds for what doubles round off.
SLACK = 1e-9


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in runs(batch, "v"):
                whole = np.floor(scale * x).astype(np.int32)
                yield pa.RecordBatch.from_arrays([column_of(part, "id"), _lists(whole, pa.int32())], ["id", "v"])

    return run


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), kind))


def _lead(x: np.ndarray, mean: np.ndarray, turn: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    y = x.astype(np.float64) if turn is None else (x - mean) @ turn
    return y[:, :LEAD], np.sqrt((y[:, LEAD:] ** 2).sum(axis=1))


def _rotated(mean: np.ndarray, turn: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in runs(batch, "v"):
                lead, rest = _lead(x, mean, turn)
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(lead, pa.float64()), pa.array(rest)], ["id", "v", "lead", "rest"])

    return run


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of every row of integers ``x`` (ties: the smaller number), and
    how many distances were verified."""
    bound = ((lead * lead).sum(axis=1)[:, None] - 2 * lead @ c_lead.T + (c_lead * c_lead).sum(axis=1)) + (rest[:, None] - c_rest) ** 2
    size = (lead * lead).sum(axis=1)[:, None] + (c_lead * c_lead).sum(axis=1) + rest[:, None] ** 2 + c_rest**2
    bound -= SLACK * size + 1e-6
    rows = np.arange(len(x))

    def exact(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        off = x[r] - centroids[c]
        return (off * off).sum(axis=1)

    number = bound.argmin(axis=1)
    distance = exact(rows, number)
    tried = len(x)
    first = number.copy()
    for c in range(len(centroids)):
        r = np.flatnonzero((bound[:, c] <= distance) & (first != c))
        tried += len(r)
        d = exact(r, np.full(len(r), c))
        better = (d < distance[r]) | ((d == distance[r]) & (c < number[r]))
        distance[r[better]], number[r[better]] = d[better], c
    return number, distance, tried


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part, x in runs(batch, "v"):
            lead = np.array(column_of(part, "lead").flatten()).reshape(len(x), -1)
            yield part, x.astype(np.int64), lead, np.array(column_of(part, "rest"))


def _partial(centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray):
    """Count and sums of the vectors of every centroid, one row a centroid for the whole task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for _, x, lead, rest in _pieces(batches):
            number, _, _ = nearest(x, lead, rest, centroids, c_lead, c_rest)
            counts += np.bincount(number, minlength=k)
            for c in np.unique(number):
                sums[c] += x[number == c].sum(axis=0)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), _lists(sums[some], pa.int64())], ["cluster", "n", "sums"])

    return run


def _assigned(centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, lead, rest in _pieces(batches):
            number, distance, _ = nearest(x, lead, rest, centroids, c_lead, c_rest)
            yield pa.RecordBatch.from_arrays([column_of(part, "id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return run


def centroid_clusters(rows: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each vector that counts: id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    Vectors count that have exactly ``size`` components, none of them null or non-finite; others, null ones included, have
    no row. Components at or beyond 131,072 (with the usual scale) would overflow the distances: such vectors do not
    count either. The first centroids are the ``k`` vectors with the smallest sha256 of ``<seed>:<id>`` (a null id is
    empty text there; of equal ids the lesser vector comes first); fewer vectors give fewer centroids, none give no row.
    Repeated rows count as often as they are there. Other columns are left alone. An inertia beyond 64 bits is null.
    """
    spark = rows.sparkSession
    limit = F.lit(float(GREATEST) / scale)
    plain = rows.select(F.col(key).alias("id"), F.col(vector).alias("v"))
    sound = plain.filter(finite("v") & (F.size("v") == size) & F.forall("v", lambda x: F.abs(x) < limit))
    kind = plain.schema["id"].dataType.simpleString()
    whole = written(sound.mapInArrow(_integers(scale), f"id {kind}, v array<int>"), "integers")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = whole.select(order.alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    last = f"id {kind}, cluster int, distance bigint"
    if not first:
        none = spark.createDataFrame([], f"{last}, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
        return none.withColumnRenamed("id", key)
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), size)
    mean, turn = np.zeros(size), None
    for moments in products(whole, "v", False).values():  # none for very long vectors, whose axes are taken as they are
        n, mean = moments[size, size], moments[:size, size] / moments[size, size]
        turn = axes(moments[:size, :size] / n - np.outer(mean, mean))
    data = written(whole.mapInArrow(_rotated(mean, turn), f"id {kind}, v array<int>, lead array<double>, rest double"), "rotated")
    for _ in range(rounds):
        partial = data.mapInArrow(_partial(centroids, *_lead(centroids, mean, turn)), "cluster bigint, n bigint, sums array<bigint>")
        # k rows: sums of 64-bit integers, exact
        sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)]
        before = centroids.copy()
        for r in partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*sums).alias("sums")).collect():
            centroids[r["cluster"]] = [s // r["n"] for s in r["sums"]]
        if (centroids == before).all():
            break  # further rounds would change nothing
    schema = f"id {kind}, cluster int, distance bigint"
    found = written(data.mapInArrow(_assigned(centroids, *_lead(centroids, mean, turn)), schema), "assigned")
    total = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    named = {r["cluster"]: int(r["d"]) for r in total}
    fits = lambda x: x if x < 1 << 63 else None
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def by_cluster(values: list, kind: str):
        """A column with the value of the row's cluster; there are k of them."""
        return reduce(lambda e, p: e.when(F.col("cluster") == p[0], F.lit(p[1]).cast(kind)), enumerate(values), F)

    return found.select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        by_cluster([fits(named.get(c, 0)) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(fits(sum(named.values()))).cast("bigint").alias("inertia"),
        by_cluster(marks, "string").alias("centroid_sha256"),
    )
