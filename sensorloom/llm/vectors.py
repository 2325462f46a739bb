"""What the operators on vectors share: which vectors count, matrices out of Arrow batches, principal axes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of

#: Vectors of more components than this are not rotated: the axes would need their square in memory.
AXES = 2048
#: Numbers of components for which axes are sought: the most frequent ones. Axes only speed things up.
KINDS = 4
#: Rows of a batch taken at once, so that scratch arrays stay small.
ROWS = 4096


def finite(column: str) -> Column:
    """Whether the array is there and all its components are, too, as finite numbers."""
    c = F.col(column)
    sound = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & sound, F.lit(False))


def runs(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batch in runs of rows whose arrays have one length, each with its matrix of doubles. No array may be null."""
    for first in range(0, batch.num_rows, ROWS):
        part = batch.slice(first, ROWS)
        vectors = column_of(part, column)
        lengths = np.diff(vectors.offsets.to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), part.num_rows]
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        at = np.concatenate([[0], np.cumsum(lengths)])
        for a, b in zip(cuts, cuts[1:]):
            yield part.slice(a, b - a), flat[at[a] : at[b]].reshape(b - a, lengths[a])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, of rows that are not zero. Scaled first: squares of huge or tiny numbers would be lost."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _products(column: str, direction: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in runs(batch, column):
                d = x.shape[1]
                if not 0 < d <= AXES:
                    continue
                x = np.column_stack([unit(x) if direction else x, np.ones(len(x))])
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d + 1, d)), pa.array(np.arange(d + 1)), pa.array(m.tolist(), pa.list_(pa.float64()))], ["d", "i", "row"]
            )

    return run


def _summed(group: pa.Table) -> pa.Table:
    rows = np.array(group["row"].to_pylist())
    return pa.table({"d": group["d"][:1], "i": group["i"][:1], "row": pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.float64()))})


def products(rows: DataFrame, column: str, direction: bool) -> dict[int, np.ndarray]:
    """Sums of outer products of the vectors (x, 1), by number of components; ``direction``: of vectors of length one.

    Each task adds up its own, one row for each row of the matrix is shuffled. The driver gets KINDS matrices at most, of
    (AXES + 1) squared numbers at most.
    """
    schema = "d bigint, i bigint, row array<double>"
    added = rows.select(column).mapInArrow(_products(column, direction), schema).groupBy("d", "i").applyInArrow(_summed, schema)
    last = added.filter("i = d").select("d", F.element_at("row", -1).alias("n"))
    usual = last.orderBy(F.desc("n"), "d").limit(KINDS).select("d")
    found: dict[int, list] = {}
    for r in added.join(F.broadcast(usual), "d").collect():
        found.setdefault(r["d"], []).append((r["i"], r["row"]))
    return {d: np.array([row for _, row in sorted(m)]) for d, m in found.items()}


def axes(matrix: np.ndarray) -> np.ndarray:
    """Orthonormal columns along which the symmetric matrix is diagonal, that of the greatest share first."""
    return np.ascontiguousarray(np.linalg.eigh(matrix)[1][:, ::-1])
