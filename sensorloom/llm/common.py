"""What several operators share: columns picked by name, batches in slices, null texts as empty ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records sent to a Python worker at once; texts of thousands of words make larger batches needlessly big.
BATCH_RECORDS = 500


def prepare(spark: SparkSession) -> None:
    """Batches of bounded size for the jobs of this folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_RECORDS))


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the split into folds. A null id counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes together (one row at least)."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
    piece = (np.cumsum(sizes) - 1).clip(0) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
