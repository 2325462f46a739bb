"""Row numbers from 0 per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.session import scratch_dir


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str = "sequence", tasks: int | None = None) -> DataFrame:
    """``name`` counts the rows of each group from 0 in the given (total) order.

    Rows are range partitioned by (group, order), so that a large group is spread over many tasks, and written
    once with their position inside the sorted partition. The written table fixes the ranges: the counts taken
    from it fit the rows even when tasks are run again. What is joined back is one row per (partition, group).
    """
    path = scratch_dir(df.sparkSession, "numbered")
    (
        df.repartitionByRange(*([] if tasks is None else [tasks]), *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_position", F.monotonically_increasing_id())
        .write.mode("overwrite")
        .parquet(path)
    )
    placed = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_position", 33))
    parts = placed.groupBy("_part", *group).agg(F.min("_position").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    numbered = placed.join(offsets, ["_part", *group])
    return numbered.withColumn(name, F.col("_position") - F.col("_first") + F.col("_before")).select(
        *[c for c in df.columns if c != name], name
    )
