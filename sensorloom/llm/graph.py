"""Connected components of an edge table, with joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns node and root (the least node of its component) for every node of edges (u, v).

    Large and small stars in turn: every node hands its larger, then its smaller neighbours to the least of them,
    until nothing changes (a few rounds, as the distance to the root is about halved each time). A hub's edges are
    minima and joins, so no task holds a whole neighbourhood. Each round is written to the shared scratch folder.
    Loops and null ends are left out; an empty table gives an empty one.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = now.filter("u is not null and v is not null and u != v").distinct()
    now, before = written(now, "edges"), None
    state = _state(now)
    while state != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the join are dealt out anew and a hub's rows can be split over tasks
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = written(small.filter("u != v").distinct(), "edges")
        before, state = state, _state(now)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
