"""Collecting queries and what they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.fields import LeafFields
from sensorloom.operators.extract import extract, wants_of
from sensorloom.operators.flatten import flatten_structs
from sensorloom.operators.ontology import project_json
from sensorloom.session import configure
from sensorloom.sources.bridges import as_messages, load, micros_to_ns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Events with k and ns, for the SQL side.
EV = "ev AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) * 1000 AS ns FROM events)"
# What event messages are good: error messages are broken for the last digits 0 and 1.
GOOD_EVENT = "NOT (event_type = 'error' AND event_id % 10 IN (0, 1))"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL."""

    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def messages_from(
    spark: SparkSession, sf_dir: str, table: str, payload: Column, ns: Column, sequence: Column, topic: Column | None = None
) -> DataFrame:
    """A table as JSON messages of one recording."""
    rows = load(spark, sf_dir, table)
    return as_messages(rows, F.lit(table), F.lit(1), F.lit(f"/{table}") if topic is None else topic, ns, sequence, payload)


def lines(spark: SparkSession, sf_dir: str, payload: Column) -> DataFrame:
    return messages_from(
        spark, sf_dir, "lineitem", payload, micros_to_ns("l_shipdate"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    )


def orders(spark: SparkSession, sf_dir: str, payload: Column) -> DataFrame:
    return messages_from(spark, sf_dir, "orders", payload, micros_to_ns("o_orderdate"), F.col("o_orderkey"))


def with_fields(messages: DataFrame, read, keep: tuple[str, ...] = ("sequence",)) -> DataFrame:
    """Columns computed by ``read(fields)`` from the extracted leaves of JSON messages."""
    columns = read(LeafFields(F.col("log_time_ns")))
    return extract(messages, wants_of(read)).select(*keep, *[c.alias(n) for n, c in columns.items()])


def scalars_of(df: DataFrame, *paths: str) -> DataFrame:
    """Chosen leaves of a nested table as scalar columns: a.b gives a_b; a.b# its size, a.b@ its first element."""
    flat = flatten_structs(df, keep_shape=True)
    picked = []
    for path in paths:
        if path.endswith("#"):
            picked.append(F.size(F.col(f"`{path[:-1]}`")).alias(path[:-1].replace(".", "_") + "_n"))
        elif path.endswith("@"):
            picked.append(F.get(F.col(f"`{path[:-1]}`"), F.lit(0)).alias(path[:-1].replace(".", "_") + "_0"))
        else:
            picked.append(F.col(f"`{path}`").alias(path.replace(".", "_")))
    return flat.select(*picked)


def projected(messages: DataFrame, tag: str, *paths: str) -> DataFrame:
    """Good rows of a projection with chosen leaves."""
    rows = project_json(messages, tag, keep=["sequence"]).where(F.col("reject_reason").isNull())
    return scalars_of(rows, "sequence", *paths)
