"""The two input tables: messages and channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas as S


# Parsing costs far more than reading, and JSON compresses well: small row groups (compressed bytes) let several
# tasks share a file of messages.
_ROW_GROUP = {"parquet.block.size": str(8 * 1024 * 1024)}


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A stored message table. The schema is given: folder values are text even where they look like numbers."""
    return spark.read.schema(S.MESSAGES).parquet(path)


def write_messages(messages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store messages by topic, sorted by recording and time so that row groups can be skipped.

    Rebalancing splits a topic that outgrows one file and merges small ones.
    """
    (
        messages.hint("rebalance", "topic")
        .sortWithinPartitions("topic", "recording", "log_time_ns")
        .write.mode(mode)
        .options(**_ROW_GROUP)
        .partitionBy("topic")
        .parquet(path)
    )


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.CHANNELS).parquet(path)


# Characters that are escaped in the name of a partition folder.
_ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(32)}


# Fixed value: the folder of an empty or null partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_name(value: str | None) -> str:
    """A partition value as it appears in its folder."""
    if not value:
        return _NO_VALUE
    return "".join(f"%{ord(ch):02X}" if ch in _ESCAPED else ch for ch in value)


def file_stem(file_name: Column) -> Column:
    """Name of a file without its last extension."""
    return F.when(file_name.rlike(r"^.+\.[^.]*$"), F.regexp_extract(file_name, r"^(.+)\.[^.]*$", 1)).otherwise(file_name)


def sequence_name(file_name: Column, given: Column | None = None) -> Column:
    """The given name, or the stem of the file when none is given."""
    stem = file_stem(file_name)
    return stem if given is None else F.coalesce(F.nullif(given, F.lit("")), stem)
