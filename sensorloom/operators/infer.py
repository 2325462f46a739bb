"""Tables from JSON topics whose fields are not known beforehand.

Two passes over one topic: the catalogue of its fields (``operators.catalogue``), then a select built from it. The driver
gets the columns of the table, which are bounded; an object with too many members is one map column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.fields import leaf_name
from sensorloom.operators.catalogue import FIELDS, field_catalogue, readable_fields
from sensorloom.operators.decode import decode_json, good_rows, sample_first
from sensorloom.operators.extract import Path, Wants, extract
from sensorloom.operators.raw import ALL_FIELDS


def topic_kinds(messages: DataFrame, sample_rows: int | None = None, limit: int = FIELDS) -> dict[Path, str]:
    """Every field of a topic and how to read it, sorted by name: the first pass.

    With ``sample_rows``, only fields of the first messages by log time are found, as decoders do that ask for a sample.
    """
    if sample_rows is not None:
        messages = sample_first(messages, sample_rows)
    # one topic, whatever it is called
    decoded = good_rows(decode_json(messages)).select("body", F.lit("").alias("of"))
    found = readable_fields(field_catalogue(decoded, ["of"]), ["of"], limit).select("path", "kind").collect()
    kinds: dict[Path, str] = {}
    for path, kind in sorted(((tuple(r["path"]), r["kind"]) for r in found), key=lambda leaf: len(leaf[0])):
        name = ".".join(path)
        kinds.pop(next((p for p in kinds if ".".join(p) == name), None), None)
        kinds[path] = kind
    return dict(sorted(kinds.items(), key=lambda item: ".".join(item[0])))


def _wants(kinds: dict[Path, str]) -> Wants:
    return {path: {kind} for path, kind in kinds.items()}


def channel_table(messages: DataFrame, time_name: str = "timestamp_ns", sample_rows: int | None = None, limit: int = FIELDS) -> DataFrame:
    """One topic as a table: the log time first, then the union of all keys sorted by name.

    ``reject_reason`` stays with the rows. See ``topic_kinds`` for ``sample_rows``, ``readable_fields`` for ``limit``; a topic that is one
    map has it as ``fields``.
    """
    kinds = topic_kinds(messages, sample_rows, limit)
    leaves = extract(messages, _wants(kinds))
    return leaves.select(
        F.col("log_time_ns").alias(time_name),
        *[F.col(f"`{leaf_name(kind, path)}`").alias(".".join(path) or ALL_FIELDS) for path, kind in kinds.items()],
        "reject_reason",
    )


def raw_projection(messages: DataFrame) -> DataFrame:
    """Tag ``raw``: every column, the log time among them, sorted by name."""
    table = channel_table(messages, "_log_time_ns")
    names = sorted(c for c in table.columns if c != "reject_reason")
    return table.select(*[f"`{n}`" for n in names], "reject_reason")


def read_channel(messages: DataFrame) -> DataFrame:
    """``channel_table`` without the rejects."""
    return good_rows(channel_table(messages))
