"""Tag ``raw`` as rows of a store: topics of any columns in one table.

A job for every topic would not scale with their number, and one table cannot have the columns of all. So the body is kept
as a variant, which Parquet stores typed, and the columns of each topic are logged with it (``readable_fields``). A pull
reads the logged columns from the variant.
"""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.fields import leaf_sql, variant_sql
from sensorloom.operators.catalogue import Path, field_catalogue, has_mixed, loose_body, readable_fields
from sensorloom.operators.decode import decode_json

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TAG = "raw"

#: Name of the column that holds all fields of a topic with too many of them.
ALL_FIELDS = "fields"

# Names of the columns that every pulled row has besides the fields of its topic.
_TIMES = ("timestamp_ns", "_log_time_ns")


@F.pandas_udf(T.BooleanType())
def _mixed(body: pd.Series) -> pd.Series:
    """Bodies are null (the usual case) where their shape shows that no array is mixed."""
    return pd.Series([has_mixed(text) for text in body], dtype=bool)


def raw_rows(messages: DataFrame, keep: list[str]) -> DataFrame:
    """Times, the body as a variant and the reject reason of JSON messages."""
    decoded = decode_json(messages)
    loose = decoded.select("*", F.inline(F.array(F.struct(loose_body().alias("_loose")))))
    reason = F.coalesce("reject_reason", F.when(F.coalesce(_mixed("_loose"), F.lit(False)), "mixed_array"))
    return loose.select(
        *keep,
        F.col("log_time_ns").alias("timestamp_ns"),
        F.col("log_time_ns").alias("recording_timestamp_ns"),
        F.when(F.col("reject_reason").isNull(), F.col("body")).alias("body"),
        reason.alias("reject_reason"),
    )


def logged_fields(rows: DataFrame) -> DataFrame:
    """sequence, topic and ``fields`` (JSON: path and kind of each column) of stored raw rows."""
    keys = ["sequence", "topic"]
    fields = readable_fields(field_catalogue(rows, keys), keys)
    # at most ``catalogue.FIELDS`` columns for a topic
    columns = F.array_sort(F.collect_list(F.struct("path", "kind")))
    return fields.groupBy(*keys).agg(F.to_json(columns).alias("fields"))


def field_columns(fields: list[dict]) -> list[tuple[str, str]]:
    """Name and SQL of the columns of a topic from the variant ``body``, sorted by name.

    Where two fields have one name (``a.b`` as a key, and b inside a) the nested one is meant. A name that the times have
    gets a mark at its end."""
    found: dict[str, tuple[Path, str]] = {}
    for path, kind in sorted(((tuple(f["path"]), f["kind"]) for f in fields), key=lambda f: len(f[0])):
        name = ".".join(path) or ALL_FIELDS
        while name in _TIMES:
            name += "_"
        found[name] = (path, kind)
    return [(name, variant_sql(kind, leaf_sql("body", path))) for name, (path, kind) in sorted(found.items())]


def columns_of(stored: DataFrame, fields: str | None) -> DataFrame:
    """Stored rows with the logged columns of their topic: the event time, then all others, the log time among them, by name."""
    columns = [*field_columns(json.loads(fields or "[]")), ("_log_time_ns", "recording_timestamp_ns")]
    return stored.select("sequence", "timestamp_ns", *[F.expr(sql).alias(name) for name, sql in sorted(columns)])


#: Columns of the stored table.
STORED = T.StructType(
    [
        T.StructField("sequence", T.StringType()),
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("recording_timestamp_ns", T.LongType()),
        T.StructField("body", T.VariantType()),
    ]
)

