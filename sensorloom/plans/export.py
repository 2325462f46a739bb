"""Tables back to messages, and sequences to files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.text import sanitize_name
from sensorloom.operators.definitions import json_schema
from sensorloom.operators.sequence import number_rows
from sensorloom.plans.store import SequenceStore
from sensorloom.sources.messages import folder_name


def time_column(columns: list[str]) -> str | None:
    """The column that becomes the log time of a message."""
    return next((c for c in ("timestamp_ns", "recording_timestamp_ns") if c in columns), None)


def log_time(df: DataFrame) -> Column:
    name = time_column(df.columns)
    return F.lit(0).cast("bigint") if name is None else F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def cell_to_json(column: Column, data_type: T.DataType) -> Column:
    """A cell as it enters the body: floats widen, numbers JSON cannot hold and bytes become null, at any depth."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        wide = column.cast("double")
        return F.when(~F.isnan(wide) & (F.abs(wide) != float("inf")), wide)
    if isinstance(data_type, T.BinaryType):
        return F.lit(None).cast("string")
    if isinstance(data_type, T.StructType) and _needs_care(data_type):
        cells = [cell_to_json(column.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*cells))
    if isinstance(data_type, T.ArrayType) and _needs_care(data_type):
        return F.transform(column, lambda e: cell_to_json(e, data_type.elementType))
    if isinstance(data_type, T.MapType) and _needs_care(data_type.valueType):
        return F.transform_values(column, lambda _, v: cell_to_json(v, data_type.valueType))
    return column


def _needs_care(data_type: T.DataType) -> bool:
    """Whether a float or bytes stand anywhere inside."""
    if isinstance(data_type, T.StructType):
        return any(_needs_care(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _needs_care(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _needs_care(data_type.valueType)
    return isinstance(data_type, (T.FloatType, T.DoubleType, T.BinaryType))


def scalar_to_json(column: Column, data_type: T.DataType) -> Column:
    """As ``cell_to_json`` with every non-scalar null."""
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast("string")
    return cell_to_json(column, data_type)


def json_body(df: DataFrame, leave_out: list[str], cell=cell_to_json) -> Column:
    """JSON object of all columns but the chosen time column; nulls are written."""
    skip = set(leave_out) | {time_column(df.columns)}
    cells = [cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if f.name not in skip]
    if not cells:
        return F.lit("{}")
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def to_messages(
    rows: DataFrame, recording: str | Column, topic: str | Column, order: list[str] | None = None, cell=cell_to_json,
    leave_out: list[str] | None = None,
) -> DataFrame:
    """Rows of one or many topics as JSON messages with a sequence number per topic.

    Rows of equal time are ordered by ``order``, then by body; rows equal in all of it are the same message.
    """
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    hidden = [*(order or []), *(leave_out or [])]
    messages = rows.select(
        as_column(recording).alias("recording"),
        as_column(topic).alias("topic"),
        log_time(rows).alias("log_time_ns"),
        *[F.col(c) for c in order or []],
        json_body(rows, hidden, cell).alias("body"),
    )
    numbered = number_rows(messages, ["recording", "topic"], ["log_time_ns", *(order or []), "body"], "sequence")
    return numbered.select(
        "recording",
        "topic",
        "log_time_ns",
        F.col("log_time_ns").alias("publish_time_ns"),
        "sequence",
        F.col("body").cast("binary").alias("payload"),
    )


def table_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type) of the tables at hand."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "`table` string, `column` string, type string")


def export_channels(recording: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Channel rows of exported topics: JSON encoding, JSON Schema, schema named like the topic."""
    schemas = json_schema(table_columns(tables))
    numbered = schemas.sparkSession.createDataFrame(
        [(name, i) for i, name in enumerate(tables, start=1)], "`table` string, channel_id int"
    )
    return schemas.join(numbered, "table").select(
        F.lit(recording).alias("recording"),
        "channel_id",
        F.col("table").alias("topic"),
        F.lit("json").alias("encoding"),
        F.col("channel_id").alias("schema_id"),
        F.col("table").alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
        F.col("json_schema").alias("schema_data"),
    )


def write_recording(path: str, recording: str, tables: dict[str, DataFrame]) -> None:
    """Store tables, one per topic, as a recording: messages and channels."""
    channels = export_channels(recording, tables)
    for topic, rows in tables.items():
        to_messages(rows, recording, topic).drop("topic").sortWithinPartitions("log_time_ns", "sequence").write.mode(
            "errorifexists"
        ).parquet(f"{path}/messages/topic={folder_name(topic)}")
    channels.write.mode("errorifexists").parquet(f"{path}/channels")


def export_sequence(store: SequenceStore, sequence: str, out_dir: str, file_format: str = "parquet") -> list[str]:
    """One folder per topic; topics without rows are left out; nothing written is an error.

    Topics whose names give the same folder are refused before anything is written.
    """
    if file_format != "parquet":
        raise ValueError(f"unknown format {file_format!r}; valid: parquet")
    named = store.list_topics(sequence).select("topic", sanitize_name(F.col("topic")).alias("name"), "rows")
    topics = named.where("rows > 0").orderBy("topic").collect()
    folders: dict[str, str] = {}
    for topic in topics:
        other = folders.setdefault(topic["name"], topic["topic"])
        if other != topic["topic"]:
            raise ValueError(f"{other!r} and {topic['topic']!r} would share the folder {topic['name']!r}")
    written = []
    for topic in topics:
        path = f"{out_dir}/{topic['name']}"
        store.pull_topic(sequence, topic["topic"]).write.mode("errorifexists").parquet(path)
        written.append(path)
    if not written:
        raise LookupError(f"{sequence!r} has no topic with rows")
    return written


MANIFEST = "sequence string, topic string, tag string, folder string, rows bigint"


def export_by_tag(store: SequenceStore, sequences: list[str], out_dir: str) -> DataFrame:
    """Topics of many sequences as Parquet, one job for each tag whatever the number of topics. Returns the manifest.

    A tag is one table, its rows clustered and sorted by sequence and topic, so the number of files does not grow with the
    number of sequences; the manifest says which folder holds which topic. It is written last, so an export without one did
    not end: nothing is renamed or moved. Topics without rows are left out, and nothing
    written is an error. Topics of a tag whose columns differ by topic keep their body as a variant, with the columns of
    each in the catalogue.
    """
    wanted = store.spark.createDataFrame([(s,) for s in sequences], "sequence string")
    topics = store.topic_log().where("status = 'uploaded' and rows > 0").join(wanted, "sequence", "left_semi")
    tables = topics.groupBy("key", "tag").agg(F.min("table_schema").alias("table_schema")).collect()
    if not tables:
        raise LookupError(f"no topic with rows in {sequences}")
    manifest = None
    for row in tables:
        rows = store.read_tag(row["key"], row["tag"], schema=store.stored_schema(row["table_schema"])).join(wanted, "sequence", "left_semi")
        folder = f"{row['key']}/{row['tag']}"
        (
            rows.withColumnsRenamed({"sequence": "of_sequence", "topic": "of_topic"})
            .repartition("of_sequence", "of_topic")
            .sortWithinPartitions("of_sequence", "of_topic", "timestamp_ns")
            .write.mode("errorifexists").parquet(f"{out_dir}/{folder}")
        )
        mine = topics.where((F.col("key") == row["key"]) & (F.col("tag") == row["tag"]))
        mine = mine.select("sequence", "topic", "tag", F.lit(folder).alias("folder"), "rows")
        manifest = mine if manifest is None else manifest.unionByName(mine)
    manifest.write.mode("errorifexists").parquet(f"{out_dir}/{_MANIFEST}")
    return store.spark.read.schema(MANIFEST).parquet(f"{out_dir}/{_MANIFEST}")


_MANIFEST = "_export_manifest"


def read_exported(spark: SparkSession, out_dir: str, sequence: str, topic: str) -> DataFrame:
    """Rows of an exported topic: its tag's table, filtered to it."""
    try:
        # a name with an underscore is no data of the folders beside it, but is read when asked for
        manifest = spark.read.schema(MANIFEST).parquet(f"{out_dir}/{_MANIFEST}")
        found = manifest.where((F.col("sequence") == sequence) & (F.col("topic") == topic)).select("folder").distinct().collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise LookupError(f"no finished export in {out_dir}") from None
    if not found:
        raise LookupError(f"no such topic: {sequence}/{topic}")
    mine = (F.col("of_sequence") == sequence) & (F.col("of_topic") == topic)
    parts = [spark.read.parquet(f"{out_dir}/{r['folder']}").where(mine).drop("of_sequence", "of_topic") for r in found]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows
