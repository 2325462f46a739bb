"""Reports over recordings and sequences, as tables with formatted columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.text import format_duration, format_file_size, format_timestamp_utc

_DASH = "—"


def recording_report(index: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per channel beside the figures of its recording.

    ``index`` is a channel index, ``summary`` a recording summary (bytes optional). The duration shows only
    when both times are above 0.
    """
    timed = (F.col("start_time_ns") > 0) & (F.col("end_time_ns") > 0)
    if "bytes" in summary.columns:
        summary = summary.withColumn("size", format_file_size(F.col("bytes")))
    figures = summary.withColumns(
        {
            "duration": F.when(timed, format_duration(F.col("end_time_ns") - F.col("start_time_ns"))),
            "start_utc": F.when(timed, format_timestamp_utc(F.col("start_time_ns"))),
            "end_utc": F.when(timed, format_timestamp_utc(F.col("end_time_ns"))),
        }
    )
    channels = index.groupBy("recording").agg(F.count("*").alias("channels"))
    return index.join(figures, "recording", "left").join(channels, "recording").select(
        "recording",
        *[c for c in ("size",) if c in figures.columns],
        "channels",
        "duration",
        "start_utc",
        "end_utc",
        "topic",
        "encoding",
        "message_count",
        "schema_name",
    )


def global_range(topics: DataFrame, keys: list[str]) -> DataFrame:
    """Range over topics; minima that are not above 0 do not count."""
    return topics.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(F.col("min_ts_ns") > 0, F.col("min_ts_ns"))), F.lit(0)).cast("bigint").alias("global_min"),
        F.greatest(F.coalesce(F.max("max_ts_ns"), F.lit(0)), F.lit(0)).cast("bigint").alias("global_max"),
        F.count("*").alias("topics"),
    )


def sequence_report(topics: DataFrame) -> DataFrame:
    """One row per topic (see ``SequenceStore.list_topics``) beside the range of its sequence."""
    ranges = global_range(topics, ["sequence"])
    known = (F.col("min_ts_ns") > 0) & (F.col("max_ts_ns") > 0)
    both = (F.col("global_min") > 0) & (F.col("global_max") > 0)
    fields = F.json_array_length(F.get_json_object("table_schema", "$.fields"))
    return topics.join(ranges, "sequence").select(
        "sequence",
        "topics",
        F.when(both, format_timestamp_utc(F.col("global_min"))).alias("start_utc"),
        F.when(both, format_timestamp_utc(F.col("global_max"))).alias("end_utc"),
        "topic",
        F.when(fields > 0, fields.cast("string")).otherwise(_DASH).alias("fields"),
        F.when(known, format_duration(F.col("max_ts_ns") - F.col("min_ts_ns"))).otherwise(_DASH).alias("duration"),
    )


def sequence_listing(names: DataFrame) -> DataFrame:
    """Sequence names beside their number."""
    return names.withColumn("sequences", F.lit(names.count()).cast("bigint"))


def detect_tag(columns: DataFrame) -> DataFrame:
    """Tag of each topic from its columns (topic, column, type); null when no rule holds."""
    has = lambda name: F.bool_or(F.col("column") == name)
    seen = columns.groupBy("topic").agg(
        *[has(n).alias(f"has_{n}") for n in _RULE_COLUMNS],
        F.bool_or((F.col("column") == "data") & (F.col("type") == "binary")).alias("binary_data"),
        F.count("*").alias("columns"),
    )
    tag = F
    for *names, result in _RULES:
        condition = F.lit(True)
        for name in names:
            condition = condition & F.col(f"has_{name}")
        tag = tag.when(condition, result)
    image = F.col("binary_data") & (F.col("columns") <= 3)
    sized = F.col("has_height") | F.col("has_width")
    tag = tag.when(image & sized, "image").when(image, "compressed_image")
    return seen.select("topic", tag.alias("tag"))


# Rules in the order they are tried, each a set of columns and a tag.
_RULES = [
    ("acceleration", "angular_velocity", "imu"),
    ("position", "status", "gps"),
    ("linear", "angular", "velocity"),
    ("position", "orientation", "pose"),
    ("translation", "rotation", "transform"),
    ("force", "torque", "force_torque"),
    ("sentence", "nmea_sentence"),
]
_RULE_COLUMNS = sorted({n for rule in _RULES for n in rule[:-1]} | {"height", "width"})
