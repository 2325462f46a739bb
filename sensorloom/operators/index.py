"""Index of recordings: channels with counts, recordings with totals and time range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topic_scan(messages: DataFrame, topic: str) -> DataFrame:
    """Messages of one topic; a partition filter on a table laid out by topic."""
    return messages.where(F.col("topic") == topic)


def message_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("recording", "channel_id").agg(F.count("*").alias("message_count"))


def with_counts(channels: DataFrame, counts: DataFrame) -> DataFrame:
    return channels.join(counts, ["recording", "channel_id"], "left").withColumn(
        "message_count", F.coalesce("message_count", F.lit(0).cast("bigint"))
    )


def channel_index(channels: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per channel with its message count, 0 for a channel without messages."""
    return with_counts(channels, message_counts(messages))


def recording_summary(messages: DataFrame) -> DataFrame:
    return messages.groupBy("recording").agg(
        F.count("*").alias("total_messages"),
        F.min("log_time_ns").alias("start_time_ns"),
        F.max("log_time_ns").alias("end_time_ns"),
    )


def file_figures(stored: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Rows, time range and bytes per key and file of a stored table, in one scan of the key and time columns.

    A file shared by several keys counts for each by its rows.
    """
    per_file = stored.groupBy(
        *keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("rows"), F.min(time).alias("ts_min"), F.max(time).alias("ts_max"))
    share = F.col("size") * F.col("rows") / F.sum("rows").over(Window.partitionBy("file"))
    return per_file.withColumn("bytes", share).drop("size")


def figures_of(files: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, time range and bytes per key of figures by file."""
    return files.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.min("ts_min").alias("ts_min"),
        F.max("ts_max").alias("ts_max"),
        F.round(F.sum("bytes")).cast("bigint").alias("bytes"),
    )


def stored_figures(stored: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Rows, time range and bytes per key of a stored table, in one scan of the key and time columns."""
    return figures_of(file_figures(stored, keys, time), keys)


def recording_summary_with_size(stored_messages: DataFrame) -> DataFrame:
    """``recording_summary`` of a stored table, with file bytes."""
    figures = stored_figures(stored_messages, ["recording"], "log_time_ns")
    return figures.withColumnsRenamed(
        {"rows": "total_messages", "ts_min": "start_time_ns", "ts_max": "end_time_ns"}
    )


def progress_totals(good: DataFrame) -> DataFrame:
    """Rows and payload bytes processed."""
    return good.groupBy("recording", "topic").agg(
        F.count("*").alias("rows"), F.sum(F.length("payload").cast("bigint")).alias("bytes")
    )


def percent_done(done, total):
    """round(100 * done / total) within 0..100; 0 when the total is 0."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), done / total))
    return F.when(total > 0, F.round(share * 100)).otherwise(F.lit(0.0)).cast("int")


def bytes_per_second(size, seconds):
    """Whole bytes per second; 0 while the time is too short to tell."""
    return F.when(seconds > 0.1, F.floor(size / seconds)).otherwise(F.lit(0)).cast("bigint")
