"""ST: publishing from a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.registry import EV, query
from registered.sources import _once
from sensorloom.operators.ontology import default_registry
from sensorloom.plans.store import SequenceStore
from sensorloom.session import scratch_dir
from sensorloom.sources.bridges import event_channels, event_messages
from sensorloom.streaming.publish_stream import StreamPublisher, message_stream

c = F.col


def stream_events(spark, sf_dir, registry=None):
    """The event messages as a folder of files, streamed a few files at a time and published."""
    folder = scratch_dir(spark, "stream") + "/messages"
    event_messages(spark, sf_dir).repartition(6, "sequence").write.parquet(folder)
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    publisher = StreamPublisher(store, event_channels(spark, sf_dir), registry)
    publisher.start(message_stream(spark, folder, files_per_batch=2), scratch_dir(spark, "checkpoint"))
    counts = publisher.finish()
    return store, publisher, counts


def streamed(spark, sf_dir):
    return _once(spark, "streamed", sf_dir, lambda: stream_events(spark, sf_dir))


@query(
    "st1_micro_batches",
    f"""WITH {EV} SELECT ns AS timestamp_ns, ns AS recording_timestamp_ns, value AS acceleration_x, 'u' || user_id AS frame_id
        FROM ev WHERE event_type = 'click'""",
)
def st1(spark, sf_dir):
    store, *_ = streamed(spark, sf_dir)
    return store.pull_topic("events", "/click").select(
        "timestamp_ns", "recording_timestamp_ns", c("acceleration.x").alias("acceleration_x"), c("header.frame_id").alias("frame_id")
    )


@query(
    "st2_topics_of_stream",
    f"""SELECT '/' || event_type AS topic, CAST(SUM(CASE WHEN event_type = 'purchase' THEN GREATEST(event_id % 4, 1) ELSE 1 END) AS BIGINT) AS rows
        FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def st2(spark, sf_dir):
    store, *_ = streamed(spark, sf_dir)
    return store.list_topics("events").select("topic", "rows")


@query(
    "st1_restart",
    f"""WITH {EV} SELECT ns AS timestamp_ns, value AS acceleration_x FROM ev WHERE event_type = 'click'""",
)
def st1_restart(spark, sf_dir):
    """Half of the files, then a new publisher on the same upload and checkpoint for the rest."""

    def make():
        folder, checkpoint = scratch_dir(spark, "stream") + "/messages", scratch_dir(spark, "checkpoint")
        store, channels, messages = SequenceStore(spark, scratch_dir(spark, "store")), event_channels(spark, sf_dir), event_messages(spark, sf_dir)
        messages.where("sequence % 2 = 0").write.parquet(folder)
        before = StreamPublisher(store, channels)
        before.start(message_stream(spark, folder), checkpoint).awaitTermination()
        messages.where("sequence % 2 = 1").write.mode("append").parquet(folder)
        after = StreamPublisher.resume(store, before.upload.key, channels)
        after.start(message_stream(spark, folder), checkpoint)
        after.finish()
        return store

    store = _once(spark, "restarted", sf_dir, make)
    return store.pull_topic("events", "/click").select("timestamp_ns", c("acceleration.x").alias("acceleration_x"))


@query("st3_progress", "SELECT COUNT(*) AS rows, TRUE AS has_bytes FROM events")
def st3(spark, sf_dir):
    """Rows and bytes of all batches, of which there are more than a query's own report keeps."""
    store, publisher, _ = streamed(spark, sf_dir)
    return store.batches(publisher.upload.key).agg(F.sum("rows").alias("rows"), (F.sum("bytes") > 0).alias("has_bytes"))


@query("st4_interrupt", "SELECT 'events' AS name, 'deleted' AS state, CAST(0 AS BIGINT) AS topics, COUNT(*) AS rows FROM events")
def st4(spark, sf_dir):
    """A stream that is interrupted after its batches were written leaves no sequence behind."""
    folder = scratch_dir(spark, "stream") + "/messages"
    event_messages(spark, sf_dir).write.parquet(folder)
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    publisher = StreamPublisher(store, event_channels(spark, sf_dir))
    publisher.start(message_stream(spark, folder), scratch_dir(spark, "checkpoint"), processingTime="1 second")
    publisher.query.processAllAvailable()
    publisher.interrupt()
    written = store.batches(publisher.upload.key).agg(F.sum("rows").alias("rows"))
    topics = store.list_topics().agg(F.count("*").alias("topics"))
    return store.states().select("name", "state").crossJoin(topics).crossJoin(written)


@query(
    "st5_failing_topic",
    """SELECT CASE event_type WHEN 'error' THEN 'skipped' WHEN 'view' THEN 'failed' ELSE 'uploaded' END AS status, COUNT(*) AS topics
       FROM (SELECT DISTINCT event_type FROM events) GROUP BY 1""",
)
def st5(spark, sf_dir):
    """One tag whose projection raises; the other topics are published."""
    registry = default_registry().add("floating64", lambda fields: {"data": F.raise_error(F.lit("broken projection"))})
    return stream_events(spark, sf_dir, registry)[2]


@query("u3_row_consumer", "SELECT event_type, COUNT(*) AS rows FROM events GROUP BY 1")
def u3(spark, sf_dir):
    """A consumer of the caller, here one that appends each micro-batch to a table."""
    folder, taken = scratch_dir(spark, "stream") + "/messages", scratch_dir(spark, "consumer") + "/rows"
    event_messages(spark, sf_dir).repartition(4, "sequence").write.parquet(folder)

    def consume(batch, batch_id):
        batch.select(F.substr(c("topic"), F.lit(2)).alias("event_type")).write.mode("overwrite").parquet(f"{taken}/batch={batch_id}")

    stream = message_stream(spark, folder, files_per_batch=2).writeStream.foreachBatch(consume).option(
        "checkpointLocation", scratch_dir(spark, "checkpoint")
    )
    stream.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(taken).groupBy("event_type").agg(F.count("*").alias("rows"))
