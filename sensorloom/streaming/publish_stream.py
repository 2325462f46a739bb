"""Publishing from a stream of messages.

The same routing and projections as in batch, per micro-batch: one scan of the batch, which counts it on the way. A batch is
written to its own folder, so a batch that runs again replaces itself. Every row stands alone: no watermark and no state are
needed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom import schemas as S
from sensorloom.operators import decode, ontology, raw, routing
from sensorloom.plans.publish import Lane, Router, outcomes
from sensorloom.plans.store import SequenceStore, Upload


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.MESSAGES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


class StreamPublisher:
    """A running upload fed by a stream. ``finish`` publishes what arrived, ``interrupt`` drops it.

    ``on_progress`` is told rows and bytes as soon as a batch is read, before its tags are written.

    What each batch held is in the store's log, so a publisher can be made anew after a crash: ``resume`` with the key
    of the upload and the checkpoint of the stream goes on where the last committed batch ended.
    """

    def __init__(
        self, store: SequenceStore, channels: DataFrame, registry=None, tags=None, decoders=None, parallel_tags: int = 4,
        key: str | None = None, on_progress: Callable[[int, int], None] | None = None,
    ):
        self.store = store
        self.registry = registry or ontology.default_registry()
        tags = routing.tag_map(store.spark) if tags is None else tags
        known = sorted({*decode.DECODERS, *(decoders or {})})
        self.routes = routing.route(channels, tags, [*self.registry.tags(), raw.TAG], known)
        self.query: StreamingQuery | None = None
        self.on_progress = on_progress
        self._running = (0, 0)
        self._before: dict[tuple[str, str], str] = {}
        if key is None:
            self.upload: Upload = store.begin_upload(channels.select(F.col("recording").alias("name")).distinct())
        else:
            self._take_up(key)
        self._lane = Lane(self.upload, Router(self.routes), self.registry, decoders, parallel_tags)
        self._lane.failed |= self._before

    @property
    def failed(self) -> dict[tuple[str, str], str]:
        """Why a (tag, encoding) failed, in this run or before a restart."""
        return self._lane.failed

    @classmethod
    def resume(cls, store: SequenceStore, key: str, channels: DataFrame, **options) -> "StreamPublisher":
        """The publisher of an upload that is still open, with the failures of its earlier batches."""
        return cls(store, channels, key=key, **options)

    def _take_up(self, key: str) -> None:
        if self.store.states().where((F.col("key") == key) & (F.col("state") == "open")).isEmpty():
            raise LookupError(f"no open upload: {key}")
        self.upload = Upload(self.store, key)
        # one row per tag and failure, in as few different texts as there were failures
        for row in self.store.batches(key).select("failed", "schemas").distinct().collect():
            self._before |= {(tag, encoding): why for tag, encoding, why in json.loads(row["failed"])}
            self.upload._schemas |= json.loads(row["schemas"])
        if '"variant"' in self.upload._schemas.get(raw.TAG, ""):
            self.upload.open_columns.add(raw.TAG)

    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        def read(rows: int, size: int) -> None:
            self._running = (rows, size)
            if self.on_progress is not None:
                self.on_progress(*self.progress())

        rows, size = self._lane.write(batch, batch_id, read)
        failed = json.dumps(sorted([*way, why] for way, why in self.failed.items()))
        self.store.append_batch(self.upload.key, batch_id, rows, size, failed, json.dumps(self.upload._schemas))
        self._running = (0, 0)

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        self.query = (
            messages.writeStream.foreachBatch(self._write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
        return self.query

    def progress(self) -> tuple[int, int]:
        """Rows and bytes of all batches so far, those before a restart and the one that is being written included."""
        total = self.store.batches(self.upload.key).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
        return (total["rows"] or 0) + self._running[0], (total["bytes"] or 0) + self._running[1]

    def finish(self) -> DataFrame:
        """Wait for the stream, record the topics, publish. Returns the number of topics per status."""
        self.query.awaitTermination()
        outcome = outcomes(self.routes, self.failed)
        self.upload.record(outcome.select(F.col("recording").alias("sequence"), "topic", "tag", "status"))
        self.upload.finalize()
        return outcome.groupBy("status").agg(F.count("*").alias("topics"))

    def interrupt(self) -> None:
        if self.query is not None:
            self.query.stop()
        self.upload.cleanup()
