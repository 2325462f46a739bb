"""Publishing recordings: every message is read and routed once, then each tag is projected from what was routed to it.

1. Messages are joined with the routes of their channels and written, rebalanced, to a staging folder per (tag, encoding);
   messages that no channel claims have a folder of their own. This is the only scan of the messages and the only shuffle.
2. A map-only job per folder projects and writes the rows, a few at a time.
3. The topics are logged and the upload is finalized; the staging folder is removed.

A table that is laid out by topic needs no staging: its folders are pruned by the routes of each tag.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators import decode, ontology, raw, routing
from sensorloom.operators.flatten import flatten_structs
from sensorloom.plans.store import NO_CHANNEL, SequenceStore, Upload
from sensorloom.session import remove_folder
from sensorloom.sources.messages import folder_name

_log = logging.getLogger(__name__)

#: A (tag, encoding).
Way = tuple[str, str]

# Staged messages are parsed by the tasks that read them: small row groups let several tasks share a file.
_ROW_GROUP = {"parquet.block.size": str(8 * 1024 * 1024)}
_STRAY: Way = (NO_CHANNEL, "")

#: Payload bytes of a batch up to which its ways are dealt out over all cores again: what was rebalanced to a file each would
#: be parsed by one task each. Beyond it, there are files enough and every way is map-only.
SMALL_BATCH = 256 * 1024 * 1024


class Interrupted(RuntimeError):
    """The publication was interrupted; nothing of it is visible."""


@dataclass
class Progress:
    """What a publication has done so far: messages and payload bytes read, and rows by (tag, encoding)."""

    rows: int = 0
    bytes: int = 0
    ways: int = 0
    written: dict[Way, tuple[int, int]] = field(default_factory=dict)

    def good(self) -> int:
        return sum(good for good, _ in self.written.values())

    def rejected(self) -> int:
        return sum(bad for _, bad in self.written.values())


class Router:
    """Which messages belong to which (tag, encoding): those whose topic, recording and channel are routed there.

    One way for any number of channels, as joins. Where the routes are small enough to be sent to all tasks, which
    their measured size decides, their topics also prune the folders of a table laid out by topic.
    """

    KEYS = ["topic", "recording", "channel_id"]

    def __init__(self, routes: DataFrame):
        self.channels = routes.select(*self.KEYS)
        self.routes = routes.where("status = 'routed'")
        # as many rows as tags and encodings there are
        self._ways = sorted((r["tag"], r["encoding"]) for r in self.routes.select("tag", "encoding").distinct().collect())

    def ways(self) -> list[Way]:
        return list(self._ways)

    def messages_of(self, messages: DataFrame, tag: str, encoding: str) -> DataFrame:
        mine = self.routes.where((F.col("tag") == tag) & (F.col("encoding") == encoding)).select(*self.KEYS)
        return messages.join(mine, self.KEYS, "left_semi")

    def unclaimed(self, messages: DataFrame) -> DataFrame:
        """Messages that no channel claims. Topics are found by their keys first, so a laid-out table is pruned."""
        keys = messages.select(*self.KEYS).distinct().join(self.channels, self.KEYS, "left_anti")
        if keys.isEmpty():
            return messages.limit(0)
        same = [F.col(f"m.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.KEYS]
        return messages.alias("m").join(keys.alias("k"), same, "left_semi")

    def routed(self, messages: DataFrame) -> DataFrame:
        """Messages with ``_tag`` and ``_encoding``, once for each of their ways; without a channel: NO_CHANNEL.

        Messages of channels that are not published are left out."""
        ways = self.routes.select(*self.KEYS, F.col("tag").alias("_tag"), F.col("encoding").alias("_encoding")).distinct()
        known = self.channels.distinct().join(ways, self.KEYS, "left").fillna("", ["_tag", "_encoding"])
        joined = messages.join(known, self.KEYS, "left")
        tagged = joined.withColumns({"_tag": F.coalesce("_tag", F.lit(NO_CHANNEL)), "_encoding": F.coalesce("_encoding", F.lit(""))})
        return tagged.where("_tag <> ''").select(*messages.columns, "_tag", "_encoding")


def stray_rows(messages: DataFrame) -> DataFrame:
    """Messages without a channel, as rejects."""
    return messages.select(
        F.col("recording").alias("sequence"),
        "topic",
        F.col("log_time_ns").alias("timestamp_ns"),
        F.col("log_time_ns").alias("recording_timestamp_ns"),
        "payload",
        F.lit(NO_CHANNEL).alias("reject_reason"),
    )


def project_messages(messages: DataFrame, tag: str, encoding: str, registry=None, decoders=None) -> DataFrame:
    """Typed rows of one tag, keyed by sequence and topic."""
    if (tag, encoding) == _STRAY:
        return stray_rows(messages)
    keep = ["recording", "topic", "payload"]
    if encoding == "json":
        if tag == raw.TAG and (registry or ontology.default_registry()).find(tag) is None:
            rows = raw.raw_rows(messages, keep)
        else:
            rows = ontology.project_json(messages, tag, registry, keep)
    else:
        decoded = decode.decoder_for(encoding, decoders)(messages)
        rows = ontology.project_flat(flatten_structs(decoded), tag, registry, keep)
    return rows.withColumnRenamed("recording", "sequence")


class Staging:
    """Routed messages in a folder of the store, one folder below it for each way."""

    def __init__(self, store: SequenceStore, key: str, batch: int):
        self.spark, self.path = store.spark, f"{store.staging_path(key)}/batch={batch}"
        self.schema = None

    def write(self, messages: DataFrame, router: Router, observation: Observation) -> None:
        """The one scan. Rebalancing splits a hot topic over tasks and lets small topics share one; ``observation`` counts."""
        self.schema = messages.schema
        size = F.sum(F.octet_length("payload").cast("bigint"))
        seen = messages.observe(observation, F.count("*").alias("rows"), F.coalesce(size, F.lit(0)).alias("bytes"))
        order = ["_tag", "_encoding", "topic", *[c for c in ("recording", "log_time_ns") if c in messages.columns]]
        (
            router.routed(seen)
            .hint("rebalance", "_tag", "_encoding", "topic")
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .options(**_ROW_GROUP)
            .partitionBy("_tag", "_encoding")
            .parquet(self.path)
        )

    def messages_of(self, way: Way) -> DataFrame | None:
        """Messages of a way, None without any. Only its folder is listed."""
        tag, encoding = way
        path = f"{self.path}/_tag={folder_name(tag)}/_encoding={folder_name(encoding)}"
        try:
            return self.spark.read.schema(self.schema).parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def remove(self) -> None:
        remove_folder(self.spark, self.path)


@contextmanager
def _tagged(spark: SparkSession, job_tag: str):
    """Jobs of this thread, and of threads begun in it, carry the tag and can be cancelled by it."""
    spark.sparkContext.addJobTag(job_tag)
    try:
        yield
    finally:
        spark.sparkContext.removeJobTag(job_tag)


def for_each_way(
    spark: SparkSession, ways: list[Way], write: Callable[[int, str, str], None], parallel: int, stop: threading.Event | None = None
) -> dict[Way, str]:
    """Run ``write(position, tag, encoding)`` for every way, a few at a time. Returns what failed, and why.

    Once ``stop`` is set no further way is begun, and what fails then is no failure of the way."""
    failed: dict[Way, str] = {}
    stop = stop or threading.Event()

    def run(position: int, way: Way) -> None:
        if stop.is_set():
            return
        try:
            write(position, *way)
        except Exception as error:  # one broken tag does not hold up the others
            if not stop.is_set():
                failed[way] = str(error)
                _log.warning("tag %s (%s) failed: %s", *way, error)

    with ThreadPoolExecutor(parallel) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(run), i, way) for i, way in enumerate(ways)]
        for job in jobs:
            job.result()
    return failed


def outcomes(routes: DataFrame, failed) -> DataFrame:
    """Routes with their final status: uploaded, skipped or failed."""
    broken = F.lit(False)
    for tag, encoding in failed:
        broken = broken | ((F.col("tag") == tag) & (F.col("encoding") == encoding))
    status = F.when((F.col("status") == "routed") & broken, "failed").when(F.col("status") == "routed", "uploaded")
    return routes.withColumn("status", F.coalesce(status, F.col("status")))


class Lane:
    """Writes messages of one upload, batch by batch: what batch publications and streams have in common."""

    def __init__(self, upload: Upload, router: Router, registry, decoders, parallel: int, stop: threading.Event | None = None):
        self.upload, self.router, self.registry, self.decoders, self.parallel = upload, router, registry, decoders, parallel
        self.stop = stop or threading.Event()
        self.ways: list[Way] = [*router.ways(), _STRAY]
        self.failed: dict[Way, str] = {}
        self.progress = Progress(ways=len(self.ways))

    def _write_way(self, messages: DataFrame, way: Way, batch: int, by_topic: bool, some: bool = True) -> None:
        rows = project_messages(messages, *way, self.registry, self.decoders)
        if way == (raw.TAG, "json") and self.registry.find(raw.TAG) is None:
            self.upload.open_columns.add(raw.TAG)
        if not some:
            self.upload.plan(rows, way[0])
            return
        counted = Observation()
        self.upload.write(rows, way[0], batch, by_topic, observation=counted)
        good, bad = self.progress.written.get(way, (0, 0))
        self.progress.written[way] = (good + counted.get["good"], bad + counted.get["rejected"])

    def write(self, messages: DataFrame, batch: int, on_read: Callable[[int, int], None] | None = None) -> tuple[int, int]:
        """One scan of the messages, then a job for each way. Returns messages and payload bytes read.

        ``on_read`` gets these as soon as the scan is done, before anything is projected."""
        spark, staging, seen = self.upload.store.spark, Staging(self.upload.store, self.upload.key, batch), Observation()
        first, tasks = batch * len(self.ways), spark.sparkContext.defaultParallelism
        try:
            staging.write(messages, self.router, seen)
            read = seen.get["rows"], seen.get["bytes"]
            self.progress.rows += read[0]
            self.progress.bytes += read[1]
            if on_read is not None:
                on_read(*read)

            def write(position: int, tag: str, encoding: str) -> None:
                if (tag, encoding) in self.failed:
                    return
                mine = staging.messages_of((tag, encoding))
                if mine is None:
                    self._write_way(messages.limit(0), (tag, encoding), first + position, True, some=False)
                    return
                small = read[1] <= SMALL_BATCH
                self._write_way(mine.repartition(tasks) if small else mine, (tag, encoding), first + position, not small)

            self.failed |= for_each_way(spark, self.ways, write, self.parallel, self.stop)
        finally:
            staging.remove()
        return read

    def write_laid_out(self, messages: DataFrame) -> None:
        """Messages laid out by topic: each way reads the folders of its topics."""

        def write(position: int, tag: str, encoding: str) -> None:
            stray = (tag, encoding) == _STRAY
            mine = self.router.unclaimed(messages) if stray else self.router.messages_of(messages, tag, encoding)
            self._write_way(mine, (tag, encoding), position, True)

        self.failed |= for_each_way(self.upload.store.spark, self.ways, write, self.parallel, self.stop)
        # every message went one way, but for those of channels that are not published


class Publication:
    """A publication of recordings as sequences, which can be watched and interrupted while it runs.

    ``run`` publishes and returns; ``start`` does so in the background, ``result`` waits for it. One job per tag runs
    after the scan, a few at a time. A tag whose job fails is recorded as failed and the others go on. An interrupted
    publication leaves nothing visible.
    """

    def __init__(
        self, store: SequenceStore, messages: DataFrame, channels: DataFrame, registry=None, tags: DataFrame | None = None,
        decoders: dict | None = None, parallel_tags: int = 4, by_topic: bool = False,
        on_progress: Callable[[Progress], None] | None = None,
    ):
        self.store, self.messages, self.channels, self.by_topic = store, messages, channels, by_topic
        self.registry, self.decoders, self.parallel, self.on_progress = registry or ontology.default_registry(), decoders, parallel_tags, on_progress
        tags = routing.tag_map(store.spark) if tags is None else tags
        known = [*self.registry.tags(), raw.TAG]
        self.routes = routing.route(channels, tags, known, sorted({*decode.DECODERS, *(decoders or {})}))
        self.job_tag = f"publish-{uuid.uuid4().hex}"
        self._stop = threading.Event()
        self._lane: Lane | None = None
        self._thread: threading.Thread | None = None
        self._done: tuple[str, DataFrame] | None = None
        self._error: BaseException | None = None

    @property
    def progress(self) -> Progress:
        return self._lane.progress if self._lane else Progress()

    def _told(self, *_: int) -> None:
        if self.on_progress is not None:
            self.on_progress(self.progress)

    def _check(self) -> None:
        if self._stop.is_set():
            raise Interrupted("publication was interrupted")

    def run(self) -> tuple[str, DataFrame]:
        """The key of the upload, and the number of topics per status."""
        names = self.channels.select(F.col("recording").alias("name")).distinct()
        with self.store.begin_upload(names) as upload:  # an upload that is not finalized is dropped
            try:
                with _tagged(self.store.spark, self.job_tag):
                    self._check()
                    self._lane = Lane(upload, Router(self.routes), self.registry, self.decoders, self.parallel, self._stop)
                    if self.by_topic:
                        self._lane.write_laid_out(self.messages)
                    else:
                        self._lane.write(self.messages, 0, self._told)
                    self._check()
                    upload.failed = self._lane.failed
                    outcome = outcomes(self.routes, self._lane.failed)
                    upload.record(outcome.select(F.col("recording").alias("sequence"), "topic", "tag", "status"))
            except Exception:
                self._check()  # a job that was cancelled fails
                raise
            self._check()
            upload.finalize()
            self._told()
            return upload.key, outcome.groupBy("status").agg(F.count("*").alias("topics"))

    def start(self) -> "Publication":
        def work() -> None:
            try:
                self._done = self.run()
            except BaseException as error:  # handed to the caller of ``result``
                self._error = error

        self._thread = threading.Thread(target=inheritable_thread_target(self.store.spark)(work), daemon=True)
        self._thread.start()
        return self

    def interrupt(self) -> None:
        """No further tag is begun, and running jobs are cancelled. The end of the upload is for ``result`` to wait for."""
        self._stop.set()
        self.store.spark.sparkContext.cancelJobsWithTag(self.job_tag)

    def result(self, timeout: float | None = None) -> tuple[str, DataFrame]:
        self._thread.join(timeout)
        if self._thread.is_alive():
            raise TimeoutError("still publishing")
        if self._error is not None:
            raise self._error
        return self._done


def publish(
    store: SequenceStore,
    messages: DataFrame,
    channels: DataFrame,
    registry=None,
    tags: DataFrame | None = None,
    decoders: dict | None = None,
    parallel_tags: int = 4,
    by_topic: bool = False,
) -> tuple[str, DataFrame]:
    """Publish recordings as sequences: route, decode, project, write, finalize.

    Messages are scanned once and written to a staging folder by tag. Those read from a table laid out ``by_topic`` (see
    ``write_messages``) are written without staging or a shuffle, as long as the routes are small enough to be sent to all
    tasks. Messages without a channel are kept as rejects (``store.rejects(key, NO_CHANNEL)``). Returns the upload key and
    the number of topics per status.
    """
    return Publication(store, messages, channels, registry, tags, decoders, parallel_tags, by_topic).run()
