"""Published sequences: data files, an append-only log and the reads on top of them.

Layout under ``root``::

    data/<key>/<tag>/batch=<n>/rejected=<bool>/topic=<topic>/*.parquet
    log/batches     (key, batch, rows, bytes, ...)  one row per micro-batch of a stream
    log/sequences   (name, key, state, version, ...)    one row per state change
    log/topics      (key, sequence, topic, tag, ...)    one row per topic when its upload closes
    log/files       (key, tag, sequence, topic, file, rows, ts_min, ts_max, ...)  one row per topic and data file
    log/replaced    (log, file, at_ns)              log files whose rows stand in a snapshot, to be removed
    staging/<key>/  messages on their way to a tag; gone when the upload ends

An upload has a key. Readers see the rows of a key only after its ``finalized`` row is in the log, so a
failed upload leaves nothing visible and no file is ever rewritten. A sequence has one writer at a time: taking a
name is a look and then an append, so two uploads that open the same new name at once both succeed.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import metadata as M
from sensorloom.operators import raw
from sensorloom.operators.index import figures_of, file_figures
from sensorloom.session import remove_folder
from sensorloom.sources.messages import folder_name

SEQUENCE_LOG = "name string, key string, state string, version int, user_metadata string, at_ns bigint"
TOPIC_LOG = (
    "key string, sequence string, topic string, tag string, status string, table_schema string, "
    "properties string, rows bigint, ts_min bigint, ts_max bigint, bytes bigint"
)

FILE_LOG = (
    "key string, tag string, sequence string, topic string, file string, rows bigint, ts_min bigint, ts_max bigint, bytes double"
)

BATCH_LOG = "key string, batch bigint, rows bigint, bytes bigint, failed string, schemas string"

REPLACED_LOG = "log string, file string, at_ns bigint"

# Logs that are read as a whole by catalog queries.
_LOGS = {"sequences": SEQUENCE_LOG, "topics": TOPIC_LOG, "files": FILE_LOG, "batches": BATCH_LOG}

# Order of the states of an upload, and the metadata of one made here.
_VERSION = {"open": 0, "finalized": 1, "deleted": 2}
_SOURCE = '{"source":"sensorloom"}'

# Row groups below the usual size let a pull skip more of a file.
_ROW_GROUP = {"parquet.block.size": str(32 * 1024 * 1024)}

# Where messages without a channel are kept, as rejects with this reason.
NO_CHANNEL = "no_channel"


class SequenceStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def data_path(self, key: str, tag: str) -> str:
        return f"{self.root}/data/{key}/{tag}"

    def staging_path(self, key: str) -> str:
        return f"{self.root}/staging/{key}"

    # ------------------------------------------------------------ log

    def _log(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/log/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], schema)
            raise

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/log/{name}")

    def append_states(self, names: DataFrame, key: str, state: str, user_metadata: str = _SOURCE) -> None:
        self._append(
            "sequences",
            names.select(
                F.col("name"),
                F.lit(key).alias("key"),
                F.lit(state).alias("state"),
                F.lit(_VERSION[state]).alias("version"),
                F.lit(user_metadata).alias("user_metadata"),
                F.lit(time.time_ns()).alias("at_ns"),
            ),
        )

    def append_topics(self, topics: DataFrame) -> None:
        self._append("topics", topics)

    def states(self) -> DataFrame:
        """Current state of every (name, key)."""
        return self._log("sequences", SEQUENCE_LOG).groupBy("name", "key").agg(
            F.max_by("state", "version").alias("state"), F.min_by("user_metadata", "version").alias("user_metadata")
        )

    def visible(self) -> DataFrame:
        return self.states().where("state = 'finalized'").drop("state")

    def topic_log(self) -> DataFrame:
        """Topics of finalized sequences."""
        log = self._log("topics", TOPIC_LOG).distinct()  # a row may stand in a snapshot and in the file it was made from
        return log.join(self.visible().select("key", F.col("name").alias("sequence")), ["key", "sequence"], "left_semi")

    # ------------------------------------------------------------ catalog

    def list_sequences(self) -> DataFrame:
        """Name, time range, user metadata and size of every finalized sequence."""
        log = self.topic_log().where("status = 'uploaded'")
        ranges = sequence_ranges(log.where("rows > 0"), ["key", "sequence"])
        sizes = log.groupBy("key", "sequence").agg(F.sum("bytes").alias("total_size_bytes"))
        return (
            self.visible()
            .withColumnRenamed("name", "sequence")
            .join(ranges, ["key", "sequence"], "left")
            .join(sizes, ["key", "sequence"], "left")
            .select(
                F.col("sequence").alias("name"),
                F.coalesce("min_ts_ns", F.lit(0).cast("bigint")).alias("min_ts_ns"),
                F.coalesce("max_ts_ns", F.lit(0).cast("bigint")).alias("max_ts_ns"),
                F.coalesce("total_size_bytes", F.lit(0).cast("bigint")).alias("total_size_bytes"),
                M.user_metadata(F.col("user_metadata")).alias("user_metadata"),
            )
        )

    def list_topics(self, sequence: str | None = None) -> DataFrame:
        """Topics with range, tag, user metadata and schema, of one sequence or of all."""
        log = self.topic_log().where("status = 'uploaded'")
        if sequence is not None:
            log = log.where(F.col("sequence") == sequence)
        return log.select(
            "sequence",
            "topic",
            F.coalesce("ts_min", F.lit(0).cast("bigint")).alias("min_ts_ns"),
            F.coalesce("ts_max", F.lit(0).cast("bigint")).alias("max_ts_ns"),
            M.ontology_tag(F.col("properties")).alias("ontology_tag"),
            F.map_filter(M.user_metadata(F.col("properties")), lambda k, v: k != "ontology_tag").alias("user_metadata"),
            "table_schema",
            "rows",
            "bytes",
        )

    def sequence_names(self) -> DataFrame:
        return self.visible().select("name")

    # ------------------------------------------------------------ pull

    def read_tag(
        self, key: str, tag: str, rejected: bool = False, topic: str | None = None, schema: T.StructType | None = None,
        files: list[str] | None = None,
    ) -> DataFrame:
        """Rows of a tag. Only the folders asked for are listed, or only ``files`` are read."""
        base = self.data_path(key, tag)
        reader = self.spark.read.option("basePath", base)
        folders = ["batch", "rejected", "topic"]
        path = f"{base}/batch=*/rejected={str(rejected).lower()}/topic=" + ("*" if topic is None else folder_name(topic))
        columns = [f for f in schema or reader.parquet(path).schema if f.name not in folders]
        # folder values are text even where they look like numbers
        texts = [T.StructField(name, T.StringType()) for name in folders]
        rows = reader.schema(T.StructType(columns + texts)).parquet(*([path] if files is None else files)).drop("batch", "rejected")
        # a null folder value is the empty name
        return rows.withColumn("topic", F.coalesce("topic", F.lit("")))

    def pull_topic(
        self, sequence: str, topic: str, start_ns: int | None = None, end_ns: int | None = None,
        observation: Observation | None = None,
    ) -> DataFrame:
        """Rows of one topic, optionally within the closed interval [start_ns, end_ns].

        The topic selects folders, the bounds select files by the log, sequence and bounds are pushed into the scan. An ``observation`` counts rows and
        bytes (of the values, as JSON text) as they are pulled.
        """
        parts = [self._pull(row, sequence, topic, start_ns, end_ns) for row in self._logged(sequence, topic)]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if observation is not None:
            size = F.sum(F.octet_length(F.to_json(F.struct(*[f"`{c}`" for c in rows.columns]))).cast("bigint"))
            rows = rows.observe(observation, F.count("*").alias("rows"), F.coalesce(size, F.lit(0)).alias("bytes"))
        return rows

    def first_rows(self, sequence: str, topic: str, n: int) -> DataFrame:
        """The first n rows of a topic by time, ties in no fixed order. Only files are read that can hold one of them.

        The files that end first and hold n rows together bound the time of the nth row; files that begin later are left alone.
        """
        logged = self._logged(sequence, topic)
        files = self.files().where(F.col("key").isin([r["key"] for r in logged]))
        files = files.where((F.col("sequence") == sequence) & (F.col("topic") == topic))
        so_far = F.sum("rows").over(Window.orderBy("ts_max", "file"))
        last = files.select("ts_max", so_far.alias("so_far")).where(F.col("so_far") >= n).agg(F.min("ts_max")).first()[0]
        return self.pull_topic(sequence, topic, None, last).orderBy("timestamp_ns").limit(n)

    def _logged(self, sequence: str, topic: str) -> list:
        found = (
            self.topic_log()
            .where((F.col("sequence") == sequence) & (F.col("topic") == topic) & (F.col("status") == "uploaded"))
            .groupBy("key", "tag", "table_schema")
            .agg(F.sum("rows").alias("rows"))
            .collect()
        )
        if not found:
            raise LookupError(f"no such topic: {sequence.lstrip('/')}/{topic.lstrip('/')}")
        return found

    def files(self) -> DataFrame:
        """What each data file holds, each once although a topic may have been logged again."""
        return self._log("files", FILE_LOG).dropDuplicates(["key", "tag", "sequence", "topic", "file"])

    def files_of(self, key: str, tag: str, sequence: str, topic: str, start_ns: int | None = None, end_ns: int | None = None) -> list[str]:
        """Data files of a topic that hold rows of the closed interval, by the log."""
        files = self.files().where(
            (F.col("key") == key) & (F.col("tag") == tag) & (F.col("sequence") == sequence) & (F.col("topic") == topic)
        )
        if start_ns is not None:
            files = files.where(F.col("ts_max") >= start_ns)
        if end_ns is not None:
            files = files.where(F.col("ts_min") <= end_ns)
        # as many names as a listing of the folders would give
        return [f"{self.data_path(key, tag)}/{r['file']}" for r in files.select("file").distinct().collect()]

    @staticmethod
    def stored_schema(table: str | None) -> T.StructType:
        """Columns that the data files of a topic have, by the schema in the log."""
        if table is not None and table.startswith("["):
            return raw.STORED
        return T.StructType([T.StructField("sequence", T.StringType()), *T.StructType.fromJson(json.loads(table or '{"fields":[]}')).fields])

    def _pull(self, logged, sequence: str, topic: str, start_ns: int | None, end_ns: int | None) -> DataFrame:
        key, tag, table = logged["key"], logged["tag"], logged["table_schema"]
        open_columns = table is not None and table.startswith("[")
        stored = self.stored_schema(table)
        bounded = start_ns is not None or end_ns is not None
        files = self.files_of(key, tag, sequence, topic, start_ns, end_ns) if bounded else None
        if not logged["rows"] or files == []:
            rows = self.spark.createDataFrame([], stored)
        else:
            rows = self.read_tag(key, tag, topic=topic, schema=stored, files=files).select(*[f"`{n}`" for n in stored.names])
        rows = rows.where(F.col("sequence") == sequence)
        if start_ns is not None:
            rows = rows.where(F.col("timestamp_ns") >= start_ns)
        if end_ns is not None:
            rows = rows.where(F.col("timestamp_ns") <= end_ns)
        return (raw.columns_of(rows, table) if open_columns else rows).drop("sequence")

    def rejects(self, key: str, tag: str) -> DataFrame:
        try:
            found = self.read_tag(key, tag, rejected=True)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            nothing = "recording string, topic string, log_time_ns bigint, reason string, payload binary"
            return self.spark.createDataFrame([], nothing)
        return found.select(
            F.col("sequence").alias("recording"),
            "topic",
            F.col("recording_timestamp_ns").alias("log_time_ns"),
            F.col("_reason").alias("reason"),
            F.col("_payload").alias("payload"),
        )

    # ------------------------------------------------------------ lifecycle

    def append_batch(self, key: str, batch: int, rows: int, size: int, failed: str, schemas: str) -> None:
        self._append("batches", self.spark.createDataFrame([(key, batch, rows, size, failed, schemas)], BATCH_LOG))

    def batches(self, key: str) -> DataFrame:
        """Micro-batches of an upload, each once although a batch may have run again."""
        log = self._log("batches", BATCH_LOG).where(F.col("key") == key)
        return log.groupBy("batch").agg(F.max(F.struct("rows", "bytes", "failed", "schemas")).alias("b")).select("batch", "b.*")

    def begin_upload(self, names: list[str] | DataFrame, user_metadata: dict[str, str] | None = None) -> "Upload":
        """A new key for one or many sequences; a name that is open or finalized is refused.

        ``user_metadata`` is kept with each of the sequences.
        """
        if not isinstance(names, DataFrame):
            names = self.spark.createDataFrame([(n,) for n in names], "name string")
        taken = names.join(self.states().where("state <> 'deleted'"), "name", "left_semi").head(1)
        if taken:
            raise ValueError(f"sequence exists: {taken[0]['name']}")
        key = uuid.uuid4().hex
        self.append_states(names, key, "open", json.dumps({**json.loads(_SOURCE), **(user_metadata or {})}))
        return Upload(self, key)

    def delete_sequence(self, name: str) -> None:
        """Remove a sequence that was not finalized."""
        current = self.states().where(F.col("name") == name).where("state <> 'deleted'").collect()
        if not current:
            raise LookupError(f"no such sequence: {name}")
        if any(r["state"] == "finalized" for r in current):
            raise ValueError(f"sequence is finalized: {name}")
        for row in current:
            self.append_states(self.spark.createDataFrame([(name,)], "name string"), row["key"], "deleted")

    def compact_log(self, retain_seconds: float = 3600, files: int = 16) -> dict[str, int]:
        """Write a snapshot of each log that has more than so many files; returns the number of files that each replaced.

        A snapshot is appended like any other rows, so from then on its rows stand twice, which readers allow for. The files it
        was made from are removed by a later call, after the retention: whoever listed them before can read them until
        then. A call that ends half way leaves rows that stand twice, which the next snapshot holds once.
        """
        now, replaced = time.time_ns(), {}
        old = self._log("replaced", REPLACED_LOG).where(F.col("at_ns") <= now - int(retain_seconds * 1e9))
        for row in old.select("file").distinct().collect():
            remove_folder(self.spark, f"{self.root}/log/{row['file']}")
        gone = {r["file"] for r in self._log("replaced", REPLACED_LOG).select("file").distinct().collect()}
        for name, schema in _LOGS.items():
            log = self._log(name, schema)
            names = [f"{name}/{unquote(path).rsplit('/', 1)[1]}" for path in log.inputFiles()]
            open_ = [n for n in names if n not in gone]
            if len(open_) <= files:
                continue
            self._append(name, self.spark.read.schema(schema).parquet(*[f"{self.root}/log/{n}" for n in open_]).distinct())
            self._append("replaced", self.spark.createDataFrame([(name, n, now) for n in open_], REPLACED_LOG))
            replaced[name] = len(open_)
        return replaced

    def vacuum(self, retain_seconds: float = 7 * 24 * 3600, abandon_seconds: float | None = None) -> list[str]:
        """Remove the data of uploads that were dropped longer ago than the retention. Returns their keys.

        Within the retention, readers that planned a pull before the drop can still end it. With ``abandon_seconds``,
        uploads that were opened that long ago and never ended are dropped first. Data of a key stays as long as any
        of its sequences is not deleted; the log keeps its rows.
        """
        now = time.time_ns()
        log = self._log("sequences", SEQUENCE_LOG)
        last = log.groupBy("name", "key").agg(F.max_by("state", "version").alias("state"), F.max("at_ns").alias("at_ns"))
        if abandon_seconds is not None:
            old = last.where((F.col("state") == "open") & (F.col("at_ns") < now - int(abandon_seconds * 1e9)))
            for row in old.select("key").distinct().collect():
                self.append_states(old.where(F.col("key") == row["key"]), row["key"], "deleted")
        ended = last.groupBy("key").agg(F.every(F.col("state") == "deleted").alias("dropped"), F.max("at_ns").alias("at_ns"))
        dropped = ended.where(F.col("dropped") & (F.col("at_ns") < now - int(retain_seconds * 1e9))).select("key")
        removed = []
        for row in dropped.orderBy("key").collect():
            gone = [remove_folder(self.spark, f"{self.root}/{part}/{row['key']}") for part in ("data", "staging")]
            if any(gone):
                removed.append(row["key"])
        return removed


def sequence_ranges(topics: DataFrame, keys: list[str]) -> DataFrame:
    """Time range over topics. A minimum of 0 means unset and is never taken."""
    return topics.groupBy(*keys).agg(
        F.coalesce(F.min(F.nullif(F.col("ts_min"), F.lit(0).cast("bigint"))), F.lit(0).cast("bigint")).alias("min_ts_ns"),
        F.greatest(F.coalesce(F.max("ts_max"), F.lit(0)), F.lit(0)).cast("bigint").alias("max_ts_ns"),
    )


class Upload:
    """The upload of one or many sequences under one key. All of it becomes visible at ``finalize``."""

    def __init__(self, store: SequenceStore, key: str):
        self.store, self.key = store, key
        self.finished: str | None = None
        self._open: tuple[str, str, str] | None = None
        self._schemas: dict[str, str] = {}  # table schema by tag, as written
        self._fixed: str | None = None  # table schema of the open topic
        self._metadata: dict[str, str] | None = None
        self.failed: dict[tuple[str, str], str] = {}  # why a (tag, encoding) failed
        self.open_columns: set[str] = set()  # tags whose columns differ by topic

    def names(self) -> DataFrame:
        return self.store.states().where(F.col("key") == self.key).select("name")

    def _check(self) -> None:
        if self.finished:
            raise RuntimeError(f"upload is {self.finished}")

    # -------- topic by topic

    def create_topic(self, sequence: str, topic: str, tag: str, user_metadata: dict[str, str] | None = None) -> None:
        """Open a topic; the one open before is closed first."""
        self._check()
        self.close_topic()
        self._open, self._fixed, self._metadata = (sequence, topic, tag), None, user_metadata

    def put_batch(self, rows: DataFrame) -> None:
        """Append rows to the open topic. Its first batch fixes the columns; others are refused."""
        self._check()
        if self._open is None:
            raise RuntimeError("no topic is open")
        sequence, topic, tag = self._open
        columns = {f.name: f.dataType for f in rows.schema.fields if f.name not in ("reject_reason", "payload")}
        fixed = T.StructType.fromJson(json.loads(self._fixed)) if self._fixed else None
        if fixed is not None and {f.name: f.dataType for f in fixed.fields} != columns:
            raise ValueError(f"columns of {topic!r} are fixed: {fixed.simpleString()}")
        marked = rows.select(F.lit(sequence).alias("sequence"), F.lit(topic).alias("topic"), "*")
        self._fixed = self.write(marked, tag, batch=time.time_ns())

    def close_topic(self) -> None:
        """Record row count, time range and size of the open topic."""
        if self._open is None:
            return
        sequence, topic, tag = self._open
        self._open = None
        one = self.store.spark.createDataFrame([(sequence, topic, tag)], "sequence string, topic string, tag string")
        self._record(one, {tag: self._fixed} if self._fixed else {}, topic, self._metadata)

    # -------- many topics at once

    def plan(self, rows: DataFrame, tag: str) -> DataFrame:
        """Rows as they are stored; their schema becomes that of the tag, whether or not any row is written."""
        if "reject_reason" not in rows.columns:
            rows = rows.withColumn("reject_reason", F.lit(None).cast("string"))
        if "payload" not in rows.columns:
            rows = rows.withColumn("payload", F.lit(None).cast("binary"))
        bad = F.col("reject_reason").isNotNull()
        kept = [c for c in rows.columns if c not in ("reject_reason", "payload", "log_time_ns", "channel_id")]
        rows = rows.withColumn("topic", F.coalesce("topic", F.lit("")))
        table = rows.select(*[f"`{c}`" for c in kept]).withMetadata("timestamp_ns", {"ontology_tag": tag})
        self._schemas[tag] = table.drop("sequence", "topic").schema.json()
        return rows.select(
            *[f"`{c}`" for c in kept],
            F.col("reject_reason").alias("_reason"),
            F.when(bad, F.col("payload")).alias("_payload"),
            bad.alias("rejected"),
        ).withMetadata("timestamp_ns", {"ontology_tag": tag})

    def write(
        self, rows: DataFrame, tag: str, batch: int = 0, by_topic: bool = False, observation: Observation | None = None
    ) -> str:
        """Write one batch of a tag. Writing a batch again replaces it. Returns the table schema.

        Rows that do not come ``by_topic`` already are rebalanced: a topic with most of the rows is split over
        tasks, small topics share one, and files get an even size. Sorting lets a pull skip row groups by
        sequence and time. An ``observation`` counts good and rejected rows as they are written.
        """
        marked = self.plan(rows, tag)
        if observation is not None:
            bad = F.count_if("rejected")
            marked = marked.observe(observation, (F.count("*") - bad).alias("good"), bad.alias("rejected"))
        (
            (marked if by_topic else marked.hint("rebalance", "topic"))
            .sortWithinPartitions("rejected", "topic", "sequence", "timestamp_ns")
            .write.mode("overwrite")
            .options(**_ROW_GROUP)
            .partitionBy("rejected", "topic")
            .parquet(f"{self.store.data_path(self.key, tag)}/batch={batch}")
        )
        return self._schemas[tag]

    def _file_figures(self, tag: str, topic: str | None = None) -> DataFrame | None:
        """What each data file of a tag holds: a scan of two columns. None without any file."""
        narrow = T.StructType([T.StructField("sequence", T.StringType()), T.StructField("timestamp_ns", T.LongType())])
        try:
            stored = self.store.read_tag(self.key, tag, topic=topic, schema=narrow)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise
        files = file_figures(stored, ["sequence", "topic"], "timestamp_ns")
        # names from the tag's folder on, as they are on disk
        name = F.regexp_replace(F.substring_index("file", f"/data/{self.key}/", -1), "^[^/]*/", "")
        plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        named = files.withColumn("file", plain).withColumns({"key": F.lit(self.key), "tag": F.lit(tag)})
        return named.select(*T.StructType.fromDDL(FILE_LOG).names)

    def record(self, topics: DataFrame) -> None:
        """Log topics (sequence, topic, tag[, status]) with the figures of what was written for them."""
        self._record(topics, self._schemas)

    def _record(
        self, topics: DataFrame, tables: dict[str, str], topic: str | None = None, user_metadata: dict[str, str] | None = None
    ) -> None:
        """``tables``: schemas by tag. With a ``topic``, only its folders are read for the figures."""
        if "status" not in topics.columns:
            topics = topics.withColumn("status", F.lit("uploaded"))
        log = topics.select("sequence", F.coalesce("topic", F.lit("")).alias("topic"), "tag", "status").distinct()
        keys = ["sequence", "topic", "tag"]
        found = [f for f in (self._file_figures(tag, topic) for tag in tables) if f is not None]
        if found:
            self.store._append("files", reduce(DataFrame.unionByName, found))  # one job for all tags
            files = self.store.files().where(F.col("key") == self.key)
            log = log.join(figures_of(files, keys), keys, "left")
        else:
            log = log.withColumns({c: F.lit(None).cast("bigint") for c in ("rows", "ts_min", "ts_max", "bytes")})
        schemas = [F.lit(x) for pair in tables.items() for x in pair] or [F.lit(""), F.lit("")]
        table = F.try_element_at(F.create_map(*schemas), F.col("tag"))
        fields = [self._fields(tag, topic).withColumn("tag", F.lit(tag)) for tag in self.open_columns if tag in tables]
        if fields:
            log = log.join(reduce(DataFrame.unionByName, fields), keys, "left")
            table = F.when(F.col("tag").isin(sorted(self.open_columns)), F.coalesce("fields", F.lit("[]"))).otherwise(table)
        self.store.append_topics(
            log.select(
                F.lit(self.key).alias("key"),
                "sequence",
                "topic",
                "tag",
                "status",
                table.alias("table_schema"),
                M.properties(F.col("tag"), user_metadata).alias("properties"),
                F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"),
                "ts_min",
                "ts_max",
                F.coalesce(F.col("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
            )
        )

    def _fields(self, tag: str, topic: str | None) -> DataFrame:
        """Columns of each topic of a tag whose rows are kept as variants."""
        return raw.logged_fields(self.store.read_tag(self.key, tag, topic=topic, schema=raw.STORED))

    # -------- end

    def finalize(self) -> None:
        self._check()
        self.close_topic()
        self.store.append_states(self.names(), self.key, "finalized")
        self.finished = "finalized"
        remove_folder(self.store.spark, self.store.staging_path(self.key))

    def cleanup(self) -> None:
        """Drop an upload that was not finalized; doing so twice is fine."""
        if self.finished:
            return
        self._open = None
        self.store.append_states(self.names(), self.key, "deleted")
        self.finished = "deleted"
        remove_folder(self.store.spark, self.store.staging_path(self.key))

    def __enter__(self) -> "Upload":
        return self

    def __exit__(self, *error) -> None:
        self.cleanup()
