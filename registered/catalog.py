"""C: catalog queries. L: publish lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.registry import query
from registered.sources import stored_lines, talk_store
from sensorloom.operators import index
from sensorloom.plans import reports
from sensorloom.plans.store import SequenceStore
from sensorloom.session import scratch_dir
from sensorloom.sources.bridges import load, talk_channels, talk_messages

c = F.col

_TALK = "t AS (SELECT 'conv_' || conv_id AS s, '/' || role AS topic, MIN(turn) * 1000000000 AS a, MAX(turn) * 1000000000 AS b, COUNT(*) AS n FROM conversations GROUP BY 1, 2)"


@query(
    "c1_list_sequences",
    f"""WITH {_TALK} SELECT s AS name, COALESCE(MIN(NULLIF(a, 0)), 0) AS min_ts_ns, MAX(b) AS max_ts_ns, TRUE AS has_size,
        'sensorloom' AS source FROM t GROUP BY 1""",
)
def c1(spark, sf_dir):
    store, _ = talk_store(spark, sf_dir)
    return store.list_sequences().select(
        "name", "min_ts_ns", "max_ts_ns", (c("total_size_bytes") > 0).alias("has_size"), c("user_metadata")["source"].alias("source")
    )


@query(
    "c2_list_topics",
    f"""WITH {_TALK} SELECT s AS sequence, topic, a AS min_ts_ns, b AS max_ts_ns, 'string' AS ontology_tag, n AS rows, 4 AS columns FROM t""",
)
def c2(spark, sf_dir):
    store, _ = talk_store(spark, sf_dir)
    columns = F.json_array_length(F.get_json_object("table_schema", "$.fields"))
    return store.list_topics().select(
        "sequence", "topic", "min_ts_ns", "max_ts_ns", "ontology_tag", "rows", columns.alias("columns")
    )


# Column sets an order can stand for, with the tag each one has.
_SHAPES = [
    ("acceleration:struct angular_velocity:struct position:struct", "imu"),
    ("position:struct status:struct orientation:struct", "gps"),
    ("linear:struct angular:struct", "velocity"),
    ("position:struct orientation:struct", "pose"),
    ("translation:struct rotation:struct", "transform"),
    ("force:struct torque:struct", "force_torque"),
    ("sentence:string", "nmea_sentence"),
    ("data:binary height:int", "image"),
    ("data:binary format:string", "compressed_image"),
    ("data:binary a:int b:int c:int", None),
    ("data:string", None),
    ("mystery:double", None),
]


@query(
    "c3_detect_tag",
    "SELECT 'o' || o_orderkey AS topic, CASE o_orderkey % 12 "
    + " ".join(f"WHEN {i} THEN '{tag}'" for i, (_, tag) in enumerate(_SHAPES) if tag)
    + " END AS tag FROM orders",
)
def c3(spark, sf_dir):
    """Orders as topics, each with one of the column sets."""
    sets = F.array(*[F.lit(shape) for shape, _ in _SHAPES])
    rows = load(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), c("o_orderkey").cast("string")).alias("topic"),
        F.explode(F.split(F.get(sets, (c("o_orderkey") % len(_SHAPES)).cast("int")), " ")).alias("f"),
    )
    return reports.detect_tag(
        rows.select("topic", F.substring_index("f", ":", 1).alias("column"), F.substring_index("f", ":", -1).alias("type"))
    )


_DURATION = """CASE WHEN {s} >= 3600 THEN ({s} // 3600) || 'h ' || ({s} % 3600 // 60) || 'm ' || ({s} % 60) || 's'
    WHEN {s} >= 60 THEN ({s} // 60) || 'm ' || ({s} % 60) || 's' ELSE {s} || 's' END"""


@query(
    "c4_recording_report",
    f"""WITH r AS (SELECT conv_id, MIN(turn) AS a, MAX(turn) AS b, COUNT(DISTINCT role) AS channels FROM conversations GROUP BY 1),
        ch AS (SELECT conv_id, role, COUNT(*) AS n FROM conversations GROUP BY 1, 2)
        SELECT 'conv_' || conv_id AS recording, channels, CASE WHEN a > 0 AND b > 0 THEN {_DURATION.format(s='(b - a)')} END AS duration,
        CASE WHEN a > 0 AND b > 0 THEN strftime(make_timestamp(a * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS start_utc,
        '/' || role AS topic, 'json' AS encoding, n AS message_count, 'std_msgs/msg/String' AS schema_name FROM r JOIN ch USING (conv_id)""",
)
def c4(spark, sf_dir):
    messages = talk_messages(spark, sf_dir)
    report = reports.recording_report(
        index.channel_index(talk_channels(spark, sf_dir), messages), index.recording_summary(messages)
    )
    return report.drop("end_utc")


@query(
    "c4_line_report",
    f"""WITH r AS (SELECT epoch(MIN(l_shipdate))::BIGINT AS a, epoch(MAX(l_shipdate))::BIGINT AS b FROM lineitem)
        SELECT 'lines' AS recording, {_DURATION.format(s='(b - a)')} AS duration,
        strftime(make_timestamp(a * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS start_utc, strftime(make_timestamp(b * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS end_utc,
        '/line/' || l_linenumber AS topic, COUNT(*) AS message_count FROM lineitem, r GROUP BY ALL""",
)
def c4_lines(spark, sf_dir):
    messages = stored_lines(spark, sf_dir)
    channels = messages.select("recording", "channel_id", "topic").distinct().withColumns(
        {"encoding": F.lit("json"), "schema_name": F.lit("geometry_msgs/Twist")}
    )
    report = reports.recording_report(
        index.channel_index(channels, messages), index.recording_summary_with_size(messages)
    )
    return report.select("recording", "duration", "start_utc", "end_utc", "topic", "message_count")


@query(
    "c5_sequence_report",
    f"""WITH {_TALK}, g AS (SELECT s, COALESCE(MIN(CASE WHEN a > 0 THEN a END), 0) AS lo, MAX(b) AS hi, COUNT(*) AS topics FROM t GROUP BY 1)
        SELECT t.s AS sequence, topics, CASE WHEN lo > 0 AND hi > 0 THEN strftime(make_timestamp(lo // 1000), '%Y-%m-%dT%H:%M:%SZ') END AS start_utc,
        CASE WHEN lo > 0 AND hi > 0 THEN strftime(make_timestamp(hi // 1000), '%Y-%m-%dT%H:%M:%SZ') END AS end_utc, topic, '4' AS fields,
        CASE WHEN a > 0 AND b > 0 THEN {_DURATION.format(s='((b - a) // 1000000000)')} ELSE '—' END AS duration FROM t JOIN g ON t.s = g.s""",
)
def c5(spark, sf_dir):
    store, _ = talk_store(spark, sf_dir)
    return reports.sequence_report(store.list_topics())


@query(
    "c6_sequence_names",
    "SELECT DISTINCT 'conv_' || conv_id AS name, (SELECT COUNT(DISTINCT conv_id) FROM conversations) AS sequences FROM conversations",
)
def c6(spark, sf_dir):
    store, _ = talk_store(spark, sf_dir)
    return reports.sequence_listing(store.sequence_names())


# ---------------------------------------------------------------- lifecycle


def _names(spark, sf_dir, condition: str):
    return load(spark, sf_dir, "conversations").where(condition).select(
        F.concat(F.lit("conv_"), c("conv_id").cast("string")).alias("name")
    ).distinct()


@query("l1_begin_upload", "SELECT DISTINCT 'conv_' || conv_id AS name, 'open' AS state, 0 AS visible FROM conversations")
def l1(spark, sf_dir):
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    store.begin_upload(_names(spark, sf_dir, "true"))
    visible = store.sequence_names().withColumn("visible", F.lit(1))
    return store.states().join(visible, "name", "left").select("name", "state", F.coalesce("visible", F.lit(0)).alias("visible"))


@query(
    "l2_create_topic",
    """SELECT CASE WHEN o_orderkey % 2 = 0 THEN '/even' ELSE '/odd' END AS topic, 'order' AS tag, 'uploaded' AS status FROM orders GROUP BY 1""",
)
def l2(spark, sf_dir):
    """Opening the second topic closes, and so logs, the first; the second is closed by the end of the upload."""
    rows = load(spark, sf_dir, "orders").select(c("o_orderkey").alias("timestamp_ns"), "o_custkey")
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    with store.begin_upload(["orders"]) as upload:
        for topic, rest in (("/even", 0), ("/odd", 1)):
            upload.create_topic("orders", topic, "order")
            upload.put_batch(rows.where(c("timestamp_ns") % 2 == rest))
        upload.finalize()
    return store.topic_log().select("topic", "tag", "status")


@query(
    "l4_close_topic",
    "SELECT COUNT(*) AS rows, MIN(o_orderkey) AS ts_min, MAX(o_orderkey) AS ts_max, TRUE AS has_bytes FROM orders",
)
def l4(spark, sf_dir):
    """Closing a topic records its rows, range and size, before anything is visible."""
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    upload = store.begin_upload(["orders"])
    upload.create_topic("orders", "/all", "order")
    upload.put_batch(load(spark, sf_dir, "orders").select(c("o_orderkey").alias("timestamp_ns"), "o_custkey"))
    upload.close_topic()
    upload.close_topic()
    upload.finalize()
    return store.topic_log().select("rows", "ts_min", "ts_max", (c("bytes") > 0).alias("has_bytes"))


@query(
    "l3_put_batches",
    """SELECT CASE WHEN o_orderkey % 2 = 0 THEN '/even' ELSE '/odd' END AS topic, COUNT(*) AS rows, MIN(epoch_us(o_orderdate)) * 1000 AS min_ts_ns,
       CAST(SUM(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY 1""",
)
def l3(spark, sf_dir):
    """Two topics of one sequence, one of them in two batches; opening the second closes the first."""
    rows = load(spark, sf_dir, "orders").select(
        (F.unix_micros(c("o_orderdate").cast("timestamp")) * 1000).alias("timestamp_ns"), "o_orderkey", "o_custkey"
    )
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    with store.begin_upload(["orders"]) as upload:
        upload.create_topic("orders", "/even", "order")
        upload.put_batch(rows.where("o_orderkey % 4 = 0"))
        upload.put_batch(rows.where("o_orderkey % 4 = 2"))
        upload.create_topic("orders", "/odd", "order")
        upload.put_batch(rows.where("o_orderkey % 2 = 1"))
        upload.finalize()
    keys = store.pull_topic("orders", "/even").select(F.lit("/even").alias("topic"), "o_custkey").unionByName(
        store.pull_topic("orders", "/odd").select(F.lit("/odd").alias("topic"), "o_custkey")
    ).groupBy("topic").agg(F.sum("o_custkey").alias("keys"))
    return store.list_topics("orders").join(keys, "topic").select("topic", "rows", "min_ts_ns", "keys")


@query("l5_finalize", "SELECT DISTINCT 'conv_' || conv_id AS name FROM conversations WHERE conv_id % 3 = 0")
def l5(spark, sf_dir):
    """Of three uploads one is finalized, one dropped and one left open: only the first is seen."""
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    store.begin_upload(_names(spark, sf_dir, "conv_id % 3 = 0")).finalize()
    store.begin_upload(_names(spark, sf_dir, "conv_id % 3 = 1")).cleanup()
    store.begin_upload(_names(spark, sf_dir, "conv_id % 3 = 2"))
    return store.sequence_names()


@query(
    "l6_cleanup",
    """SELECT DISTINCT 'conv_' || conv_id AS name, CASE WHEN conv_id % 2 = 0 THEN 'deleted' ELSE 'finalized' END AS state,
       CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 2 END AS uploads FROM conversations""",
)
def l6(spark, sf_dir):
    """A dropped name can be used again."""
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    upload = store.begin_upload(_names(spark, sf_dir, "true"))
    upload.cleanup()
    upload.cleanup()
    store.begin_upload(_names(spark, sf_dir, "conv_id % 2 = 1")).finalize()
    return store.states().groupBy("name").agg(F.max("state").alias("state"), F.count("*").alias("uploads"))


@query("l7_delete_sequence", "SELECT DISTINCT 'conv_' || conv_id AS name, CASE WHEN conv_id = 0 THEN 'deleted' ELSE 'open' END AS state FROM conversations")
def l7(spark, sf_dir):
    """One sequence that was not finalized is deleted, the others of its upload stay."""
    store = SequenceStore(spark, scratch_dir(spark, "store"))
    store.begin_upload(_names(spark, sf_dir, "true"))
    store.delete_sequence("conv_0")
    return store.states().select("name", "state")
