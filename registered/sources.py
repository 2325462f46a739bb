"""S: scans, sources and sinks over stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.registry import EV, GOOD_EVENT, query
from sensorloom.operators import index, infer
from sensorloom.operators.decode import good_rows
from sensorloom.operators.definitions import json_schema
from sensorloom.plans import export
from sensorloom.plans.publish import publish
from sensorloom.plans.store import NO_CHANNEL, SequenceStore
from sensorloom.session import scratch_dir
from sensorloom.sources import messages as M
from sensorloom.sources.bridges import (
    event_channels,
    event_messages,
    line_messages,
    load,
    micros_to_ns,
    talk_channels,
    talk_messages,
)

c = F.col

_made: dict[tuple, object] = {}


def _once(spark, name: str, sf_dir: str, make):
    """What several queries read is written once per application."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def stored_lines(spark, sf_dir):
    """Line items as a stored message table, laid out by topic."""

    def make():
        path = scratch_dir(spark, "messages") + "/lines"
        M.write_messages(line_messages(spark, sf_dir), path)
        return path

    return M.read_messages(spark, _once(spark, "lines", sf_dir, make))


def talk_store(spark, sf_dir) -> tuple[SequenceStore, str]:
    """All conversations published as sequences."""

    def make():
        store = SequenceStore(spark, scratch_dir(spark, "store"))
        key, _ = publish(store, talk_messages(spark, sf_dir), talk_channels(spark, sf_dir))
        return store, key

    return _once(spark, "talk", sf_dir, make)


def event_store(spark, sf_dir) -> tuple[SequenceStore, str]:
    """The event recording published, with the statuses of its topics."""

    def make():
        store = SequenceStore(spark, scratch_dir(spark, "store"))
        return store, *publish(store, event_messages(spark, sf_dir), event_channels(spark, sf_dir))

    return _once(spark, "events", sf_dir, make)


@query("s1_topic_scan", "SELECT l_orderkey * 10 + 3 AS sequence, epoch_us(l_shipdate) * 1000 AS log_time_ns FROM lineitem WHERE l_linenumber = 3")
def s1(spark, sf_dir):
    return index.topic_scan(stored_lines(spark, sf_dir), "/line/3").select("sequence", "log_time_ns")


@query(
    "s2_channel_index",
    f"""WITH ch AS (SELECT event_type, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS channel_id,
        CASE event_type WHEN 'click' THEN 'sensor_msgs/msg/Imu' WHEN 'view' THEN 'std_msgs.msg.Float64' WHEN 'signup' THEN 'sensor_msgs/NavSatFix'
        WHEN 'purchase' THEN 'tf2_msgs/msg/TFMessage' ELSE 'acme_msgs/msg/Unknown' END AS schema_name FROM events)
        SELECT channel_id, '/' || event_type AS topic, 'json' AS encoding, schema_name, COUNT(*) AS message_count FROM ch GROUP BY ALL""",
)
def s2(spark, sf_dir):
    found = index.channel_index(event_channels(spark, sf_dir), event_messages(spark, sf_dir))
    return found.select("channel_id", "topic", "encoding", "schema_name", "message_count")


@query(
    "s3_recording_summary",
    """SELECT 'lines' AS recording, COUNT(*) AS total_messages, epoch_us(MIN(l_shipdate)) * 1000 AS start_time_ns,
       epoch_us(MAX(l_shipdate)) * 1000 AS end_time_ns, TRUE AS has_size FROM lineitem""",
)
def s3(spark, sf_dir):
    summary = index.recording_summary_with_size(stored_lines(spark, sf_dir))
    return summary.withColumn("has_size", c("bytes") > 0).drop("bytes")


@query(
    "s6_topic_pull",
    f"""WITH {EV} SELECT ns AS timestamp_ns, value AS data FROM ev WHERE event_type = 'view'
        AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""",
)
def s6(spark, sf_dir):
    store, *_ = event_store(spark, sf_dir)
    pulled = store.pull_topic("events", "/view", 1704412800 * 10**9, 1705708800 * 10**9)
    return pulled.select("timestamp_ns", "data")


@query(
    "s7_sequence_export",
    f"""SELECT CASE event_type WHEN 'click' THEN 'click' ELSE event_type END AS topic,
        CAST(SUM(CASE WHEN event_type = 'purchase' THEN GREATEST(event_id % 4, 1) ELSE 1 END) AS BIGINT) AS rows
        FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def s7(spark, sf_dir):
    """Every topic of the sequence as its own Parquet folder, read back."""
    store, *_ = event_store(spark, sf_dir)
    written = export.export_sequence(store, "events", scratch_dir(spark, "export") + "/events")
    parts = None
    for path in written:
        part = spark.read.parquet(path).select(F.lit(path.rsplit("/", 1)[1]).alias("topic"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("topic").agg(F.count("*").alias("rows"))


@query(
    "s7_export_by_tag",
    """SELECT 'conv_' || conv_id AS sequence, '/' || role AS topic, COUNT(*) AS rows, CAST(SUM(octet_length(encode(text))) AS BIGINT) AS bytes
       FROM conversations WHERE conv_id % 2 = 0 GROUP BY 1, 2""",
)
def s7_by_tag(spark, sf_dir):
    """Half of the conversations exported in one job, and read back by the manifest's folders."""
    store, _ = talk_store(spark, sf_dir)
    names = [r["name"] for r in store.sequence_names().where("cast(substr(name, 6) as int) % 2 = 0").collect()]
    out = scratch_dir(spark, "export") + "/talks"
    manifest = export.export_by_tag(store, names, out)
    folder = manifest.select("folder").distinct().first()["folder"]
    rows = spark.read.parquet(f"{out}/{folder}").groupBy(c("of_sequence").alias("sequence"), c("of_topic").alias("topic")).agg(
        F.sum(F.octet_length("data").cast("bigint")).alias("bytes")
    )
    return manifest.join(rows, ["sequence", "topic"]).select("sequence", "topic", "rows", "bytes")


def _order_rows(spark, sf_dir):
    """Orders as a table with a time column, one topic per status."""
    return load(spark, sf_dir, "orders").select(
        micros_to_ns("o_orderdate").alias("timestamp_ns"), c("o_orderkey").alias("id"), c("o_totalprice").alias("price"),
        F.when(c("o_orderkey") % 3 > 0, c("o_orderpriority")).alias("priority"), c("o_orderstatus").alias("status"),
    )


@query(
    "s8_json_sink",
    """SELECT '/' || o_orderstatus AS topic, epoch_us(o_orderdate) * 1000 AS log_time_ns, epoch_us(o_orderdate) * 1000 AS publish_time_ns,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS sequence, o_orderkey AS id, o_totalprice AS price,
       CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority, TRUE AS null_written FROM orders""",
)
def s8(spark, sf_dir):
    rows = _order_rows(spark, sf_dir).withColumn("at", c("id"))
    sent = export.to_messages(rows, "orders", F.concat(F.lit("/"), "status"), order=["at"], leave_out=["status"])
    text = c("payload").cast("string")
    return sent.select(
        "topic", "log_time_ns", "publish_time_ns", "sequence", F.get_json_object(text, "$.id").cast("bigint").alias("id"),
        F.get_json_object(text, "$.price").cast("double").alias("price"), F.get_json_object(text, "$.priority").alias("priority"),
        text.contains('"priority":').alias("null_written"),
    )


@query(
    "s9_time_column",
    """SELECT o_orderkey AS id, kind, CASE kind WHEN 'event' THEN epoch_us(o_orderdate) * 1000 WHEN 'ingest' THEN o_orderkey ELSE 0 END AS log_time_ns,
       CASE kind WHEN 'event' THEN 2 ELSE 1 END AS body_fields FROM orders, (VALUES ('event'), ('ingest'), ('none')) t(kind)""",
)
def s9(spark, sf_dir):
    """The event time is preferred, then the ingest time, then 0; only the chosen column leaves the body."""
    rows = _order_rows(spark, sf_dir).select("id", "timestamp_ns", c("id").alias("recording_timestamp_ns"))
    parts = None
    for kind, table in {
        "event": rows, "ingest": rows.drop("timestamp_ns"), "none": rows.drop("timestamp_ns", "recording_timestamp_ns")
    }.items():
        part = table.select(
            "id", F.lit(kind).alias("kind"), export.log_time(table).alias("log_time_ns"),
            F.size(F.json_object_keys(export.json_body(table, []))).alias("body_fields"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    "s10_json_schema",
    """SELECT 'T' || o_orderkey AS "table", '{"properties":{"c' || o_custkey || '":{"type":"' ||
       CASE o_custkey % 4 WHEN 0 THEN 'number' WHEN 1 THEN 'boolean' ELSE 'string' END || '"},"d":{"type":"number"}},"type":"object"}' AS json_schema FROM orders""",
)
def s10(spark, sf_dir):
    """Orders as tables of three columns, the type of one depending on the customer."""
    types = F.array(*[F.lit(t) for t in ("double", "boolean", "string", "array<double>")])
    column = F.concat(F.lit("c"), c("o_custkey").cast("string"))
    rows = load(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), c("o_orderkey").cast("string")).alias("table"),
        F.explode(
            F.array(
                F.struct(F.lit("timestamp_ns").alias("column"), F.lit("bigint").alias("type")),
                F.struct(F.lit("d").alias("column"), F.lit("decimal(20,0)").alias("type")),
                F.struct(column.alias("column"), F.get(types, (c("o_custkey") % 4).cast("int")).alias("type")),
            )
        ).alias("f"),
    )
    return json_schema(rows.select("table", "f.column", "f.type"))


@query(
    "s11_cell_to_json",
    """SELECT l_orderkey, l_linenumber, l_quantity AS real, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS widened, l_partkey AS whole,
       l_returnflag AS text, 'null' AS list, 'null' AS bytes, CASE WHEN l_linenumber > 3 THEN 'true' ELSE 'null' END AS flag FROM lineitem""",
)
def s11(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", c("l_quantity").alias("real"), c("l_tax").cast("float").alias("widened"),
        c("l_partkey").alias("whole"), c("l_returnflag").alias("text"), F.array("l_tax").alias("list"),
        c("l_returnflag").cast("binary").alias("bytes"), F.when(c("l_linenumber") > 3, True).alias("flag"),
    )
    body = F.try_parse_json(export.json_body(rows, ["l_orderkey", "l_linenumber"], export.scalar_to_json))
    cell = lambda name, kind: F.try_variant_get(body, f"$.{name}", kind)
    return rows.select(
        "l_orderkey", "l_linenumber", cell("real", "double").alias("real"), cell("widened", "double").alias("widened"),
        cell("whole", "bigint").alias("whole"), cell("text", "string").alias("text"),
        *[F.to_json(cell(n, "variant")).alias(n) for n in ("list", "bytes", "flag")],
    )


@query(
    "s12_publish",
    """SELECT CASE WHEN event_type = 'error' THEN 'skipped' ELSE 'uploaded' END AS status, COUNT(*) AS topics
       FROM (SELECT DISTINCT event_type FROM events) GROUP BY 1""",
)
def s12(spark, sf_dir):
    return event_store(spark, sf_dir)[2]


@query(
    "s12_publish_stray",
    f"""WITH {EV} SELECT 'no_channel' AS reason, '/' || event_type AS topic, ns AS log_time_ns FROM ev WHERE event_type IN ('click', 'error')""",
)
def s12_stray(spark, sf_dir):
    """Two channels are missing: their messages are kept as rejects."""

    def make():
        store = SequenceStore(spark, scratch_dir(spark, "store"))
        channels = event_channels(spark, sf_dir).where("topic not in ('/click', '/error')")
        return store, publish(store, event_messages(spark, sf_dir), channels)[0]

    store, key = _once(spark, "stray", sf_dir, make)
    return store.rejects(key, NO_CHANNEL).select("reason", "topic", "log_time_ns")


@query(
    "s13_sequence_naming",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'given ' || page_id ELSE
       CASE WHEN regexp_matches(f, '^.+\\.[^.]*$') THEN regexp_extract(f, '^(.+)\\.[^.]*$', 1) ELSE f END END AS name
       FROM (SELECT page_id, regexp_extract(url, '[^/]*$') AS f FROM pages)""",
)
def s13(spark, sf_dir):
    given = F.when(c("page_id") % 2 == 0, F.concat(F.lit("given "), c("page_id").cast("string"))).otherwise("")
    return load(spark, sf_dir, "pages").select(
        "page_id", M.sequence_name(F.substring_index("url", "/", -1), given).alias("name")
    )


@query(
    "s5_s8_round_trip",
    f"""WITH {EV} SELECT ns AS timestamp_ns, user_id, value FROM ev WHERE event_type = 'error' AND {GOOD_EVENT}""",
)
def round_trip(spark, sf_dir):
    """A topic read as a table, written as messages, read again."""
    table = infer.read_channel(index.topic_scan(event_messages(spark, sf_dir), "/error"))
    again = export.to_messages(table, "copy", "/error")
    return good_rows(infer.channel_table(again))
