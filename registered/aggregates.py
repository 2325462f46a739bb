"""A: aggregations. W: windows, order, limits, unions."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from registered.decoding import event_json
from registered.registry import EV, messages_from, query
from registered.sources import event_store, talk_store
from sensorloom.operators import decode, index, infer, routing
from sensorloom.operators.catalogue import field_catalogue
from sensorloom.operators.ontology import default_registry
from sensorloom.operators.sequence import number_rows
from sensorloom.plans.reports import global_range
from sensorloom.plans.store import sequence_ranges
from sensorloom.sources.bridges import (
    event_channels,
    event_messages,
    json_of,
    line_messages,
    load,
    micros_to_ns,
    talk_channels,
    talk_messages,
)

c = F.col


@query("a1_channel_counts", "SELECT 'lines' AS recording, l_linenumber AS channel_id, COUNT(*) AS message_count FROM lineitem GROUP BY 2")
def a1(spark, sf_dir):
    return index.message_counts(line_messages(spark, sf_dir))


@query(
    "a2_recording_range",
    """SELECT 'conv_' || conv_id AS recording, COUNT(*) AS total_messages, MIN(turn) * 1000000000 AS start_time_ns,
       MAX(turn) * 1000000000 AS end_time_ns FROM conversations GROUP BY 1""",
)
def a2(spark, sf_dir):
    return index.recording_summary(talk_messages(spark, sf_dir))


def _topic_ranges(spark, sf_dir):
    talk = talk_messages(spark, sf_dir)
    return talk.groupBy("recording", "topic").agg(F.min("log_time_ns").alias("ts_min"), F.max("log_time_ns").alias("ts_max"))


@query(
    "a3_sequence_range",
    """WITH t AS (SELECT conv_id, role, MIN(turn) * 1000000000 AS a, MAX(turn) * 1000000000 AS b FROM conversations GROUP BY 1, 2)
       SELECT 'conv_' || conv_id AS recording, COALESCE(MIN(NULLIF(a, 0)), 0) AS min_ts_ns, MAX(b) AS max_ts_ns FROM t GROUP BY 1""",
)
def a3(spark, sf_dir):
    return sequence_ranges(_topic_ranges(spark, sf_dir), ["recording"])


@query(
    "a4_global_range",
    """WITH t AS (SELECT conv_id, role, MIN(turn) * 1000000000 AS a, MAX(turn) * 1000000000 AS b FROM conversations GROUP BY 1, 2)
       SELECT 'conv_' || conv_id AS recording, COALESCE(MIN(CASE WHEN a > 0 THEN a END), 0) AS global_min, MAX(b) AS global_max,
       COUNT(*) AS topics FROM t GROUP BY 1""",
)
def a4(spark, sf_dir):
    ranges = _topic_ranges(spark, sf_dir).withColumnsRenamed({"ts_min": "min_ts_ns", "ts_max": "max_ts_ns"})
    return global_range(ranges, ["recording"])


@query(
    "a5_progress_totals",
    """SELECT '/' || p_brand AS topic, COUNT(*) AS rows, CAST(SUM(length('{"data":"' || p_name || '"}')) AS BIGINT) AS bytes FROM part GROUP BY 1""",
)
def a5(spark, sf_dir):
    messages = messages_from(
        spark, sf_dir, "part", json_of(data=c("p_name")), F.lit(0).cast("bigint"), c("p_partkey"), F.concat(F.lit("/"), c("p_brand"))
    )
    return index.progress_totals(decode.good_rows(decode.decode_json(messages))).drop("recording")


@query(
    "a7_topic_status_counts",
    """SELECT CASE WHEN event_type = 'error' THEN 'skipped' ELSE 'routed' END AS status, COUNT(*) AS topics
       FROM (SELECT DISTINCT event_type FROM events) GROUP BY 1""",
)
def a7(spark, sf_dir):
    routes = routing.route(
        event_channels(spark, sf_dir), routing.tag_map(spark), default_registry().tags(), sorted(decode.DECODERS)
    )
    return routes.groupBy("status").agg(F.count("*").alias("topics"))


@query(
    "a8_channel_and_topic_numbers",
    """SELECT 'conv_' || conv_id AS recording, COUNT(DISTINCT role) AS channels, COUNT(*) AS messages FROM conversations GROUP BY 1""",
)
def a8(spark, sf_dir):
    channels = index.channel_index(talk_channels(spark, sf_dir), talk_messages(spark, sf_dir))
    return channels.groupBy("recording").agg(F.count("*").alias("channels"), F.sum("message_count").alias("messages"))


@query(
    "a9_percent_done",
    """SELECT o_orderkey, CAST(CASE WHEN o_custkey % 50 = 0 THEN 0 ELSE ROUND(LEAST(o_orderkey % 100 / (o_custkey % 50.0), 1.0) * 100) END AS INTEGER) AS percent,
       CASE WHEN o_custkey % 50 > 0 THEN CAST(FLOOR(CAST(o_orderkey AS DOUBLE) / CAST(o_custkey % 50 AS DOUBLE)) AS BIGINT) ELSE 0 END AS rate FROM orders""",
)
def a9(spark, sf_dir):
    done, total = (c("o_orderkey") % 100).cast("double"), (c("o_custkey") % 50).cast("double")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", index.percent_done(done, total).alias("percent"), index.bytes_per_second(c("o_orderkey"), total).alias("rate")
    )


# Fields of the event messages: topic, path, kind, and which rows have them.
_EVENT_FIELDS = [
    *(("click", path, "object", "TRUE") for path in ("header", "header.stamp", "linear_acceleration", "angular_velocity", "orientation")),
    *(("click", path, "integer", "TRUE") for path in ("header.stamp.sec", "header.stamp.nanosec", "linear_acceleration.y", "angular_velocity.z")),
    *(("click", path, "num", "TRUE") for path in ("linear_acceleration.x", "linear_acceleration.z", "angular_velocity.x", "angular_velocity.y")),
    *(("click", path, "num", "TRUE") for path in ("orientation.x", "orientation.w")),
    ("click", "header.frame_id", "text", "TRUE"),
    *(("click", path, "nums", "TRUE") for path in ("linear_acceleration_covariance", "orientation_covariance")),
    ("view", "data", "num", "TRUE"),
    *(("signup", path, "integer", "TRUE") for path in ("longitude", "altitude", "position_covariance_type")),
    ("signup", "latitude", "num", "TRUE"),
    ("signup", "position_covariance", "nums", "TRUE"),
    ("signup", "status", "object", "event_id % 2 = 0"),
    *(("signup", path, "integer", "event_id % 2 = 0") for path in ("status.status", "status.service")),
    ("purchase", "value", "num", "TRUE"),
    ("purchase", "transforms", "list", "event_id % 4 > 0"),
    ("purchase", "transforms", "empty", "event_id % 4 = 0"),
    *(("error", path, kind, "event_id % 10 NOT IN (0, 1)") for path, kind in (("value", "num"), ("user_id", "integer"))),
]


@query(
    "a10_key_union",
    " UNION ALL ".join(
        f"""SELECT '/{topic}' AS topic, '{path}' AS path, '{kind}' AS kind, COUNT(*) AS rows FROM events
            WHERE event_type = '{topic}' AND {has} HAVING COUNT(*) > 0"""
        for topic, path, kind, has in _EVENT_FIELDS
    ),
)
def a10(spark, sf_dir):
    """The fields of all topics in one pass over the messages."""
    decoded = decode.good_rows(decode.decode_json(event_messages(spark, sf_dir)))
    return field_catalogue(decoded, ["topic"]).withColumn("path", F.array_join("path", "."))


# ---------------------------------------------------------------- numbers, order, limit, union

_NUMBERED = """SELECT l_linenumber AS channel_id, epoch_us(l_shipdate) * 1000 AS log_time_ns, l_orderkey * 10 + l_linenumber AS id,
    row_number() OVER (PARTITION BY l_linenumber ORDER BY l_shipdate, l_orderkey * 10 + l_linenumber) - 1 AS sequence FROM lineitem"""


def _plain_lines(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        c("l_linenumber").alias("channel_id"), micros_to_ns("l_shipdate").alias("log_time_ns"),
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("id"),
    )


@query("w1_sequence_numbers", _NUMBERED)
def w1(spark, sf_dir):
    return number_rows(_plain_lines(spark, sf_dir), ["channel_id"], ["log_time_ns", "id"])


@query("w1_sequence_numbers_by_range", _NUMBERED)
def w1_range(spark, sf_dir):
    """A given number of ranges."""
    return number_rows(_plain_lines(spark, sf_dir), ["channel_id"], ["log_time_ns", "id"], tasks=7)


@query(
    "w2_sorted_columns",
    f"WITH {EV} SELECT 'timestamp_ns,a,b,c' AS names, COUNT(*) AS rows FROM ev",
)
def w2(spark, sf_dir):
    table = infer.read_channel(event_json(spark, sf_dir, json_of(c=c("k"), a=c("value"), b=c("user_id"))))
    return table.agg(F.count("*").alias("rows")).select(F.lit(",".join(table.columns)).alias("names"), "rows")


@query("w3_first_rows", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey LIMIT 500")
def w3(spark, sf_dir):
    return (
        load(spark, sf_dir, "lineitem")
        .orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
        .limit(500)
        .select("l_orderkey", "l_linenumber", "l_partkey")
    )


@query(
    "w4_union_batches",
    """SELECT o_orderkey AS id, o_totalprice AS price, NULL::VARCHAR AS name FROM orders
       UNION ALL SELECT c_custkey, NULL, c_name FROM customer""",
)
def w4(spark, sf_dir):
    left = load(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_totalprice").alias("price"))
    right = load(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"))
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "a6_pulled_rows",
    """SELECT '/' || role AS topic, COUNT(*) AS rows, CAST(SUM(octet_length(encode(text))) AS BIGINT) AS text_bytes FROM conversations GROUP BY 1""",
)
def a6(spark, sf_dir):
    store, key = talk_store(spark, sf_dir)
    return store.read_tag(key, "string").groupBy("topic").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("data").cast("bigint")).alias("text_bytes")
    )


@query(
    "a6_pull_observed",
    """SELECT '/' || event_type AS topic, CAST(SUM(CASE WHEN event_type = 'purchase' THEN GREATEST(event_id % 4, 1) ELSE 1 END) AS BIGINT) AS rows,
       TRUE AS has_bytes FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def a6_observed(spark, sf_dir):
    """What the observations of the pulls of all topics of a sequence counted."""
    store = event_store(spark, sf_dir)[0]
    seen = []
    for row in store.list_topics("events").select("topic").collect():
        observed = Observation()
        store.pull_topic("events", row["topic"], observation=observed).write.format("noop").mode("overwrite").save()
        seen.append((row["topic"], observed.get["rows"], observed.get["bytes"] > 0))
    return spark.createDataFrame(seen, "topic string, rows bigint, has_bytes boolean")
