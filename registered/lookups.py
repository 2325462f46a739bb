"""J: lookups. U: hooks."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.registry import EV, query, scalars_of
from sensorloom.operators import decode, routing
from sensorloom.operators.flatten import flatten_structs
from sensorloom.operators.index import message_counts, topic_scan, with_counts
from sensorloom.operators.ontology import default_registry, project_flat, project_json
from sensorloom.plans.publish import Router, project_messages
from sensorloom.sources.bridges import (
    event_channels,
    event_messages,
    json_of,
    load,
    talk_channels,
    talk_messages,
)

c = F.col


def part_channels(spark, sf_dir):
    """Parts as channels of many recordings, with source types in all spellings and some unknown ones."""
    package = F.when(c("p_partkey") % 2 == 0, "sensor_msgs").otherwise("geometry_msgs")
    name = F.when(c("p_partkey") % 2 == 0, "Imu").otherwise("TwistWithCovarianceStamped")
    spelled = (
        F.when(c("p_partkey") % 4 < 2, F.concat(package, F.lit("/msg/"), name))
        .when(c("p_size") % 3 == 0, F.concat(package, F.lit("/"), name))
        .when(c("p_size") % 3 == 1, F.concat(package, F.lit(".msg."), name))
        .otherwise(c("p_type"))
    )
    return load(spark, sf_dir, "part").select(
        F.concat(F.lit("rec"), (c("p_partkey") % 100).cast("string")).alias("recording"),
        c("p_partkey").cast("int").alias("channel_id"),
        F.concat(F.lit("/"), "p_brand").alias("topic"),
        spelled.alias("schema_name"),
        F.when(c("p_size") % 10 == 0, "custom").otherwise("json").alias("encoding"),
    )


_KNOWN = "(p_partkey % 4 < 2 OR p_size % 3 < 2)"
_TAG = "CASE WHEN p_partkey % 2 = 0 THEN 'imu' ELSE 'velocity' END"


@query(
    "j1_channel_schema",
    """SELECT p.p_partkey AS channel_id, p.p_size AS schema_id, COALESCE(n.n_name, '') AS schema_name,
       CASE WHEN n.n_name IS NULL THEN '' ELSE 'jsonschema' END AS schema_encoding FROM part p LEFT JOIN nation n ON p_size = n_nationkey""",
)
def j1(spark, sf_dir):
    channels = load(spark, sf_dir, "part").select(
        F.lit("parts").alias("recording"), c("p_partkey").alias("channel_id"), c("p_size").alias("schema_id")
    )
    schemas = load(spark, sf_dir, "nation").select(
        F.lit("parts").alias("recording"), c("n_nationkey").alias("schema_id"), c("n_name").alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
    )
    return routing.join_schemas(channels, schemas).drop("recording")


@query(
    "j2_channel_counts",
    """SELECT conv_id AS recording, role, COUNT(*) AS message_count FROM conversations GROUP BY 1, 2
       UNION ALL SELECT DISTINCT conv_id, 'observer', 0 FROM conversations""",
)
def j2(spark, sf_dir):
    """Every recording also has a channel without messages."""
    channels = talk_channels(spark, sf_dir)
    silent = channels.dropDuplicates(["recording"]).withColumns({"channel_id": F.lit(99), "topic": F.lit("/observer")})
    index = with_counts(channels.unionByName(silent), message_counts(talk_messages(spark, sf_dir)))
    return index.select(
        F.regexp_extract("recording", "[0-9]+", 0).cast("bigint").alias("recording"), F.substr(c("topic"), F.lit(2)).alias("role"), "message_count"
    )


@query("j3_routed_channels", f"SELECT p_partkey AS channel_id, {_TAG} AS tag FROM part WHERE {_KNOWN}")
def j3(spark, sf_dir):
    return routing.routed(part_channels(spark, sf_dir), routing.tag_map(spark)).select("channel_id", "tag")


@query("j4_unrouted_channels", f"SELECT p_partkey AS channel_id, p_type AS schema_name FROM part WHERE NOT {_KNOWN}")
def j4(spark, sf_dir):
    return routing.unrouted(part_channels(spark, sf_dir), routing.tag_map(spark)).select("channel_id", "schema_name")


@query(
    "j5_tag_projections",
    f"""WITH {EV} SELECT CASE event_type WHEN 'click' THEN 'imu' WHEN 'view' THEN 'floating64' WHEN 'signup' THEN 'gps' ELSE 'frame_transform' END AS tag,
        '/' || event_type AS topic, CAST(SUM(CASE WHEN event_type = 'purchase' THEN GREATEST(event_id % 4, 1) ELSE 1 END) AS BIGINT) AS rows,
        MIN(ns) AS first_ns FROM ev WHERE event_type <> 'error' GROUP BY 1, 2""",
)
def j5(spark, sf_dir):
    """Every tag found in the channels, each projected by its own registry entry."""
    registry = default_registry()
    routes = routing.route(event_channels(spark, sf_dir), routing.tag_map(spark), registry.tags(), sorted(decode.DECODERS))
    router, messages, parts = Router(routes), event_messages(spark, sf_dir), None
    for tag, encoding in router.ways():
        rows = project_messages(router.messages_of(messages, tag, encoding), tag, encoding, registry)
        part = rows.where("reject_reason is null").select(F.lit(tag).alias("tag"), "topic", "recording_timestamp_ns")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("tag", "topic").agg(F.count("*").alias("rows"), F.min("recording_timestamp_ns").alias("first_ns"))


@query(
    "j6_topic_metadata",
    """SELECT o_orderkey, CASE WHEN o_custkey % 7 > 1 THEN c_mktsegment END AS ontology_tag,
       CASE WHEN o_custkey % 7 > 1 THEN c_name END AS owner FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 7 > 0""",
)
def j6(spark, sf_dir):
    """Orders as topics; one in seven has no metadata, one in seven metadata that does not parse."""
    text = F.when(c("c_custkey") % 7 == 1, "{bad").otherwise(
        json_of(ontology_tag=c("c_mktsegment"), owner=c("c_name"))
    )
    metadata = load(spark, sf_dir, "customer").where("c_custkey % 7 > 0").select(c("c_custkey").alias("key"), text.alias("properties"))
    topics = load(spark, sf_dir, "orders").select("o_orderkey", c("o_custkey").alias("key"))
    joined = routing.join_metadata(topics, metadata, ["key"])
    return joined.select("o_orderkey", "ontology_tag", F.try_element_at("user_metadata", F.lit("owner")).alias("owner"))


# ---------------------------------------------------------------- hooks


@query(
    "u1_registered_projection",
    f"WITH {EV} SELECT event_id AS sequence, ns AS timestamp_ns, value * 2 AS doubled FROM ev WHERE event_type = 'view'",
)
def u1(spark, sf_dir):
    registry = default_registry().add("doubled", lambda fields: {"doubled": fields.num("data") * 2})
    rows = project_json(topic_scan(event_messages(spark, sf_dir), "/view"), "doubled", registry, ["sequence"])
    return rows.select("sequence", "timestamp_ns", "doubled")


@query(
    "u1_own_frame_transform",
    f"WITH {EV} SELECT event_id AS sequence, TRUE AS listed FROM ev WHERE event_type = 'purchase'",
)
def u1_own(spark, sf_dir):
    """A projection of the caller under a tag that is opened by element otherwise: one row per message."""
    registry = default_registry().add("frame_transform", lambda fields: {"listed": fields.has("transforms")})
    rows = project_json(topic_scan(event_messages(spark, sf_dir), "/purchase"), "frame_transform", registry, ["sequence"])
    return rows.select("sequence", "listed")


@query(
    "u2_user_mappings",
    """SELECT s.p_type AS schema_name, max_by('tag_' || p_partkey, p_partkey) AS tag FROM part s GROUP BY 1""",
)
def u2(spark, sf_dir):
    """Parts as mappings entered one after the other: the last one of a type counts."""
    user = load(spark, sf_dir, "part").select(
        c("p_type").alias("schema_name"), F.concat(F.lit("tag_"), c("p_partkey").cast("string")).alias("tag"),
        c("p_partkey").alias("priority"),
    )
    mapped = routing.with_mappings(routing.tag_map(spark).withColumn("priority", F.lit(0)), user)
    return mapped.join(user.select("schema_name").distinct(), "schema_name", "left_semi")


@query(
    "u4_user_decoder",
    f"WITH {EV} SELECT event_id AS sequence, ns AS timestamp_ns, value AS data FROM ev WHERE event_type = 'view'",
)
def u4(spark, sf_dir):
    """A text encoding with its own decoder: the payload is the number itself."""

    def number(messages):
        return messages.withColumn("data", c("payload").cast("string").cast("double")).withColumn(
            "reject_reason", F.when(c("data").isNull(), "parse_error")
        )

    views = topic_scan(event_messages(spark, sf_dir), "/view")
    plain = views.withColumn("payload", F.get_json_object(c("payload").cast("string"), "$.data").cast("binary"))
    decoded = decode.decoder_for("plain", {"plain": number})(plain)
    return scalars_of(project_flat(flatten_structs(decoded), "floating64", keep=["sequence"]), "sequence", "timestamp_ns", "data")
