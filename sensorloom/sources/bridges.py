"""Messages and channels made from relational tables.

Any table can be looked at as a recording: a column gives the topic, one the time, the others the payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def micros_to_ns(ts: str) -> Column:
    """A timestamp without zone, read as UTC, in ns."""
    return F.unix_micros(F.col(ts).cast("timestamp")) * F.lit(1000)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_messages(
    table: DataFrame, recording: Column, channel_id: Column, topic: Column, log_time: Column, sequence: Column, payload: Column
) -> DataFrame:
    return table.select(
        recording.cast("string").alias("recording"),
        channel_id.cast("int").alias("channel_id"),
        topic.alias("topic"),
        log_time.cast("bigint").alias("log_time_ns"),
        log_time.cast("bigint").alias("publish_time_ns"),
        sequence.cast("bigint").alias("sequence"),
        payload.cast("binary").alias("payload"),
    )


def json_of(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


# Channels of the event table by event type.
EVENT_CHANNELS = {
    "click": (1, "sensor_msgs/msg/Imu"),
    "view": (2, "std_msgs.msg.Float64"),
    "signup": (3, "sensor_msgs/NavSatFix"),
    "purchase": (4, "tf2_msgs/msg/TFMessage"),
    "error": (5, "acme_msgs/msg/Unknown"),
}


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with k from the props."""
    return load(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).withColumn(
        "ns", micros_to_ns("ts")
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as one recording with five topics; some error messages are broken."""
    e = F.col
    xyz = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    stamp = F.struct(F.expr("ns div 1000000000").alias("sec"), (e("ns") % 1_000_000_000).alias("nanosec"))
    header = F.struct(stamp.alias("stamp"), F.concat(F.lit("u"), e("user_id").cast("string")).alias("frame_id"))
    odd = e("event_id") % 2 == 1
    imu = json_of(
        header=header,
        linear_acceleration=xyz(e("value"), e("k"), F.lit(9.81)),
        angular_velocity=xyz(e("value"), F.lit(0.5), e("user_id")),
        orientation=F.struct(F.lit(0.0).alias("x"), F.lit(1.0).alias("w")),
        linear_acceleration_covariance=F.array(e("value"), F.lit(0.0), F.lit(0.0)),
        orientation_covariance=F.array(F.when(odd, F.lit(-1.0)).otherwise(e("value")), F.lit(0.0)),
    )
    status = F.when(~odd, F.struct((e("user_id") % 4).alias("status"), e("k").alias("service")))
    fix = json_of(
        latitude=e("value"),
        longitude=e("user_id"),
        altitude=e("k"),
        status=status,
        position_covariance=F.array(e("value"), F.lit(0.0), F.lit(0.0)),
        position_covariance_type=F.lit(2),
    )
    element = lambda i: F.struct(
        F.struct(F.struct((F.lit(100) + i).alias("sec"), e("k").alias("nanosec")).alias("stamp")).alias("header"),
        F.concat(F.lit("link_"), i.cast("string")).alias("child_frame_id"),
        F.struct(xyz(e("value"), i, e("k")).alias("translation")).alias("transform"),
    )
    elements = F.when(e("event_id") % 4 > 0, F.transform(F.sequence(F.lit(1), (e("event_id") % 4).cast("int")), element))
    broken = F.when(e("event_id") % 10 == 0, "not json{").when(e("event_id") % 10 == 1, "[1,2,3]")
    payload = (
        F.when(e("event_type") == "click", imu)
        .when(e("event_type") == "view", json_of(data=e("value")))
        .when(e("event_type") == "signup", fix)
        .when(e("event_type") == "purchase", json_of(transforms=F.coalesce(elements, F.array()), value=e("value")))
        .otherwise(F.coalesce(broken, json_of(value=e("value"), user_id=e("user_id"))))
    )
    ids = F.create_map(*[F.lit(x) for name, (i, _) in EVENT_CHANNELS.items() for x in (name, i)])
    return as_messages(
        event_rows(spark, sf_dir), F.lit("events"), ids[e("event_type")], F.concat(F.lit("/"), e("event_type")),
        e("ns"), e("event_id"), payload,
    )


def event_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels of ``event_messages``, one per event type found."""
    ids = F.create_map(*[F.lit(x) for name, (i, _) in EVENT_CHANNELS.items() for x in (name, i)])
    names = F.create_map(*[F.lit(x) for name, (_, s) in EVENT_CHANNELS.items() for x in (name, s)])
    kinds = load(spark, sf_dir, "events").select("event_type").distinct()
    return kinds.select(
        F.lit("events").alias("recording"),
        ids[F.col("event_type")].alias("channel_id"),
        F.concat(F.lit("/"), "event_type").alias("topic"),
        F.lit("json").alias("encoding"),
        ids[F.col("event_type")].alias("schema_id"),
        names[F.col("event_type")].alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
        F.lit("").alias("schema_data"),
    )


def line_messages(spark: SparkSession, sf_dir: str, payload: Column | None = None) -> DataFrame:
    """Line items as one recording with a topic per line number; velocity payload unless another is given."""
    c = F.col
    xyz = lambda x, y, z: F.struct(c(x).alias("x"), c(y).alias("y"), c(z).alias("z"))
    velocity = json_of(
        linear=xyz("l_quantity", "l_extendedprice", "l_discount"), angular=xyz("l_tax", "l_discount", "l_linenumber")
    )
    line = load(spark, sf_dir, "lineitem")
    return as_messages(
        line, F.lit("lines"), c("l_linenumber"), F.concat(F.lit("/line/"), c("l_linenumber").cast("string")),
        micros_to_ns("l_shipdate"), c("l_orderkey") * 10 + c("l_linenumber"), velocity if payload is None else payload,
    )


# Channel per role of a conversation.
ROLE_CHANNELS = {"system": 1, "user": 2, "assistant": 3, "tool": 4}


def talk_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations: a recording each, a topic per role, one text message per turn."""
    c = F.col
    ids = F.create_map(*[F.lit(x) for pair in ROLE_CHANNELS.items() for x in pair])
    return as_messages(
        load(spark, sf_dir, "conversations"), F.concat(F.lit("conv_"), c("conv_id").cast("string")),
        F.coalesce(ids[c("role")], F.lit(9)), F.concat(F.lit("/"), c("role")), c("turn") * 1_000_000_000, c("turn"),
        json_of(data=c("text")),
    )


def talk_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.create_map(*[F.lit(x) for pair in ROLE_CHANNELS.items() for x in pair])
    pairs = load(spark, sf_dir, "conversations").select("conv_id", "role").distinct()
    return pairs.select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("recording"),
        F.coalesce(ids[F.col("role")], F.lit(9)).alias("channel_id"),
        F.concat(F.lit("/"), "role").alias("topic"),
        F.lit("json").alias("encoding"),
        F.lit(1).alias("schema_id"),
        F.lit("std_msgs/msg/String").alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
        F.lit("").alias("schema_data"),
    )
