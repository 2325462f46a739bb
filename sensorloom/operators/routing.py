"""From channels to ontology tags.

Channels and tag map are lookups. No side is broadcast by hint: the optimizer knows the size of the tag map,
and adaptive execution decides on measured sizes for the channels, which grow with the recordings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import metadata as M
from sensorloom.functions.fields import text_literal

# Source types and their tags.
_PLAIN = {
    "sensor_msgs": {
        "Imu": "imu",
        "NavSatFix": "gps",
        "Image": "image",
        "CompressedImage": "compressed_image",
        "CameraInfo": "camera_info",
        "BatteryState": "battery_state",
        "JointState": "robot_joint",
        "RegionOfInterest": "roi",
    },
    "nmea_msgs": {"Sentence": "nmea_sentence"},
    "nav_msgs": {"Odometry": "motion_state"},
    "tf2_msgs": {"TFMessage": "frame_transform"},
    "std_msgs": {
        "String": "string",
        "Bool": "boolean",
        **{f"Int{n}": f"integer{n}" for n in (8, 16, 32, 64)},
        **{f"UInt{n}": f"unsigned{n}" for n in (8, 16, 32, 64)},
        **{f"Float{n}": f"floating{n}" for n in (32, 64)},
    },
}
_STAMPED = {
    "Vector3": "vector3d",
    "Point": "point3d",
    "Quaternion": "quaternion",
    "Transform": "transform",
    "Wrench": "force_torque",
}
_WITH_COVARIANCE = {"Pose": "pose", "Twist": "velocity", "Accel": "acceleration"}


def source_types() -> dict[tuple[str, str], str]:
    """Tag by (package, type)."""
    types = {(package, name): tag for package, tags in _PLAIN.items() for name, tag in tags.items()}
    for endings, tags in (
        (("", "Stamped"), _STAMPED),
        (("", "Stamped", "WithCovariance", "WithCovarianceStamped"), _WITH_COVARIANCE),
    ):
        types |= {("geometry_msgs", name + end): tag for name, tag in tags.items() for end in endings}
    return types


def spellings(package: str, name: str) -> tuple[str, str, str]:
    return f"{package}/msg/{name}", f"{package}/{name}", f"{package}.msg.{name}"


def tag_map(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """(schema_name, tag): every source type in its three spellings; ``extra`` entries win."""
    mapping = {s: tag for key, tag in source_types().items() for s in spellings(*key)} | (extra or {})
    # inline values: the optimizer knows how small they are
    rows = ", ".join(f"({text_literal(name)}, {text_literal(tag)})" for name, tag in sorted(mapping.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(schema_name, tag)")


def with_mappings(base: DataFrame, user: DataFrame) -> DataFrame:
    """Add mappings from a table (schema_name, tag, priority); the highest priority wins."""
    rows = base.select("schema_name", "tag", F.lit(-1).alias("priority")).unionByName(
        user.select("schema_name", "tag", "priority")
    )
    return rows.groupBy("schema_name").agg(F.max_by("tag", "priority").alias("tag"))


def join_schemas(channels: DataFrame, schemas: DataFrame) -> DataFrame:
    """Channels with their schema; a missing schema leaves blank names."""
    joined = channels.join(schemas, ["recording", "schema_id"], "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in ("schema_name", "schema_encoding", "schema_data") if c in joined.columns}
    )


def join_metadata(topics: DataFrame, metadata: DataFrame, keys: list[str]) -> DataFrame:
    """Topics with the tag and the user's entries of their metadata (column ``properties``); both null or empty without."""
    joined = topics.join(metadata, keys, "left")
    return joined.withColumns(
        {"ontology_tag": M.ontology_tag(F.col("properties")), "user_metadata": M.user_metadata(F.col("properties"))}
    ).drop("properties")


def routed(channels: DataFrame, tags: DataFrame) -> DataFrame:
    return channels.join(tags, "schema_name")


def unrouted(channels: DataFrame, tags: DataFrame) -> DataFrame:
    return channels.join(tags, "schema_name", "left_anti")


def route(channels: DataFrame, tags: DataFrame, known_tags: list[str], encodings: list[str]) -> DataFrame:
    """Every channel with ``tag`` and ``status``: routed, skipped (no adapter) or failed (no decoder)."""
    found = channels.join(tags, "schema_name", "left")
    adapter = F.coalesce(F.col("tag").isin(known_tags), F.lit(False))
    status = (
        F.when(~adapter, "skipped").when(F.col("encoding").isin(encodings), "routed").otherwise("failed")
    )
    return found.withColumn("status", status)
