"""O: projections, one per ontology tag."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.registry import EV, GOOD_EVENT, lines, messages_from, orders, projected, query, scalars_of
from registered.sources import _once
from sensorloom.operators import infer
from sensorloom.operators.decode import good_rows
from sensorloom.operators.flatten import flatten_structs
from sensorloom.operators.index import topic_scan
from sensorloom.operators.ontology import project_flat, project_json
from sensorloom.operators.routing import tag_map
from sensorloom.plans.publish import publish
from sensorloom.plans.store import SequenceStore
from sensorloom.session import scratch_dir
from sensorloom.sources.bridges import event_channels, event_messages, json_of, load, talk_messages

c = F.col

L_SEQ = "l_orderkey * 10 + l_linenumber AS sequence"
L_NS = "epoch_us(l_shipdate) * 1000"
O_NS = "epoch_us(o_orderdate) * 1000"
HEADER = ("header.stamp.sec", "header.stamp.nanosec", "header.frame_id")
TIMES = ("timestamp_ns", "recording_timestamp_ns")


def log_header(ns: str) -> str:
    return f"""({ns}) // 1000000000 AS header_stamp_sec, ({ns}) % 1000000000 AS header_stamp_nanosec,
        CAST(NULL AS VARCHAR) AS header_frame_id"""


def times(ns: str) -> str:
    return f"{ns} AS timestamp_ns, {ns} AS recording_timestamp_ns"


# Stamped messages carry this header: order key as seconds, line number as nanoseconds.
def line_stamp():
    stamp = F.struct(c("l_orderkey").alias("sec"), c("l_linenumber").alias("nanosec")).alias("stamp")
    return F.struct(stamp, c("l_returnflag").alias("frame_id"))


def stamped_sql(when: str, ns: str = L_NS) -> str:
    return f"""CASE WHEN {when} THEN l_orderkey * 1000000000 + l_linenumber ELSE {ns} END AS timestamp_ns,
        {ns} AS recording_timestamp_ns,
        CASE WHEN {when} THEN l_orderkey ELSE ({ns}) // 1000000000 END AS header_stamp_sec,
        CASE WHEN {when} THEN l_linenumber ELSE ({ns}) % 1000000000 END AS header_stamp_nanosec,
        CASE WHEN {when} THEN l_returnflag END AS header_frame_id"""


def xyz(*names: str):
    return F.struct(*[c(n).alias(a) for a, n in zip("xyzw", names)])


VEC = ("l_quantity", "l_extendedprice", "l_discount")
STAMPED = "l_linenumber % 2 = 1"


def odd():
    return c("l_linenumber") % 2 == 1


def cov3():
    return F.array(c("l_tax"), F.lit(0.0), F.lit(0.0))


COV = "CASE WHEN l_tax <> 0 THEN l_tax END AS covariance_0"


def _axes_query(name: str, tag: str, wrapper: str, axes: str):
    source = dict(zip("xyzw", (*VEC, "l_tax")))
    columns = ", ".join(f"{source[a]} AS {a}" for a in axes)

    @query(name, f"SELECT {L_SEQ}, {stamped_sql(STAMPED)}, {columns}, {COV} FROM lineitem")
    def run(spark, sf_dir):
        values = [c(source[a]).alias(a) for a in axes]
        payload = F.when(
            odd(), json_of(header=line_stamp(), covariance=cov3(), **{wrapper: F.struct(*values)})
        ).otherwise(F.to_json(F.struct(*values, cov3().alias("covariance"))))
        return projected(lines(spark, sf_dir, payload), tag, *TIMES, *HEADER, *axes, "covariance@")

    return run


_axes_query("o1_vector3d", "vector3d", "vector", "xyz")
_axes_query("o2_point3d", "point3d", "point", "xyz")
_axes_query("o3_quaternion", "quaternion", "quaternion", "xyzw")


# ---------------------------------------------------------------- compound geometry


@query(
    "o4_pose",
    f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, l_quantity AS position_x, l_extendedprice AS position_y,
        l_discount AS position_z, l_tax AS orientation_x, l_quantity AS orientation_w, {COV} FROM lineitem""",
)
def o4(spark, sf_dir):
    pose = F.struct(
        xyz(*VEC).alias("position"), F.struct(c("l_tax").alias("x"), c("l_quantity").alias("w")).alias("orientation")
    )
    kind = c("l_linenumber") % 3
    payload = (
        F.when(kind == 0, json_of(pose=F.struct(pose.alias("pose"), cov3().alias("covariance"))))
        .when(kind == 1, json_of(pose=pose, covariance=cov3()))
        .otherwise(json_of(position=pose["position"], orientation=pose["orientation"], covariance=cov3()))
    )
    return projected(
        lines(spark, sf_dir, payload), "pose", *TIMES, *HEADER, "position.x", "position.y", "position.z",
        "orientation.x", "orientation.w", "covariance@",
    )


def _motion_query(name: str, tag: str, outer: str):
    """Wrapped twice, once or not; a third of the rows has no angular part."""

    @query(
        name,
        f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, l_quantity AS linear_x, l_extendedprice AS linear_y,
            l_discount AS linear_z, CASE WHEN l_linenumber % 3 < 2 THEN l_tax END AS angular_x,
            l_linenumber % 3 = 2 AS no_angular, {COV} FROM lineitem""",
    )
    def run(spark, sf_dir):
        linear, angular = xyz(*VEC), F.struct(c("l_tax").alias("x"))
        both = F.struct(linear.alias("linear"), angular.alias("angular"))
        kind = c("l_linenumber") % 3
        payload = (
            F.when(kind == 0, json_of(**{outer: F.struct(both.alias(outer), cov3().alias("covariance"))}))
            .when(kind == 1, json_of(**{outer: both}, covariance=cov3()))
            .otherwise(json_of(linear=linear, covariance=cov3()))
        )
        rows = project_json(lines(spark, sf_dir, payload), tag, keep=["sequence"]).where("reject_reason is null")
        return scalars_of(
            rows.withColumn("no_angular", c("angular").isNull()), "sequence", *TIMES, *HEADER, "linear.x", "linear.y",
            "linear.z", "angular.x", "no_angular", "covariance@",
        )

    return run


_motion_query("o5_velocity", "velocity", "twist")
_motion_query("o6_acceleration", "acceleration", "accel")


@query(
    "o7_transform",
    f"""SELECT {L_SEQ}, {stamped_sql(STAMPED)}, l_quantity AS translation_x, l_extendedprice AS translation_y,
        l_tax AS rotation_w, CASE WHEN {STAMPED} THEN l_linestatus END AS target_frame_id FROM lineitem""",
)
def o7(spark, sf_dir):
    parts = {"translation": xyz(*VEC), "rotation": F.struct(c("l_tax").alias("w"))}
    payload = F.when(
        odd(),
        json_of(header=line_stamp(), child_frame_id=c("l_linestatus"), transform=F.struct(*[v.alias(k) for k, v in parts.items()])),
    ).otherwise(json_of(**parts))
    return projected(
        lines(spark, sf_dir, payload), "transform", *TIMES, *HEADER, "translation.x", "translation.y", "rotation.w",
        "target_frame_id",
    )


@query(
    "o8_force_torque",
    f"""SELECT {L_SEQ}, {stamped_sql(STAMPED)}, l_quantity AS force_x, l_extendedprice AS force_y, l_discount AS force_z,
        l_tax AS torque_x, CAST(NULL AS DOUBLE) AS torque_z FROM lineitem""",
)
def o8(spark, sf_dir):
    force, torque = xyz(*VEC), F.struct(c("l_tax").alias("x"))
    payload = F.when(
        odd(), json_of(header=line_stamp(), wrench=F.struct(force.alias("force"), torque.alias("torque")))
    ).otherwise(json_of(force=force, torque=torque))
    return projected(
        lines(spark, sf_dir, payload), "force_torque", *TIMES, *HEADER, "force.x", "force.y", "force.z", "torque.x", "torque.z"
    )


@query(
    "o12_motion_state",
    f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, l_quantity AS pose_position_x, l_discount AS pose_position_z,
        l_tax AS pose_orientation_w, CASE WHEN l_tax <> 0 THEN l_tax END AS pose_covariance_0,
        l_quantity AS velocity_linear_x, CAST(NULL AS DOUBLE) AS velocity_angular_x,
        CASE WHEN {STAMPED} AND l_discount <> 0 THEN l_discount END AS velocity_covariance_0,
        CASE WHEN {STAMPED} THEN l_linestatus ELSE '' END AS target_frame_id, CAST(NULL AS DOUBLE) AS acceleration_linear_x,
        CAST(NULL AS DOUBLE) AS covariance_0 FROM lineitem""",
)
def o12(spark, sf_dir):
    pose = F.struct(xyz(*VEC).alias("position"), F.struct(c("l_tax").alias("w")).alias("orientation"))
    twist = F.struct(xyz(*VEC).alias("linear"))
    doubled = json_of(
        pose=F.struct(pose.alias("pose"), cov3().alias("covariance")),
        twist=F.struct(twist.alias("twist"), F.array(c("l_discount"), F.lit(0.0)).alias("covariance")),
        child_frame_id=c("l_linestatus"),
    )
    single = json_of(
        pose=F.struct(pose["position"].alias("position"), pose["orientation"].alias("orientation"), cov3().alias("covariance")),
        twist=twist,
    )
    return projected(
        lines(spark, sf_dir, F.when(odd(), doubled).otherwise(single)), "motion_state", *TIMES, *HEADER, "pose.position.x",
        "pose.position.z", "pose.orientation.w", "pose.covariance@", "velocity.linear.x", "velocity.angular.x",
        "velocity.covariance@", "target_frame_id", "acceleration.linear.x", "covariance@",
    )


# ---------------------------------------------------------------- sensors


@query(
    "o9_imu",
    f"""WITH {EV} SELECT event_id AS sequence, ns AS timestamp_ns, ns AS recording_timestamp_ns, ns // 1000000000 AS header_stamp_sec,
        ns % 1000000000 AS header_stamp_nanosec, 'u' || user_id AS header_frame_id, value AS acceleration_x,
        CAST(k AS DOUBLE) AS acceleration_y, CAST(9.81 AS DOUBLE) AS acceleration_z,
        CASE WHEN value NOT IN (0, -1) THEN value END AS acceleration_covariance_0, CAST(user_id AS DOUBLE) AS angular_velocity_z,
        CASE WHEN event_id % 2 = 0 AND value <> -1 THEN CAST(1 AS DOUBLE) END AS orientation_w,
        CASE WHEN event_id % 2 = 0 AND value NOT IN (0, -1) THEN value END AS orientation_covariance_0
        FROM ev WHERE event_type = 'click'""",
)
def o9(spark, sf_dir):
    return projected(
        topic_scan(event_messages(spark, sf_dir), "/click"), "imu", *TIMES, *HEADER, "acceleration.x", "acceleration.y",
        "acceleration.z", "acceleration.covariance@", "angular_velocity.z", "orientation.w", "orientation.covariance@",
    )


@query(
    "o10_gps",
    f"""WITH {EV} SELECT event_id AS sequence, ns AS timestamp_ns, ns AS recording_timestamp_ns, {log_header('ns')},
        value AS position_x, CAST(user_id AS DOUBLE) AS position_y, CAST(k AS DOUBLE) AS position_z,
        CASE WHEN value NOT IN (0, -1) THEN value END AS position_covariance_0, CAST(2 AS SMALLINT) AS position_covariance_type,
        CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 4 AS TINYINT) END AS status_status,
        CASE WHEN event_id % 2 = 0 THEN CAST(k AS INTEGER) END AS status_service,
        CAST(NULL AS DOUBLE) AS status_hdop, CAST(NULL AS DOUBLE) AS velocity_x FROM ev WHERE event_type = 'signup'""",
)
def o10(spark, sf_dir):
    return projected(
        topic_scan(event_messages(spark, sf_dir), "/signup"), "gps", *TIMES, *HEADER, "position.x", "position.y", "position.z",
        "position.covariance@", "position.covariance_type", "status.status", "status.service", "status.hdop", "velocity.x",
    )


@query(
    "o11_gps_status",
    f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, CASE WHEN l_suppkey < 128 THEN CAST(l_suppkey AS TINYINT) END AS status,
        CASE WHEN l_partkey * 50 < 65536 THEN CAST(l_partkey * 50 AS INTEGER) END AS service,
        CAST(NULL AS TINYINT) AS satellites FROM lineitem""",
)
def o11(spark, sf_dir):
    payload = json_of(status=c("l_suppkey"), service=c("l_partkey") * 50)
    return projected(lines(spark, sf_dir, payload), "gps_status", *TIMES, *HEADER, "status", "service", "satellites")


@query(
    "o13_frame_transform",
    f"""WITH {EV}, el AS (SELECT ev.*, i FROM ev, UNNEST(generate_series(1, GREATEST(event_id % 4, 1))) t(i) WHERE event_type = 'purchase')
        SELECT event_id AS sequence, CASE WHEN event_id % 4 > 0 THEN (100 + i) * 1000000000 + k ELSE ns END AS timestamp_ns,
        ns AS recording_timestamp_ns, CASE WHEN event_id % 4 > 0 THEN 100 + i ELSE ns // 1000000000 END AS header_stamp_sec,
        CASE WHEN event_id % 4 > 0 THEN k ELSE ns % 1000000000 END AS header_stamp_nanosec, CAST(NULL AS VARCHAR) AS header_frame_id,
        CASE WHEN event_id % 4 > 0 THEN value END AS translation_x, CASE WHEN event_id % 4 > 0 THEN CAST(i AS DOUBLE) END AS translation_y,
        CASE WHEN event_id % 4 > 0 THEN 'link_' || i END AS target_frame_id FROM el""",
)
def o13(spark, sf_dir):
    return projected(
        topic_scan(event_messages(spark, sf_dir), "/purchase"), "frame_transform", *TIMES, *HEADER, "translation.x",
        "translation.y", "target_frame_id",
    )


def _flat(df, tag: str, *paths: str):
    rows = project_flat(flatten_structs(df), tag, keep=["sequence"]).where(F.col("reject_reason").isNull())
    return scalars_of(rows, "sequence", *paths)


@query(
    "o14_image",
    f"""SELECT doc_id AS sequence, {times('n_chars')}, {log_header('n_chars')}, octet_length(encode(text)) AS bytes,
        md5(encode(text)) AS digest, 'raw' AS format, CAST(n_chars AS INTEGER) AS width, CAST(doc_id AS INTEGER) AS height,
        CAST(n_chars * 3 AS INTEGER) AS stride, lang AS encoding, doc_id % 2 = 1 AS is_bigendian FROM documents""",
)
def o14(spark, sf_dir):
    image = load(spark, sf_dir, "documents").select(
        c("doc_id").alias("sequence"), c("n_chars").alias("log_time_ns"), c("text").cast("binary").alias("data"),
        c("n_chars").alias("width"), c("doc_id").alias("height"), (c("n_chars") * 3).alias("step"), c("lang").alias("encoding"),
        (c("doc_id") % 2).cast("tinyint").alias("is_bigendian"),
    )
    rows = _flat(image, "image", *TIMES, *HEADER, "data", "format", "width", "height", "stride", "encoding", "is_bigendian")
    return rows.select("*", F.length("data").cast("bigint").alias("bytes"), F.md5("data").alias("digest")).drop("data")


@query(
    "o15_compressed_image",
    f"""SELECT doc_id AS sequence, {times('n_chars')}, {log_header('n_chars')}, octet_length(encode(text)) AS bytes,
        md5(encode(text)) AS digest, source AS format FROM documents""",
)
def o15(spark, sf_dir):
    image = load(spark, sf_dir, "documents").select(
        c("doc_id").alias("sequence"), c("n_chars").alias("log_time_ns"), c("text").cast("binary").alias("data"), c("source").alias("format")
    )
    rows = _flat(image, "compressed_image", *TIMES, *HEADER, "data", "format")
    return rows.select("*", F.length("data").cast("bigint").alias("bytes"), F.md5("data").alias("digest")).drop("data")


@query(
    "o16_camera_info",
    f"""SELECT vec_id AS sequence, {times('vec_id')}, {log_header('vec_id')}, vec_id AS height, CAST(label AS BIGINT) AS width,
        CASE WHEN vec_id % 2 = 0 THEN 'plumb_bob' ELSE '' END AS distortion_model,
        CASE WHEN vec_id % 2 = 0 THEN 5 ELSE 0 END AS distortion_parameters_n,
        9 AS intrinsic_parameters_n, CASE WHEN vec_id % 2 = 0 THEN CAST(label AS DOUBLE) ELSE 0.0::DOUBLE END AS intrinsic_parameters_0,
        9 AS rectification_parameters_n, 0.0::DOUBLE AS rectification_parameters_0,
        12 AS projection_parameters_n, CAST(vec_id AS DOUBLE) AS projection_parameters_0,
        CASE WHEN vec_id % 2 = 0 THEN CAST(label AS DOUBLE) END AS binning_x, CAST(NULL AS DOUBLE) AS binning_y,
        CASE WHEN vec_id % 2 = 0 THEN 10.0::DOUBLE END AS roi_offset_x, CASE WHEN vec_id % 2 = 0 THEN 0.0::DOUBLE END AS roi_offset_y,
        CASE WHEN vec_id % 2 = 0 THEN vec_id END AS roi_height, CASE WHEN vec_id % 2 = 0 THEN label > 4 END AS roi_do_rectify
        FROM embeddings""",
)
def o16(spark, sf_dir):
    filled = lambda column, n: F.array_repeat(column.cast("double"), n)
    full = json_of(
        height=c("vec_id"), width=c("label"), distortion_model=F.lit("plumb_bob"), d=filled(c("label"), 5), k=filled(c("label"), 9),
        r=filled(c("label"), 8), P=filled(c("vec_id"), 12), binning_x=c("label"),
        roi=F.struct(F.lit(10).alias("x_offset"), c("vec_id").alias("height"), (c("label") > 4).alias("do_rectify")),
    )
    bare = json_of(height=c("vec_id"), width=c("label"), p=filled(c("vec_id"), 12))
    payload = F.when(c("vec_id") % 2 == 0, full).otherwise(bare)
    rows = messages_from(spark, sf_dir, "embeddings", payload, c("vec_id"), c("vec_id"))
    return projected(
        rows, "camera_info", *TIMES, *HEADER, "height", "width", "distortion_model", "distortion_parameters#",
        "intrinsic_parameters#", "intrinsic_parameters@", "rectification_parameters#", "rectification_parameters@",
        "projection_parameters#", "projection_parameters@", "binning.x", "binning.y", "roi.offset.x", "roi.offset.y", "roi.height",
        "roi.do_rectify",
    )


def _float(expression: str) -> str:
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE)"


@query(
    "o17_battery_state",
    f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, {_float('l_quantity')} AS voltage, {_float('l_tax')} AS temperature,
        {_float('l_extendedprice')} AS charge, 0.0::DOUBLE AS percentage, CAST(l_linenumber AS SMALLINT) AS power_supply_status,
        CAST(CASE WHEN l_suppkey < 256 THEN l_suppkey ELSE 0 END AS SMALLINT) AS power_supply_health, l_linenumber > 3 AS present,
        l_returnflag AS location, '' AS serial_number,
        CASE WHEN {STAMPED} THEN {_float('l_discount')} END AS cell_voltage_0, CAST(NULL AS DOUBLE) AS cell_temperature_0 FROM lineitem""",
)
def o17(spark, sf_dir):
    payload = json_of(
        voltage=c("l_quantity"), temperature=c("l_tax"), charge=c("l_extendedprice"), power_supply_status=c("l_linenumber"),
        power_supply_health=c("l_suppkey"), present=c("l_linenumber") > 3, location=c("l_returnflag"),
        cell_voltage=F.when(odd(), F.array("l_discount", "l_tax")).otherwise(F.array().cast("array<double>")),
    )
    rows = projected(
        lines(spark, sf_dir, payload), "battery_state", *TIMES, *HEADER, "voltage", "temperature", "charge", "percentage",
        "power_supply_status", "power_supply_health", "present", "location", "serial_number", "cell_voltage@", "cell_temperature@",
    )
    wide = ("voltage", "temperature", "charge", "percentage", "cell_voltage_0", "cell_temperature_0")
    return rows.withColumns({n: c(n).cast("double") for n in wide})


@query(
    "o18_robot_joint",
    f"""SELECT vec_id AS sequence, {times('vec_id')}, {log_header('vec_id')}, 2 AS names_n, 'joint_' || label AS names_0,
        len(embedding) AS positions_n, ROUND(CAST(embedding[1] AS DOUBLE), 6) AS position, 0 AS velocities_n,
        CASE WHEN vec_id % 2 = 0 THEN 1 ELSE 0 END AS efforts_n FROM embeddings""",
)
def o18(spark, sf_dir):
    payload = json_of(
        name=F.array(F.concat(F.lit("joint_"), c("label").cast("string")), F.lit("joint_b")),
        position=c("embedding").cast("array<double>"), effort=F.when(c("vec_id") % 2 == 0, F.array(F.lit(1.5))),
    )
    rows = projected(
        messages_from(spark, sf_dir, "embeddings", payload, c("vec_id"), c("vec_id")), "robot_joint", *TIMES, *HEADER,
        "names#", "names@", "positions#", "positions@", "velocities#", "efforts#",
    )
    return rows.withColumn("position", F.round("positions_0", 6)).withColumn("positions_n", c("positions_n").cast("bigint")).drop("positions_0")


@query(
    "o19_nmea_sentence",
    f"""SELECT o_orderkey AS sequence, {times(O_NS)}, {log_header(O_NS)},
        CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '$GP' || o_orderpriority END AS sentence FROM orders""",
)
def o19(spark, sf_dir):
    sentence = F.when(c("o_orderkey") % 5 == 0, json_of(sentence=c("o_orderkey"))).otherwise(
        json_of(sentence=F.concat(F.lit("$GP"), "o_orderpriority"))
    )
    return projected(orders(spark, sf_dir, sentence), "nmea_sentence", *TIMES, *HEADER, "sentence")


@query(
    "o20_roi",
    f"""SELECT p_partkey AS sequence, {times('p_partkey')}, {log_header('p_partkey')}, CAST(p_size AS DOUBLE) AS offset_x,
        0.0::DOUBLE AS offset_y, CAST(p_size * 2 AS BIGINT) AS height, 0::BIGINT AS width, p_size > 25 AS do_rectify FROM part""",
)
def o20(spark, sf_dir):
    payload = json_of(x_offset=c("p_size"), height=c("p_size") * 2, width=-c("p_partkey") - 1, do_rectify=c("p_size") > 25)
    rows = messages_from(spark, sf_dir, "part", payload, c("p_partkey"), c("p_partkey"))
    return projected(rows, "roi", *TIMES, *HEADER, "offset.x", "offset.y", "height", "width", "do_rectify")


@query(
    "o21_raw",
    f"""WITH {EV} SELECT ns AS _log_time_ns, user_id, value FROM ev WHERE event_type = 'error' AND {GOOD_EVENT}""",
)
def o21(spark, sf_dir):
    return good_rows(infer.raw_projection(topic_scan(event_messages(spark, sf_dir), "/error")))


def raw_store(spark, sf_dir):
    """Two topics with different fields, and some broken messages, published under the tag ``raw``."""

    def make():
        messages = event_messages(spark, sf_dir).where("topic in ('/error', '/signup', '/click')")
        channels = event_channels(spark, sf_dir).where("topic in ('/error', '/signup')").withColumn("schema_name", F.lit("acme/Any"))
        store = SequenceStore(spark, scratch_dir(spark, "store"))
        key, _ = publish(store, messages, channels, tags=tag_map(spark, {"acme/Any": "raw"}))
        return store, key

    return _once(spark, "raw", sf_dir, make)


@query(
    "o21_raw_published",
    f"""WITH {EV} SELECT '/error' AS topic, '_log_time_ns,timestamp_ns,user_id,value' AS columns, ns AS timestamp_ns, ns AS _log_time_ns, user_id, value,
        NULL::BIGINT AS service FROM ev WHERE event_type = 'error' AND {GOOD_EVENT}
        UNION ALL SELECT '/signup', '_log_time_ns,altitude,latitude,longitude,position_covariance,position_covariance_type,status.service,status.status,timestamp_ns',
        ns, ns, user_id, value, CASE WHEN event_id % 2 = 0 THEN k END FROM ev WHERE event_type = 'signup'""",
)
def o21_published(spark, sf_dir):
    """Topics of one tag pulled with the columns that each of them has."""
    store, _ = raw_store(spark, sf_dir)
    error, signup = store.pull_topic("events", "/error"), store.pull_topic("events", "/signup")
    named = lambda df, topic: df.withColumns({"topic": F.lit(topic), "columns": F.lit(",".join(sorted(df.columns)))})
    out = ["topic", "columns", "timestamp_ns", "_log_time_ns"]
    one = named(error, "/error").select(*out, "user_id", "value", F.lit(None).cast("bigint").alias("service"))
    two = named(signup, "/signup").select(
        *out, c("longitude").alias("user_id"), c("latitude").alias("value"), c("`status.service`").alias("service")
    )
    return one.unionByName(two)


@query(
    "o21_raw_rejects",
    f"""WITH {EV} SELECT '/error' AS topic, ns AS log_time_ns, CASE event_id % 10 WHEN 0 THEN 'parse_error' ELSE 'not_object' END AS reason
        FROM ev WHERE event_type = 'error' AND NOT ({GOOD_EVENT})""",
)
def o21_rejects(spark, sf_dir):
    store, key = raw_store(spark, sf_dir)
    return store.rejects(key, "raw").select("topic", "log_time_ns", "reason")


# ---------------------------------------------------------------- scalars


@query(
    "o22_string",
    f"""SELECT conv_id, turn, {times('turn * 1000000000')}, {log_header('turn * 1000000000')}, role, text AS data FROM conversations""",
)
def o22(spark, sf_dir):
    rows = project_json(talk_messages(spark, sf_dir), "string", keep=["recording", "topic", "sequence"])
    flat = scalars_of(rows.where("reject_reason is null"), "recording", "topic", "sequence", *TIMES, *HEADER, "data")
    return flat.select(
        F.regexp_extract("recording", "[0-9]+", 0).cast("bigint").alias("conv_id"), c("sequence").alias("turn"),
        F.substr(c("topic"), F.lit(2)).alias("role"), *TIMES, *[h.replace(".", "_") for h in HEADER], "data",
    )


@query(
    "o23_boolean",
    f"SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, {STAMPED} AND l_quantity > 20 AS data FROM lineitem",
)
def o23(spark, sf_dir):
    payload = F.when(odd(), json_of(data=c("l_quantity") > 20)).otherwise(json_of(data=c("l_quantity")))
    return projected(lines(spark, sf_dir, payload), "boolean", *TIMES, *HEADER, "data")


def _whole_query(number: int, tag: str, low: int, high: int, column: str, sql_type: str):
    """An integer column and, on even lines, text, which reads as 0. Values outside of the width are rejects."""

    @query(
        f"o{number}_{tag}",
        f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, CAST(CASE WHEN {STAMPED} THEN {column} ELSE 0 END AS {sql_type}) AS data
            FROM lineitem WHERE NOT ({STAMPED}) OR {column} BETWEEN {low} AND {high}""",
    )
    def run(spark, sf_dir):
        value = F.expr(column)
        payload = F.when(odd(), json_of(data=value)).otherwise(json_of(data=value.cast("string")))
        return projected(lines(spark, sf_dir, payload), tag, *TIMES, *HEADER, "data")

    return run


_whole_query(24, "integer8", -(2**7), 2**7 - 1, "l_partkey - 150", "TINYINT")
_whole_query(25, "integer16", -(2**15), 2**15 - 1, "(l_partkey - 500) * 40", "SMALLINT")
_whole_query(26, "integer32", -(2**31), 2**31 - 1, "(l_partkey - 500) * 2500000", "INTEGER")
_whole_query(27, "integer64", -(2**63), 2**63 - 1, "l_orderkey * -1000000007", "BIGINT")
_whole_query(28, "unsigned8", 0, 2**8 - 1, "l_partkey - 50", "SMALLINT")
_whole_query(29, "unsigned16", 0, 2**16 - 1, "(l_partkey - 50) * 60", "INTEGER")
_whole_query(30, "unsigned32", 0, 2**32 - 1, "(l_partkey - 50) * 3000000", "BIGINT")
# the greatest of all, one beyond it, and values on both sides of 2^63 and of 0
_whole_query(
    31, "unsigned64", 0, 2**64 - 1,
    """CASE l_partkey % 5 WHEN 0 THEN CAST('18446744073709551615' AS DECIMAL(20,0)) WHEN 1 THEN CAST('18446744073709551616' AS DECIMAL(20,0))
       WHEN 2 THEN CAST('9223372036854775808' AS DECIMAL(20,0)) + CAST(l_partkey AS DECIMAL(20,0))
       WHEN 3 THEN CAST(l_partkey - 50 AS DECIMAL(20,0)) ELSE CAST('9223372036854775807' AS DECIMAL(20,0)) - CAST(l_partkey AS DECIMAL(20,0)) END""",
    "DECIMAL(20,0)",
)


def _real_query(number: int, tag: str, shown: str):
    @query(
        f"o{number}_{tag}",
        f"""SELECT {L_SEQ}, {times(L_NS)}, {log_header(L_NS)}, CASE WHEN {STAMPED} THEN {shown} ELSE 0.0::DOUBLE END AS data
            FROM lineitem""",
    )
    def run(spark, sf_dir):
        payload = F.when(odd(), json_of(data=c("l_extendedprice"))).otherwise(json_of(data=c("l_returnflag")))
        rows = projected(lines(spark, sf_dir, payload), tag, *TIMES, *HEADER, "data")
        return rows.withColumn("data", c("data").cast("double"))

    return run


_real_query(32, "floating32", _float("l_extendedprice"))


@query(
    "o33_floating64",
    f"""WITH {EV} SELECT event_id AS sequence, ns AS timestamp_ns, ns AS recording_timestamp_ns, {log_header('ns')}, value AS data
        FROM ev WHERE event_type = 'view'""",
)
def o33(spark, sf_dir):
    return projected(topic_scan(event_messages(spark, sf_dir), "/view"), "floating64", *TIMES, *HEADER, "data")
