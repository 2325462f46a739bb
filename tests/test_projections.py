import json

import pytest
from pyspark.sql import functions as F

from sensorloom import schemas as S
from sensorloom.operators.flatten import flatten_structs
from sensorloom.operators.ontology import default_registry, project_flat, project_json
from sensorloom.operators.routing import source_types, spellings, tag_map, with_mappings

TAGS = default_registry().tags()


def one(messages, tag, body):
    row = project_json(messages(json.dumps(body)), tag).first().asDict(recursive=True)
    assert row["reject_reason"] is None
    return row


def test_tags_and_types():
    assert len(TAGS) == 32 and len(source_types()) == 45
    assert set(source_types().values()) | {"gps_status"} == set(TAGS)


@pytest.mark.parametrize("tag", TAGS)
def test_empty_input_keeps_the_schema(messages, spark, tag):
    empty = project_json(messages("{}").where("false"), tag)
    assert empty.count() == 0 and {"timestamp_ns", "recording_timestamp_ns"} <= set(empty.columns)
    bare = project_json(messages("{}"), tag, keep=[])
    assert bare.count() == 1 and bare.schema == project_json(messages("{}").where("false"), tag, keep=[]).schema


COV36 = [0.1] * 36


@pytest.mark.parametrize("body", [{"x": 1, "y": 2.5, "z": True}, {"vector": {"x": 1, "y": 2.5, "z": True}}, {"vector": {"x": 1.0, "y": 2.5, "z": 1}, "x": 9}])
def test_vector(messages, body):
    row = one(messages, "vector3d", body)
    assert (row["x"], row["y"], row["z"], row["covariance"]) == (1.0, 2.5, 1.0, None)
    assert row["header"] == {"seq": None, "stamp": {"sec": 1, "nanosec": 0}, "frame_id": None}


@pytest.mark.parametrize("wrap", [lambda p: {**p, "covariance": COV36}, lambda p: {"pose": p, "covariance": COV36},
                                  lambda p: {"pose": {"pose": p, "covariance": COV36}}])
def test_pose_variants(messages, wrap):
    row = one(messages, "pose", wrap({"position": {"x": 1, "y": 2, "z": 3}, "orientation": {"w": 1}}))
    assert (row["position"]["z"], row["orientation"]["w"], row["covariance"]) == (3.0, 1.0, COV36)


def test_velocity_parts_are_null_without_axes(messages):
    row = one(messages, "velocity", {"twist": {"linear": {"x": 1}, "angular": {"x": "text"}}})
    assert row["linear"]["x"] == 1.0 and row["angular"] is None


def test_imu_orientation(messages):
    base = {"linear_acceleration": {"x": 0.1, "y": 0.2, "z": 9.81}, "angular_velocity": {"x": 0.01}, "orientation": {"x": 0, "w": 1}}
    assert one(messages, "imu", base)["orientation"] is None
    assert one(messages, "imu", base | {"orientation_covariance": [-1, 0]})["orientation"] is None
    assert one(messages, "imu", base | {"orientation_covariance": []})["orientation"] is None
    known = one(messages, "imu", base | {"orientation_covariance": [0.01, 0]})
    assert known["orientation"]["w"] == 1.0 and known["orientation"]["covariance"] == [0.01, 0.0]
    zero = one(messages, "imu", base | {"orientation_covariance": [0, 0]})
    assert zero["orientation"]["w"] == 1.0 and zero["orientation"]["covariance"] is None
    assert zero["acceleration"]["z"] == 9.81


def test_gps(messages):
    row = one(messages, "gps", {"latitude": 45.5, "longitude": -122.5, "altitude": 100, "position_covariance": [1, 0, 0], "position_covariance_type": 2})
    assert (row["position"]["x"], row["position"]["covariance_type"], row["status"], row["velocity"]) == (45.5, 2, None, None)
    assert one(messages, "gps", {"status": {"service": 3}})["status"]["service"] == 3
    row = one(messages, "gps_status", {"status": 2, "service": 3})
    assert (row["status"], row["service"], row["satellites"]) == (2, 3, None)


def test_odometry(messages):
    for wrap in (lambda n, v: {n: {n: v}}, lambda n, v: {n: v}):
        body = wrap("pose", {"position": {"x": 1}}) | wrap("twist", {"linear": {"x": 2}})
        row = one(messages, "motion_state", body | {"child_frame_id": "base_link"})
        assert (row["pose"]["position"]["x"], row["velocity"]["linear"]["x"], row["target_frame_id"]) == (1.0, 2.0, "base_link")
        assert row["acceleration"] is None
    assert one(messages, "motion_state", {"position": {"x": 1}})["pose"]["position"]["x"] is None


def _links(n):
    return [
        {"header": {"stamp": {"sec": 100 + i, "nanosec": 0}}, "child_frame_id": f"link_{i}", "transform": {"translation": {"x": i}}} for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 3])
def test_transforms(messages, n):
    out = project_json(messages(json.dumps({"transforms": _links(n)})), "frame_transform").orderBy("timestamp_ns").collect()
    assert [(r.timestamp_ns, r.target_frame_id, r.translation.x) for r in out] == [((100 + i) * 10**9, f"link_{i}", float(i)) for i in range(n)]
    assert {r.recording_timestamp_ns for r in out} == {10**9}


def test_transforms_without_list_or_stamp(messages):
    for body in ({"transforms": []}, {"child_frame_id": "x"}):
        row = one(messages, "frame_transform", body)
        assert row["timestamp_ns"] == 10**9 and row["header"]["stamp"]["sec"] == 1
    row = one(messages, "frame_transform", {"transforms": [{"child_frame_id": "y"}]})
    assert (row["timestamp_ns"], row["header"], row["target_frame_id"]) == (10**9, None, "y")


def test_sensors(messages):
    camera = {"height": 480, "width": 640, "distortion_model": "plumb_bob", "d": [0.1] * 5, "k": [1] * 9, "r": [1] * 8, "P": [2] * 12,
              "binning_x": 1, "roi": {"x_offset": 10, "height": 100}}
    row = one(messages, "camera_info", camera)
    assert (row["height"], len(row["distortion_parameters"]), row["intrinsic_parameters"]) == (480, 5, [1.0] * 9)
    assert row["rectification_parameters"] == [0.0] * 9 and row["projection_parameters"] == [2.0] * 12
    assert row["binning"] == {"x": 1.0, "y": None} and row["roi"]["offset"] == {"x": 10.0, "y": 0.0} and row["roi"]["width"] == 0
    bare = one(messages, "camera_info", {})
    assert bare["binning"] is None and bare["roi"] is None and bare["distortion_parameters"] == []

    row = one(messages, "battery_state", {"voltage": 12.5, "power_supply_health": 300, "cell_voltage": [3.5] * 3, "cell_temperature": []})
    assert (row["voltage"], row["power_supply_health"], row["cell_voltage"], row["cell_temperature"]) == (12.5, 0, [3.5] * 3, None)
    row = one(messages, "robot_joint", {"name": ["joint1", "joint2"], "position": [1, 2]})
    assert (row["names"], row["positions"], row["efforts"]) == (["joint1", "joint2"], [1.0, 2.0], [])
    assert one(messages, "nmea_sentence", {"sentence": "$GPGGA"})["sentence"] == "$GPGGA"
    row = one(messages, "roi", {"x_offset": 10, "y_offset": 20, "height": 100, "width": 200})
    assert (row["offset"], row["height"], row["do_rectify"]) == ({"x": 10.0, "y": 20.0}, 100, None)


def test_image_from_columns(spark):
    df = spark.sql(
        "SELECT 5L log_time_ns, cast('abcd' as binary) data, cast(640 as bigint) width, 480 height, 1920L step, 'bgr8' encoding, 1S is_bigendian, "
        "named_struct('stamp', named_struct('sec', 2, 'nanosec', 3L), 'frame_id', 'cam') header"
    )
    row = project_flat(flatten_structs(df), "image").first()
    assert (bytes(row.data), row.format, row.width, row.stride, row.encoding, row.is_bigendian) == (b"abcd", "raw", 640, 1920, "bgr8", True)
    assert (row.timestamp_ns, row.recording_timestamp_ns, row.header.frame_id) == (2_000_000_003, 5, "cam")


def test_columns_and_json_agree(messages, spark):
    """A struct source gives the same rows as the JSON of the same values."""
    body = {"header": {"stamp": {"sec": 7, "nanosec": 9}, "frame_id": "f"}, "transforms": _links(2), "pose": {"pose": {"position": {"x": 1.5}}},
            "twist": {"linear": {"x": 2}, "covariance": [1.0, 0.5]}, "latitude": 4.5, "status": {"status": 1}, "name": ["a"], "data": 4}
    source = spark.read.json(spark.createDataFrame([(json.dumps(body),)], "value string").rdd.map(lambda r: r[0]))
    flat = flatten_structs(source.withColumn("log_time_ns", F.lit(10**9)))
    for tag in TAGS:
        a = [r.asDict(recursive=True) for r in project_json(messages(json.dumps(body)), tag, keep=[]).collect()]
        b = [r.asDict(recursive=True) for r in project_flat(flat, tag, keep=[]).collect()]
        assert a == b, tag


@pytest.mark.parametrize(
    "tag, good, bad",
    [("integer8", -128, 128), ("integer16", 32767, -32769), ("integer32", 2**31 - 1, 2**31), ("unsigned8", 255, -1), ("unsigned16", 65535, 65536),
     ("unsigned32", 2**32 - 1, -5), ("integer64", 2**63 - 1, None), ("unsigned64", 2**63 - 1, -1)],
)
def test_integer_widths(messages, tag, good, bad):
    out = project_json(messages(*[json.dumps({"data": v}) for v in (good, "text", 1.5, bad)]), tag).orderBy("sequence").collect()
    assert [r.data for r in out[:3]] == [good, 0, 0]
    assert [r.reject_reason for r in out] == [None, None, None, None if bad is None else "out_of_range"]


def test_scalars(messages):
    assert one(messages, "string", {"data": "x"})["data"] == "x" and one(messages, "string", {"data": 5})["data"] == ""
    assert one(messages, "boolean", {"data": True})["data"] is True and one(messages, "boolean", {"data": 1})["data"] is False
    assert one(messages, "floating32", {"data": 0.5})["data"] == 0.5 and one(messages, "floating64", {"data": True})["data"] == 1.0


def test_registry_is_extended_by_hand(messages):
    registry = default_registry().add("mine", lambda f: {"twice": f.num("a.b") * 2})
    assert project_json(messages('{"a":{"b":4}}'), "mine", registry).first().twice == 8.0
    assert default_registry().find("mine") is None
    with pytest.raises(KeyError):
        project_json(messages("{}"), "mine")


def test_tag_map(spark):
    found = {r.schema_name: r.tag for r in tag_map(spark, {"my/Type": "imu", "std_msgs/Bool": "string"}).collect()}
    assert len(found) == 136
    assert {found[s] for s in spellings("geometry_msgs", "TwistWithCovariance")} == {"velocity"}
    assert (found["my/Type"], found["std_msgs/Bool"], found["std_msgs/msg/Bool"]) == ("imu", "string", "boolean")
    user = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("std_msgs/Bool", "z", 0)], "schema_name string, tag string, priority int")
    merged = {r.schema_name: r.tag for r in with_mappings(tag_map(spark), user).collect()}
    assert (merged["a"], merged["std_msgs/Bool"], len(merged)) == ("y", "z", 136)


TYPED = {
    "pose": {"position": S.POINT3, "orientation": S.QUAT, "header": S.HEADER, "covariance": "array<double>", "covariance_type": "smallint"},
    "velocity": {"linear": S.VEC3, "angular": S.VEC3}, "transform": {"translation": S.VEC3, "rotation": S.QUAT, "target_frame_id": "string"},
    "imu": {"acceleration": S.VEC3, "angular_velocity": S.VEC3, "orientation": S.QUAT, "header": S.HEADER},
    "gps": {"position": S.POINT3, "velocity": S.VEC3, "status": S.GPS_STATUS, "header": S.HEADER},
    "motion_state": {"pose": S.POSE, "velocity": S.VELOCITY, "target_frame_id": "string", "acceleration": S.ACCEL},
    "image": {"data": "binary", "format": "string", "width": "int", "height": "int", "stride": "int", "encoding": "string", "is_bigendian": "boolean"},
    "camera_info": {"height": "bigint", "distortion_parameters": "array<double>", "binning": S.VEC2, "roi": S.ROI},
    "battery_state": {"voltage": "float", "power_supply_status": "smallint", "cell_voltage": "array<float>"},
    "robot_joint": {"names": "array<string>", "efforts": "array<double>"}, "roi": {"offset": S.VEC2, "height": "bigint", "do_rectify": "boolean"},
    "gps_status": {"status": "tinyint", "service": "int", "satellites": "tinyint", "hdop": "double"},
    "unsigned64": {"data": "decimal(20,0)"}, "unsigned8": {"data": "smallint"}, "floating32": {"data": "float"},
}


@pytest.mark.parametrize("tag", TYPED)
def test_column_types(messages, tag):
    types = dict(project_json(messages("{}"), tag).dtypes)
    assert {n: types[n] for n in TYPED[tag]} == TYPED[tag]
    assert types["timestamp_ns"] == types["recording_timestamp_ns"] == "bigint"
