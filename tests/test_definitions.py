import json

import pytest

from sensorloom.operators import definitions as D
from sensorloom.plans.reports import detect_tag


@pytest.fixture(scope="module")
def channels(spark):
    def make(*pairs):
        return spark.createDataFrame(list(pairs), "schema_name string, schema_data string")

    return make


def fields(df):
    return [(r.block, r.field, r.base_type, r.array_size, r.default) for r in D.field_catalog(df).orderBy("block_no", "ordinal").collect()]


@pytest.mark.parametrize(
    "text, found",
    [
        ("float64 x\nfloat64 y", [("x", "float64", 0, None), ("y", "float64", 0, None)]),
        ("float64[9] k", [("k", "float64", 9, None)]),
        ("uint8[] data", [("data", "uint8", -1, None)]),
        ("# a comment\nfloat64 x # tail\n\n   \r\n", [("x", "float64", 0, None)]),
        ("string name \"default text\" \r\nint32 n 5", [("name", "string", 0, '"default text"'), ("n", "int32", 0, "5")]),
        ("uint8 A=1\nstring<=10 s\nbyte b\nchar c", [("b", "byte", 0, None), ("c", "char", 0, None)]),
        ("alone\nfloat64 x", [("x", "float64", 0, None)]),
        ("", []),
        ("# only\n# comments", []),
    ],
)
def test_fields(channels, text, found):
    assert [f[1:] for f in fields(channels(("pkg/T", text)))] == found


def ddl(df):
    return {r.schema_name: r.ddl for r in D.declared_ddl(df).collect()}


def test_nested(channels):
    text = (
        "Header header\ngeometry_msgs/Vector3[3] v\nunknown/Thing t\ntime at\n====\nMSG: std_msgs/Header\nTime stamp\nstring frame_id\n"
        "======\nMSG: builtin/Time\nint32 sec\nuint32 nanosec\n===\nMSG: geometry_msgs/Vector3\nfloat64 x\n==\n=====\nMSG: pkg/Empty\n"
    )
    out = ddl(channels(("pkg/T", text), ("pkg/U", "float32[] a\npkg/Empty e\n===\nMSG: pkg/Empty"), ("pkg/V", "")))
    assert out["pkg/T"] == (
        "`timestamp_ns` bigint, `header` struct<`stamp`:struct<`sec`:int,`nanosec`:bigint>,`frame_id`:string>, "
        "`v` array<struct<`x`:double>>, `t` binary, `at` struct<sec:bigint,nanosec:bigint>"
    )
    assert out["pkg/U"] == "`timestamp_ns` bigint, `a` array<float>, `e` struct<>" and out["pkg/V"] == "`timestamp_ns` bigint"


def test_same_name_in_two_texts_stays_apart(channels):
    same = ("pkg/T", "Sub s\n===\nMSG: a/Sub\nint8 x"), ("pkg/T", "Sub s\n===\nMSG: a/Sub\nbool x"), ("pkg/T", "Sub s\n===\nMSG: a/Sub\nbool x")
    assert sorted(r.ddl for r in D.declared_ddl(channels(*same)).collect()) == [
        "`timestamp_ns` bigint, `s` struct<`x`:boolean>", "`timestamp_ns` bigint, `s` struct<`x`:tinyint>",
    ]


def test_last_block_of_a_name_counts(channels):
    df = channels(("pkg/T", "Sub s\n===\nMSG: Sub\nint8 x\n===\nMSG: Sub\nbool y"))
    assert ddl(df)["pkg/T"] == "`timestamp_ns` bigint, `s` struct<`y`:boolean>"


def test_self_nesting_has_no_schema_and_harms_no_other(channels):
    got = ddl(channels(("pkg/T", "int8 x\nA a\n===\nMSG: A\nB b\n===\nMSG: B\nA a"), ("pkg/U", "C c\n===\nMSG: C\nbool y")))
    assert got == {"pkg/T": None, "pkg/U": "`timestamp_ns` bigint, `c` struct<`y`:boolean>"}


def test_a_column_listed_twice(spark):
    rows = [("t", "a", "double"), ("t", "a", "bigint"), ("t", "b", "double"), ("t", "b", "string"), ("t", "timestamp_ns", "bigint")]
    schema = D.json_schema(spark.createDataFrame(rows, "`table` string, `column` string, type string")).first().json_schema
    assert json.loads(schema)["properties"] == {"a": {"type": "number"}, "b": {"type": "string"}}


@pytest.mark.parametrize(
    "columns, tag",
    [("acceleration angular_velocity", "imu"), ("position orientation", "pose"), ("position status orientation", "gps"), ("linear angular", "velocity"),
     ("mystery", None), ("data:binary", "compressed_image"), ("data:binary width", "image"), ("data:binary a b c", None), ("data", None)],
)
def test_detect(spark, columns, tag):
    rows = [("t", c.split(":")[0], c.split(":")[1] if ":" in c else "string") for c in columns.split()]
    assert detect_tag(spark.createDataFrame(rows, "topic string, column string, type string")).first().tag == tag
