import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import decode, flatten, infer
from sensorloom.operators.extract import extract, leaf_name


def table(messages, *payloads):
    return infer.channel_table(messages(*payloads))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"x":1.5,"y":2.5}', {"x": 1.5, "y": 2.5}),
        ('{"pos":{"x":1.0,"y":2.0}}', {"pos.x": 1.0, "pos.y": 2.0}),
        ('{"count":42}', {"count": 42}),
        ('{"flag":true}', {"flag": True}),
        ('{"name":"hello"}', {"name": "hello"}),
        ('{"values":[1.0,2.0,3.0]}', {"values": [1.0, 2.0, 3.0]}),
        ('{"tags":["a","b","c"]}', {"tags": ["a", "b", "c"]}),
        ('{"val":99.5,"name":"test","ok":false}', {"name": "test", "ok": False, "val": 99.5}),
        ('{"empty":[]}', {"empty": []}),
        ('{"o":[{"b":1,"a":2}],"n":null}', {"o": '[{"a":2,"b":1}]'}),
        ('{"b":[true,1]}', {"b": "[true,1]"}),
        ('{"a.b":1,"a":{"b":2}}', {"a.b": 2}),
        ('{"k":1,"k":2}', {"k": 2}),
        ('{"it\'s":{"a b":1}}', {"it's.a b": 1}),
        ('{"k":1,"K":2}', {"k": 1, "K": 2}),
        ("{}", {}),
    ],
)
def test_values(messages, payload, expected):
    (row,) = rows(table(messages, payload))
    assert row.pop("reject_reason") is None and row.pop("timestamp_ns") == 10**9
    assert row == expected and list(row) == sorted(row)


@pytest.mark.parametrize(
    "payload, reason",
    [
        ("not json{", "parse_error"), ("[1,2,3]", "not_object"), ("5", "not_object"), ("", "parse_error"), ('{"a":1} x', "parse_error"),
        ('{"a":1},{"a":2}', "parse_error"), ('{"a":1}]', "parse_error"), ('{"a":NaN}', "parse_error"), (b'{"a":"\xff"}', "parse_error"),
        ("{'a':1}", "parse_error"), ('{"a":1e999}', "parse_error"), ('{"a":[-1.5E+400]}', "parse_error"), ('{"a":' + "9" * 400 + "}", "parse_error"), ('{"a":12345678901234567890}', "int_overflow"), ('{"a":[1,"x"]}', "mixed_array"),
        ('{"a":["x",1]}', "mixed_array"), ('{"a":[1,null]}', "mixed_array"), ('{"a":[1,true]}', "mixed_array"),
    ],
)
def test_rejects(messages, payload, reason):
    wants = {("a",): {"nums", "texts"}, ("b",): {"num"}} if reason == "mixed_array" else {("a",): {"num"}}
    for leaves in (extract(messages(payload), wants), extract(messages(payload), {("a",): {"nums"}}), table(messages, payload, '{"a":[2]}')):
        assert [r.reject_reason for r in leaves.collect()][0] == reason


@pytest.mark.parametrize(
    "payload", ['{"a":-12345678901234567890}', '{"a":12345678901234567890.5}', '{"a":"12345678901234567890"}', '{"a":18446744073709551616}',
                '{"a":[12345678901234567890]}', '  {"a":1}  ', '{"a":1e3}', '{"a":1e300,"b":"1e999"}', '{"a":1e-999}', '{"b":"null , null [null","a":1}']
)
def test_not_rejected(messages, payload):
    assert extract(messages(payload), {("a",): {"num"}}).first().reject_reason is None


def test_types_merge_over_rows(messages):
    out = table(messages, '{"a":1,"b":1,"c":[1],"d":[],"e":[]}', '{"a":1.5,"b":"x","c":[2.5],"d":["t"],"z":true,"e":[]}')
    assert dict(out.dtypes) == {
        "timestamp_ns": "bigint", "a": "double", "b": "string", "c": "array<double>", "d": "array<string>", "e": "array<double>",
        "z": "boolean", "reject_reason": "string",
    }
    first, second = rows(out)
    assert (first["a"], first["b"], first["z"], second["b"]) == (1.0, "1", None, "x")


def test_mixed_rows_do_not_spoil_the_type(messages):
    out = table(messages, '{"a":[1,"x"]}', '{"a":[1,2]}')
    assert dict(out.dtypes)["a"] == "array<double>"
    assert [(r.a, r.reject_reason) for r in out.collect()][1] == ([1.0, 2.0], None)


def test_empty_channel(messages, spark):
    none = messages("{}").where("false")
    assert infer.channel_table(none).columns == ["timestamp_ns", "reject_reason"] and infer.channel_table(none).count() == 0


def test_raw_is_sorted_with_the_log_time(messages):
    out = infer.raw_projection(messages('{"value":1,"name":"n"}', '{"value":2}'))
    assert out.columns == ["_log_time_ns", "name", "value", "reject_reason"]
    assert [r.name for r in out.collect()] == ["n", None]


def test_late_fields_are_found(messages):
    out = infer.channel_table(messages(*['{"a":1}'] * 3, '{"a":"x","b":7}'))
    assert [(r.a, r.b) for r in out.collect()] == [("1", None)] * 3 + [("x", 7)]


def test_passthrough_and_routing(messages, spark):
    out = decode.good_rows(decode.decoder_for("cbor")(messages(b"\x00\x01", b""))).collect()
    assert [bytes(r.data) for r in out] == [b"\x00\x01", b""]
    refused = decode.rejects(decode.decoder_for("custom_unknown")(messages("payload"))).collect()
    assert [(r.reason, bytes(r.payload)) for r in refused] == [("unsupported_encoding", b"payload")]
    custom = decode.decoder_for("mine", {"mine": lambda df: df.withColumn("x", F.lit(1))})(messages("a"))
    assert custom.first().x == 1


KINDS = ("num", "integer", "flag", "text", "nums", "texts", "has")
leaf = st.one_of(
    st.none(), st.booleans(), st.integers(-(2**70), 2**70), st.floats(allow_nan=False, allow_infinity=False, width=32),
    st.sampled_from(["", "x", "1.5", "NaN", "-Infinity", "INF", "null", 'q"uote', "[1,null]", "true"]),
    st.lists(st.one_of(st.integers(-5, 5), st.floats(-9, 9, width=16)), max_size=3), st.lists(st.sampled_from(["a", "null"]), max_size=2),
    st.lists(st.one_of(st.integers(0, 3), st.none(), st.text("ab", max_size=1), st.booleans()), max_size=3),
    st.dictionaries(st.sampled_from("ab"), st.integers(0, 3), max_size=2),
)


def expected(v, kind):
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    if kind == "has":
        return v is not None and not isinstance(v, dict)
    if kind == "num":
        return float(v) if number or isinstance(v, bool) else None
    if kind == "integer":
        return v if number and isinstance(v, int) and -(2**63) <= v < 2**63 else None
    if kind == "flag":
        return v if isinstance(v, bool) else None
    if kind == "text":
        return v if isinstance(v, str) else None
    if kind == "nums" and isinstance(v, list):
        return [float(e) for e in v] if all(isinstance(e, (int, float)) and not isinstance(e, bool) for e in v) else None
    if kind == "texts" and isinstance(v, list):
        return v if v and all(isinstance(e, str) for e in v) else None
    return None


def mixed(v):
    if not isinstance(v, list) or not v:
        return False
    kind = lambda e: "n" if isinstance(e, (int, float)) and not isinstance(e, bool) else "t" if isinstance(e, str) else "o"
    return kind(v[0]) != "o" and any(kind(e) != kind(v[0]) for e in v)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(leaf, leaf), min_size=40, max_size=80))
def test_fast_and_exact_reading_agree(messages, pairs):
    """Every kind on its own takes the typed parse, all kinds together the variant; both follow the rules."""
    data = messages(*[json.dumps({"u": {"v": a}, "w": b}) for a, b in pairs]).coalesce(1)
    for kinds in [{k} for k in KINDS] + [set(KINDS)]:
        out = extract(data, {("u", "v"): kinds, ("w",): {"num"}}).orderBy("sequence").collect()
        for (a, b), row in zip(pairs, out):
            overflow = any(isinstance(x, int) and not isinstance(x, bool) and 2**63 <= x < 2**64 for x in (a, b))
            reason = "int_overflow" if overflow else "mixed_array" if kinds & {"nums", "texts"} and mixed(a) else None
            assert row.reject_reason == reason, (a, b)
            if reason is None:
                for kind in kinds:
                    assert row[leaf_name(kind, ("u", "v"))] == expected(a, kind), (a, kind)
                assert row["num:w"] == expected(b, "num"), b


def test_flatten_and_defaults(spark):
    df = spark.sql(
        "SELECT named_struct('b', 1, 'c', named_struct('d', cast(null as string))) a, array(true, false) f, map('k', 1) m, "
        "array(named_struct('p', named_struct('q', 5))) s, array(cast('x' as binary)) t, cast(null as array<int>) n, cast('y' as binary) z"
    )
    flat = flatten.flatten_structs(df)
    row = flat.first().asDict(recursive=True)
    assert row["a.b"] == 1 and row["a.c.d"] is None and row["f"] == [1.0, 0.0] and row["t"] == ["x"]
    assert row["m"] == [{"key": "k", "value": 1}] and row["s"] == [{"p.q": 5}] and bytes(row["z"]) == b"y"
    filled = flatten.fill_unset(flat).first()
    assert filled["a.c.d"] == "" and filled["n"] == []
