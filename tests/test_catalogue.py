"""The fields of JSON topics, objects with open key sets, and integers of 64 bits without a sign."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sensorloom.functions.fields import LeafFields
from sensorloom.operators import infer
from sensorloom.operators.catalogue import body_leaves, field_catalogue, readable_fields, shape_leaves
from sensorloom.operators.decode import decode_json, good_rows
from sensorloom.operators.extract import extract, wants_of
from sensorloom.operators.ontology import project_json


def drawn_body(r, depth=0):
    names = ["a", "b c", "d`e", "f.g", "", "é", "x,y: z>", "1"]
    values = [None, True, 1, -3, 2.5, "s", "[1]", [], [1, 2], [1, None], [None], ["p", "q"], [True], [1, "x"], ["x", 1], [[1]], [{"k": 1}, {"k": "s"}]]
    body = {}
    for name in r.sample(names, r.randint(0, 4)):
        body[name] = drawn_body(r, depth + 1) if depth < 3 and r.random() < 0.3 else r.choice(values)
    return body


def test_shapes_and_bodies_give_the_same_fields(spark):
    """Where no array is loose, the shape of a body tells what the body does."""
    r = random.Random(3)
    bodies = [drawn_body(r) for _ in range(300)]
    rows = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "i int, t string")
    shapes = rows.select("i", F.schema_of_variant(F.parse_json("t")).alias("shape")).collect()
    plain = 0
    for row in shapes:
        if "ARRAY<VARIANT>" in row["shape"]:
            continue
        found = body_leaves(bodies[row["i"]])
        if "mixed" in found.values():  # a null after a number does not show in the shape
            continue
        assert shape_leaves(row["shape"]) == found, (row["shape"], bodies[row["i"]])
        plain += 1
    assert plain > 100


def test_catalogue_counts_every_field(messages):
    payloads = ['{"a":1,"o":{"x":"t"}}', '{"a":2.5,"o":{}}', '{"a":null,"v":[1,"x"]}', '{"v":[]}', "bad"]
    decoded = good_rows(decode_json(messages(*payloads)))
    got = {(".".join(r.path), r.kind): r.rows for r in field_catalogue(decoded, ["topic"]).collect()}
    assert got == {
        ("a", "integer"): 1, ("a", "num"): 1, ("o", "object"): 2, ("o.x", "text"): 1, ("v", "mixed"): 1, ("v", "empty"): 1,
    }


def kinds(messages, payloads, **options):
    return {".".join(p): k for p, k in infer.topic_kinds(messages(*payloads), **options).items()}


def test_an_object_that_is_something_else_as_well_is_text(messages):
    table = infer.channel_table(messages('{"a":{"b":1,"c":{"d":2}}}', '{"a":5}', '{"e":1}'))
    assert table.columns == ["timestamp_ns", "a", "e", "reject_reason"]
    assert [r.a for r in table.orderBy("timestamp_ns").collect()] == ['{"b":1,"c":{"d":2}}', "5", None]


def test_many_keys_become_a_map(messages):
    ids = [f'{{"n":{i},"by_id":{{"u{i}":{i}.5,"shared":{i}}},"deep":{{"p":{{"q{i}":{{"z":[{i}]}}}}}}}}' for i in range(30)]
    assert kinds(messages, ids, limit=20) == {"by_id": "map:num", "deep.p": "map:anytext", "n": "integer"}
    assert len(kinds(messages, ids)) == 62
    table = good_rows(infer.channel_table(messages(*ids), limit=20)).orderBy("n").collect()
    assert table[3]["by_id"] == {"u3": 3.5, "shared": 3.0} and table[3]["deep.p"] == {"q3": '{"z":[3]}'}


def test_a_topic_whose_keys_are_ids_is_one_map(messages):
    payloads = [f'{{"id{i}":{i},"none":null}}' for i in range(30)] + ["[1]", "bad", '{"id5":7}']
    table = infer.channel_table(messages(*payloads), limit=10)
    assert table.columns == ["timestamp_ns", "fields", "reject_reason"]
    rows = table.orderBy("timestamp_ns").collect()
    assert rows[4]["fields"] == {"id4": 4} and rows[-1]["fields"] == {"id5": 7}
    assert [r["reject_reason"] for r in rows[30:]] == ["not_object", "parse_error", None]


def test_wide_objects_inside_wide_objects(messages):
    """Innermost first: each member with too many columns is a map, and so is the object that then still has too many."""
    payloads = [f'{{"o{i % 3}":{{"k{i}":{i}}},"p{i}":{{"x":1}}}}' for i in range(60)]
    found = kinds(messages, payloads, limit=15)
    assert found == {"": "map:anytext"}
    row = good_rows(infer.channel_table(messages(*payloads), limit=15)).orderBy("timestamp_ns").first()
    assert row["fields"] == {"o0": '{"k0":0}', "p0": '{"x":1}'}


def test_a_hundred_thousand_keys(spark):
    """Every row has keys of its own: nothing grows on the driver, and each key is found in the map."""
    rows = spark.range(20000, numPartitions=4).select(
        F.lit("r").alias("recording"), F.lit(1).alias("channel_id"), F.lit("/t").alias("topic"), F.col("id").alias("log_time_ns"),
        F.col("id").alias("publish_time_ns"), F.col("id").alias("sequence"),
        F.concat(
            F.lit('{"n":1,"seen":{'),
            F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.format_string('"k%d_%d":%d', F.col("id"), i, i)), ","),
            F.lit("}}"),
        ).cast("binary").alias("payload"),
    )
    table = good_rows(infer.channel_table(rows))
    assert table.columns == ["timestamp_ns", "n", "seen"] and dict(table.dtypes)["seen"] == "map<string,bigint>"
    got = table.select(F.explode("seen").alias("k", "v")).agg(F.count_distinct("k").alias("k"), F.sum("v").alias("v")).first()
    assert (got["k"], got["v"]) == (100000, 200000)


def test_fields_of_the_first_messages_only(messages):
    payloads = ['{"a":1}'] * 5 + ['{"a":2,"late":1}']
    assert kinds(messages, payloads, sample_rows=3) == {"a": "integer"}
    assert kinds(messages, payloads) == {"a": "integer", "late": "integer"}


# ---------------------------------------------------------------- integers

MOST = 2**64 - 1


@pytest.mark.parametrize(
    "literal,value,reason",
    [
        ("0", 0, None), ("5", 5, None), (str(2**63 - 1), 2**63 - 1, None), (str(2**63), 2**63, None), (str(MOST), MOST, None),
        (str(MOST + 1), None, "out_of_range"), ("-1", None, "out_of_range"), (str(-(2**63) - 1), None, "out_of_range"), ("9" * 38, None, "out_of_range"),
        ("1.0", 0, None), ("1e3", 0, None), (f"{2**63}.0", 0, None), (f'"{2**63}"', 0, None), ("true", 0, None), ("null", 0, None),
        ("9999999999999999999999999999999999999999", 0, None),
    ],
)
def test_unsigned64(messages, literal, value, reason):
    row = project_json(messages(f'{{"data":{literal},"text":"{2**63 + 1}"}}'), "unsigned64").first()
    assert row.reject_reason == reason
    if reason is None:
        assert int(row.data) == value


def test_other_integers_beyond_bigint_are_still_rejects(messages):
    rows = project_json(messages(f'{{"data":{2**63},"other":{2**63 + 1}}}', f'{{"data":1,"other":{MOST}}}', f'{{"data":{2**63},"v":[{2**63}]}}'), "unsigned64")
    assert [r.reject_reason for r in rows.orderBy("sequence").collect()] == ["int_overflow", "int_overflow", None]
    assert project_json(messages(f'{{"data":{2**63}}}'), "integer64").first().reject_reason == "int_overflow"


def test_getters_of_two_widths_on_one_path(messages):
    read = lambda f: {"big": f.integer("n", "uint64"), "small": f.integer("n", "int64"), "has": f.has("n")}
    columns = read(LeafFields())
    rows = extract(messages(f'{{"n":{MOST}}}', '{"n":7}', '{"n":"7"}', "{}"), wants_of(read)).orderBy("sequence")
    got = [tuple(r) for r in rows.select(*[c.alias(n) for n, c in columns.items()]).collect()]
    assert [(None if b is None else int(b), s, h) for b, s, h in got] == [(MOST, None, True), (7, 7, True), (None, None, True), (None, None, False)]


def test_readable_fields_of_an_empty_catalogue(spark, messages):
    none = field_catalogue(decode_json(messages("{}")).limit(0))
    assert readable_fields(none).count() == 0
