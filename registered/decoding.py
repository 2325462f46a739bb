"""D: decoding, flattening, definitions; S4 and S5."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registered.registry import EV, GOOD_EVENT, messages_from, query
from sensorloom.operators import decode, definitions, flatten, infer
from sensorloom.operators.extract import extract
from sensorloom.operators.index import topic_scan
from sensorloom.sources.bridges import as_messages, event_messages, event_rows, json_of, load

c = F.col


def underscored(df: DataFrame) -> DataFrame:
    return df.toDF(*[n.replace(".", "_") for n in df.columns])


def event_json(spark, sf_dir, payload):
    """Events as one topic with the given payload."""
    return as_messages(event_rows(spark, sf_dir), F.lit("e"), F.lit(1), F.lit("/e"), c("ns"), c("event_id"), payload)


# ---------------------------------------------------------------- JSON


@query(
    "d1_json_decode",
    """SELECT event_id AS sequence, CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'parse_error'
       WHEN event_type = 'error' AND event_id % 10 = 1 THEN 'not_object' END AS reject_reason FROM events""",
)
def d1(spark, sf_dir):
    return decode.decode_json(event_messages(spark, sf_dir)).select("sequence", "reject_reason")


@query(
    "d2_flatten_objects",
    f"""WITH {EV} SELECT ns AS timestamp_ns, value AS a_b_c, k AS a_b_d, user_id AS a_e, event_type AS f FROM ev""",
)
def d2(spark, sf_dir):
    inner = F.struct(c("value").alias("c"), c("k").alias("d"))
    payload = json_of(a=F.struct(inner.alias("b"), c("user_id").alias("e")), f=c("event_type"))
    return underscored(infer.read_channel(event_json(spark, sf_dir, payload)))


@query(
    "d3_numeric_array",
    f"""WITH {EV} SELECT ns AS timestamp_ns, 3 AS n, value AS first, CAST(k AS DOUBLE) AS second, 1000.0::DOUBLE AS third FROM ev""",
)
def d3(spark, sf_dir):
    payload = F.concat(F.lit('{"a":['), c("value").cast("string"), F.lit(","), c("k").cast("string"), F.lit(",1e3]}"))
    table = infer.read_channel(event_json(spark, sf_dir, payload))
    return table.select("timestamp_ns", F.size("a").alias("n"), *[c("a")[i].alias(n) for i, n in enumerate(("first", "second", "third"))])


@query("d4_string_array", f"WITH {EV} SELECT ns AS timestamp_ns, 2 AS n, event_type AS first, 'k' || k AS second FROM ev")
def d4(spark, sf_dir):
    payload = json_of(a=F.array(c("event_type"), F.concat(F.lit("k"), c("k").cast("string"))))
    table = infer.read_channel(event_json(spark, sf_dir, payload))
    return table.select("timestamp_ns", F.size("a").alias("n"), c("a")[0].alias("first"), c("a")[1].alias("second"))


@query(
    "d5_empty_array",
    f"WITH {EV} SELECT ns AS timestamp_ns, 0 AS always, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS sometimes FROM ev",
)
def d5(spark, sf_dir):
    sometimes = F.when(c("k") % 2 == 0, F.array(c("value"))).otherwise(F.array().cast("array<double>"))
    payload = json_of(a=F.array().cast("array<double>"), b=sometimes)
    table = infer.read_channel(event_json(spark, sf_dir, payload))
    return table.select("timestamp_ns", F.size("a").alias("always"), F.size("b").alias("sometimes"))


@query(
    "d6_other_arrays",
    f"""WITH {EV} SELECT ns AS timestamp_ns, '[{{"k":' || k || '}}]' AS objects, '[[' || k || ',1]]' AS arrays,
        CASE WHEN k > 50 THEN '[true]' ELSE '[false]' END AS flags FROM ev""",
)
def d6(spark, sf_dir):
    payload = json_of(
        objects=F.array(F.struct("k")), arrays=F.array(F.array(c("k"), F.lit(1).cast("bigint"))), flags=F.array(c("k") > 50)
    )
    return infer.read_channel(event_json(spark, sf_dir, payload))


@query(
    "d7_scalar_types",
    f"""WITH {EV} SELECT ns AS timestamp_ns, k > 50 AS flag, event_id AS whole, value AS real,
        CAST(k AS DOUBLE) AS widened, event_type AS text FROM ev""",
)
def d7(spark, sf_dir):
    """``widened`` is an integer in some messages and a real in others, so it is real in all."""
    widened = F.when(c("k") % 2 == 0, F.concat(c("k").cast("string"), F.lit(".0"))).otherwise(c("k").cast("string"))
    payload = F.concat(
        F.lit('{"flag":'), (c("k") > 50).cast("string"), F.lit(',"whole":'), c("event_id").cast("string"), F.lit(',"real":'),
        c("value").cast("string"), F.lit(',"widened":'), widened, F.lit(',"text":"'), c("event_type"), F.lit('"}'),
    )
    return infer.read_channel(event_json(spark, sf_dir, payload))


@query(
    "d8_null_fields",
    f"WITH {EV} SELECT ns AS timestamp_ns, CASE WHEN k % 2 = 0 THEN value END AS sometimes, user_id AS kept FROM ev",
)
def d8(spark, sf_dir):
    """A field that is null everywhere gives no column."""
    some = F.when(c("k") % 2 == 0, c("value").cast("string")).otherwise("null")
    payload = F.concat(F.lit('{"never":null,"sometimes":'), some, F.lit(',"kept":'), c("user_id").cast("string"), F.lit("}"))
    return infer.read_channel(event_json(spark, sf_dir, payload))


@query(
    "d9_passthrough",
    "SELECT doc_id AS sequence, octet_length(encode(text)) AS bytes, md5(encode(text)) AS digest FROM documents",
)
def d9(spark, sf_dir):
    rows = messages_from(spark, sf_dir, "documents", c("text"), c("n_chars"), c("doc_id"))
    data = decode.good_rows(decode.decode_passthrough(rows))
    return data.select("sequence", F.length("data").cast("bigint").alias("bytes"), F.md5("data").alias("digest"))


@query(
    "d10_encoding_routing",
    """SELECT c_custkey, c_custkey % 5 < 3 AS supported,
       CASE WHEN c_custkey % 5 >= 3 THEN 'unsupported_encoding' END AS reject_reason FROM customer""",
)
def d10(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in ("json", "cbor", "flatbuffer", "custom_unknown", "cdr")])
    channels = load(spark, sf_dir, "customer").select("c_custkey", F.get(names, (c("c_custkey") % 5).cast("int")).alias("encoding"))
    return decode.encoding_support(channels).drop("encoding")


# ---------------------------------------------------------------- struct sources


@query(
    "d11_flatten_structs",
    """SELECT o_orderkey AS id, o_totalprice AS price_total, o_orderstatus AS price_status_code,
       c_name AS customer_name, c_nationkey AS customer_home_nation FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def d11(spark, sf_dir):
    o, cust = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    nested = o.join(cust, c("o_custkey") == c("c_custkey")).select(
        c("o_orderkey").alias("id"),
        F.struct(c("o_totalprice").alias("total"), F.struct(c("o_orderstatus").alias("code")).alias("status")).alias("price"),
        F.struct(c("c_name").alias("name"), F.struct(c("c_nationkey").alias("nation")).alias("home")).alias("customer"),
    )
    return underscored(flatten.flatten_structs(nested))


@query(
    "d12_primitive_arrays",
    """SELECT vec_id, len(embedding) AS n, ROUND(CAST(embedding[1] AS DOUBLE), 6) AS first,
       CASE WHEN label > 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag, CAST(label AS DOUBLE) AS whole FROM embeddings""",
)
def d12(spark, sf_dir):
    rows = load(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.array(c("label") > 4).alias("flags"), F.array("label").alias("wholes")
    )
    flat = flatten.flatten_structs(rows)
    return flat.select(
        "vec_id", F.size("embedding").cast("bigint").alias("n"), F.round(c("embedding")[0], 6).alias("first"),
        c("flags")[0].alias("flag"), c("wholes")[0].alias("whole"),
    )


@query(
    "d13_array_of_messages",
    """SELECT l_orderkey, l_linenumber, i, CASE i WHEN 0 THEN l_quantity ELSE l_extendedprice END AS at_x,
       CASE i WHEN 0 THEN l_returnflag ELSE l_linestatus END AS name FROM lineitem, UNNEST([0, 1]) t(i)""",
)
def d13(spark, sf_dir):
    element = lambda x, name: F.struct(F.struct(c(x).alias("x")).alias("at"), c(name).alias("name"))
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(element("l_quantity", "l_returnflag"), element("l_extendedprice", "l_linestatus")).alias("parts")
    )
    opened = flatten.flatten_structs(rows).select("l_orderkey", "l_linenumber", F.posexplode("parts").alias("i", "p"))
    return opened.select("l_orderkey", "l_linenumber", "i", c("p").getField("at.x").alias("at_x"), c("p").getField("name").alias("name"))


@query(
    "d14_map_entries",
    """SELECT l_orderkey, l_linenumber, key, CASE key WHEN 'tax' THEN l_tax ELSE l_discount END AS value
       FROM lineitem, UNNEST(['tax', 'discount']) t(key)""",
)
def d14(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.create_map(F.lit("tax"), "l_tax", F.lit("discount"), "l_discount").alias("m")
    )
    return flatten.flatten_structs(rows).select("l_orderkey", "l_linenumber", F.explode("m").alias("e")).select(
        "l_orderkey", "l_linenumber", c("e").getField("key").alias("key"), c("e").getField("value").alias("value")
    )


@query(
    "d15_enum_and_bytes",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status,
       octet_length(encode(o_orderpriority)) AS bytes, o_orderpriority AS text,
       CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE WHEN 'P' THEN 2.0::DOUBLE END AS repeated FROM orders""",
)
def d15(spark, sf_dir):
    status = flatten.enum_number(c("o_orderstatus"), {"F": 0, "O": 1, "P": 2})
    data = c("o_orderpriority").cast("binary")
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", status.alias("status"), data.alias("data"), F.array(data).alias("texts"), F.array(status).alias("codes")
    )
    return flatten.flatten_structs(rows).select(
        "o_orderkey", "status", F.length("data").cast("bigint").alias("bytes"), c("texts")[0].alias("text"), c("codes")[0].alias("repeated")
    )


@query(
    "d16_unset_defaults",
    """SELECT l.o_orderkey, COALESCE(q.doc_id, 0) AS doc_id, COALESCE(q.quality, 0) AS quality, COALESCE(q.quality = 1, FALSE) AS good,
       COALESCE('q' || q.quality, '') AS text FROM orders l LEFT JOIN labels q ON l.o_orderkey = q.doc_id""",
)
def d16(spark, sf_dir):
    marked = load(spark, sf_dir, "labels").select(
        "doc_id", "quality", (c("quality") == 1).alias("good"), F.concat(F.lit("q"), c("quality").cast("string")).alias("text")
    )
    rows = load(spark, sf_dir, "orders").select("o_orderkey").join(marked, c("o_orderkey") == c("doc_id"), "left")
    return flatten.fill_unset(rows)


# ---------------------------------------------------------------- definitions

_DEFINITION = [
    "# about @name", "float64[@nation] samples # tail", "  uint8[] data\r", "string mark  some @nation default ", "uint8 LIMIT=@nation",
    "string<=10 bounded", "Vec direction", "pkg_b/Vec[] exact", "missing/Thing other", "char letter", "time at", "", "====", "MSG: pkg_b/Vec",
    "float64 x", "Deep deep", "=====", "MSG: pkg_a/Vec", "float32 z", "======", "MSG: pkg_b/Deep", "bool flag", "===", "no header", "int8 lost",
]


def definition_channels(spark, sf_dir):
    """Customers as channels, each with its own definition text."""
    text = F.lit("\n".join(_DEFINITION))
    for mark, column in (("@name", "c_name"), ("@nation", "c_nationkey")):
        text = F.replace(text, F.lit(mark), c(column).cast("string"))
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("pkg/T"), c("c_custkey").cast("string")).alias("schema_name"), text.alias("schema_data")
    )


def _fields_sql() -> str:
    """Fields of the definition, by block and ordinal."""
    main = [
        ("samples", "float64", "c_nationkey", None), ("data", "uint8", "-1", None), ("mark", "string", "0", "'some ' || c_nationkey || ' default'"),
        ("direction", "Vec", "0", None), ("exact", "pkg_b/Vec", "-1", None), ("other", "missing/Thing", "0", None),
        ("letter", "char", "0", None), ("at", "time", "0", None),
    ]
    blocks = [("'pkg/T' || c_custkey", main), ("'pkg_b/Vec'", [("x", "float64", "0", None), ("deep", "Deep", "0", None)]),
              ("'pkg_a/Vec'", [("z", "float32", "0", None)]), ("'pkg_b/Deep'", [("flag", "bool", "0", None)])]
    rows = []
    for block, fields in blocks:
        for at, (field, base, size, default) in enumerate(fields, start=1):
            rows.append(
                f"SELECT 'pkg/T' || c_custkey AS schema_name, {block} AS block, {at} AS ordinal, '{field}' AS field, '{base}' AS base_type, "
                f"CAST({size} AS INTEGER) AS array_size, {default or 'CAST(NULL AS VARCHAR)'} AS \"default\" FROM customer"
            )
    return " UNION ALL ".join(rows)


@query("d18_field_catalog", _fields_sql())
def d18(spark, sf_dir):
    return definitions.field_catalog(definition_channels(spark, sf_dir)).drop("definition", "block_no")


@query(
    "d18_skipped_lines",
    """SELECT 'pkg/T' || c_custkey AS schema_name, 'pkg/T' || c_custkey AS block, 'uint8 LIMIT=' || c_nationkey AS line,
       FALSE AS skipped_bounded FROM customer
       UNION ALL SELECT 'pkg/T' || c_custkey, 'pkg/T' || c_custkey, 'string<=10 bounded', TRUE FROM customer""",
)
def d18_skipped(spark, sf_dir):
    return definitions.skipped_lines(definition_channels(spark, sf_dir))


@query(
    "d18b_nested_types",
    """SELECT 'pkg/T' || c_custkey AS schema_name, field, resolved FROM customer,
       (VALUES ('direction', 'pkg_a/Vec'), ('exact', 'pkg_b/Vec'), ('other', NULL), ('deep', 'pkg_b/Deep')) t(field, resolved)""",
)
def d18b(spark, sf_dir):
    channels = definition_channels(spark, sf_dir)
    return definitions.nested_types(channels, definitions.field_catalog(channels)).where(
        ~c("base_type").isin("time")
    ).select("schema_name", "field", "resolved")


@query(
    "d19_declared_schema",
    """SELECT 'pkg/T' || c_custkey AS schema_name, '`timestamp_ns` bigint, `samples` ' ||
       CASE WHEN c_nationkey = 0 THEN 'double' ELSE 'array<double>' END ||
       ', `data` array<smallint>, `mark` string, `direction` struct<`z`:float>, `exact` array<struct<`x`:double,`deep`:struct<`flag`:boolean>>>, ' ||
       '`other` binary, `letter` smallint, `at` struct<sec:bigint,nanosec:bigint>' AS ddl FROM customer""",
)
def d19(spark, sf_dir):
    return definitions.declared_ddl(definition_channels(spark, sf_dir)).drop("definition")


# ---------------------------------------------------------------- rejects, stop, sample


@query(
    "d20_rejects",
    f"""WITH {EV} SELECT 'events' AS recording, '/error' AS topic, ns AS log_time_ns,
        CASE WHEN event_id % 10 = 0 THEN 'parse_error' ELSE 'not_object' END AS reason,
        CASE WHEN event_id % 10 = 0 THEN 'not json{{' ELSE '[1,2,3]' END AS payload
        FROM ev WHERE NOT ({GOOD_EVENT})""",
)
def d20(spark, sf_dir):
    rows = decode.rejects(decode.decode_json(event_messages(spark, sf_dir)))
    return rows.withColumn("payload", c("payload").cast("string"))


@query(
    "d20_mixed_and_overflow",
    f"""WITH {EV} SELECT event_id AS sequence, CASE event_id % 6 WHEN 0 THEN 'mixed_array' WHEN 1 THEN 'mixed_array' WHEN 2 THEN 'int_overflow'
        WHEN 3 THEN 'parse_error' END AS reject_reason, CASE WHEN event_id % 6 > 3 THEN value END AS first FROM ev""",
)
def d20_mixed(spark, sf_dir):
    """Arrays of two kinds, integers beyond 2^63-1 and text after the object are bad; numbers stay exact."""
    value = c("value").cast("string")
    payload = (
        F.when(c("event_id") % 6 == 0, F.concat(F.lit('{"a":['), value, F.lit(',"x"]}')))
        .when(c("event_id") % 6 == 1, F.concat(F.lit('{"a":['), value, F.lit(",null]}")))
        .when(c("event_id") % 6 == 2, F.concat(F.lit('{"b":12345678901234567890,"a":['), value, F.lit("]}")))
        .when(c("event_id") % 6 == 3, F.concat(F.lit('{"a":['), value, F.lit("]} {}")))
        .otherwise(F.concat(F.lit('{"b":"12345678901234567890","a":['), value, F.lit(",2]}")))
    )
    leaves = extract(event_json(spark, sf_dir, payload), {("a",): {"nums"}})
    return leaves.select(
        "sequence", "reject_reason", F.when(c("reject_reason").isNull(), c("`nums:a`")[0]).alias("first")
    )


@query(
    "d21_raw_projection",
    f"""WITH {EV} SELECT ns AS _log_time_ns, CASE WHEN k % 3 > 0 THEN event_type END AS a_kind, value AS b_value FROM ev""",
)
def d21(spark, sf_dir):
    payload = json_of(b_value=c("value"), a_kind=F.when(c("k") % 3 > 0, c("event_type")))
    return decode.good_rows(infer.raw_projection(event_json(spark, sf_dir, payload)))


@query("d22_early_stop", "SELECT event_id AS sequence FROM events ORDER BY ts, event_id LIMIT 1000")
def d22(spark, sf_dir):
    return decode.sample_first(event_messages(spark, sf_dir), 1000).select("sequence")


@query(
    "d23_sample_before_decode",
    f"WITH {EV} SELECT ns AS timestamp_ns, value, CASE WHEN event_id >= 5000 THEN user_id END AS late FROM ev",
)
def d23(spark, sf_dir):
    """Fields that first appear in later rows are found as well: every row is asked for its fields.

    A recording too short to reach them has no such field; its column is then empty.
    """
    late = F.when(c("event_id") >= 5000, c("user_id"))
    table = decode.good_rows(infer.channel_table(event_json(spark, sf_dir, json_of(value=c("value"), late=late))))
    if "late" not in table.columns:
        table = table.withColumn("late", F.lit(None).cast("bigint"))
    return table.select("timestamp_ns", "value", "late")


@query(
    "d23_first_messages",
    f"""WITH {EV}, f AS (SELECT *, row_number() OVER (ORDER BY ns, event_id) AS place FROM ev)
        SELECT ns AS timestamp_ns, 2 AS fields, CASE WHEN place % 3 = 1 THEN value END AS early, place AS every FROM f""",
)
def d23_sample(spark, sf_dir):
    """A decoder that asks for the first 100 messages knows the fields of these: what begins later has no column."""
    place = F.row_number().over(Window.orderBy("ns", "event_id"))
    rows = event_rows(spark, sf_dir).withColumn("place", place)
    payload = json_of(every=c("place"), early=F.when(c("place") % 3 == 1, c("value")), rare=F.when(c("place") > 100, c("user_id")))
    sent = as_messages(rows, F.lit("events"), F.lit(1), F.lit("/all"), c("ns"), c("event_id"), payload)
    table = decode.good_rows(infer.channel_table(sent, sample_rows=100))
    return table.select("timestamp_ns", F.lit(len(table.columns) - 1).alias("fields"), "early", "every")


@query(
    "d21_open_keys",
    f"""WITH {EV} SELECT ns AS timestamp_ns, k, 'u' || user_id % 120 AS key, value, 2 AS columns FROM ev""",
)
def d21_open(spark, sf_dir):
    """An object whose members are ids is one map column, which holds every member."""
    payload = F.concat(
        F.lit('{"k":'), c("k").cast("string"), F.lit(',"by_user":{"u'), (c("user_id") % 120).cast("string"), F.lit('":{"seen":['),
        c("value").cast("string"), F.lit("]}}}"),
    )
    table = infer.channel_table(event_json(spark, sf_dir, payload), limit=8)
    wide = decode.good_rows(table).withColumn("columns", F.lit(len(table.columns) - 2))
    key = F.map_keys("by_user")[0]
    value = F.get_json_object(F.map_values("by_user")[0], "$.seen[0]").cast("double")
    return wide.select("timestamp_ns", "k", key.alias("key"), value.alias("value"), "columns")


# ---------------------------------------------------------------- scans


@query(
    "s4_decoded_scan",
    f"""WITH {EV} SELECT event_id AS sequence, ns AS _log_time_ns, value, user_id FROM ev WHERE event_type = 'error' AND {GOOD_EVENT}""",
)
def s4(spark, sf_dir):
    scan = decode.good_rows(decode.decoded_scan(event_messages(spark, sf_dir), "/error"))
    return scan.select(
        "sequence", "_log_time_ns", F.try_variant_get("body", "$.value", "double").alias("value"),
        F.try_variant_get("body", "$.user_id", "bigint").alias("user_id"),
    )


@query(
    "s5_channel_table",
    f"""WITH {EV} SELECT ns AS timestamp_ns, k AS altitude, value AS latitude, user_id AS longitude,
        2 AS position_covariance_type, CASE WHEN event_id % 2 = 0 THEN k END AS status_service,
        CASE WHEN event_id % 2 = 0 THEN user_id % 4 END AS status_status, value AS covariance_0 FROM ev WHERE event_type = 'signup'""",
)
def s5(spark, sf_dir):
    table = underscored(infer.read_channel(topic_scan(event_messages(spark, sf_dir), "/signup")))
    return table.withColumn("covariance_0", c("position_covariance")[0]).drop("position_covariance")
