"""F: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.registry import EV, lines, messages_from, orders, query, scalars_of, with_fields
from sensorloom.functions import geometry as G
from sensorloom.functions import metadata as M
from sensorloom.functions import text as X
from sensorloom.sources.bridges import as_messages, event_rows, json_of, load

c = F.col

# ---------------------------------------------------------------- times and header


def _stamped(spark, sf_dir):
    """Orders as messages: a full stamp, half a stamp, or none."""
    sec, nano = c("o_custkey"), c("o_orderkey") % 1000
    kind = c("o_orderkey") % 4
    payload = (
        F.when(kind == 0, json_of(header=F.struct(F.struct(sec.alias("sec"), nano.alias("nanosec")).alias("stamp"), c("o_orderstatus").alias("frame_id"))))
        .when(kind == 1, json_of(header=F.struct(F.struct(sec.alias("sec")).alias("stamp"), c("o_orderkey").alias("seq"))))
        .when(kind == 2, json_of(header=F.struct(c("o_orderstatus").alias("frame_id"))))
        .otherwise(json_of(other=sec))
    )
    return orders(spark, sf_dir, payload)


_ORDER_NS = "epoch_us(o_orderdate) * 1000"


@query(
    "f1_event_and_ingest_time",
    f"""SELECT o_orderkey AS sequence,
        CASE WHEN o_orderkey % 4 = 0 THEN o_custkey * 1000000000 + o_orderkey % 1000 ELSE {_ORDER_NS} END AS event_ns,
        {_ORDER_NS} AS ingest_ns FROM orders""",
)
def f1(spark, sf_dir):
    return with_fields(_stamped(spark, sf_dir), lambda f: {"event_ns": G.event_time(f), "ingest_ns": G.ingest_time(f)})


@query(
    "f11_header",
    f"""SELECT o_orderkey AS sequence,
        CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey END AS header_seq,
        CASE o_orderkey % 4 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey WHEN 3 THEN {_ORDER_NS} // 1000000000 END AS header_stamp_sec,
        CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 1000 WHEN 3 THEN ({_ORDER_NS}) % 1000000000 END AS header_stamp_nanosec,
        CASE WHEN o_orderkey % 4 IN (0, 2) THEN o_orderstatus END AS header_frame_id FROM orders""",
)
def f11(spark, sf_dir):
    rows = with_fields(_stamped(spark, sf_dir), lambda f: {"header": G.header(f)})
    return scalars_of(rows, "sequence", "header.seq", "header.stamp.sec", "header.stamp.nanosec", "header.frame_id")


# ---------------------------------------------------------------- covariance and structs


@query(
    "f2_valid_covariance",
    """SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE ELSE FALSE END AS valid
       FROM embeddings""",
)
def f2(spark, sf_dir):
    values = (
        F.when(c("vec_id") % 4 == 0, F.slice("embedding", 1, 9).cast("array<double>"))
        .when(c("vec_id") % 4 == 1, F.concat(F.array(F.lit(-1.0)), F.slice("embedding", 2, 8).cast("array<double>")))
        .when(c("vec_id") % 4 == 2, F.array_repeat(F.lit(0.0), 9))
        .otherwise(F.array().cast("array<double>"))
    )
    return load(spark, sf_dir, "embeddings").select("vec_id", G.valid_covariance(values).alias("valid"))


def _kinds(spark, sf_dir):
    """Events as messages whose field v is an integer, a real, text, a boolean or null."""
    kind = c("event_id") % 5
    rows = event_rows(spark, sf_dir)
    payload = (
        F.when(kind == 0, json_of(v=c("event_id")))
        .when(kind == 1, json_of(v=c("value") + 0.001))
        .when(kind == 2, json_of(v=c("event_id").cast("string")))
        .when(kind == 3, json_of(v=c("k") > 50))
        .otherwise(F.lit('{"v":null}'))
    )
    return as_messages(rows, F.lit("e"), F.lit(1), F.lit("/v"), c("ns"), c("event_id"), payload)


@query(
    "f3_strict_getters",
    f"""WITH {EV} SELECT event_id AS sequence,
        CASE WHEN event_id % 5 = 0 THEN event_id END AS as_int64,
        CASE WHEN event_id % 5 = 0 THEN CAST(event_id AS INTEGER) END AS as_int32,
        CASE WHEN event_id % 5 = 2 THEN CAST(event_id AS VARCHAR) END AS as_text,
        CASE WHEN event_id % 5 = 3 THEN k > 50 END AS as_flag,
        event_id % 5 <> 4 AS present FROM ev""",
)
def f3(spark, sf_dir):
    return with_fields(
        _kinds(spark, sf_dir),
        lambda f: {
            "as_int64": f.integer("v", "int64"),
            "as_int32": f.integer("v", "int32"),
            "as_text": f.text("v"),
            "as_flag": f.flag("v"),
            "present": f.has("v"),
        },
    )


@query(
    "f4_small_integers",
    """SELECT l_orderkey * 10 + l_linenumber AS sequence,
        CASE WHEN l_partkey - 100 BETWEEN -128 AND 127 THEN CAST(l_partkey - 100 AS TINYINT) END AS as_int8,
        CASE WHEN l_partkey - 100 BETWEEN 0 AND 255 THEN CAST(l_partkey - 100 AS SMALLINT) END AS as_uint8,
        CASE WHEN (l_partkey - 100) * 40 BETWEEN -32768 AND 32767 THEN CAST((l_partkey - 100) * 40 AS SMALLINT) END AS as_int16,
        CASE WHEN (l_partkey - 100) * 40 BETWEEN 0 AND 65535 THEN CAST((l_partkey - 100) * 40 AS INTEGER) END AS as_uint16
       FROM lineitem""",
)
def f4(spark, sf_dir):
    low = c("l_partkey") - 100
    return with_fields(
        lines(spark, sf_dir, json_of(a=low, b=low * 40)),
        lambda f: {
            "as_int8": f.integer("a", "int8"),
            "as_uint8": f.integer("a", "uint8"),
            "as_int16": f.integer("b", "int16"),
            "as_uint16": f.integer("b", "uint16"),
        },
    )


@query(
    "f5_strict_arrays",
    """SELECT vec_id AS sequence,
        CASE WHEN vec_id % 3 = 0 THEN 3 WHEN vec_id % 3 = 2 THEN 0 END AS numbers,
        CASE WHEN vec_id % 3 = 0 THEN CAST(label AS DOUBLE) END AS first_number,
        CASE WHEN vec_id % 3 = 1 THEN 2 END AS texts,
        CASE WHEN vec_id % 3 = 1 THEN 'v' || vec_id END AS first_text FROM embeddings""",
)
def f5(spark, sf_dir):
    kind = c("vec_id") % 3
    payload = (
        F.when(kind == 0, json_of(a=F.array(c("label").cast("double"), c("vec_id").cast("double"), F.lit(0.5))))
        .when(kind == 1, json_of(a=F.array(F.concat(F.lit("v"), c("vec_id").cast("string")), F.lit("w"))))
        .otherwise(F.lit('{"a":[]}'))
    )
    rows = messages_from(spark, sf_dir, "embeddings", payload, c("vec_id"), c("vec_id"))
    read = with_fields(rows, lambda f: {"n": f.nums("a"), "t": f.texts("a")})
    return read.select(
        "sequence",
        F.when(c("n").isNotNull(), F.size("n")).alias("numbers"),
        F.get("n", F.lit(0)).alias("first_number"),
        F.when(c("t").isNotNull(), F.size("t")).alias("texts"),
        F.get("t", F.lit(0)).alias("first_text"),
    )


_AS_NUMBER = """CASE event_id % 5 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN value + 0.001
                WHEN 3 THEN CASE WHEN k > 50 THEN 1.0 ELSE 0.0 END END"""


@query("f6_numeric_as_double", f"WITH {EV} SELECT event_id AS sequence, ROUND({_AS_NUMBER}, 6) AS number FROM ev")
def f6(spark, sf_dir):
    return with_fields(_kinds(spark, sf_dir), lambda f: {"number": F.round(f.num("v"), 6)})


@query(
    "f7_numeric_as_float",
    f"WITH {EV} SELECT event_id AS sequence, ROUND(CAST(CAST({_AS_NUMBER} AS FLOAT) AS DOUBLE), 4) AS number FROM ev",
)
def f7(spark, sf_dir):
    return with_fields(_kinds(spark, sf_dir), lambda f: {"number": F.round(f.num32("v").cast("double"), 4)})


def _prefixed(spark, sf_dir):
    """Line items with the value under outer.inner., under outer. or bare, by line number."""
    xyz = F.struct(c("l_quantity").alias("x"), c("l_tax").alias("y"))
    kind = c("l_linenumber") % 4
    payload = (
        F.when(kind == 0, json_of(outer=F.struct(xyz.alias("inner"))))
        .when(kind == 1, json_of(outer=xyz))
        .when(kind == 2, json_of(x=c("l_quantity"), y=c("l_tax")))
        .otherwise(json_of(y=c("l_tax")))
    )
    return lines(spark, sf_dir, payload)


@query(
    "f10_resolve_prefix",
    """SELECT l_orderkey * 10 + l_linenumber AS sequence,
        CASE l_linenumber % 4 WHEN 0 THEN 'outer.inner.' WHEN 1 THEN 'outer.' ELSE '' END AS prefix,
        CASE WHEN l_linenumber % 4 < 3 THEN l_quantity END AS x, l_tax AS y FROM lineitem""",
)
def f10(spark, sf_dir):
    prefixes = ["outer.inner.", "outer.", ""]
    return with_fields(
        _prefixed(spark, sf_dir),
        lambda f: {
            "prefix": G.by_prefix(f, "x", prefixes, F.lit),
            "x": G.by_prefix(f, "x", prefixes, lambda p: f.num(p + "x")),
            "y": G.by_prefix(f, "x", prefixes, lambda p: f.num(p + "y")),
        },
    )


def _spatial(spark, sf_dir):
    """Line items with a vector, a quaternion and a covariance; some without any axis."""
    axes = [c("l_quantity").alias("x"), c("l_extendedprice").alias("y"), c("l_discount").alias("z")]
    cov = F.array(c("l_tax"), F.lit(0.0), c("l_discount"))
    payload = F.when(
        c("l_linenumber") % 3 > 0,
        json_of(v=F.struct(*axes), q=F.struct(*axes, c("l_tax").alias("w")), cov=cov, kind=c("l_linenumber")),
    ).otherwise(json_of(v=F.struct(F.lit("text").alias("x")), cov=F.array(F.lit(-1.0), c("l_tax"))))
    return lines(spark, sf_dir, payload)


_SEQ = "l_orderkey * 10 + l_linenumber AS sequence"
_HAS = "l_linenumber % 3 > 0"
_VALID = "(l_linenumber % 3 > 0 AND (l_tax <> 0 OR l_discount <> 0))"


@query(
    "f12_covariance",
    f"""SELECT {_SEQ}, CASE WHEN {_VALID} THEN l_tax END AS first, CASE WHEN {_VALID} THEN 3 END AS n,
        CASE WHEN {_HAS} THEN CAST(l_linenumber AS SMALLINT) END AS kind FROM lineitem""",
)
def f12(spark, sf_dir):
    rows = with_fields(
        _spatial(spark, sf_dir), lambda f: {"cov": G.covariance(f, "cov"), "kind": G.covariance_type(f, "kind")}
    )
    return rows.select(
        "sequence", F.get("cov", F.lit(0)).alias("first"), F.when(c("cov").isNotNull(), F.size("cov")).alias("n"), "kind"
    )


def _axes_sql(name: str, axes: str) -> str:
    source = {"x": "l_quantity", "y": "l_extendedprice", "z": "l_discount", "w": "l_tax"}
    return ", ".join(f"CASE WHEN {_HAS} THEN {source[a]} END AS {name}_{a}" for a in axes)


@query("f13_vector3", f"SELECT {_SEQ}, {_axes_sql('v', 'xyz')}, NOT ({_HAS}) AS is_null FROM lineitem")
def f13(spark, sf_dir):
    rows = with_fields(_spatial(spark, sf_dir), lambda f: {"v": G.vector3(f, "v.", "cov", nullable=True)})
    return scalars_of(rows.withColumn("is_null", c("v").isNull()), "sequence", "v.x", "v.y", "v.z", "is_null")


@query("f14_quaternion", f"SELECT {_SEQ}, {_axes_sql('q', 'xyzw')}, FALSE AS is_null FROM lineitem")
def f14(spark, sf_dir):
    rows = with_fields(_spatial(spark, sf_dir), lambda f: {"q": G.quaternion(f, "q.", "cov")})
    return scalars_of(rows.withColumn("is_null", c("q").isNull()), "sequence", "q.x", "q.y", "q.z", "q.w", "is_null")


@query(
    "f15_point3",
    f"""SELECT {_SEQ}, {_axes_sql('p', 'xyz')}, CASE WHEN {_HAS} THEN CAST(l_linenumber AS SMALLINT) END AS p_covariance_type,
        CASE WHEN {_VALID} THEN l_tax END AS p_covariance_0 FROM lineitem""",
)
def f15(spark, sf_dir):
    rows = with_fields(_spatial(spark, sf_dir), lambda f: {"p": G.point3(f, "v.", "cov", "kind")})
    return scalars_of(rows, "sequence", "p.x", "p.y", "p.z", "p.covariance_type", "p.covariance@")


# ---------------------------------------------------------------- formats


@query(
    "f16_format_duration",
    """WITH d AS (SELECT doc_id, n_chars * 7 AS s FROM documents)
       SELECT doc_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's'
         WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS duration FROM d""",
)
def f16(spark, sf_dir):
    ns = c("n_chars") * 7 * F.lit(1_000_000_000) + F.lit(999_999_999)
    return load(spark, sf_dir, "documents").select("doc_id", X.format_duration(ns).alias("duration"))


@query(
    "f17_format_file_size",
    """WITH d AS (SELECT doc_id, n_chars * (CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END) AS b FROM documents)
       SELECT doc_id, CASE WHEN b >= 1000000000 THEN printf('%.1f GB', b / 1e9) WHEN b >= 1000000 THEN printf('%.1f MB', b / 1e6)
         WHEN b >= 1000 THEN printf('%.1f KB', b / 1e3) ELSE b || ' B' END AS size FROM d""",
)
def f17(spark, sf_dir):
    scale = F.when(c("doc_id") % 3 == 0, 1).when(c("doc_id") % 3 == 1, 1000).otherwise(1_000_000)
    size = X.format_file_size(c("n_chars") * scale)
    return load(spark, sf_dir, "documents").select("doc_id", size.alias("size"))


@query(
    "f18_format_timestamp_utc",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS utc FROM events",
)
def f18(spark, sf_dir):
    return event_rows(spark, sf_dir).select("event_id", X.format_timestamp_utc(c("ns")).alias("utc"))


# ---------------------------------------------------------------- names


@query(
    "f19_sanitize_name",
    "SELECT page_id, regexp_replace(replace('/' || url, '/', '_'), '^_', '') AS name FROM pages",
)
def f19(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", X.sanitize_name(F.concat(F.lit("/"), "url")).alias("name"))


@query("f20_strip_leading_slashes", "SELECT page_id, ltrim(substr(url, 6 + page_id % 2), '/') AS name FROM pages")
def f20(spark, sf_dir):
    cut = F.substr(c("url"), (F.lit(6) + c("page_id") % 2).cast("int"))
    return load(spark, sf_dir, "pages").select("page_id", X.strip_leading_slashes(cut).alias("name"))


@query(
    "f21_pack_resource",
    "SELECT page_id, ltrim(substr(url, 6), '/') || '/' || page_id AS resource FROM pages",
)
def f21(spark, sf_dir):
    return load(spark, sf_dir, "pages").select(
        "page_id",
        X.pack_resource(F.substr(c("url"), F.lit(6)), F.concat(F.lit("//"), c("page_id").cast("string"))).alias("resource"),
    )


@query(
    "f22_topic_of_resource",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'other/' || c_name ELSE '/' || c_mktsegment END AS topic
       FROM customer""",
)
def f22(spark, sf_dir):
    joined = F.when(c("c_custkey") % 4 == 3, F.concat(F.lit("other/"), "c_name")).when(
        c("c_custkey") % 4 == 2, F.concat("c_name", F.lit(":"), "c_mktsegment")
    ).otherwise(F.concat("c_name", F.lit("/"), "c_mktsegment"))
    return load(spark, sf_dir, "customer").select("c_custkey", X.topic_of_resource(joined, c("c_name")).alias("topic"))


@query("f26_short_name", "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages")
def f26(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", X.short_name(c("url")).alias("name"))


@query(
    "f27_parse_type",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN p_name || '[' || p_size ELSE p_name END AS base,
        CAST(CASE p_partkey % 4 WHEN 1 THEN p_size WHEN 2 THEN -1 ELSE 0 END AS INTEGER) AS size FROM part""",
)
def f27(spark, sf_dir):
    size = c("p_size").cast("string")
    text = (
        F.when(c("p_partkey") % 4 == 0, c("p_name"))
        .when(c("p_partkey") % 4 == 1, F.concat("p_name", F.lit("["), size, F.lit("]")))
        .when(c("p_partkey") % 4 == 2, F.concat("p_name", F.lit("[]")))
        .otherwise(F.concat("p_name", F.lit("["), size))
    )
    return load(spark, sf_dir, "part").select("p_partkey", X.array_base(text).alias("base"), X.array_size(text).alias("size"))


# ---------------------------------------------------------------- JSON metadata


@query(
    "f23_endpoint_range",
    """SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN c_custkey END AS ts_min,
        CASE WHEN c_custkey % 7 > 1 THEN c_custkey + 1000 END AS ts_max FROM customer""",
)
def f23(spark, sf_dir):
    both = F.struct(c("c_custkey").alias("min"), (c("c_custkey") + 1000).alias("max"))
    text = (
        F.when(c("c_custkey") % 7 == 0, '{"timestamp": bad')
        .when(c("c_custkey") % 7 == 1, json_of(timestamp=F.struct(c("c_custkey").alias("min"))))
        .otherwise(json_of(timestamp=both))
    )
    found = M.endpoint_range(text)
    return load(spark, sf_dir, "customer").select("c_custkey", found["min"].alias("ts_min"), found["max"].alias("ts_max"))


@query(
    "f24_ontology_tag",
    "SELECT c_custkey, CASE WHEN c_custkey % 7 > 2 THEN c_mktsegment END AS tag FROM customer",
)
def f24(spark, sf_dir):
    text = (
        F.when(c("c_custkey") % 7 == 0, '{"ontology_tag": ')
        .when(c("c_custkey") % 7 == 1, json_of(ontology_tag=c("c_custkey")))
        .when(c("c_custkey") % 7 == 2, json_of(other=c("c_name")))
        .otherwise(json_of(ontology_tag=c("c_mktsegment")))
    )
    return load(spark, sf_dir, "customer").select("c_custkey", M.ontology_tag(text).alias("tag"))


@query(
    "f25_user_metadata",
    """SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN 4 ELSE 0 END AS keys,
        CASE WHEN c_custkey % 7 > 1 THEN c_name END AS name,
        CASE WHEN c_custkey % 7 > 1 THEN CAST(c_nationkey AS VARCHAR) END AS nation,
        CASE WHEN c_custkey % 7 > 1 THEN '{"a":' || c_nationkey || '}' END AS nested,
        CASE WHEN c_custkey % 7 > 1 THEN 'null' END AS missing FROM customer""",
)
def f25(spark, sf_dir):
    text = (
        F.when(c("c_custkey") % 7 == 0, '{"name": ')
        .when(c("c_custkey") % 7 == 1, F.lit('["x","y"]'))
        .otherwise(
            F.concat(
                F.lit('{"name":"'), "c_name", F.lit('","nation":'), c("c_nationkey").cast("string"), F.lit(',"nested":{"a":'),
                c("c_nationkey").cast("string"), F.lit('},"missing":null,"ros:type":"x"}'),
            )
        )
    )
    rows = load(spark, sf_dir, "customer").select("c_custkey", M.user_metadata(text).alias("m"))
    return rows.select(
        "c_custkey", F.size("m").alias("keys"), *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("name", "nation", "nested", "missing")]
    )


@query("f28_unwrap_response", "SELECT c_custkey, c_name AS key FROM customer")
def f28(spark, sf_dir):
    text = F.when(c("c_custkey") % 2 == 0, json_of(response=F.struct(c("c_name").alias("key")))).otherwise(
        json_of(key=c("c_name"))
    )
    body = M.unwrap_response(F.try_parse_json(text))
    return load(spark, sf_dir, "customer").select("c_custkey", F.try_variant_get(body, "$.key", "string").alias("key"))


@query(
    "d24_drop_internal_keys",
    """SELECT n.n_nationkey, COUNT(*) AS keys FROM customer JOIN nation n ON c_nationkey = n_nationkey
       WHERE c_custkey % 3 <> 0 GROUP BY 1""",
)
def d24(spark, sf_dir):
    """Customers of a nation as metadata keys, a third of them internal. Map keys are counted per customer row."""
    key = F.concat(F.when(c("c_custkey") % 3 == 0, F.lit("ros:")).otherwise(F.lit("user:")), "c_name")
    rows = load(spark, sf_dir, "customer").select("c_nationkey", M.drop_internal_keys(F.create_map(key, F.lit("x"))).alias("m"))
    counts = rows.groupBy("c_nationkey").agg(F.sum(F.size("m")).alias("keys"))
    nation = load(spark, sf_dir, "nation")
    return nation.join(counts, nation.n_nationkey == counts.c_nationkey).where("keys > 0").select("n_nationkey", "keys")
