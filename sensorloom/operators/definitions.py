"""Message definition texts as tables: fields, nested types, declared schemas.

A definition holds a main block and, after lines of ``===``, further blocks headed by ``MSG: name``. Texts
are handled once however many channels carry them; every step is keyed by ``definition``, the hash of
(schema name, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.text import array_base, array_size, short_name
from sensorloom.session import written

# Declared primitives and the Spark types that hold them.
PRIMITIVES = {
    "bool": "boolean",
    "int8": "tinyint",
    "uint8": "smallint",
    "byte": "smallint",
    "char": "smallint",
    "int16": "smallint",
    "uint16": "int",
    "int32": "int",
    "uint32": "bigint",
    "int64": "bigint",
    "uint64": "decimal(20,0)",
    "float32": "float",
    "float64": "double",
    "string": "string",
    "wstring": "string",
    "time": "struct<sec:bigint,nanosec:bigint>",
    "duration": "struct<sec:bigint,nanosec:bigint>",
}

_BLANK = r"[ \t\r\n]"


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")


def distinct_definitions(channels: DataFrame) -> DataFrame:
    """Each (schema_name, schema_data) once."""
    return channels.select("schema_name", "schema_data").distinct().withColumn(
        "definition", F.sha2(F.concat_ws("\u0000", "schema_name", "schema_data"), 256)
    )


def definition_blocks(definitions: DataFrame) -> DataFrame:
    """(definition, schema_name, block_no, block, lines): the text cut at its separators.

    Block 0 is the main type. A later block without a ``MSG:`` head has no name and is left out. Of two
    later blocks of one name the last counts.
    """
    pieces = F.split("schema_data", r"(?dm)^[ \t\r]*={3,}[ \t\r]*$")
    block = definitions.select("definition", "schema_name", F.posexplode(pieces).alias("block_no", "text"))
    # the text of a later block starts with the line feed that ended its separator line
    body = F.when(F.col("block_no") > 0, F.regexp_replace("text", r"^\n", "")).otherwise(F.col("text"))
    lines = block.select("definition", "schema_name", "block_no", F.split(body, "\n").alias("lines"))
    head = _trim(F.col("lines")[0])
    name = F.when(F.col("block_no") == 0, F.col("schema_name")).when(
        head.startswith("MSG: "), _trim(F.substr(head, F.lit(6)))
    )
    named = lines.withColumn("block", name).where(F.col("block").isNotNull())
    return named.groupBy("definition", "schema_name", "block", (F.col("block_no") > 0).alias("later")).agg(
        F.max("block_no").alias("block_no"), F.max_by("lines", "block_no").alias("lines")
    )


def definition_lines(definitions: DataFrame) -> DataFrame:
    """The lines of every block, without the head line of later blocks."""
    return definition_blocks(definitions).select(
        "definition", "schema_name", "block_no", "block", F.posexplode("lines").alias("line_no", "raw")
    ).where((F.col("block_no") == 0) | (F.col("line_no") > 0))


def field_catalog(channels: DataFrame) -> DataFrame:
    """One row per declared field.

    Lines with ``=`` are constants and left out; those that hold a bounded type are marked in
    ``bounded_catalog``.
    """
    lines = definition_lines(distinct_definitions(channels))
    code = lines.withColumn("line", _trim(F.regexp_replace("raw", "#.*$", "")))
    field = code.where(~F.contains("line", F.lit("="))).where(F.col("line").rlike(r"^\S+\s+\S+"))
    type_text = F.regexp_extract("line", r"^(\S+)\s+(\S+)\s*(.*)$", 1)
    parsed = field.select(
        "definition",
        "schema_name",
        "block_no",
        "block",
        "line_no",
        F.regexp_extract("line", r"^(\S+)\s+(\S+)\s*(.*)$", 2).alias("field"),
        array_base(type_text).alias("base_type"),
        array_size(type_text).alias("array_size"),
        F.nullif(_trim(F.regexp_extract("line", r"^(\S+)\s+(\S+)\s*(.*)$", 3)), F.lit("")).alias("default"),
    )
    # ordinals by an aggregate over the few fields of a block
    ordered = parsed.groupBy("definition", "schema_name", "block_no", "block").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "field", "base_type", "array_size", "default"))).alias("fields")
    )
    return ordered.select(
        "definition", "schema_name", "block_no", "block", F.posexplode("fields").alias("at", "f")
    ).select(
        "definition",
        "schema_name",
        "block_no",
        "block",
        (F.col("at") + 1).alias("ordinal"),
        "f.field",
        "f.base_type",
        "f.array_size",
        "f.default",
    )


def skipped_lines(channels: DataFrame) -> DataFrame:
    """Lines taken for constants; ``skipped_bounded`` tells the bounded types among them."""
    lines = definition_lines(distinct_definitions(channels))
    code = lines.withColumn("line", _trim(F.regexp_replace("raw", "#.*$", "")))
    return code.where(F.contains("line", F.lit("="))).select(
        "schema_name", "block", "line", F.contains("line", F.lit("<=")).alias("skipped_bounded")
    )


def _later_blocks(channels: DataFrame) -> DataFrame:
    return definition_blocks(distinct_definitions(channels)).where("block_no > 0").select("definition", "block")


def nested_types(channels: DataFrame, fields: DataFrame) -> DataFrame:
    """Fields of nested type with the block that defines it, null when there is none.

    The full name decides; otherwise the part after the last slash, the smallest full name first.
    """
    nested = fields.where(~F.col("base_type").isin(list(PRIMITIVES)))
    blocks = _later_blocks(channels).withColumnRenamed("block", "candidate")
    exact = blocks.select("definition", F.col("candidate").alias("base_type"), F.col("candidate").alias("exact"))
    short = blocks.groupBy("definition", short_name(F.col("candidate")).alias("short")).agg(
        F.min("candidate").alias("by_short")
    )
    return (
        nested.withColumn("short", short_name(F.col("base_type")))
        .join(exact, ["definition", "base_type"], "left")
        .join(short, ["definition", "short"], "left")
        .withColumn("resolved", F.coalesce("exact", "by_short"))
        .drop("short", "exact", "by_short")
    )


def _ddl(element: Column) -> Column:
    return F.when(F.col("array_size") == 0, element).otherwise(F.concat(F.lit("array<"), element, F.lit(">")))


def _primitive(base: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in PRIMITIVES.items() for x in pair])
    return F.try_element_at(names, base)


def _nesting(fields: DataFrame) -> tuple[int, DataFrame]:
    """Levels of nesting below the main block, and the definitions that nest into themselves.

    What a definition nests is a small graph of block names; it is followed level by level from every block. A block
    that is reached from itself ends its definition, which takes no part in later levels.
    """
    edges = fields.where("resolved is not null").select("definition", F.col("block").alias("above"), F.col("resolved").alias("below")).distinct()
    reached, depth = written(edges, "levels"), 0
    cyclic = reached.where("false").select("definition")
    while not reached.isEmpty():
        depth += 1
        cyclic = cyclic.unionByName(reached.where("above = below").select("definition").distinct())
        step = edges.withColumnsRenamed({"above": "at", "below": "next"})
        open_ = reached.join(cyclic.distinct(), "definition", "left_anti")
        reached = written(
            open_.withColumnRenamed("below", "at")
            .join(step, ["definition", "at"])
            .select("definition", "above", F.col("next").alias("below"))
            .distinct(),
            "levels",
        )
    return depth, cyclic.distinct()


def field_types(channels: DataFrame) -> DataFrame:
    """``field_catalog`` with the Spark type of each field; an unresolved nested type is binary.

    In a definition that nests into itself, nested fields have no type (null).

    The parsed fields and blocks are written once, then types are filled in from the innermost blocks
    outwards, one join per level of nesting.
    """
    fields = field_catalog(channels)
    resolved = nested_types(channels, fields).select("definition", "block_no", "ordinal", "resolved")
    fields = written(fields.join(resolved, ["definition", "block_no", "ordinal"], "left"), "fields")
    blocks = written(_later_blocks(channels), "blocks")
    primitive = _primitive(F.col("base_type"))
    typed = fields.withColumn("type", _ddl(F.coalesce(primitive, F.lit("binary"))))
    members = F.transform(
        F.sort_array(F.collect_list(F.struct("ordinal", "field", "type"))),
        lambda m: F.concat(F.lit("`"), m["field"], F.lit("`:"), m["type"]),
    )
    depth, cyclic = _nesting(fields)
    for _ in range(depth):
        filled = typed.where("block_no > 0").groupBy("definition", "block").agg(F.array_join(members, ",").alias("members"))
        known = blocks.join(filled, ["definition", "block"], "left").select(
            "definition",
            F.col("block").alias("resolved"),
            F.concat(F.lit("struct<"), F.coalesce("members", F.lit("")), F.lit(">")).alias("struct"),
        )
        typed = fields.join(known, ["definition", "resolved"], "left").withColumn(
            "type", _ddl(F.coalesce(primitive, "struct", F.lit("binary")))
        ).drop("struct")
    endless = cyclic.select("definition", F.lit(True).alias("cyclic"))
    typed = typed.join(endless, "definition", "left")
    known = F.when(F.col("cyclic").isNull() | F.col("resolved").isNull(), F.col("type"))
    return typed.withColumn("type", known).drop("cyclic")


def declared_schema(channels: DataFrame) -> DataFrame:
    """Declared fields of each schema: the time column first, then the main block in order."""
    fields = field_types(channels).where("block_no = 0").select("schema_name", "definition", "ordinal", "field", "type")
    time = distinct_definitions(channels).select(
        "schema_name", "definition", F.lit(0).alias("ordinal"), F.lit("timestamp_ns").alias("field"), F.lit("bigint").alias("type")
    )
    return time.unionByName(fields)


def declared_ddl(channels: DataFrame) -> DataFrame:
    """One DDL text per schema; null for a definition that nests into itself."""
    members = F.transform(
        F.sort_array(F.collect_list(F.struct("ordinal", "field", "type"))),
        lambda m: F.concat(F.lit("`"), m["field"], F.lit("` "), m["type"]),
    )
    ddl = F.when(~F.bool_or(F.col("type").isNull()), F.array_join(members, ", "))
    return declared_schema(channels).groupBy("schema_name", "definition").agg(ddl.alias("ddl"))


def json_schema(columns: DataFrame) -> DataFrame:
    """JSON Schema per table from rows (table, column, type); the time column is left out.

    A property is number, boolean or string, string standing for everything else.
    """
    number = r"^(tinyint|smallint|int|bigint|float|double|decimal.*)$"
    kind = F.when(F.col("type").rlike(number), "number").when(F.col("type") == "boolean", "boolean").otherwise("string")
    # a column listed twice with types that differ is text
    kinds = columns.groupBy("table", "column").agg(F.min(kind).alias("a"), F.max(kind).alias("b"))
    kind = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise("string")
    entry = F.when(F.col("column") != "timestamp_ns", F.struct("column", F.struct(kind.alias("type"))))
    listed = kinds.groupBy("table").agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("properties")
    )
    return listed.select(
        "table",
        F.to_json(F.struct("properties", F.lit("object").alias("type"))).alias("json_schema"),
    )
