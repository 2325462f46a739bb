"""Typed access to the fields of one message.

The projections ask for fields by dot path ("header.stamp.sec") and do not care where they come from:

* ``LeafFields`` reads the leaves that ``operators.extract`` took from a JSON payload;
* ``ColumnFields`` reads flattened columns of a struct-typed source;
* ``FieldProbe`` reads nothing and notes what would be read.

Every getter gives null when the stored kind is not the requested one; nothing is coerced from text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT_RANGES = {
    "int8": (-(2**7), 2**7 - 1, "tinyint"),
    "int16": (-(2**15), 2**15 - 1, "smallint"),
    "int32": (-(2**31), 2**31 - 1, "int"),
    "int64": (-(2**63), 2**63 - 1, "bigint"),
    "uint8": (0, 2**8 - 1, "smallint"),
    "uint16": (0, 2**16 - 1, "int"),
    "uint32": (0, 2**32 - 1, "bigint"),
    "uint64": (0, 2**64 - 1, "decimal(20,0)"),
}


def whole_kind(kind: str) -> str:
    """Kind of the leaf that an integer of this width is read from: one of any size where bigint is too small."""
    return "whole" if kind == "uint64" else "integer"


def ranged(value: Column, kind: str) -> Column:
    """An integer column narrowed to a width; null when outside of it."""
    low, high, spark_type = INT_RANGES[kind]
    if kind == "int64":
        return value.cast("bigint")
    bounds = [F.lit(str(b)).cast("decimal(20,0)" if kind == "uint64" else "bigint") for b in (low, high)]
    return F.when(value.between(*bounds), value).cast(spark_type)


# How a leaf of each kind is read from a variant {x}. Text is told by its quote, containers by their bracket;
# 1 is an integer, 1.0 and true are not; an array counts only when all of its elements are of one kind.
_TEXT = "startswith(to_json({x}), '\"')"
_ALL_TEXT = "forall(try_variant_get({x}, '$', 'array<variant>'), e -> startswith(to_json(e), '\"'))"
_NUMBERS = r"to_json({x}) RLIKE '^\\[[-+0-9.eE,]*\\]$'"
_TEXTS = "(startswith(to_json({x}), '[\"') AND coalesce(" + _ALL_TEXT + ", false))"
VARIANT_SQL = {
    "num": "CASE WHEN NOT " + _TEXT + " THEN try_variant_get({x}, '$', 'double') END",
    "integer": "CASE WHEN schema_of_variant({x}) = 'BIGINT' THEN try_variant_get({x}, '$', 'bigint') END",
    # any size: 1.0 and 1e3 are none, but beyond 2^63 an integer and a real without a fraction look the same here
    "whole": "CASE WHEN schema_of_variant({x}) = 'BIGINT' THEN CAST(try_variant_get({x}, '$', 'bigint') AS DECIMAL(38,0)) "
    r"WHEN schema_of_variant({x}) RLIKE '^DECIMAL\\((19|[23][0-9]),0\\)$' THEN CAST(to_json({x}) AS DECIMAL(38,0)) END",
    "flag": "CASE WHEN to_json({x}) IN ('true', 'false') THEN try_variant_get({x}, '$', 'boolean') END",
    "text": "CASE WHEN " + _TEXT + " THEN try_variant_get({x}, '$', 'string') END",
    "nums": "CASE WHEN " + _NUMBERS + " THEN try_variant_get({x}, '$', 'array<double>') END",
    "texts": "CASE WHEN " + _TEXTS + " THEN try_variant_get({x}, '$', 'array<string>') END",
    # strings as they are, everything else as JSON text
    "anytext": "CASE WHEN " + _TEXT + " THEN try_variant_get({x}, '$', 'string') "
    "WHEN {x} IS NOT NULL AND NOT is_variant_null({x}) THEN to_json({x}) END",
    "items": "try_variant_get({x}, '$', 'array<variant>')",
    # an object is not a field itself, its members are
    "has": "({x} IS NOT NULL AND NOT is_variant_null({x}) AND NOT startswith(to_json({x}), '{'))",
    # an array whose first element is a number or text while a later one is of another kind
    "mixed": r"coalesce((to_json({x}) RLIKE '^\\[[-0-9]' AND NOT " + _NUMBERS + ") "
    "OR (startswith(to_json({x}), '[\"') AND NOT " + _TEXTS + "), false)",
}


def json_path(path: tuple[str, ...]) -> str:
    """Keys to a variant path: (a, b) becomes $['a']['b'], and a key with a single quote stands in double ones."""
    return "$" + "".join(f'["{part}"]' if "'" in part else f"['{part}']" for part in path)


def variant_sql(kind: str, leaf: str) -> str:
    """SQL of a leaf read as a kind; ``map:<kind>`` reads all members of an object as that kind, without null ones."""
    if kind.startswith("map:"):
        members = f"map_filter(try_variant_get({leaf}, '$', 'map<string,variant>'), (k, v) -> v IS NOT NULL AND NOT is_variant_null(v))"
        return f"transform_values({members}, (k, v) -> {variant_sql(kind[4:], 'v')})"
    return VARIANT_SQL[kind].replace("{x}", leaf)


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def leaf_sql(body: str, path: tuple[str, ...]) -> str:
    """The leaf at a path of a variant, as a variant."""
    return f"try_variant_get({body}, {text_literal(json_path(path))}, 'variant')"


def is_text(leaf: Column) -> Column:
    return F.to_json(leaf).startswith('"')


class FieldProbe:
    """Stands in for the fields of a message and notes what a projection asks for.

    ``wants`` maps every path to the kinds read from it; ``operators.extract`` plans one parse from that.
    """

    def __init__(self):
        self.wants: dict[tuple[str, ...], set[str]] = {}
        self.log_time = F.lit(None).cast("bigint")
        self.checks: list[tuple[Column, str]] = []

    def _note(self, path: str, kind: str, spark_type: str) -> Column:
        self.wants.setdefault(tuple(path.split(".")), set()).add(kind)
        return F.lit(None).cast(spark_type)

    def has(self, path: str) -> Column:
        return self._note(path, "has", "boolean")

    def num(self, path: str) -> Column:
        return self._note(path, "num", "double")

    def num32(self, path: str) -> Column:
        return self._note(path, "num", "float")

    def integer(self, path: str, kind: str) -> Column:
        return self._note(path, whole_kind(kind), INT_RANGES[kind][2])

    def out_of_range(self, path: str, kind: str) -> Column:
        return self._note(path, whole_kind(kind), "boolean")

    def text(self, path: str) -> Column:
        return self._note(path, "text", "string")

    def flag(self, path: str) -> Column:
        return self._note(path, "flag", "boolean")

    def nums(self, path: str) -> Column:
        return self._note(path, "nums", "array<double>")

    def texts(self, path: str) -> Column:
        return self._note(path, "texts", "array<string>")

    def octets(self, path: str) -> Column:
        return F.lit(None).cast("binary")


class LeafFields:
    """Fields of a message whose wanted leaves were extracted to one column per (kind, path)."""

    def __init__(self, log_time: Column | None = None, owner: str | None = None):
        self.log_time = log_time if log_time is not None else F.lit(None).cast("bigint")
        self.checks: list[tuple[Column, str]] = []
        self._owner = owner

    def _leaf(self, kind: str, path: str) -> Column:
        name = leaf_name(kind, tuple(path.split(".")))
        return F.col(f"`{name}`") if self._owner is None else F.col(self._owner).getField(name)

    def has(self, path: str) -> Column:
        return self._leaf("has", path)

    def num(self, path: str) -> Column:
        return self._leaf("num", path)

    def num32(self, path: str) -> Column:
        return self._leaf("num", path).cast("float")

    def integer(self, path: str, kind: str) -> Column:
        return ranged(self._leaf(whole_kind(kind), path), kind)

    def out_of_range(self, path: str, kind: str) -> Column:
        value = self._leaf(whole_kind(kind), path)
        return value.isNotNull() & ranged(value, kind).isNull()

    def text(self, path: str) -> Column:
        return self._leaf("text", path)

    def flag(self, path: str) -> Column:
        return self._leaf("flag", path)

    def nums(self, path: str) -> Column:
        return self._leaf("nums", path)

    def texts(self, path: str) -> Column:
        return self._leaf("texts", path)

    def octets(self, path: str) -> Column:
        """JSON has no byte arrays."""
        return F.lit(None).cast("binary")


def leaf_name(kind: str, path: tuple[str, ...]) -> str:
    return f"{kind}:{'.'.join(path)}"


class ColumnFields:
    """Fields of a flat DataFrame whose column names are the dot paths (see ``flatten_structs``)."""

    def __init__(self, columns: dict[str, tuple[Column, T.DataType]], log_time: Column | None = None):
        self.columns = columns
        self.log_time = log_time if log_time is not None else F.lit(None).cast("bigint")
        self.checks: list[tuple[Column, str]] = []

    @classmethod
    def of(cls, flat: DataFrame, log_time: str | None = "log_time_ns") -> "ColumnFields":
        columns = {f.name: (F.col(f"`{f.name}`"), f.dataType) for f in flat.schema.fields}
        present = log_time is not None and log_time in columns
        return cls(columns, F.col(log_time) if present else None)

    def _pick(self, path: str, accepts, otherwise: str, convert) -> Column:
        column, data_type = self.columns.get(path, (None, None))
        if column is None or not accepts(data_type):
            return F.lit(None).cast(otherwise)
        return convert(column)

    @staticmethod
    def _is_integer(t: T.DataType) -> bool:
        return isinstance(t, T.IntegralType) or (isinstance(t, T.DecimalType) and t.scale == 0)

    @staticmethod
    def _is_number(t: T.DataType) -> bool:
        return isinstance(t, (T.NumericType, T.BooleanType))

    @classmethod
    def _is_numbers(cls, t: T.DataType) -> bool:
        return isinstance(t, T.ArrayType) and cls._is_number(t.elementType)

    def has(self, path: str) -> Column:
        column, _ = self.columns.get(path, (None, None))
        return F.lit(False) if column is None else column.isNotNull()

    def num(self, path: str) -> Column:
        return self._pick(path, self._is_number, "double", lambda c: c.cast("double"))

    def num32(self, path: str) -> Column:
        return self._pick(path, self._is_number, "float", lambda c: c.cast("float"))

    def integer(self, path: str, kind: str) -> Column:
        return self._pick(path, self._is_integer, INT_RANGES[kind][2], lambda c: ranged(c, kind))

    def out_of_range(self, path: str, kind: str) -> Column:
        return self._pick(
            path, self._is_integer, "boolean", lambda c: c.isNotNull() & ranged(c, kind).isNull()
        )

    def text(self, path: str) -> Column:
        return self._pick(path, lambda t: isinstance(t, T.StringType), "string", lambda c: c)

    def flag(self, path: str) -> Column:
        return self._pick(path, lambda t: isinstance(t, T.BooleanType), "boolean", lambda c: c)

    def nums(self, path: str) -> Column:
        return self._pick(path, self._is_numbers, "array<double>", lambda c: c.cast("array<double>"))

    def texts(self, path: str) -> Column:
        texts = lambda t: isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType)
        return self._pick(path, texts, "array<string>", lambda c: c)

    def octets(self, path: str) -> Column:
        return self._pick(path, lambda t: isinstance(t, T.BinaryType), "binary", lambda c: c)
