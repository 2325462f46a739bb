"""Flattening of struct-typed sources to dot-path columns.

Types follow the flat field model: numeric and boolean arrays become array<double>, maps become arrays
of {key, value}, arrays of structs keep their elements (flattened), binary stays binary. Arrays of binary become
texts, in which malformed bytes turn into the replacement character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults of a field that was never set, by Spark type.
_UNSET = [
    (T.BooleanType, "false"),
    (T.NumericType, "0"),
    (T.StringType, "''"),
]


def _leaves(data_type: T.StructType, column, above: tuple[str, ...] = ()):
    """(path, column, type) of every leaf of a struct."""
    for field in data_type.fields:
        path, child = above + (field.name,), column(field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, lambda name, c=child: c.getField(name), path)
        else:
            yield path, child, field.dataType


def _by_name(leaves) -> dict[str, tuple[Column, T.DataType]]:
    """Leaves by dot path. Field b of struct a wins over a column literally named "a.b"."""
    chosen = {}
    for path, column, data_type in sorted(leaves, key=lambda leaf: len(leaf[0])):
        chosen[".".join(path)] = (column, data_type)
    return chosen


def _flat_struct(data_type: T.StructType, column: Column) -> Column:
    leaves = _by_name(_leaves(data_type, lambda name: column.getField(name)))
    return F.struct(*[_shape(c, t).alias(name) for name, (c, t) in leaves.items()])


def _shape(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.MapType):
        return F.map_entries(column)
    if isinstance(data_type, T.ArrayType):
        element = data_type.elementType
        if isinstance(element, (T.NumericType, T.BooleanType)):
            return column.cast("array<double>")
        if isinstance(element, T.BinaryType):
            return F.transform(column, lambda b: F.make_valid_utf8(b.cast("string")))
        if isinstance(element, T.StructType):
            return F.transform(column, lambda e: _flat_struct(element, e))
    return column


def flatten_structs(df: DataFrame, keep_shape: bool = False) -> DataFrame:
    """One column per leaf, named by its dot path."""
    leaves = _by_name(_leaves(df.schema, lambda name: F.col(f"`{name}`")))
    return df.select(*[(c if keep_shape else _shape(c, t)).alias(name) for name, (c, t) in leaves.items()])


def fill_unset(flat: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Declared fields that were never set get the default of their type."""
    wanted = set(columns) if columns is not None else {f.name for f in flat.schema.fields}

    def filled(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name not in wanted:
            return column
        for kind, text in _UNSET:
            if isinstance(field.dataType, kind):
                return F.coalesce(column, F.expr(text).cast(field.dataType)).alias(field.name)
        if isinstance(field.dataType, T.BinaryType):
            return F.coalesce(column, F.lit("").cast("binary")).alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.coalesce(column, F.array().cast(field.dataType)).alias(field.name)
        return column

    return flat.select(*[filled(f) for f in flat.schema.fields])


def enum_number(column: Column, values: dict[str, int]) -> Column:
    """Enum names to their numbers."""
    mapping = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.try_element_at(mapping, column).cast("int")
