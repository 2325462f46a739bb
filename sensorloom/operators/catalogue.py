"""Which fields the JSON bodies of topics have, whatever the number of keys: (path, kind, rows) as a table.

The shape of every body (``schema_of_variant``) is counted first, so a regular topic leaves a handful of shapes, and only
these are opened to paths. Nothing is gathered on the driver, and no string names all keys of a topic.

Kinds of a leaf: ``integer``, ``num``, ``flag``, ``text``, ``nums``, ``texts``, ``empty`` (an array without elements), ``list``
(any other array), ``mixed`` (an array that begins with a number or text and goes on with something else), and ``object``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.session import written

# executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns that an object may open to. One with more becomes one map column, which holds every key.
FIELDS = 1000

Path = tuple[str, ...]

# An array of this type has elements that do not merge: only such bodies are looked at themselves.
_LOOSE = "ARRAY<VARIANT>"
# Kind of a leaf by the name of its type.
_KINDS = {"BIGINT": "integer", "DECIMAL": "num", "DOUBLE": "num", "FLOAT": "num", "BOOLEAN": "flag", "STRING": "text", "VARIANT": "list"}


class _Shape:
    """Reads the fields off a shape such as ``OBJECT<a: BIGINT, `b c`: ARRAY<STRING>>``."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _word(self, ends: str) -> str:
        start = self.at
        while self.at < len(self.text) and self.text[self.at] not in ends:
            self.at += 1
        return self.text[start : self.at]

    def _name(self) -> str:
        if self.text[self.at] != "`":
            return self._word(":")
        parts = []
        while self.text[self.at] == "`":  # a doubled quote stands for one
            end = self.text.index("`", self.at + 1)
            parts.append(self.text[self.at + 1 : end])
            self.at = end + 1
        return "`".join(parts)

    def kind(self, path: Path, found: dict[Path, str]) -> str | None:
        """Kind of the type that comes next; the leaves of an object are put into ``found``."""
        word = self._word("<>,(")
        if word == "OBJECT":
            self.at += 1
            while self.text[self.at] != ">":
                name = self._name()
                self.at += 2
                kind = self.kind((*path, name), found)
                if kind is not None:
                    found[(*path, name)] = kind
                if self.text[self.at] == ",":
                    self.at += 2
            self.at += 1
            return "object"
        if word == "ARRAY":
            self.at += 1
            inner = self.kind((), {})
            self.at += 1
            return {"integer": "nums", "num": "nums", "text": "texts", None: "empty"}.get(inner, "list")
        if self.text[self.at : self.at + 1] == "(":
            self._word(")")
            self.at += 1
        return _KINDS.get(word)


def shape_leaves(shape: str) -> dict[Path, str]:
    """Kind by path of an object's shape; fields that are null do not count."""
    found: dict[Path, str] = {}
    _Shape(shape).kind((), found)
    return found


def _list_kind(items: list) -> str:
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    some = [x for x in items if x is not None]
    if not some:
        return "empty"
    if number(items[0]) or isinstance(items[0], str):
        if all(map(number, items)):
            return "nums"
        return "texts" if all(isinstance(x, str) for x in items) else "mixed"
    if all(map(number, some)):
        return "nums"
    return "texts" if all(isinstance(x, str) for x in some) else "list"


def body_leaves(body: dict, path: Path = ()) -> dict[Path, str]:
    """The same from a body itself, where arrays can be told apart by their elements."""
    found: dict[Path, str] = {}
    for name, value in body.items():
        at = (*path, name)
        if isinstance(value, dict):
            found |= {at: "object"} | body_leaves(value, at)
        elif isinstance(value, list):
            found[at] = _list_kind(value)
        elif value is not None:
            kinds = {bool: "flag", int: "integer", float: "num", str: "text"}
            found[at] = kinds[type(value)]
    return found


def has_mixed(text: str | None) -> bool:
    """Whether an array of a body, given as JSON text, is mixed."""
    return text is not None and "mixed" in body_leaves(json.loads(text)).values()


def _opened(keys: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            out: list[list] = [[] for _ in range(len(keys) + 3)]
            for i, (shape, loose, rows) in enumerate(zip(columns["shape"], columns["loose"], columns["rows"])):
                leaves = shape_leaves(shape) if loose is None else body_leaves(json.loads(loose))
                for path, kind in leaves.items():
                    for column, value in zip(out, [*(columns[k][i] for k in keys), list(path), kind, rows]):
                        column.append(value)
            arrays = [pa.array(column, field.type) for column, field in zip(out, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def loose_body() -> Column:
    """The body as JSON text where its shape does not tell the kinds of all arrays, else null.

    That is where elements do not merge, and where one is null: a null after a number is not seen in the shape."""
    shape = F.schema_of_variant("body")
    nulls = shape.contains("ARRAY<") & F.to_json("body").rlike(r",null[,\]]")
    return F.when(shape.contains(_LOOSE) | nulls, F.to_json("body"))


def field_catalogue(decoded: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Key union over rows: ``keys``, path, kind and the number of rows that have it, for every path and kind found.

    ``decoded`` has the variant ``body`` of every message; null fields do not count. Keys are text columns."""
    keys = ["recording", "topic"] if keys is None else keys
    shapes = decoded.select(*keys, F.schema_of_variant("body").alias("shape"), loose_body().alias("loose"))
    shapes = shapes.where("shape like 'OBJECT<%'").groupBy(*keys, "shape", "loose").agg(F.count("*").alias("rows"))
    schema = pa.schema([*((k, pa.string()) for k in keys), ("path", pa.list_(pa.string())), ("kind", pa.string()), ("rows", pa.int64())])
    ddl = ", ".join([*(f"`{k}` string" for k in keys), "path array<string>", "kind string", "rows bigint"])
    opened = shapes.mapInArrow(_opened(keys, schema), ddl)
    return opened.groupBy(*keys, "path", "kind").agg(F.sum("rows").alias("rows"))


# How a set of kinds is read: all numbers, all of one kind of array; everything else as text.
_READ_AS = """CASE
    WHEN array_contains(kinds, 'object') THEN IF(size(kinds) > 1, 'anytext', 'object')
    WHEN kinds = array('integer') THEN 'integer'
    WHEN size(array_except(kinds, array('integer', 'num'))) = 0 THEN 'num'
    WHEN kinds = array('flag') THEN 'flag'
    WHEN size(array_except(kinds, array('nums', 'empty', 'mixed'))) = 0 AND arrays_overlap(kinds, array('nums', 'empty')) THEN 'nums'
    WHEN size(array_except(kinds, array('texts', 'empty', 'mixed'))) = 0 AND array_contains(kinds, 'texts') THEN 'texts'
    ELSE 'anytext' END"""


def readable_fields(catalogue: DataFrame, keys: list[str] | None = None, limit: int = FIELDS) -> DataFrame:
    """``keys``, path and kind of the columns that topics are read as, at most ``limit`` for a topic.

    A field that is an object in some rows and something else in others is one column of JSON text. An object with more
    than ``limit`` columns below it, counted from the innermost out, is one map column: of kind ``map:<kind>`` if all its
    members are of one kind, else of JSON texts. No key is lost either way. The path of a topic that is one map is empty.
    """
    keys = ["recording", "topic"] if keys is None else keys
    fields = catalogue.groupBy(*keys, "path").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    fields = written(fields.select(*keys, "path", F.expr(_READ_AS).alias("kind"), F.array_contains("kinds", "object").alias("split")), "fields")
    # an object that is something else as well is one column, whatever lies below it
    odd = fields.where("split and kind = 'anytext'").select(*keys, F.col("path").alias("above"))
    leaves = fields.where("kind <> 'object'").select(*keys, "path", "kind")
    if not odd.isEmpty():
        above = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda n: F.slice("path", 1, n))
        below = leaves.where("size(path) > 1").select(*keys, "path", F.explode(above).alias("above"))
        below = below.join(odd, [*keys, "above"], "left_semi").select(*keys, "path").distinct()
        leaves = leaves.join(below, [*keys, "path"], "left_anti")
    widest = leaves.groupBy(*keys).agg(F.count("*").alias("n"), F.max(F.size("path")).alias("depth"))
    widest = widest.agg(F.max("n").alias("n"), F.max("depth").alias("depth")).first()
    if (widest["n"] or 0) <= limit:
        return leaves
    for level in range(widest["depth"] - 1, -1, -1):
        parent = F.slice("path", 1, level) if level else F.array().cast("array<string>")
        inner = leaves.where(F.size("path") > level).withColumn("parent", parent)
        kinds = F.array_sort(F.collect_set("kind"))
        flat = F.max(F.size("path")) == level + 1
        one = F.when(flat & (F.size(kinds) == 1) & ~F.element_at(kinds, 1).startswith("map"), F.element_at(kinds, 1))
        two = F.when(flat & (F.concat_ws(",", kinds) == "integer,num"), "num")
        kind = F.concat(F.lit("map:"), F.coalesce(one, two, F.lit("anytext")))
        open_ = inner.groupBy(*keys, "parent").agg(F.count("*").alias("n"), kind.alias("kind")).where(F.col("n") > limit)
        open_ = written(open_, "open")
        kept = inner.join(open_, [*keys, "parent"], "left_anti").select(*keys, "path", "kind")
        outer = leaves.where(F.size("path") <= level)
        leaves = written(outer.unionByName(kept).unionByName(open_.select(*keys, F.col("parent").alias("path"), "kind")), "fields")
    return leaves
