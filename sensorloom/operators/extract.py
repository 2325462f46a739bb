"""The wanted leaves of JSON payloads in one pass.

Payloads are parsed by ``from_json`` with exactly the fields a projection reads, each with the type it is
read as. That is fast, but lenient in a few corners (text for a number, "NaN", trailing text, nulls in
arrays). Every such row is recognised and only those rows are parsed again into a variant, from which the
leaves are read with strict kinds and the reject reason is found. Both ways give the same columns.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.fields import FieldProbe, leaf_name, leaf_sql, variant_sql
from sensorloom.operators.decode import (
    BIG_NUMBER,
    END_MARK,
    big_integers,
    json_reason,
    json_text,
    unsigned_only,
    wrapped_body,
)

Path = tuple[str, ...]
Wants = dict[Path, set[str]]

# Strict JSON for the fast parse.
_STRICT = {
    "columnNameOfCorruptRecord": "_bad",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
_FAST_TYPES = {
    "num": T.DoubleType(),
    "integer": T.LongType(),
    "whole": T.LongType(),
    "flag": T.BooleanType(),
    "nums": T.ArrayType(T.DoubleType()),
}
_MOST = 2**63 - 1
_KEY, _END = f"body-{END_MARK}", f"mark-{END_MARK}"


@lru_cache(maxsize=1024)
def wants_of(projection) -> Wants:
    """Paths and kinds a projection reads."""
    probe = FieldProbe()
    projection(probe)
    return probe.wants


class _Plan:
    """Struct type for the fast parse, and where each wanted path is found in it."""

    def __init__(self, wants: Wants):
        self.wants = wants
        self.roots: dict[Path, T.DataType] = {}
        for path in sorted(wants, key=len):
            above = [path[:i] for i in range(len(path))]
            if any(p in self.roots for p in above):
                continue  # read from the variant of the path above
            below = any(q != path and q[: len(path)] == path for q in wants)
            kinds = wants[path] - {"has"}
            single = _FAST_TYPES.get(next(iter(kinds))) if len(kinds) == 1 and not below else None
            self.roots[path] = single or T.VariantType()

    def root_of(self, path: Path) -> Path:
        return next(path[:i] for i in range(len(path) + 1) if path[:i] in self.roots)

    def schema(self) -> T.DataType:
        if () in self.roots:  # the whole body is asked for
            return self.roots[()]
        tree: dict = {}
        for path, data_type in self.roots.items():
            node = tree
            for part in path[:-1]:
                node = node.setdefault(part, {})
            node[path[-1]] = data_type

        def struct(node: dict) -> T.StructType:
            return T.StructType(
                [T.StructField(k, struct(v) if isinstance(v, dict) else v) for k, v in node.items()]
            )

        return struct(tree)


def _fast_leaf(path: Path) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in ("_parsed", _KEY, *path))


# Rows where the fast parse is exact. Suspect are integers that may overflow, null inside an array, and text
# that reads as a special number.
_SOUND = f"""coalesce(
    _parsed._bad IS NULL AND _parsed.`{_KEY}` IS NOT NULL AND _parsed.`{_END}` = '{END_MARK}'
    AND NOT (contains(_text, 'null') AND _text RLIKE '[\\\\[,]\\\\s*null')
    AND NOT (contains(_text, 'NaN"') OR contains(_text, 'INF"') OR contains(_text, 'Infinity"'))
    AND NOT _text RLIKE '{BIG_NUMBER}', false)"""


def _leaf_columns(plan: _Plan) -> tuple[list[str], str, str]:
    """SQL of the leaf columns, and of the mixed-array tests on sound and on other rows."""
    columns, mixed_fast, mixed_slow = [], ["false"], ["false"]
    for path, kinds in plan.wants.items():
        root = plan.root_of(path)
        typed = not isinstance(plan.roots[root], T.VariantType)
        fast, slow = _fast_leaf(root), leaf_sql("_body", path)
        if path != root:
            fast = leaf_sql(fast, path[len(root):])
        for kind in sorted(kinds):
            if not typed:
                column = variant_sql(kind, f"CASE WHEN _sound THEN {fast} ELSE {slow} END")
            else:
                quick = {"has": f"{fast} IS NOT NULL", "whole": f"CAST({fast} AS DECIMAL(38,0))"}.get(kind, fast)
                column = f"CASE WHEN _sound THEN {quick} ELSE {variant_sql(kind, slow)} END"
            if kind == "whole":  # beyond bigint only what the text has as an integer
                column = f"IF({column} <= {_MOST}BD OR array_contains(_big, CAST({column} AS STRING)), {column}, NULL)"
            columns.append(f"{column} AS `{leaf_name(kind, path)}`")
        if kinds & {"nums", "texts", "anytext"}:
            mixed_slow.append(variant_sql("mixed", slow))
            if not typed:
                mixed_fast.append(variant_sql("mixed", fast))
    return columns, " OR ".join(mixed_fast), " OR ".join(mixed_slow)


def extract(messages: DataFrame, wants: Wants) -> DataFrame:
    """Messages with one column per (kind, path), see ``leaf_name``, and ``reject_reason``."""
    plan = _Plan(wants)
    schema = T.StructType(
        [
            T.StructField(_KEY, plan.schema()),
            T.StructField(_END, T.StringType()),
            T.StructField("_bad", T.StringType()),
        ]
    )
    text = json_text(F.col("payload"))
    framed = F.concat(F.lit(f'{{"{_KEY}":'), text, F.lit(f',"{_END}":"{END_MARK}"}}'))
    # The generator keeps later filters on the result from repeating the parse below it.
    parsed = messages.select(
        "*", F.inline(F.array(F.struct(text.alias("_text"), F.from_json(framed, schema, _STRICT).alias("_parsed"))))
    )
    # a body taken as a whole need not be an object: the second way finds out
    sound = F.lit(False) if () in plan.roots else F.expr(_SOUND)
    checked = parsed.select("*", F.inline(F.array(F.struct(sound.alias("_sound")))))
    checked = checked.withColumn("_body", F.when(~F.col("_sound"), wrapped_body(F.col("_text"))))
    columns, mixed_fast, mixed_slow = _leaf_columns(plan)
    whole = [path for path, kinds in wants.items() if "whole" in kinds]
    unsigned = F.lit(0)
    if whole:
        checked = checked.withColumn("_big", F.when(~F.col("_sound"), big_integers(F.col("_text"))))
        for path in whole:
            unsigned = unsigned + F.coalesce(unsigned_only(F.expr(variant_sql("whole", leaf_sql("_body", path)))), F.lit(False)).cast("int")
    reason = F.when(F.col("_sound"), F.when(F.expr(mixed_fast), "mixed_array")).otherwise(
        F.coalesce(json_reason(F.col("_body"), F.col("_text"), unsigned), F.when(F.expr(mixed_slow), "mixed_array"))
    )
    # so does this one, for the checks: a filter on the reason reads it instead of making it again
    judged = checked.select("*", F.inline(F.array(F.struct(reason.alias("reject_reason")))))
    return judged.select(*messages.columns, *[F.expr(column) for column in columns], "reject_reason")


def extract_variant(elements: DataFrame, body: str, wants: Wants, owner: str) -> DataFrame:
    """The same leaves from a variant column, as one struct named ``owner``, plus ``<owner>_mixed``."""
    columns, mixed = [], ["false"]
    for path, kinds in wants.items():
        leaf = leaf_sql(body, path)
        columns += [F.expr(variant_sql(kind, leaf)).alias(leaf_name(kind, path)) for kind in sorted(kinds)]
        if kinds & {"nums", "texts"}:
            mixed.append(variant_sql("mixed", leaf))
    return elements.select("*", F.struct(*columns).alias(owner), F.expr(" OR ".join(mixed)).alias(f"{owner}_mixed"))
