"""Text helpers: durations, sizes, topic and resource names, declared types."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom.functions.geometry import NANOS, whole_div


def format_duration(ns: Column) -> Column:
    """8072 s gives ``2h 14m 32s``; leading zero units are left out and fractions cut."""
    total = whole_div(ns, NANOS)
    hours, minutes, seconds = whole_div(total, 3600), whole_div(total % 3600, 60), total % 60
    tail = F.concat(seconds.cast("string"), F.lit("s"))
    middle = F.concat(minutes.cast("string"), F.lit("m "), tail)
    return (
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), middle))
        .when(minutes > 0, middle)
        .otherwise(tail)
    )


# Where a value lies exactly between two tenths, its double may lie above, below or on that middle. The
# printed digit follows the double, and the even digit when it is exact.
_MIDDLES = [Fraction(2 * digit + 1, 20) for digit in range(10)]
_MIDDLE = [float(m) for m in _MIDDLES]
_UP = [Fraction(float(m)) > m or (Fraction(float(m)) == m and digit % 2 == 1) for digit, m in enumerate(_MIDDLES)]


def _one_decimal(size: Column, unit: int) -> Column:
    """size / unit with one decimal, rounded like the double size / unit."""
    lower = whole_div(size, unit // 10)
    middle = size % (unit // 10) == unit // 20
    value = size / F.lit(float(unit))
    part, digit = value - F.floor(value), (lower % 10).cast("int")
    at = F.get(F.array(*[F.lit(m) for m in _MIDDLE]), digit)
    on_middle = F.get(F.array(*[F.lit(u) for u in _UP]), digit)
    up = F.when(middle, (part > at) | ((part == at) & on_middle)).otherwise(size % (unit // 10) > unit // 20)
    tenths = lower + up.cast("bigint")
    return F.concat(whole_div(tenths, 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def format_file_size(size: Column) -> Column:
    """Decimal units with one decimal; plain bytes below 1000."""
    return (
        F.when(size >= 1_000_000_000, F.concat(_one_decimal(size, 1_000_000_000), F.lit(" GB")))
        .when(size >= 1_000_000, F.concat(_one_decimal(size, 1_000_000), F.lit(" MB")))
        .when(size >= 1_000, F.concat(_one_decimal(size, 1_000), F.lit(" KB")))
        .otherwise(F.concat(size.cast("string"), F.lit(" B")))
    )


def format_timestamp_utc(ns: Column) -> Column:
    """ISO 8601 to the second. The session zone is UTC (see ``session.configure``)."""
    return F.date_format(F.timestamp_seconds(whole_div(ns, NANOS)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def sanitize_name(topic: Column) -> Column:
    return F.regexp_replace(F.translate(topic, "/", "_"), "^_", "")


def strip_leading_slashes(name: Column) -> Column:
    return F.ltrim(name, F.lit("/"))


def pack_resource(sequence: Column, topic: Column) -> Column:
    return F.concat(strip_leading_slashes(sequence), F.lit("/"), strip_leading_slashes(topic))


def topic_of_resource(resource: Column, sequence: Column) -> Column:
    """The part of a resource after its sequence, with a leading slash; unchanged without that prefix."""
    skip = F.length(sequence) + 2
    starts = F.startswith(resource, sequence) & (F.length(resource) > F.length(sequence))
    return F.when(starts, F.concat(F.lit("/"), F.substring(resource, skip, F.length(resource)))).otherwise(resource)


def short_name(type_name: Column) -> Column:
    return F.substring_index(type_name, "/", -1)


# Declared type text: base[inner]. Without a closing bracket the whole text is the base.
_ARRAY = r"^([^\[]*)\[([^\]]*)\]"


def array_base(type_text: Column) -> Column:
    return F.when(type_text.rlike(_ARRAY), F.regexp_extract(type_text, _ARRAY, 1)).otherwise(type_text)


def array_size(type_text: Column) -> Column:
    """0 for a scalar, N for T[N], -1 for T[]."""
    inner = F.regexp_extract(type_text, _ARRAY, 2)
    return (
        F.when(~type_text.rlike(_ARRAY), F.lit(0))
        .when(inner == "", F.lit(-1))
        .otherwise(F.regexp_extract(inner, r"^\s*([-+]?[0-9]+)", 1).try_cast("int"))
    )
