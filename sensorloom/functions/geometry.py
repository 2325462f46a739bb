"""Times, headers, covariances and the geometric structs built from message fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom import schemas as S

NANOS = 1_000_000_000


def null_of(ddl: str) -> Column:
    return F.expr(f"CAST(NULL AS {ddl})")


# ---------------------------------------------------------------- times and header

def event_time(fields) -> Column:
    """Header stamp in ns when both parts exist, else log time, else 0.

    A stamp beyond bigint in ns (seconds given in ms or ns) marks its row ``out_of_range``.
    """
    sec = fields.integer("header.stamp.sec", "int64")
    nanosec = fields.integer("header.stamp.nanosec", "int64")
    stamp = F.try_add(F.try_multiply(sec, F.lit(NANOS)), nanosec)
    fields.checks.append((sec.isNotNull() & nanosec.isNotNull() & stamp.isNull(), "out_of_range"))
    return F.coalesce(stamp, fields.log_time, F.lit(0).cast("bigint"))


def ingest_time(fields) -> Column:
    return F.coalesce(fields.log_time, F.lit(0).cast("bigint"))


def header(fields, prefix: str = "header.") -> Column:
    """The header of a message; without one, a header stamped with the log time."""
    frame, sec, nanosec = (prefix + p for p in ("frame_id", "stamp.sec", "stamp.nanosec"))
    sec_value, nanosec_value = fields.integer(sec, "int64"), fields.integer(nanosec, "int64")
    stamp = F.when(
        sec_value.isNotNull() | nanosec_value.isNotNull(),
        F.struct(sec_value.alias("sec"), nanosec_value.alias("nanosec")),
    )
    own = F.struct(
        fields.integer(prefix + "seq", "int64").alias("seq"),
        stamp.alias("stamp"),
        fields.text(frame).alias("frame_id"),
    )
    log_sec = whole_div(fields.log_time, NANOS)
    logged = F.struct(
        null_of("bigint").alias("seq"),
        F.struct(log_sec.alias("sec"), (fields.log_time % F.lit(NANOS)).alias("nanosec")).alias("stamp"),
        null_of("string").alias("frame_id"),
    )
    return (
        F.when(fields.has(frame) | fields.has(sec) | fields.has(nanosec), own)
        .when(fields.log_time.isNotNull(), logged)
        .cast(S.HEADER)
    )


def whole_div(value: Column, by: int) -> Column:
    """Integer division that never leaves bigint."""
    return F.call_function("div", value, F.lit(by))


# ---------------------------------------------------------------- covariance

def valid_covariance(values: Column) -> Column:
    """Not empty, not marked unknown by a leading -1, and not all zero."""
    return F.coalesce(
        (F.size(values) > 0)
        & (F.get(values, F.lit(0)) != -1.0)
        & ((F.array_min(values) != 0.0) | (F.array_max(values) != 0.0)),
        F.lit(False),
    )


def covariance(fields, key: str | None) -> Column:
    if key is None:
        return null_of("array<double>")
    values = fields.nums(key)
    return F.when(valid_covariance(values), values)


def covariance_type(fields, key: str | None) -> Column:
    if key is None:
        return null_of("smallint")
    return fields.integer(key, "int16").cast("smallint")


# ---------------------------------------------------------------- prefixes

def by_prefix(fields, leaf: str, prefixes: list[str], build) -> Column:
    """``build(prefix)`` for the first prefix under which ``leaf`` exists, else for the last one."""
    *firsts, last = prefixes
    return reduce(
        lambda rest, p: F.when(fields.has(p + leaf), build(p)).otherwise(rest),
        reversed(firsts),
        build(last),
    )


# ---------------------------------------------------------------- structs

def _axes(fields, prefix: str, names: str, cov: Column, cov_type: Column, ddl: str, nullable: bool):
    parts = [fields.num(prefix + n) for n in names]
    built = F.struct(
        *[p.alias(n) for p, n in zip(parts, names)],
        null_of(S.HEADER).alias("header"),
        cov.alias("covariance"),
        cov_type.alias("covariance_type"),
    ).cast(ddl)
    if not nullable:
        return built
    return F.when(reduce(lambda a, b: a | b, [p.isNotNull() for p in parts]), built)


def vector3(fields, prefix: str, cov_key: str | None = None, nullable: bool = False) -> Column:
    return _axes(fields, prefix, "xyz", covariance(fields, cov_key), null_of("smallint"), S.VEC3, nullable)


def quaternion(fields, prefix: str, cov_key: str | None = None, nullable: bool = False) -> Column:
    return _axes(fields, prefix, "xyzw", covariance(fields, cov_key), null_of("smallint"), S.QUAT, nullable)


def point3(
    fields, prefix: str, cov_key: str | None = None, cov_type_key: str | None = None, nullable: bool = False
) -> Column:
    return _axes(
        fields, prefix, "xyz", covariance(fields, cov_key), covariance_type(fields, cov_type_key), S.POINT3, nullable
    )
