"""The typed time-series schemas: one projection per ontology tag.

A projection maps the fields of a message to the columns of its tag. It is a function
``fields -> {column: expression}`` over the accessors of ``functions.fields``, so the same definition
serves JSON bodies and struct-typed sources, in batch and in a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import schemas as S
from sensorloom.functions import geometry as G
from sensorloom.functions.fields import INT_RANGES, ColumnFields, LeafFields, leaf_name
from sensorloom.operators import infer
from sensorloom.operators.extract import Wants, extract, extract_variant, wants_of
from sensorloom.operators.flatten import flatten_structs

Columns = dict[str, Column]
Projection = Callable[[object], Columns]

KEYS = ["recording", "topic", "log_time_ns", "sequence", "payload"]


def _mixin(fields, cov_keys: tuple[str, ...] = ("covariance",)) -> Columns:
    return {
        "header": G.header(fields),
        "covariance": F.coalesce(*[G.covariance(fields, k) for k in cov_keys]),
        "covariance_type": G.null_of("smallint"),
    }


# ---------------------------------------------------------------- geometry

def _axes(prefix: str, names: str) -> Projection:
    def project(fields) -> Columns:
        pick = lambda n: G.by_prefix(fields, "x", [prefix, ""], lambda p: fields.num(p + n))
        return {n: pick(n) for n in names} | _mixin(fields)

    return project


def pose(fields) -> Columns:
    part = lambda build: G.by_prefix(fields, "position.x", ["pose.pose.", "pose.", ""], build)
    return {
        "position": part(lambda p: G.point3(fields, p + "position.")),
        "orientation": part(lambda p: G.quaternion(fields, p + "orientation.")),
    } | _mixin(fields, ("pose.covariance", "covariance"))


def _motion(outer: str) -> Projection:
    """Linear and angular part, plain or wrapped once or twice in ``outer``."""

    def project(fields) -> Columns:
        prefixes = [f"{outer}.{outer}.", f"{outer}.", ""]
        part = lambda name: G.by_prefix(
            fields, "linear.x", prefixes, lambda p: G.vector3(fields, f"{p}{name}.", nullable=True)
        )
        return {"linear": part("linear"), "angular": part("angular")} | _mixin(
            fields, (f"{outer}.covariance", "covariance")
        )

    return project


def transform(fields) -> Columns:
    part = lambda build: G.by_prefix(fields, "translation.x", ["transform.", ""], build)
    return {
        "translation": part(lambda p: G.vector3(fields, p + "translation.")),
        "rotation": part(lambda p: G.quaternion(fields, p + "rotation.")),
        "target_frame_id": fields.text("child_frame_id"),
    } | _mixin(fields)


def force_torque(fields) -> Columns:
    part = lambda name: G.by_prefix(fields, "force.x", ["wrench.", ""], lambda p: G.vector3(fields, f"{p}{name}."))
    return {"force": part("force"), "torque": part("torque")} | _mixin(fields)


def motion_state(fields) -> Columns:
    posed = lambda build: G.by_prefix(fields, "position.x", ["pose.pose.", "pose."], build)
    moved = lambda name: G.by_prefix(
        fields, "linear.x", ["twist.twist.", "twist."], lambda p: G.vector3(fields, f"{p}{name}.", nullable=True)
    )
    inner = lambda key: [
        G.null_of(S.HEADER).alias("header"),
        G.covariance(fields, key).alias("covariance"),
        G.null_of("smallint").alias("covariance_type"),
    ]
    return {
        "pose": F.struct(
            posed(lambda p: G.point3(fields, p + "position.")).alias("position"),
            posed(lambda p: G.quaternion(fields, p + "orientation.")).alias("orientation"),
            *inner("pose.covariance"),
        ).cast(S.POSE),
        "velocity": F.struct(
            moved("linear").alias("linear"), moved("angular").alias("angular"), *inner("twist.covariance")
        ).cast(S.VELOCITY),
        "target_frame_id": F.coalesce(fields.text("child_frame_id"), F.lit("")),
        "acceleration": G.null_of(S.ACCEL),
    } | _mixin(fields)


# ---------------------------------------------------------------- sensors

def imu(fields) -> Columns:
    cov = fields.nums("orientation_covariance")
    known = (F.size(cov) > 0) & (F.get(cov, F.lit(0)) != -1.0)
    given = fields.has("orientation.x") | fields.has("orientation.w")
    return {
        "acceleration": G.vector3(fields, "linear_acceleration.", "linear_acceleration_covariance"),
        "angular_velocity": G.vector3(fields, "angular_velocity.", "angular_velocity_covariance"),
        "orientation": F.when(known & given, G.quaternion(fields, "orientation.", "orientation_covariance")),
        "header": G.header(fields),
    }


def _gps_status(fields, prefix: str) -> Columns:
    return {
        "status": fields.integer(prefix + "status", "int8"),
        "service": fields.integer(prefix + "service", "uint16"),
        "satellites": G.null_of("tinyint"),
        "hdop": G.null_of("double"),
        "vdop": G.null_of("double"),
    }


def gps(fields) -> Columns:
    position = F.struct(
        fields.num("latitude").alias("x"),
        fields.num("longitude").alias("y"),
        fields.num("altitude").alias("z"),
        G.null_of(S.HEADER).alias("header"),
        G.covariance(fields, "position_covariance").alias("covariance"),
        G.covariance_type(fields, "position_covariance_type").alias("covariance_type"),
    ).cast(S.POINT3)
    status = F.struct(
        *[c.alias(n) for n, c in _gps_status(fields, "status.").items()], G.null_of(S.HEADER).alias("header")
    ).cast(S.GPS_STATUS)
    return {
        "position": position,
        "velocity": G.null_of(S.VEC3),
        "status": F.when(fields.has("status.status") | fields.has("status.service"), status),
        "header": G.header(fields),
    }


def gps_status(fields) -> Columns:
    return _gps_status(fields, "") | {"header": G.header(fields)}


def _bytes(fields) -> Column:
    return F.coalesce(fields.octets("data"), F.lit("").cast("binary"))


def _truth(fields, path: str) -> Column:
    """A boolean, or an integer that is not zero."""
    return F.coalesce(fields.flag(path), fields.integer(path, "int64") != 0)


def image(fields) -> Columns:
    whole = lambda path: F.coalesce(fields.integer(path, "int32"), F.lit(0)).cast("int")
    return {
        "data": _bytes(fields),
        "format": F.coalesce(fields.text("format"), F.lit("raw")),
        "width": whole("width"),
        "height": whole("height"),
        "stride": whole("step"),
        "encoding": F.coalesce(fields.text("encoding"), F.lit("")),
        "is_bigendian": _truth(fields, "is_bigendian"),
        "header": G.header(fields),
    }


def compressed_image(fields) -> Columns:
    return {
        "data": _bytes(fields),
        "format": F.coalesce(fields.text("format"), F.lit("")),
        "header": G.header(fields),
    }


def _extent(fields, path: str) -> Column:
    return F.coalesce(fields.integer(path, "uint32"), F.lit(0)).cast("bigint")


def _roi(fields, prefix: str) -> Columns:
    at = lambda path: F.coalesce(fields.num(prefix + path), F.lit(0.0))
    return {
        "offset": F.struct(at("x_offset").alias("x"), at("y_offset").alias("y")).cast(S.VEC2),
        "height": _extent(fields, prefix + "height"),
        "width": _extent(fields, prefix + "width"),
        "do_rectify": fields.flag(prefix + "do_rectify"),
    }


def roi(fields) -> Columns:
    return _roi(fields, "") | {"header": G.header(fields)}


def camera_info(fields) -> Columns:
    given = lambda name: F.coalesce(fields.nums(name), fields.nums(name.upper()))

    def matrix(name: str, size: int) -> Column:
        values = given(name)
        return F.when(F.size(values) == size, values).otherwise(F.array_repeat(F.lit(0.0), size))

    bin_x, bin_y = fields.num("binning_x"), fields.num("binning_y")
    region = F.struct(
        *[c.alias(n) for n, c in _roi(fields, "roi.").items()], G.null_of(S.HEADER).alias("header")
    ).cast(S.ROI)
    return {
        "height": _extent(fields, "height"),
        "width": _extent(fields, "width"),
        "distortion_model": F.coalesce(fields.text("distortion_model"), F.lit("")),
        "distortion_parameters": F.coalesce(given("d"), F.array().cast("array<double>")),
        "intrinsic_parameters": matrix("k", 9),
        "rectification_parameters": matrix("r", 9),
        "projection_parameters": matrix("p", 12),
        "binning": F.when(
            bin_x.isNotNull() | bin_y.isNotNull(), F.struct(bin_x.alias("x"), bin_y.alias("y")).cast(S.VEC2)
        ),
        "roi": F.when(fields.has("roi.x_offset") | fields.has("roi.height"), region),
        "header": G.header(fields),
    }


# Field names of a battery message, in output order.
_BATTERY_FLOATS = ("voltage", "temperature", "current", "charge", "capacity", "design_capacity", "percentage")
_BATTERY_CODES = ("power_supply_status", "power_supply_health", "power_supply_technology")


def battery_state(fields) -> Columns:
    def cells(name: str) -> Column:
        values = fields.nums(name)
        return F.when(F.size(values) > 0, values.cast("array<float>"))

    floats = {n: F.coalesce(fields.num32(n), F.lit(0).cast("float")) for n in _BATTERY_FLOATS}
    codes = {n: F.coalesce(fields.integer(n, "uint8"), F.lit(0)).cast("smallint") for n in _BATTERY_CODES}
    return (
        floats
        | codes
        | {
            "present": F.coalesce(fields.flag("present"), F.lit(False)),
            "location": F.coalesce(fields.text("location"), F.lit("")),
            "serial_number": F.coalesce(fields.text("serial_number"), F.lit("")),
            "cell_voltage": cells("cell_voltage"),
            "cell_temperature": cells("cell_temperature"),
            "header": G.header(fields),
        }
    )


def robot_joint(fields) -> Columns:
    numbers = lambda name: F.coalesce(fields.nums(name), F.array().cast("array<double>"))
    return {
        "names": F.coalesce(fields.texts("name"), F.array().cast("array<string>")),
        "positions": numbers("position"),
        "velocities": numbers("velocity"),
        "efforts": numbers("effort"),
        "header": G.header(fields),
    }


def nmea_sentence(fields) -> Columns:
    return {"sentence": F.coalesce(fields.text("sentence"), F.lit("")), "header": G.header(fields)}


# ---------------------------------------------------------------- scalars

def _scalar(read, default: str) -> Projection:
    return lambda fields: {"data": F.coalesce(read(fields), F.expr(default)), "header": G.header(fields)}


def _whole(kind: str) -> Projection:
    def project(fields) -> Columns:
        fields.checks.append((F.coalesce(fields.out_of_range("data", kind), F.lit(False)), "out_of_range"))
        value = F.coalesce(fields.integer("data", kind), F.lit(0).cast(INT_RANGES[kind][2]))
        return {"data": value, "header": G.header(fields)}

    return project


# Tag of each integer width.
_INTEGER_TAGS = {
    "integer8": "int8",
    "integer16": "int16",
    "integer32": "int32",
    "integer64": "int64",
    "unsigned8": "uint8",
    "unsigned16": "uint16",
    "unsigned32": "uint32",
    "unsigned64": "uint64",
}


class Registry:
    """Projections by tag. ``add`` replaces an earlier one.

    A projection may give one row per element of a list field, whose name is kept with it.
    """

    def __init__(self, projections: dict[str, Projection] | None = None, elements: dict[str, str] | None = None):
        self._projections = dict(projections or {})
        self._elements = dict(elements or {})

    def add(self, tag: str, projection: Projection, elements: str | None = None) -> "Registry":
        self._projections[tag] = projection
        self._elements.pop(tag, None)
        if elements is not None:
            self._elements[tag] = elements
        return self

    def elements(self, tag: str) -> str | None:
        """The list field that is opened for this tag, if any."""
        return self._elements.get(tag)

    def find(self, tag: str) -> Projection | None:
        return self._projections.get(tag)

    def tags(self) -> list[str]:
        return sorted(self._projections)


_PROJECTIONS: dict[str, Projection] = {
    "vector3d": _axes("vector.", "xyz"),
    "point3d": _axes("point.", "xyz"),
    "quaternion": _axes("quaternion.", "xyzw"),
    "pose": pose,
    "velocity": _motion("twist"),
    "acceleration": _motion("accel"),
    "transform": transform,
    "force_torque": force_torque,
    "imu": imu,
    "gps": gps,
    "gps_status": gps_status,
    "motion_state": motion_state,
    "frame_transform": transform,
    "image": image,
    "compressed_image": compressed_image,
    "camera_info": camera_info,
    "battery_state": battery_state,
    "robot_joint": robot_joint,
    "nmea_sentence": nmea_sentence,
    "roi": roi,
    "string": _scalar(lambda f: f.text("data"), "''"),
    "boolean": _scalar(lambda f: f.flag("data"), "false"),
    **{tag: _whole(kind) for tag, kind in _INTEGER_TAGS.items()},
    "floating32": _scalar(lambda f: f.num32("data"), "float(0)"),
    "floating64": _scalar(lambda f: f.num("data"), "double(0)"),
}


# Tags with a row per element of a list field.
_ELEMENTS = {"frame_transform": "transforms"}


def default_registry() -> Registry:
    """A registry of its own holding every tag but ``raw``, whose columns follow the data."""
    return Registry(_PROJECTIONS, _ELEMENTS)


# ---------------------------------------------------------------- applying a projection

def _reason(fields, earlier: Column | None) -> Column:
    checks = [F.when(cond, F.lit(reason)) for cond, reason in fields.checks]
    parts = ([earlier] if earlier is not None else []) + checks
    return F.coalesce(*parts) if parts else F.lit(None).cast("string")


def _finish(df: DataFrame, times: Columns, columns: Columns, reason: Column, keep: list[str]) -> DataFrame:
    kept = [F.col(c) for c in keep if c in df.columns]
    typed = [c.alias(n) for n, c in {**times, **columns}.items()]
    return df.select(*kept, *typed, reason.alias("reject_reason"))


def _times(fields) -> Columns:
    return {"timestamp_ns": G.event_time(fields), "recording_timestamp_ns": G.ingest_time(fields)}


@lru_cache(maxsize=256)
def _typed(projection: Projection) -> tuple[Columns, Columns, Column]:
    """Times, columns and reject reason over extracted leaves: made once for a projection, as a stream asks for each batch."""
    fields = LeafFields(F.col("log_time_ns"))
    times, columns = _times(fields), projection(fields)
    return times, columns, _reason(fields, F.col("reject_reason"))


@lru_cache(maxsize=256)
def _typed_elements(projection: Projection) -> tuple[Columns, Columns, Column]:
    """The same over the leaves of an element of a list."""
    own = LeafFields(owner="_leaves")
    times, columns = _times(own), projection(own)
    return times, columns, _reason(own, None)


def _find(registry: Registry | None, tag: str) -> Projection:
    projection = (registry or default_registry()).find(tag)
    if projection is None:
        raise KeyError(f"no projection for tag {tag!r}")
    return projection


def project_json(messages: DataFrame, tag: str, registry: Registry | None = None, keep: list[str] | None = None) -> DataFrame:
    """Typed rows of one tag from JSON messages; ``reject_reason`` marks the bad ones."""
    keep = KEYS if keep is None else keep
    registry = registry or default_registry()
    if tag == "raw" and registry.find(tag) is None:
        return infer.raw_projection(messages)
    projection = _find(registry, tag)
    wants = wants_of(_times) | wants_of(projection)
    wants = {p: wants_of(_times).get(p, set()) | wants_of(projection).get(p, set()) for p in wants}
    if registry.elements(tag):
        return _project_elements(messages, projection, wants, keep, registry.elements(tag))
    return _finish(extract(messages, wants), *_typed(projection), keep)


def _project_elements(messages: DataFrame, projection: Projection, wants: Wants, keep: list[str], elements: str) -> DataFrame:
    """One row per element of a list field; a message without elements is one row itself."""
    path = tuple(elements.split("."))
    leaves = extract(messages, {path: {"items"}} | wants)
    items = F.col(f"`{leaf_name('items', path)}`")
    opened = leaves.select("*", F.explode_outer(F.when(F.size(items) > 0, items)).alias("_element"))
    opened = extract_variant(opened, "_element", wants, "_leaves")
    own_times, own_columns, own_checks = _typed_elements(projection)
    times, columns, message_reason = _typed(projection)
    split = F.col("_element").isNotNull()
    zero = F.lit(0).cast("bigint")
    merged_times = {n: F.when(split, F.coalesce(F.nullif(own_times[n], zero), times[n])).otherwise(times[n]) for n in times}
    merged = {n: F.when(split, own_columns[n]).otherwise(columns[n]) for n in columns}
    own_reason = F.when(split, F.coalesce(F.when(F.col("_leaves_mixed"), "mixed_array"), own_checks))
    return _finish(opened, merged_times, merged, F.coalesce(message_reason, own_reason), keep)


def project_flat(flat: DataFrame, tag: str, registry: Registry | None = None, keep: list[str] | None = None) -> DataFrame:
    """Typed rows of one tag from flattened struct columns (see ``flatten_structs``)."""
    keep = KEYS if keep is None else keep
    registry = registry or default_registry()
    if tag == "raw" and registry.find(tag) is None:
        names = sorted(c for c in flat.columns if c != "log_time_ns")
        named = [F.col(f"`{n}`") for n in names]
        return flat.select(F.col("log_time_ns").alias("_log_time_ns"), *named) if "log_time_ns" in flat.columns else flat.select(*named)
    projection = _find(registry, tag)
    if registry.elements(tag) in flat.columns:
        return _project_flat_elements(flat, projection, keep, registry.elements(tag))
    fields = ColumnFields.of(flat)
    columns = projection(fields)
    return _finish(flat, _times(fields), columns, _reason(fields, _earlier(flat)), keep)


def _earlier(df: DataFrame) -> Column | None:
    return F.col("reject_reason") if "reject_reason" in df.columns else None


def _project_flat_elements(flat: DataFrame, projection: Projection, keep: list[str], elements: str) -> DataFrame:
    base = ColumnFields.of(flat)
    own = projection(base)
    opened = flat.select("*", F.explode_outer(F.col(f"`{elements}`")).alias("element"))
    element_type = opened.schema["element"].dataType
    paths = flatten_structs(opened.select("element"), keep_shape=True).schema.fields
    inner = ColumnFields(
        {
            f.name.removeprefix("element."): (_descend(F.col("element"), f.name, element_type), f.dataType)
            for f in paths
        }
    )
    part = projection(inner)
    is_element = F.col("element").isNotNull()
    columns = {n: F.when(is_element, part[n]).otherwise(own[n]) for n in own}
    zero = F.lit(0).cast("bigint")
    times = {
        n: F.coalesce(F.nullif(F.when(is_element, v), zero), _times(base)[n]) for n, v in _times(inner).items()
    }
    checked = F.coalesce(_reason(base, _earlier(flat)), F.when(is_element, _reason(inner, None)))
    return _finish(opened, times, columns, checked, keep)


def _descend(column: Column, name: str, data_type: T.DataType) -> Column:
    """Field of a struct whose own field names may hold dots (flattened elements) or be nested."""
    rest = name.removeprefix("element.")
    if rest in data_type.fieldNames():
        return column.getField(rest)
    return reduce(lambda c, part: c.getField(part), rest.split("."), column)
