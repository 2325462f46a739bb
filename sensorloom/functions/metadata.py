"""JSON metadata of endpoints, topics and sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom.functions.fields import is_text

# Fixed value: keys starting with this prefix are internal and never shown.
INTERNAL_PREFIX = "ros:"


def endpoint_range(text: Column) -> Column:
    """struct<min,max> from {"timestamp": {"min": .., "max": ..}}; null unless both are there."""
    stamp = F.from_json(text, "timestamp struct<min:bigint,max:bigint>")["timestamp"]
    return F.when(stamp["min"].isNotNull() & stamp["max"].isNotNull(), stamp)


def ontology_tag(properties: Column) -> Column:
    leaf = F.try_variant_get(F.try_parse_json(properties), "$.ontology_tag", "variant")
    return F.when(is_text(leaf), F.try_variant_get(leaf, "$", "string"))


def drop_internal_keys(metadata: Column) -> Column:
    return F.map_filter(metadata, lambda k, v: ~k.startswith(INTERNAL_PREFIX))


def user_metadata(text: Column) -> Column:
    """Object as map<string,string>; values that are not strings stay JSON text; anything else gives {}."""
    is_object = F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{")
    parsed = F.when(is_object, F.from_json(text, "map<string,string>"))
    named = F.transform_values(parsed, lambda k, v: F.coalesce(v, F.lit("null")))
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(drop_internal_keys(named), empty)


def properties(tag: Column, user: dict[str, str] | None = None) -> Column:
    """The metadata text of a topic: its tag and what the user added."""
    added = [F.lit(text).alias(key) for key, text in sorted((user or {}).items()) if key != "ontology_tag"]
    return F.to_json(F.struct(tag.alias("ontology_tag"), *added))


def unwrap_response(body: Column) -> Column:
    """The ``response`` part of a reply, or the reply itself when it has none."""
    return F.coalesce(F.try_variant_get(body, "$.response", "variant"), body)
