"""Payload decoding and the separation of bad rows.

A decoder is ``DataFrame -> DataFrame``: it adds the decoded column and ``reject_reason`` (null for a
good row). Nothing is filtered on the way, so one pass over the messages serves good rows and rejects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Decoder = Callable[[DataFrame], DataFrame]

REJECTS = ["recording", "topic", "log_time_ns", "reason", "payload"]

# String literals are cut out before integer literals are looked for.
_STRING_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_FLAT_ARRAY = r"\[[^\[\]{}]*\]"
# integers above 2^63-1 (19 digits from 92... on, or more), and large exponents; times in ns are below
BIG_NUMBER = "9[2-9][0-9]{17}|[0-9]{20}|[eE][+]?[0-9]{3}"
END_MARK = "end-of-payload-7d1f0c52"
_HUGE_NUMBER = r"[0-9]{309,}|-?[0-9]+(?:\.[0-9]+)?[eE]\+?[0-9]{3,}"
_ANY_INTEGER = r"(?<![0-9.eE+\-])-?[0-9]{19,38}(?![0-9.eE])"
_BIG_INTEGER = r"(?<![0-9.eE+\-])[0-9]{19,20}(?![0-9.eE])"


# Integers that fit 64 bits without a sign only.
_LEAST_UNSIGNED, _GREATEST_UNSIGNED = "9223372036854775808", "18446744073709551615"


def unsigned_only(value: Column) -> Column:
    """Whether a number lies in (2^63-1, 2^64-1]."""
    return value.between(F.lit(_LEAST_UNSIGNED).cast("decimal(20,0)"), F.lit(_GREATEST_UNSIGNED).cast("decimal(20,0)"))


def big_integers(text: Column) -> Column:
    """The integer literals of 19 to 38 digits in a JSON text, as they stand there."""
    return F.regexp_extract_all(F.regexp_replace(text, _STRING_LITERAL, '""'), F.lit(_ANY_INTEGER), F.lit(0))


def _int_overflow(text: Column, read: Column) -> Column:
    """A scalar integer in (2^63-1, 2^64-1], which fits neither bigint nor the real-number rule, beyond the ``read`` ones."""
    bare = F.regexp_replace(F.regexp_replace(text, _STRING_LITERAL, '""'), _FLAT_ARRAY, "[]")
    found = F.regexp_extract_all(bare, F.lit(_BIG_INTEGER), F.lit(0))
    big = F.size(F.filter(found, lambda t: unsigned_only(t.cast("decimal(20,0)")))) > read
    return F.when(text.rlike(BIG_NUMBER), big).otherwise(F.lit(False))


def json_text(payload: Column) -> Column:
    return F.try_validate_utf8(payload.cast("string"))


def wrapped_body(text: Column) -> Column:
    """The JSON value of a text as a variant, null unless the whole text is one value.

    ``try_parse_json`` stops after the first value and ignores what follows. The text is therefore
    parsed as the first element of an array that ends with a mark: anything after the value breaks the
    array or moves the mark.
    """
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]')))
    ends = F.try_variant_get(array, "$[1]", "string") == END_MARK
    return F.when(ends, F.try_variant_get(array, "$[0]", "variant"))


def json_reason(body: Column, text: Column, unsigned: Column | None = None) -> Column:
    """Why a JSON message is bad; null for a good one. ``unsigned``: how many integers beyond bigint are read as such."""
    return (
        F.when(body.isNull() | _too_large(text), "parse_error")
        .when(~text.rlike(r"^\s*\{"), "not_object")
        .when(_int_overflow(text, F.lit(0) if unsigned is None else unsigned), "int_overflow")
    )


def _too_large(text: Column) -> Column:
    """A number beyond the range of a double."""
    found = F.regexp_extract_all(F.regexp_replace(text, _STRING_LITERAL, '""'), F.lit(_HUGE_NUMBER), F.lit(0))
    infinite = F.exists(found, lambda t: F.abs(t.cast("double")) == float("inf"))
    return F.when(text.rlike(BIG_NUMBER), infinite).otherwise(F.lit(False))


def decode_json(messages: DataFrame) -> DataFrame:
    """Parse the whole payload into the variant column ``body``.

    Where the wanted fields are known, ``operators.extract`` is the faster way.
    """
    text = json_text(F.col("payload"))
    # The generator keeps later filters on the result from repeating the parse below it.
    parsed = messages.select("*", F.inline(F.array(F.struct(text.alias("_text"), wrapped_body(text).alias("body")))))
    return parsed.withColumn("reject_reason", json_reason(F.col("body"), F.col("_text"))).drop("_text")


def decode_passthrough(messages: DataFrame) -> DataFrame:
    """Hand the payload on unread as ``data``."""
    return messages.withColumn("data", F.col("payload")).withColumn("reject_reason", F.lit(None).cast("string"))


def reject_all(messages: DataFrame) -> DataFrame:
    return messages.withColumn("reject_reason", F.lit("unsupported_encoding"))


# Encodings with a decoder for binary payloads. Struct-typed sources (what wire
# formats decode to) go through ``flatten_structs`` instead.
DECODERS: dict[str, Decoder] = {
    "json": decode_json,
    "flatbuffer": decode_passthrough,
    "cbor": decode_passthrough,
}


def decoder_for(encoding: str, extra: dict[str, Decoder] | None = None) -> Decoder:
    return {**DECODERS, **(extra or {})}.get(encoding, reject_all)


def encoding_support(channels: DataFrame, extra: dict[str, Decoder] | None = None) -> DataFrame:
    """Channels with ``supported`` and, for the others, the reject reason."""
    known = sorted({*DECODERS, *(extra or {})})
    supported = F.col("encoding").isin(known)
    return channels.withColumn("supported", F.coalesce(supported, F.lit(False))).withColumn(
        "reject_reason", F.when(~F.col("supported"), "unsupported_encoding")
    )


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(decoded: DataFrame) -> DataFrame:
    """Bad rows with their reason and untouched payload."""
    return decoded.where(F.col("reject_reason").isNotNull()).select(
        "recording", "topic", "log_time_ns", F.col("reject_reason").alias("reason"), "payload"
    )


def sample_first(messages: DataFrame, rows: int = 100) -> DataFrame:
    """The first messages of one topic by log time."""
    return messages.orderBy("log_time_ns", "sequence").limit(rows)


def decoded_scan(messages: DataFrame, topic: str, encoding: str = "json", extra=None) -> DataFrame:
    """Decode one topic; ``_log_time_ns`` carries the log time next to the decoded columns."""
    scan = messages.where(F.col("topic") == topic)
    return decoder_for(encoding, extra)(scan).withColumn("_log_time_ns", F.col("log_time_ns"))
