"""Decoding of intake bodies, headers and measurement texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilcount.functions.once import once

_LARGEST_UNSIGNED = "18446744073709551615"


def trimmed_utf8(body: Column) -> Column:
    """The body as text without outer white space (any Unicode white space), NULL if it is not UTF-8."""
    text = F.try_validate_utf8(body.cast("string"))
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def base64_text(data: Column) -> Column:
    """Standard base64 on one line, whatever the session's line-break setting is."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def strict_base64(text: Column) -> Column:
    """Standard base64 with full padding, no line breaks and zero trailing bits; NULL for anything else.

    ``try_to_binary`` accepts more than that, so its result must encode back to the same text.
    """
    decoded = F.try_to_binary(text, F.lit("base64"))
    return once(F.struct(text.alias("t"), decoded.alias("d")), lambda c: F.when(base64_text(c["d"]) == c["t"], c["d"]))


def unsigned_header(text: Column) -> Column:
    """An unsigned 64-bit header value, NULL when it is missing or does not parse."""
    number = F.when(text.rlike(r"^[+]?[0-9]+\z"), text).try_cast("decimal(38,0)")
    return F.when(number <= F.lit(_LARGEST_UNSIGNED).cast("decimal(38,0)"), number)


def little_endian_u32(value: Column) -> Column:
    """Four little-endian bytes as a number; any other length, or none at all, counts as 0."""
    digits = F.hex(value)
    big_endian = F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)])
    number = F.conv(big_endian, 16, 10).cast("bigint")
    return F.when(F.length(value) == 4, number).otherwise(F.lit(0).cast("bigint"))


def headers_named(headers: Column, name: str) -> Column:
    """The record headers with this key, in order."""
    return F.filter(F.coalesce(headers, F.array()), lambda h: h["key"] == F.lit(name))


def split_measurement(text: Column) -> Column:
    """struct(name, value) of a ``name|value`` text, NULL unless it has exactly two parts.

    NUL characters around the value are padding and are removed.
    """

    def pair(parts: Column) -> Column:
        value = F.btrim(F.get(parts, F.lit(1)), F.char(F.lit(0)))
        return F.when(F.size(parts) == 2, F.struct(F.get(parts, F.lit(0)).alias("name"), value.alias("value")))

    return once(F.split(text, "[|]", -1), pair)
