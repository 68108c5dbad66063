"""Text work on names, numbers and property values."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_PATTERN = (
    r"(?i)^\s*https?:[/\\]*([^/\\?#\s@]*@)?"
    r"(\[[0-9a-f:.]+\]|[^/\\?#\s@:<>\[\]^|%]+)(:[0-9]*)?([/\\?#].*)?$"
)


def json_text(text: Column, key: str) -> Column:
    """The first text value stored under ``key`` anywhere in a JSON text, else empty.

    Numbers, booleans and null are not text values and count as a miss.
    """
    pattern = f'"{re.escape(key)}"\\s*:\\s*"([^"]*)"'
    return F.coalesce(F.regexp_extract(text, pattern, 1), F.lit(""))


def title_case(text: Column) -> Column:
    """``snake_case`` to ``Snake Case``; letters after the first stay as they are."""
    words = F.transform(
        F.split(text, "_"),
        lambda word: F.concat(F.upper(F.left(word, F.lit(1))), F.substr(word, F.lit(2))),
    )
    return F.array_join(words, " ")


def is_url(text: Column) -> Column:
    """Whether a text is an http or https address."""
    return F.coalesce(text.rlike(URL_PATTERN), F.lit(False))


def fixed3(number: Column) -> Column:
    """Three decimals of a double below 256, rounded by its exact binary value, ties up.

    The value is taken as a whole number of 2**-80, so no digit is lost before rounding.
    """
    def whole(value: Column) -> Column:
        return F.floor(value).cast("decimal(38,0)")

    scaled = F.abs(number) * float(2**20)
    high = whole(scaled)
    low = whole((scaled - F.floor(scaled)) * float(2**60))
    fine = high * F.lit(Decimal(2**60)) + low
    thousandths = F.call_function("div", fine * 2000 + F.lit(Decimal(2**80)), F.lit(Decimal(2**81)))
    sign = F.when(number < 0, "-").otherwise("")
    return F.concat(
        sign, F.floor(thousandths / 1000).cast("string"), F.lit("."),
        F.lpad((thousandths % 1000).cast("string"), 3, "0"))


def number_text(number: Column) -> Column:
    """A double written plainly: ``34`` rather than ``34.0``, never with an exponent."""
    text = number.cast("string")
    scale = F.when(F.abs(number) < 1, text.try_cast("decimal(38,37)").cast("string")).otherwise(
        text.try_cast("decimal(38,10)").cast("string"))
    plain = F.when(text.contains("E"), F.coalesce(scale, text)).otherwise(text)
    return F.when(plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)


def blank_as_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
