"""Text cleaning and typing.

`strict=False` turns a malformed value into null (count them with `quality.rejected_values`);
`strict=True` lets the ANSI cast raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(value: Column, dtype: T.DataType, strict: bool = False) -> Column:
    """Cast to a declared type; a whole number written as `3.0` is still a number when lenient."""
    if strict:
        return value.cast(dtype)
    if isinstance(dtype, T.IntegerType):
        # A double holds every 32-bit integer; 3.7 is none.
        value = value.try_cast("double")
        value = F.when(value == F.floor(value), value)
    return value.try_cast(dtype)


def clean_number(
    value: Column,
    dtype: T.DataType,
    decimal_comma: bool = False,
    decimals: int | None = None,
    strict: bool = False,
) -> Column:
    """Drop every underscore, read a decimal comma as a point if asked, and empty as null."""
    text = F.translate(value, ",_", ".") if decimal_comma else F.translate(value, "_", "")
    # An empty text is no number for `try_cast`; only the strict cast has to be spared it.
    number = typed(F.nullif(text, F.lit("")) if strict else text, dtype, strict)
    return number if decimals is None else F.round(number, decimals)


def clean_age(value: Column, strict: bool = False) -> Column:
    """Keep digits and minus signs only, so `41_` is 41 and `-500` stays out of range."""
    return typed(F.regexp_replace(value.cast("string"), "[^0-9-]", ""), T.IntegerType(), strict)


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def extract_number(value: Column) -> Column:
    """Keep digits, points and minus signs; what is then no number becomes null."""
    return F.regexp_replace(value.cast("string"), r"[^0-9.\-]", "").try_cast("double")


def coerce_number(value: Column) -> Column:
    """The text as a number if it is one, else null; NaN counts as missing."""
    return F.nullif(value.try_cast("double"), F.lit(float("nan")))


def parse_date(value: Column, pattern: str, strict: bool = False) -> Column:
    return F.to_date(value, pattern) if strict else F.try_to_date(value, pattern)
