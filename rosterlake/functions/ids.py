"""Formatting and reading of ids, and draws keyed by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake import rules


def format_id(prefix: str, number: Column) -> Column:
    """Prefix and zero-padded number; longer numbers keep all their digits.

    Padding is several times faster than a format, which is left for numbers below 0 and null."""
    number, width = number.cast("long"), rules.ID_FORMATS[prefix]
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    formatted = F.format_string(f"{prefix}%0{width}d", number)
    return F.when(number >= 0, F.concat(F.lit(prefix), padded)).otherwise(formatted)


def id_number(df: DataFrame, name: str) -> Column:
    """The running number of an id: a number as it is, the closing digits of a text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        digits = F.regexp_extract(F.col(name), r"(\d+)$", 1)
        return digits.try_cast("long")
    return F.col(name).cast("long")


def draw(seed: int, row_id: Column) -> Column:
    """A number from 0 to 2^32 - 1 that depends on the seed and the id only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
