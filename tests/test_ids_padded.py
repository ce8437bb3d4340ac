from __future__ import annotations

from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.ids import format_id


def test_padded_ids_are_the_formatted_ones(spark):
    """Zero, short, full and longer numbers, numbers below 0 and null."""
    numbers = [0, 7, 99_999, 12_345_678, 9_999_999_999, 2**63 - 1, -1, -123_456_789_012, None]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long")
    for prefix, width in rules.ID_FORMATS.items():
        wanted = F.format_string(f"{prefix}%0{width}d", "n")
        found = rows.select("n", format_id(prefix, F.col("n")).alias("found"), wanted.alias("wanted"))
        for row in found.collect():
            assert row.found == row.wanted, (prefix, row.n)
