"""Running numbers, and the row before, in one total order over all rows.

The rows are dealt out by ranges of the order itself, sorted inside their range and written once, each
with its place there. Ranges hold about as many rows each whatever the values are: numbers, texts
of any shape, or one value that a third of all rows shares, which the further columns of the order
divide. What is added up in one task afterwards is one count per range.

Both functions write a table to the shared folder (``spark.checkpoint.dir``) when they are called.
Bounds of ranges are sampled, results are not: a row's number is its rank, whatever range it is in.
Rows that agree in all columns of the order are numbered one after the other; give enough columns
for a total order, or their numbers may swap from run to run. Nulls come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.functions.ids import format_id
from rosterlake.sources.tables import write_parquet
from rosterlake.sources.workspace import shared_folder

# 2^16 consecutive rows are looked at together for the row before.
BLOCK_BITS = 16
# the low bits of Spark's increasing ids count the rows of a partition
_PLACE_BITS = 33


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows as stored by ranges of ``order``: with ``_range``, the number of the range, and
    ``_place``, the row's place in it, from 0."""
    folder = shared_folder(df.sparkSession)
    # the sampling of the bounds reads the rows as well: stored, they are computed only once
    write_parquet(df, f"{folder}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")
    row = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = dealt.withColumns(
        {
            "_range": F.shiftright(row, _PLACE_BITS).cast("int"),
            "_place": row.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
        }
    )
    write_parquet(placed, f"{folder}/ordered")
    return df.sparkSession.read.schema(placed.schema).parquet(f"{folder}/ordered")


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Number the rows 1..n in the order of the columns ``order``.

    A row's number is its place in its range and the rows of all earlier ranges. The table of
    ranges, one row for each partition of the shuffle, is sent to all tasks.
    """
    placed = in_ranges(df, order)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    numbered = placed.join(F.broadcast(before), "_range")
    return numbered.withColumn(name, F.col("_before") + F.col("_place") + 1).drop(
        "_range", "_place", "_before"
    )


def with_surrogate_key(df: DataFrame, key: str, prefix: str, order: Sequence[str]) -> DataFrame:
    """Put a formatted running number in front as column ``key``."""
    numbered = number_rows(df, order, name="_no")
    return numbered.select(format_id(prefix, F.col("_no")).alias(key), *df.columns)


def with_row_before(
    df: DataFrame, order: Sequence[str], carried: Sequence[str | Column], name: str
) -> DataFrame:
    """Add ``name``: a struct of the columns ``carried`` of the row before in ``order``, null for
    the very first row.

    Numbered rows are looked at in blocks of 2^16. The last row of each block is lent to the next
    one, so that no block needs another; lent rows are left out of the result.
    """
    size = 1 << BLOCK_BITS
    block = F.shiftright("_position", BLOCK_BITS)
    own = F.struct(block.alias("_block"), F.lit(False).alias("_lent"))
    lent = F.struct((block + 1).alias("_block"), F.lit(True).alias("_lent"))
    is_last = F.col("_position") % size == size - 1
    blocks = F.explode(F.when(is_last, F.array(own, lent)).otherwise(F.array(own)))
    in_block = Window.partitionBy("_at._block").orderBy("_position")
    return (
        number_rows(df, order, "_position")
        .withColumn("_at", blocks)
        .withColumn(name, F.lag(F.struct(*carried)).over(in_block))
        .where(~F.col("_at._lent"))
        .drop("_position", "_at")
    )
