"""Joins of facts to tables with one row per key.

They are plain left and semi joins: the facts are shuffled once by the key. A key with very many
facts makes a large shuffle partition, which adaptive execution splits into several tasks, each
with a copy of the key's one row (``spark.sql.adaptive.skewJoin``, on by default; the thresholds
are the session's). Whether a table is small enough to be sent to every task is left to Spark's
own byte limit, at planning and again at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def attach(
    facts: DataFrame, table: DataFrame, on: Sequence[str], grouped: bool = False
) -> DataFrame:
    """Left join of ``facts`` to ``table``, which holds one row per ``on``. Facts without a key
    keep null columns.

    ``grouped``: the table comes straight from a grouping by the same key. It is then dealt out
    anew, because Spark splits a large partition only where both sides were shuffled for the join.
    """
    return facts.join(table.hint("rebalance") if grouped else table, list(on), "left")


def keep_matching(facts: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """The facts whose key occurs in the dimension."""
    return facts.join(dimension.select(*on), list(on), "left_semi")
