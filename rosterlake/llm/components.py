"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.scratch import store


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, whatever their order."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("hi", "lo")).alias("x"),
        F.sum(F.xxhash64("lo", "hi") % (1 << 30)).alias("s"),
    ).first()
    return row.n, row.x, row.s


def _with_least(edges: DataFrame, of: str, at: str) -> DataFrame:
    """Each edge with ``least``, the smallest lower neighbour of the node ``of`` where it is the
    edge's node ``at``; null if it has none.

    The grouped side is dealt out anew: adaptive execution splits the edges of a node with very many
    only where both sides were shuffled for the join.
    """
    lowest = edges.groupBy(of).agg(F.min("lo").alias("least"))
    return edges.join(lowest.withColumnRenamed(of, at).hint("rebalance"), at, "left")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with an edge.

    ``edges``: two columns of whole numbers. Loops, repeated edges and nulls are ignored. Rounds
    of large-star and small-star: each node above another is linked to the smallest neighbour
    known, until nothing changes; that takes logarithmically many rounds, and stars are done in
    two. Minima are taken before each shuffle, and each join has one row per key on one side, so
    that Spark can split a node with very many edges. Rounds are written to the shared folder.
    """
    a, b = (F.col(f"`{name}`") for name in edges.columns[:2])
    ordered = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    current = store(ordered.where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "edges")
    before = _state(current)
    while before[0]:
        # large-star: a higher neighbour moves to the smallest neighbour of the lower one
        large = _with_least(current, "hi", "lo").select("hi", F.coalesce("least", "lo").alias("lo"))
        # small-star: all lower neighbours and the node itself move to the smallest of them
        moved = _with_least(large.distinct(), "hi", "hi")
        small = moved.select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("least").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")),
        )).alias("e")).select("e.*")
        current = store(small.where("hi != lo").distinct(), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    centres = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.unionByName(centres)
