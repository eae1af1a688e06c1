"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import discard, spill

MAX_ROUNDS = 60


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node with a link to another one; the root is the smallest node
    that can be reached.

    Each round hangs the larger neighbours of a node, then the smaller ones, on its least
    neighbour. The rounds grow with the logarithm of the longest path. A node with very many links
    is one row of minima joined to many rows, which adaptive execution may split; no node's
    neighbours are ever gathered. Links to itself, to null and repeated links are ignored. The result
    is a spilled table, which the caller may discard after use.
    """
    current = spill(_down(links.select(F.col(left).alias("a"), F.col(right).alias("b"))), "links")
    state = _state(current)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = _down(
            both.join(least, "a").where(F.col("b") > F.col("a")).select("b", "m").toDF("a", "b")
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), "m"
        )
        small = _down(down.union(least).toDF("a", "b"))
        last, current = current, spill(small, "links")
        discard(last)
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"components: links still change after {MAX_ROUNDS} rounds")
    stars = current.toDF("node", "root")
    stars.spilled_to = current.spilled_to
    return stars


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )
