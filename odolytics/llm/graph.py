"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolytics.session import cut_lineage

MOST_ROUNDS = 200           # a star forest takes about log2(n) rounds; this many means something is wrong


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the least node around it.

    The least neighbour is an aggregate combined before the shuffle, then joined back, so the neighbours
    of a node with very many links are never gathered in one place.
    """
    around = _both_ways(edges)
    if not large:
        around = around.where("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    moved = around.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b")))
    return moved.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node in the edge table ``(a, b)``: the smallest node it reaches.

    Self-links and repeated links do no harm; rows with a NULL end are ignored; no edges give no rows.
    """
    state = cut_lineage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_of = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")]
    seen = state.agg(*print_of).first()
    for _ in range(MOST_ROUNDS):
        if not seen["n"]:
            break
        state = cut_lineage(_step(_step(state, large=True), large=False))
        now = state.agg(*print_of).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    # Settled: every edge leads from a node to the least node of its component.
    return state.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("label"))
    ).distinct()
