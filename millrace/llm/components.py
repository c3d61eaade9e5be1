"""Connected components of a graph given as an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, durable


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, root`` for every node of an edge; nodes that reach each other share a root.

    In each round every node joins the neighbour that comes first in a random order, itself
    included, and edges move to those nodes. Random order makes the node set shrink by a constant
    share a round also on long chains. Nodes with very many neighbours are minima over partial
    aggregates. Rounds are written below the checkpoint folder, so lineage stays short; only the
    last one's nodes stay there.
    """
    edges = durable(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("r"), F.col(c).alias("v"))  # noqa: B023, E731
        joins = durable(
            both.groupBy("a")
            .agg(F.min(rank("b")).alias("first"))
            .select(F.col("a").alias("node"), F.least("first", rank("a"))["v"].alias("root")),
            "joins",
        )
        consumed = [edges]
        if labels is None:
            labels = joins
        else:
            consumed += [labels, joins]
            labels = durable(
                labels.withColumnRenamed("root", "at")
                .join(joins.withColumnRenamed("node", "at"), "at", "left")
                .select("node", F.coalesce("root", "at").alias("root")),
                "labels",
            )
        moved = (
            edges.join(joins.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
            .join(joins.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        edges = durable(moved, "edges")
        discard(*consumed)
        turn += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    discard(edges)
    return labels
