"""Connected components of a large graph, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.sinks.tables import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint") % F.lit(1 << 30))
    ).first()
    return row[0], row[1] or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); the root is the
    smallest node that can be reached. Nodes that are roots themselves are left out.

    Each round hangs the neighbours of a node on its smallest neighbour, first the
    larger ones, then the smaller ones, until nothing changes; the number of rounds
    grows with the logarithm of the longest path. A node's neighbours are never
    gathered: the smallest one is an aggregation with partial sums before its
    shuffle, and a hub's rows in the join are split by adaptive execution. Every
    round is written to the shared folder, so lineage stays short. Null ends and
    loops are ignored; an empty graph gives no rows.
    """
    current = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        larger = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        larger = stored(larger.where("a <> b"), "edges")
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = (
            larger.join(least, "a")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("a"), F.col("m").alias("b")),
                        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    )
                ).alias("e")
            )
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        current = stored(smaller, "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
