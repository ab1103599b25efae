"""Connected components of a distributed graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releasemill.workspace import materialise

MAX_ROUNDS = 60


def _is_stars(edges: DataFrame) -> bool:
    """Whether each `hi` has one `lo` and no `lo` is a `hi`."""
    rows, children = edges.agg(F.count("*"), F.count_distinct("hi")).first()
    if rows != children:
        return False
    return edges.select(F.col("lo").alias("hi")).distinct().join(edges, "hi", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node that has an edge; root is the smallest node of its component.

    `edges` has two columns of one orderable type; loops and nulls are ignored,
    repeated and reversed edges are one.  Each round writes its edges, so lineage
    stays short and nothing but two counts reaches the driver.  Minima are joined
    from written tables, so that the engine can split the join of a hub.
    """
    a, b = edges.columns
    current = materialise(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "edges",
    )
    for _ in range(MAX_ROUNDS):
        if _is_stars(current):
            break
        # Large star: every larger neighbour of a node gets the node's smallest neighbour.
        both = current.select(F.col("hi").alias("x"), F.col("lo").alias("y")).union(
            current.select(F.col("lo").alias("x"), F.col("hi").alias("y"))
        )
        least = materialise(
            both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m")), "least"
        )
        large = materialise(
            both.where("y > x").join(least, "x").where("y <> m")
            .select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct(),
            "large",
        )
        # Small star: a node and its smaller neighbours get the smallest of these.
        least = materialise(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        current = materialise(
            large.join(least, "hi").where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(least.select("hi", F.col("m").alias("lo")))
            .distinct(),
            "small",
        )
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
