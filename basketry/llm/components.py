"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.materialize import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable over undirected edges, itself included.

    Alternates large-star and small-star steps: each is one aggregation by node, so the number of
    edges does not grow, and a node with very many neighbours costs one row per neighbour and a
    pre-aggregated minimum. Edges with a null end and loops are ignored; nodes without edges are
    not in the result. Every step is written to shared storage, so no lineage grows and a lost
    executor costs one step.
    """
    x, y = F.col(a), F.col(b)
    links = stored(
        edges.where(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        # Large star: every larger neighbour of u moves to u's smallest neighbour.
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        links = stored(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "links",
        )
        # Small star: every smaller neighbour of u, and u, move to the smallest of them.
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        links = stored(
            links.join(least, "u")
            .select(
                F.explode(
                    F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
                ).alias("e")
            )
            .select("e.u", "e.v")
            .where("u != v")
            .distinct(),
            "links",
        )
        sign = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("s"),
            F.count_distinct("u").alias("nodes"),
        ).first()
        if before == sign and sign["n"] == sign["nodes"]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = sign
