"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import keep


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, label)`` for every node of ``links`` (``a long, b long``).

    ``label`` is the smallest node that can be reached.  Each round lets every node hand
    its smallest neighbour to its larger neighbours, then to its smaller ones; the links
    become stars in a logarithmic number of rounds.  A node with very many links is an
    aggregate and a skewed join for Spark, never one group in memory.  Each round is a
    written table.  No links give no rows; links of a node to itself are left out.
    """
    edges = keep(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours take the least node around.
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        # Smaller neighbours and the node itself take the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u <> v").distinct()
        )
        edges = keep(small, "links")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
