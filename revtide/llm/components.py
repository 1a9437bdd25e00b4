"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import stored


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``); the root is the least node reachable.

    Each round ties a node's larger neighbours to its least one, then its smaller ones, and is
    written to the shared folder. The rounds grow with the logarithm of the nodes and end when
    the links are stars. Links with NULL and loops are passed over.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct())
    before = _signature(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lower = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lower.hint("merge"), "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").filter("a <> b").distinct())
        after = _signature(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = after
