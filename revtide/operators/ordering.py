"""Neighbour comparison that survives one key holding most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Order values per chunk. Positions are unique in a feed, so a chunk holds at most this many rows.
CHUNK = 1_000_000


def adjacent_pairs(
    df: DataFrame, keys: list[str], order: str, cols: list[str], chunk: int = CHUNK
) -> DataFrame:
    """Every row beside its predecessor in ``order`` within ``keys``: ``prev`` and ``cur``.

    A plain ``lag`` sorts a whole key in one task. Here rows are compared inside fixed
    ranges of ``order``; then only the ends of each range are compared with one another.
    """
    cut = df.select(
        *keys,
        F.floor(F.col(order) / F.lit(chunk)).alias("_chunk"),
        F.col(order).alias("_order"),
        F.struct(*cols).alias("cur"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_order")
    seen = cut.withColumn("prev", F.lag("cur").over(inside)).withColumn(
        "_last", F.lead("_order").over(inside).isNull()
    )
    within = seen.filter(F.col("prev").isNotNull()).select(*keys, "prev", "cur")
    ends = (
        seen.filter(F.col("prev").isNull() | F.col("_last"))
        .groupBy(*keys, "_chunk")
        .agg(F.min_by("cur", "_order").alias("cur"), F.max_by("cur", "_order").alias("_tail"))
    )
    across = ends.withColumn(
        "prev", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_chunk"))
    )
    return within.unionByName(
        across.filter(F.col("prev").isNotNull()).select(*keys, "prev", "cur")
    )
