"""Lookup joins that neither broadcast without a bound nor put one key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lanes a key is spread over where both sides are known to meet on few keys.
SALTS = 16


def lanes(*cols: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def every_lane(salts: int = SALTS) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join facts with a lookup table that has one row per key.

    A plain equi-join without a hint, so nothing runs while the query is being built and a stream
    can be joined, too. At run time Spark broadcasts a lookup whose measured bytes are under
    ``spark.sql.autoBroadcastJoinThreshold`` and splits a key that holds much of the facts
    (``spark.sql.adaptive.skewJoin.enabled``).
    """
    return facts.join(lookup, keys, how)
