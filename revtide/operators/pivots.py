"""Exact nearest vectors from a store clustered by distances to pivots.

A few vectors are pivots. Every stored vector keeps its distance to each of them, and the table is
sorted by nearest pivot and distance to it, so that a row group covers a narrow range of distances. By the
triangle inequality a vector within ``r`` of the request has distances to all pivots within ``r`` of the request's own:
range predicates on plain columns, which the scan checks against the row groups' statistics. ``r`` is the worst of the best
vectors around the nearest pivots, so nothing that belongs to the result is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.functions.vectors import check_query_vector, vector_score
from revtide.operators.retrieval import MAX_BUDGET, searchable, vector_candidates
from revtide.operators.textindex import check_bounds
from revtide.verdicts import Refused

PIVOTS = 8
#: Vectors of which the pivots are chosen, and vectors for one file of the store.
SAMPLE = 256
FILE_VECTORS = 1_000_000
#: Bytes of a row group, the unit that a scan skips.
GROUP_BYTES = 1 << 20
METRICS = ("euclid", "manhattan")
#: What rounding may add to a distance, as a share.
SLACK = 1e-9


class PivotStore(NamedTuple):
    vectors: DataFrame
    pivots: list[list[float]]
    sizes: dict[int, int]
    metric: str


def _distance(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    apart = np.abs(a - b)
    return apart.sum(-1) if metric == "manhattan" else np.sqrt((apart * apart).sum(-1))


def choose_pivots(vectors: DataFrame, metric: str, count: int = PIVOTS) -> list[list[float]]:
    """Vectors far from one another among a bounded sample, those of least hash; NULL and odd vectors are no pivots."""
    whole = vectors.filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: F.isnan(x) | (F.abs(x) == float("inf"))))
    taken = whole.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    if not taken:
        return []
    length = len(taken[0].vector)
    sample = np.array([r.vector for r in taken if len(r.vector) == length], dtype="f8")
    chosen = [0]
    nearest = _distance(sample, sample[0], metric)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distance(sample, sample[chosen[-1]], metric))
    return [sample[i].tolist() for i in chosen]


def _to_pivot(pivot: Sequence[float], metric: str) -> Column:
    """NULL for vectors of another length, which no request of this length can find."""
    known = F.array(*[F.lit(float(x)) for x in pivot])
    return F.when(F.size("vector") == len(pivot), vector_score(F.col("vector"), known, metric))


def write_pivot_store(vectors: DataFrame, path: str, metric: str, count: int = PIVOTS, group_bytes: int = GROUP_BYTES) -> None:
    """Store ``vectors`` (``kind, id, revision, tombstone, vector`` and what else they have) for exact searches by ``metric``."""
    if metric not in METRICS:
        raise Refused("only euclid and manhattan obey the triangle inequality")
    pivots = choose_pivots(vectors, metric, count)
    spark = vectors.sparkSession
    spark.createDataFrame([(n, p) for n, p in enumerate(pivots)], "pivot int, vector array<double>").coalesce(1).write.parquet(f"{path}/pivots")
    names = [f"_p{n}" for n in range(len(pivots))]
    rows = vectors.withColumns({name: _to_pivot(p, metric) for name, p in zip(names, pivots, strict=True)})
    least = F.least(*names, F.lit(None)) if names else F.lit(None).cast("double")
    cell = F.lit(None).cast("int")
    for n in reversed(range(len(names))):
        cell = F.when(F.col(names[n]) == F.col("_near"), n).otherwise(cell)
    placed = rows.withColumn("_near", least).withColumn("_cell", F.coalesce(cell, F.lit(-1)))
    files = max(1, -(-vectors.count() // FILE_VECTORS))
    order = ["_cell", "_near"]
    placed.repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("parquet.block.size", group_bytes).option(
        "parquet.page.size.row.check.min", 64
    ).parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    stored.groupBy("_cell").agg(F.count("*").alias("n")).coalesce(1).write.parquet(f"{path}/sizes")
    spark.createDataFrame([(metric,)], "metric string").coalesce(1).write.parquet(f"{path}/metric")


def read_pivot_store(spark: SparkSession, path: str) -> PivotStore:
    """The store with its pivots and cells' sizes, a few rows."""
    pivots = [list(r.vector) for r in spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()]
    sizes = {r["_cell"]: r.n for r in spark.read.parquet(f"{path}/sizes").collect()}
    return PivotStore(spark.read.parquet(f"{path}/vectors"), pivots, sizes, spark.read.parquet(f"{path}/metric").first()[0])


def within_reach(store: PivotStore, query: Sequence[float], kind: str, budget: int, exclude: str | None, profile: str | None) -> DataFrame:
    """The stored vectors that may be among the best ``budget``; row groups out of reach are not read."""
    values = np.asarray(check_query_vector(query, store.metric), dtype="f8")
    if not store.pivots or len(store.pivots[0]) != len(values):
        return store.vectors
    own = [float(_distance(np.array(p), values, store.metric)) for p in store.pivots]
    near, held = [], 0
    for n in sorted(range(len(own)), key=lambda n: own[n]):
        if held >= 4 * budget:
            break
        near.append(n)
        held += store.sizes.get(n, 0)
    around = searchable(store.vectors.filter(F.col("_cell").isin(near)), kind, profile, exclude)
    wanted = F.array(*[F.lit(float(x)) for x in values])
    scored = around.filter(F.size("vector") == len(values)).select(vector_score(F.col("vector"), wanted, store.metric).alias("score"))
    worst = scored.orderBy("score").limit(budget).agg(F.max("score").alias("r"), F.count("*").alias("n")).first()
    if worst.n < budget:
        return store.vectors
    rows = store.vectors
    for n, q in enumerate(own):
        slack = SLACK * (abs(q) + worst.r + 1)
        rows = rows.filter((F.col(f"_p{n}") >= q - worst.r - slack) & (F.col(f"_p{n}") <= q + worst.r + slack))
    # A vector lies nearest to its own pivot, so its distance there bounds every other from below.
    return rows


def pivot_candidates(
    store: PivotStore,
    query: Sequence[float],
    kind: str,
    budget: int = MAX_BUDGET,
    exclude: str | None = None,
    profile: str | None = None,
    max_budget: int = MAX_BUDGET,
) -> DataFrame:
    """``vector_candidates`` from a store: the same rows, from the part of it that is within reach."""
    check_bounds(1, budget, max_budget=max_budget)
    reach = within_reach(store, query, kind, budget, exclude, profile)
    return vector_candidates(reach, query, store.metric, kind, budget, exclude, profile, max_budget)
