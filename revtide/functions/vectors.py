"""Dense float vectors: admission, canonical zero, normalisation and metrics.

Everything here is a built-in higher-order function, so it runs inside the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from revtide.verdicts import Refused, first_reason

# Limits of the vector model.
MAX_DIMENSION = 4096
METRICS = ("dot", "cosine", "euclid", "manhattan")


def is_finite(x: Column) -> Column:
    # NaN sorts above every number in Spark, so it fails the upper bound.
    return (x > F.lit(float("-inf"))) & (x < F.lit(float("inf")))


def all_finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & is_finite(x))


def canonical_vector(vector: Column) -> Column:
    """Turn -0.0 into +0.0 so that equal vectors have equal bits."""
    return F.transform(vector, lambda x: x + F.lit(0.0).cast("float"))


def vector_reject_reason(
    vector: Column, dimension: int, tombstone: Column | None = None, has_model: bool = True
) -> Column:
    """A live row needs a finite vector of the exact dimension; a tombstone must have none."""
    if not 1 <= dimension <= MAX_DIMENSION:
        raise Refused("dimension outside 1..4096")
    dead = F.lit(False) if tombstone is None else tombstone
    if not has_model:
        return first_reason((vector.isNotNull(), "vector_forbidden"))
    return first_reason(
        (dead & vector.isNotNull(), "vector_forbidden"),
        (~dead & vector.isNull(), "vector_missing"),
        (~dead & (F.size(vector) != dimension), "dimension_mismatch"),
        (~dead & ~all_finite(vector), "vector_not_finite"),
    )


def l2_norm(vector: Column) -> Column:
    """Euclidean length in double; squares of finite floats can neither overflow nor vanish."""
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def l2_normalize(vector: Column, norm: Column) -> Column:
    """Divide in double and round once to float; NULL for the zero vector.

    ``norm`` is a column holding ``l2_norm(vector)``, so it is computed once per row.
    """
    scaled = F.transform(vector, lambda x: (x.cast("double") / norm).cast("float"))
    return F.when(norm > 0, scaled)


def check_query_vector(vector: Sequence[float], metric: str) -> list[float]:
    """Driver-side check of one request vector; returns its canonical components."""
    if metric not in METRICS:
        raise Refused(f"unknown metric {metric}")
    values = [float(x) for x in vector]
    if not 1 <= len(values) <= MAX_DIMENSION or not all(map(math.isfinite, values)):
        raise Refused("query vector must have 1..4096 finite components")
    if metric == "cosine" and not any(values):
        raise Refused("cosine needs a non-zero query vector")
    return [x + 0.0 for x in values]


def vector_score(vector: Column, query: Column, metric: str) -> Column:
    """Score in double. Cosine expects both sides normalised already."""
    parts = {
        "dot": lambda a, b: a.cast("double") * b,
        "cosine": lambda a, b: a.cast("double") * b,
        "euclid": lambda a, b: (a.cast("double") - b) * (a.cast("double") - b),
        "manhattan": lambda a, b: F.abs(a.cast("double") - b),
    }[metric]
    total = F.aggregate(F.zip_with(vector, query, parts), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(total) if metric == "euclid" else total


def descending(metric: str) -> bool:
    return metric in ("dot", "cosine")
