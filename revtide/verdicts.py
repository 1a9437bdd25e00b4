"""Rejection convention.

Row faults become a ``reject_reason`` column; set faults (duplicates, conflicts,
over-limit) become a one-row verdict frame that ``require_ok`` turns into an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Refused(ValueError):
    """A request or a whole set was refused; nothing was trimmed to fit."""


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule that holds, else NULL. A NULL rule does not hold."""
    head, *rest = rules
    start = F.when(head[0], F.lit(head[1]))
    return reduce(lambda chain, rule: chain.when(rule[0], F.lit(rule[1])), rest, start)


def split_rejected(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(admitted rows without the reason column, quarantined rows with it)."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def require_ok(verdict: DataFrame, status: str = "status") -> None:
    """Raise unless the one-row verdict says ``ok``."""
    row = verdict.first()
    if row is None or row[status] != "ok":
        raise Refused("no verdict" if row is None else str(row.asDict()))


def set_difference(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose multiplicity differs, with ``surplus`` > 0 when only ``left`` has them.

    One shuffle with map-side combine; NULL equals NULL, as in a two-way ``exceptAll``.
    """
    signed = left.select(*cols, F.lit(1).alias("_n")).unionByName(
        right.select(*cols, F.lit(-1).alias("_n"))
    )
    return signed.groupBy(*cols).agg(F.sum("_n").alias("surplus")).filter("surplus <> 0")
