"""Text analysis: lower-cased runs of letters and digits."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """The terms of a text in order, with repeats."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def query_terms(text: str) -> list[str]:
    """Distinct terms of one request text, by the same rule as ``tokens``."""
    return sorted({t for t in re.split(r"[\W_]+", text.lower()) if t})


def term_counts(sorted_tokens: Column, starts: Column) -> Column:
    """(term, tf) per run of equal terms.

    ``starts`` holds the 1-based first index of every run in ``sorted_tokens``; both are
    columns of the input, so counting a text needs neither a shuffle nor a rescan per term.
    """
    end = F.size(sorted_tokens) + 1
    return F.transform(
        starts,
        lambda at, run: F.struct(
            F.get(sorted_tokens, at - 1).alias("term"),
            (F.coalesce(F.get(starts, run + 1), end) - at).alias("tf"),
        ),
    )


def run_starts(sorted_tokens: Column) -> Column:
    """1-based index of the first token of every run."""
    size = F.size(sorted_tokens)
    indexes = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(
        indexes,
        lambda at: (at == 1) | (F.get(sorted_tokens, at - 1) != F.get(sorted_tokens, at - 2)),
    )
