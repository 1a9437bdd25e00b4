"""Host telemetry: outcome counts, duration histograms, last-known status, lost operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The finite label sets.
OPERATIONS = ("action", "query", "work", "recovery")
OUTCOME_OF = {
    "ok": "success",
    "denied": "denied",
    "conflict": "conflict",
    "overloaded": "overloaded",
    "not_committed": "not_committed",
    "unknown": "unknown",
    "closed": "unavailable",
    "storage": "failed",
    "panicked": "panicked",
    "accepted": "accepted",
    "retryable": "retryable",
    "permanent": "permanent",
    "timed_out": "timed_out",
    "abandoned": "abandoned",
}
OTHERWISE = "rejected"

# Gauges of a status sample as (instrument, label, column).
GAUGES = (
    ("owned_work", "", "owned_work"),
    ("permits", "action", "action_permits"),
    ("permits", "io", "io_permits"),
    ("permits", "subscription", "subscription_permits"),
    ("registered", "resource", "registered_resources"),
    ("registered", "reaction", "registered_reactions"),
    ("registered", "channel", "registered_channels"),
)
INTAKE_STATES = ("open", "draining", "stopped")


def outcome_label(result: Column) -> Column:
    """Total map of result classes to outcome labels; anything else is ``rejected``."""
    labels = F.create_map(*[F.lit(x) for pair in OUTCOME_OF.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, result), F.lit(OTHERWISE))


def operation_counts(observations: DataFrame) -> DataFrame:
    """Count per operation and outcome of rows with ``operation`` and ``result``.

    Works on a stream as well (update mode): at most 4 x 15 groups exist.
    """
    known = observations.filter(F.col("operation").isin(*OPERATIONS))
    return known.groupBy("operation", outcome_label(F.col("result")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


def rejected_observations(observations: DataFrame) -> DataFrame:
    """How many rows the counts and the histogram leave out, by ``reject_reason``.

    ``duration_invalid`` rows are left out of the histogram only.
    """
    known = F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False))
    valid = F.coalesce(F.col("duration_s").between(0, 1.7976931348623157e308), F.lit(False))
    reason = F.when(~known, "unknown_operation").when(~valid, "duration_invalid")
    return (
        observations.select(reason.alias("reject_reason"))
        .filter("reject_reason IS NOT NULL")
        .groupBy("reject_reason")
        .agg(F.count("*").alias("n"))
    )


def duration_histogram(observations: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Count, sum and cumulative bucket counts per operation and outcome.

    ``duration_s`` must be finite and not negative; other rows do not count.
    """
    valid = F.col("duration_s").between(0, 1.7976931348623157e308)
    buckets = [
        F.count_if(F.col("duration_s") <= bound).alias(f"le_{n}") for n, bound in enumerate(bounds)
    ]
    known = observations.filter(F.col("operation").isin(*OPERATIONS) & valid)
    return known.groupBy("operation", outcome_label(F.col("result")).alias("outcome")).agg(
        F.count("*").alias("n"), F.sum("duration_s").alias("total_s"), *buckets
    )


#: Size of a quantile sketch; the error of a rank is about 0.3 % at 1024.
SKETCH_SIZE = 1024


def duration_sketches(observations: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """A mergeable quantile sketch of the durations of each operation and outcome in each ``hour``.

    ``observations`` also have ``hour``. Which rows count is as in the histogram. Sketches are combined per
    task before they are shuffled and may be stored and merged over any hours later.
    """
    valid = F.col("duration_s").between(0, 1.7976931348623157e308)
    known = observations.filter(F.col("operation").isin(*OPERATIONS) & valid)
    return known.groupBy("hour", "operation", outcome_label(F.col("result")).alias("outcome")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("duration_s", size).alias("sketch")
    )


def duration_percentiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``operation, outcome, n, share, duration_s`` over all hours of ``sketches``, one row for each of ``shares`` (0 to 1)."""
    merged = sketches.groupBy("operation", "outcome").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_sketch")
    )
    each = [
        F.struct(F.lit(float(x)).alias("share"), F.kll_sketch_get_quantile_double("_sketch", F.lit(float(x))).alias("duration_s"))
        for x in shares
    ]
    return merged.select("operation", "outcome", "n", F.explode(F.array(*each)).alias("_q")).select("operation", "outcome", "n", "_q.*")


def latest_status(samples: DataFrame) -> DataFrame:
    """Last-known value per instrument and label over status samples.

    A sample is ``ts, ok, ready, failed, intake`` and the count columns of ``GAUGES``. A
    failed sample, or one with a count out of range, sets ``available`` to 0 and adds to
    ``status_failures``; every other instrument keeps its last good value.
    """
    counts_fit = F.lit(True)
    for _, _, name in GAUGES:
        counts_fit = counts_fit & F.coalesce(F.col(name) >= 0, F.lit(False))
    good = F.coalesce(F.col("ok"), F.lit(False)) & counts_fit
    entries = [("ready", "", F.col("ready").cast("long")), ("failed", "", F.col("failed").cast("long"))]
    entries += [("intake", s, (F.col("intake") == s).cast("long")) for s in INTAKE_STATES]
    entries += [(i, label, F.col(name).cast("long")) for i, label, name in GAUGES]
    # One pass: the newest good sample per instrument, and both facts about all samples.
    marked = samples.withColumn("_good", good)
    good_ts = F.when(F.col("_good"), F.col("ts"))
    known = [F.max_by(v, good_ts).alias(f"_v{n}") for n, (_, _, v) in enumerate(entries)]
    summary = marked.agg(
        *known,
        F.max_by(F.col("_good").cast("long"), "ts").alias("available"),
        F.count_if(~F.col("_good")).alias("status_failures"),
    )
    named = [(i, label, F.col(f"_v{n}")) for n, (i, label, _) in enumerate(entries)]
    named += [(n, "", F.col(n)) for n in ("available", "status_failures")]
    values = F.array(
        *[
            F.struct(F.lit(i).alias("instrument"), F.lit(label).alias("label"), v.alias("value"))
            for i, label, v in named
        ]
    )
    return summary.select(F.explode(values).alias("_v")).select("_v.*").filter("value IS NOT NULL")


def abandoned_operations(
    starts: DataFrame, finishes: DataFrame, timeout_s: int, now_s: int
) -> DataFrame:
    """Every started observation once, with its outcome: the first finish or ``abandoned``.

    ``starts``: ``observation, operation, ts`` (Unix seconds); ``finishes``: ``observation,
    result, ts``. A start without a finish within ``timeout_s`` is abandoned once the time
    has passed at ``now_s``; younger ones are still ``open``. A finish before its start is
    none.
    """
    begun = starts.groupBy("observation").agg(F.min(F.struct("ts", "operation")).alias("s"))
    ended = (
        finishes.join(begun, "observation")
        .filter(F.col("ts") >= F.col("s.ts"))
        .groupBy("observation")
        .agg(F.min(F.struct("ts", "result")).alias("f"))
    )
    in_time = F.col("f.ts").isNotNull() & (F.col("f.ts") - F.col("s.ts") <= timeout_s)
    outcome = (
        F.when(in_time, outcome_label(F.col("f.result")))
        .when(F.lit(now_s) - F.col("s.ts") > timeout_s, "abandoned")
        .otherwise("open")
    )
    return begun.join(ended, "observation", "left").select(
        "observation", F.col("s.operation").alias("operation"), outcome.alias("outcome")
    )
