"""Folding ordered per-key change logs, and proving that a fold is the right one.

An *operation* is ``(kind, id, position, revision, tombstone, digest)`` plus any columns
carried along. Each key fold is a partial aggregate, so a hot key is combined before the
shuffle; only neighbour checks need an order and those are cut into bounded ranges.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.keys import ID_BYTES, identifier_faults
from revtide.operators.ordering import CHUNK, adjacent_pairs
from revtide.verdicts import first_reason, set_difference

KEY = ["kind", "id"]
STATE = ["revision", "tombstone", "digest"]
OPERATION = [*KEY, "position", *STATE]


class Fold(NamedTuple):
    latest: DataFrame
    conflicts: DataFrame


def with_tombstone(df: DataFrame, value: str = "value") -> DataFrame:
    """A missing value is a deletion."""
    return df.withColumn("tombstone", F.col(value).isNull())


def live(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("tombstone"))


def tombstones(df: DataFrame, *drop: str) -> DataFrame:
    """Deleted keys keep identity and revision and lose every value column."""
    return df.filter("tombstone").drop(*drop)


def check_history(
    df: DataFrame,
    kind: str,
    generation: str,
    after: int,
    end: int,
    arrival: str = "arrival",
    chunk: int = CHUNK,
) -> DataFrame:
    """Faults of one inspected batch, as rows ``(position, id, revision, fault)``.

    Every row must belong to the feed, lie in ``(after, end]`` and have a higher position
    than the row that arrived before it. Rows beyond a replay's own end are checked too.
    """
    outside = first_reason(
        (~F.col("kind").eqNullSafe(kind), "foreign_kind"),
        (~F.col("generation").eqNullSafe(generation), "foreign_generation"),
        *identifier_faults(F.col("id"), ID_BYTES, "id"),
        (F.col("revision").isNull() | (F.col("revision") < 1), "revision_invalid"),
        (F.col("position").isNull() | (F.col("position") <= after), "before_cursor"),
        (F.col("position") > end, "beyond_end"),
    )
    rows = df.withColumn("fault", outside).filter("fault IS NOT NULL")
    pairs = adjacent_pairs(df, ["kind"], arrival, ["position", "id", "revision"], chunk)
    disorder = pairs.filter(F.col("cur.position") <= F.col("prev.position")).select(
        "cur.*", F.lit("not_ascending").alias("fault")
    )
    return rows.select("position", "id", "revision", "fault").unionByName(disorder)


def revision_conflicts(ops: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Operations whose revision falls, or stays while the content changes, along a key."""
    pairs = adjacent_pairs(ops, KEY, "position", ["position", *STATE], chunk)
    changed = ~(
        F.col("cur.tombstone").eqNullSafe(F.col("prev.tombstone"))
        & F.col("cur.digest").eqNullSafe(F.col("prev.digest"))
    )
    fault = first_reason(
        (F.col("cur.revision") < F.col("prev.revision"), "revision_regressed"),
        ((F.col("cur.revision") == F.col("prev.revision")) & changed, "content_changed"),
    )
    return pairs.withColumn("fault", fault).filter("fault IS NOT NULL").select(
        *KEY,
        F.col("cur.position").alias("position"),
        F.col("cur.revision").alias("revision"),
        F.col("prev.revision").alias("previous_revision"),
        "fault",
    )


def latest(ops: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """The newest row per key: highest revision, then highest position."""
    keys = keys or KEY
    order = order or ["revision", "position"]
    rest = [c for c in ops.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return ops.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def fold_latest(ops: DataFrame, chunk: int = CHUNK) -> Fold:
    """One row per key at its highest revision, and the conflicts that void the fold."""
    return Fold(latest(ops), revision_conflicts(ops, chunk))


def _breaks(cur: Column, prev: Column) -> Column:
    """Whether an operation breaks with the one before it along its key."""
    same = cur["tombstone"].eqNullSafe(prev["tombstone"]) & cur["digest"].eqNullSafe(prev["digest"])
    return (cur["revision"] < prev["revision"]) | ((cur["revision"] == prev["revision"]) & ~same)


def folded_with_breaks(ops: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The newest row per key, all its columns, and ``breaks``, the number of conflicts along the key.

    One shuffle of the rows, by key and range of positions: a range gives its newest, first and last row
    and its own breaks; then only ranges of a key meet. A key with most of the rows is spread by range.
    """
    rest = [c for c in ops.columns if c not in KEY]
    cut = ops.select(
        *KEY, F.floor(F.col("position") / F.lit(chunk)).alias("_chunk"), F.struct(*STATE).alias("_cur"), F.struct(*rest).alias("_row"), "position"
    )
    inside = Window.partitionBy(*KEY, "_chunk").orderBy("position")
    order = F.struct("_cur.revision", "position")
    ranges = (
        cut.withColumn("_prev", F.lag("_cur").over(inside))
        .groupBy(*KEY, "_chunk")
        .agg(
            F.count_if(_breaks(F.col("_cur"), F.col("_prev"))).alias("_own"),
            F.min_by("_cur", "position").alias("_head"),
            F.max_by("_cur", "position").alias("_tail"),
            F.max_by("_row", order).alias("_newest"),
        )
    )
    along = Window.partitionBy(*KEY).orderBy("_chunk")
    return (
        ranges.withColumn("_before", F.lag("_tail").over(along))
        .groupBy(*KEY)
        .agg(
            F.max_by("_newest", F.struct("_newest.revision", "_newest.position")).alias("_row"),
            (F.sum("_own") + F.count_if(_breaks(F.col("_head"), F.col("_before")))).alias("breaks"),
        )
        .select(*KEY, "_row.*", "breaks")
    )


#: Buckets of keys that are compared by their digests.
DIGEST_BUCKETS = 4096


def key_bucket(buckets: int = DIGEST_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def _digests(rows: DataFrame, prefix: str) -> DataFrame:
    """Per ``_bucket`` the number of rows and two additive digests of them, whatever their order."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in OPERATION])
    return rows.groupBy("_bucket").agg(
        F.count("*").alias(f"{prefix}_rows"),
        F.bit_xor(F.xxhash64(*OPERATION, nulls)).alias(f"{prefix}_xor"),
        F.sum(F.pmod(F.xxhash64(*OPERATION, nulls, F.lit(1)), F.lit(1 << 31))).alias(f"{prefix}_sum"),
        F.sum("breaks").alias(f"{prefix}_breaks"),
    )


def _compared(rebuilt: DataFrame, intent: DataFrame) -> DataFrame:
    """Both sides' digests of every bucket, with ``differs``."""
    both = _digests(rebuilt, "r").join(_digests(intent, "i"), "_bucket", "full_outer")
    agree = (
        F.col("r_rows").eqNullSafe(F.col("i_rows"))
        & F.col("r_xor").eqNullSafe(F.col("i_xor"))
        & F.col("r_sum").eqNullSafe(F.col("i_sum"))
    )
    return both.withColumn("differs", ~agree)


def _sides(ops: DataFrame, intent: DataFrame, start: int, end: int, bucket: Column, chunk: int) -> tuple[DataFrame, DataFrame]:
    interval = ops.filter((F.col("position") > start) & (F.col("position") <= end))
    rebuilt = folded_with_breaks(interval.select(*OPERATION), chunk).withColumn("_bucket", bucket)
    return rebuilt, intent.select(*OPERATION, F.lit(0).cast("long").alias("breaks")).withColumn("_bucket", bucket)


def replay_buckets(
    ops: DataFrame, intent: DataFrame, start: int, end: int, bucket: Column | None = None, chunk: int = CHUNK
) -> DataFrame:
    """The key buckets in which the rebuilt interval and the stored intent differ, or conflicts lie.

    ``bucket, rebuilt_rows, intent_rows, conflicts``. Only digests meet: neither side's rows are shuffled
    for it. ``bucket`` is an expression over the key.
    """
    compared = _compared(*_sides(ops, intent, start, end, key_bucket() if bucket is None else bucket, chunk))
    return compared.filter("differs OR r_breaks > 0").select(
        F.col("_bucket").alias("bucket"),
        F.coalesce("r_rows", F.lit(0)).alias("rebuilt_rows"),
        F.coalesce("i_rows", F.lit(0)).alias("intent_rows"),
        F.coalesce("r_breaks", F.lit(0)).alias("conflicts"),
    )


def replay_matches(
    ops: DataFrame,
    intent: DataFrame,
    start: int,
    end: int,
    inspected_end: int | None = None,
    bucket: Column | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Rebuild ``(start, end]`` and compare it with the stored intent, as one verdict row.

    ``ok``; ``rebuild_required`` when the fold differs or conflicts; ``history_gap`` when the
    feed does not reach ``end``. Without ``inspected_end`` the highest position seen counts.

    The interval is read and shuffled once, and folds and conflicts come from that. Both sides are compared by
    additive digests of key buckets (64 bits of xor, a sum of 31-bit hashes and a count); rows are
    compared in differing buckets alone.
    """
    rebuilt, stored = _sides(ops, intent, start, end, key_bucket() if bucket is None else bucket, chunk)
    compared = _compared(rebuilt, stored)
    # At most one row for each bucket. An outer join is not pushed below the fold, which would read the feed again.
    odd = F.broadcast(compared.filter("differs").select(F.col("_bucket").alias("_odd")))
    apart = [side.join(odd, F.col("_bucket") == F.col("_odd"), "left").filter("_odd IS NOT NULL") for side in (rebuilt, stored)]
    differing = set_difference(*apart, OPERATION).agg(F.count("*").alias("n"))
    if inspected_end is None:
        reached = ops.agg(F.coalesce(F.max("position"), F.lit(0)).alias("n")).scalar()
    else:
        reached = F.lit(inspected_end)
    broken = compared.agg(F.coalesce(F.sum("r_breaks"), F.lit(0)).alias("n"))
    verdict = differing.select(
        F.col("n").alias("differences"),
        broken.scalar().alias("conflicts"),
        (reached >= end).alias("covered"),
    )
    return verdict.withColumn(
        "status",
        F.when(~F.col("covered"), "history_gap")
        .when((F.col("differences") > 0) | (F.col("conflicts") > 0), "rebuild_required")
        .otherwise("ok"),
    )


def merge_key_state(state: DataFrame, ops: DataFrame) -> DataFrame:
    """Monotonic upsert of one folded page into the key states, with a ``status`` per key.

    A lower revision, or an equal one with other content, is ``conflict`` and keeps the
    stored row; a page with any conflict is not to be applied (see ``page_verdict``).
    """
    old = state.select(*KEY, F.struct(*STATE).alias("_old"))
    new = ops.select(*KEY, F.struct(*STATE).alias("_new"))
    both = old.join(new, KEY, "full_outer")
    same = (
        F.col("_old.revision").eqNullSafe(F.col("_new.revision"))
        & F.col("_old.tombstone").eqNullSafe(F.col("_new.tombstone"))
        & F.col("_old.digest").eqNullSafe(F.col("_new.digest"))
    )
    status = (
        F.when(F.col("_new").isNull(), "kept")
        .when(F.col("_old").isNull(), "inserted")
        .when(same, "repeated")
        .when(F.col("_new.revision") > F.col("_old.revision"), "advanced")
        .otherwise("conflict")
    )
    take_new = F.col("status").isin("inserted", "advanced")
    return (
        both.withColumn("status", status)
        .withColumn("_row", F.when(take_new, F.col("_new")).otherwise(F.col("_old")))
        .select(*KEY, "_row.*", "status")
    )


def page_verdict(merged: DataFrame) -> DataFrame:
    """One row: ``ok`` or ``conflict`` for a merged page."""
    bad = F.count_if(F.col("status") == "conflict")
    return merged.agg(bad.alias("conflicts")).withColumn(
        "status", F.when(F.col("conflicts") > 0, "conflict").otherwise("ok")
    )


def _collapsed(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    """One row per key with its number of copies, so a repeated key cannot skew a join."""
    return df.groupBy(*KEY).agg(
        F.count("*").alias(f"{prefix}_n"), F.min(F.struct(*cols)).alias(prefix)
    )


def reconcile(intent: DataFrame, observed: DataFrame, profile: str, target: str) -> DataFrame:
    """Exact two-way match of intended and actually stored rows, one ``status`` per key.

    ``observed`` carries ``profile`` and ``target`` beside the key state. A write
    acknowledgement is no evidence; a higher stored revision is a mismatch as well.
    """
    wanted = _collapsed(intent, STATE, "want")
    found = _collapsed(observed, [*STATE, "profile", "target"], "have")
    have, want = F.col("have"), F.col("want")
    status = first_reason(
        (F.col("want_n") > 1, "duplicate_intent"),
        (F.col("have_n") > 1, "duplicate"),
        (want.isNull(), "extra"),
        (have.isNull(), "missing"),
        (~have["profile"].eqNullSafe(profile) | ~have["target"].eqNullSafe(target), "foreign"),
        (have["revision"] > want["revision"], "higher_revision"),
        (have["revision"] < want["revision"], "lower_revision"),
        (~have["tombstone"].eqNullSafe(want["tombstone"]), "tombstone_mismatch"),
        (~have["digest"].eqNullSafe(want["digest"]), "digest_mismatch"),
    )
    return wanted.join(found, KEY, "full_outer").select(
        *KEY,
        want["revision"].alias("revision"),
        have["revision"].alias("observed_revision"),
        F.coalesce(status, F.lit("ok")).alias("status"),
    )


def reconcile_vectors(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Digest equal and every float component bit-equal; no tolerance.

    Both sides hold canonical vectors (no -0.0), so value equality is bit equality.
    """
    cols = ["revision", "digest", "vector"]
    joined = _collapsed(expected, cols, "want").join(
        _collapsed(actual, cols, "have"), KEY, "full_outer"
    )
    have, want = F.col("have"), F.col("want")
    agree = F.forall(F.zip_with(want["vector"], have["vector"], lambda a, b: a == b), lambda x: x)
    status = first_reason(
        (F.col("want_n") > 1, "duplicate_intent"),
        (F.col("have_n") > 1, "duplicate"),
        (want.isNull(), "extra"),
        (have.isNull(), "missing"),
        (~have["revision"].eqNullSafe(want["revision"]), "revision_mismatch"),
        (~have["digest"].eqNullSafe(want["digest"]), "payload_mismatch"),
        (want["vector"].isNull() != have["vector"].isNull(), "vector_mismatch"),
        (F.size(want["vector"]) != F.size(have["vector"]), "dimension_mismatch"),
        (~F.coalesce(agree, F.lit(False)) & want["vector"].isNotNull(), "vector_mismatch"),
    )
    return joined.select(*KEY, F.coalesce(status, F.lit("ok")).alias("status"))


def all_ok(statuses: DataFrame) -> DataFrame:
    """One verdict row over a per-key ``status`` frame."""
    bad = F.count_if(F.col("status") != "ok")
    return statuses.agg(F.count("*").alias("keys"), bad.alias("failed")).withColumn(
        "status", F.when(F.col("failed") > 0, "mismatch").otherwise("ok")
    )


def advance_cursors(cursors: DataFrame, inspected: DataFrame) -> DataFrame:
    """Move each kind to its inspected end, filtered events included.

    ``inspected`` is the unfiltered batch. Moving back, standing still, another generation
    or a kind without a cursor is refused and leaves the position as it was.
    """
    ends = inspected.groupBy("kind", "generation").agg(F.max("position").alias("_end"))
    old = cursors.select(
        "kind", F.col("generation").alias("_generation"), F.col("position").alias("_old")
    )
    joined = old.join(ends, "kind", "full_outer")
    status = (
        F.when(F.col("_end").isNull(), "idle")
        .when(F.col("_old").isNull(), "no_cursor")
        .when(F.col("generation") != F.col("_generation"), "generation_gap")
        .when(F.col("_end") < F.col("_old"), "backward")
        .when(F.col("_end") == F.col("_old"), "unchanged")
        .otherwise("advanced")
    )
    moved = F.when(F.col("status") == "advanced", F.col("_end")).otherwise(F.col("_old"))
    return joined.withColumn("status", status).select(
        "kind",
        F.coalesce("_generation", "generation").alias("generation"),
        moved.alias("position"),
        "status",
    )


def as_operations(df: DataFrame, digest: Column) -> DataFrame:
    """Journal rows as operations: key, position, revision, tombstone and ``digest``."""
    return df.withColumn("digest", digest).select(*OPERATION)
