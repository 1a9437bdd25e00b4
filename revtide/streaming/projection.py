"""The projection job: one micro-batch is one page.

Per page: admit it after the cursor, fold, check against the stored states of its keys' buckets, persist
the intent, write the page, read it back, reconcile, and only then move the cursor. A failure leaves the
intent and the old cursor; the stream then replays the same batch id with the same rows, which must
rebuild the stored intent before anything is written again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.operators.history import (
    KEY,
    OPERATION,
    STATE,
    all_ok,
    folded_with_breaks,
    merge_key_state,
    page_verdict,
    reconcile,
)
from revtide.sources.generation import (
    BUCKETS,
    bucket_of_key,
    committed,
    compact,
    delta_path,
    is_complete,
    numbered,
    read_generation,
    remove,
    write_delta,
)
from revtide.verdicts import Refused, first_reason, require_ok, set_difference

CURSOR = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("position", T.LongType()),
    ]
)
#: Pages whose cursors and intents are kept; a page that is older than that can't be repeated.
KEPT_PAGES = 8


class RebuildRequired(RuntimeError):
    """The replayed page differs from its stored intent."""


def intent_path(path: str, batch_id: int) -> str:
    return f"{path}/intents/batch_id={batch_id}"


def cursor_path(path: str, batch_id: int) -> str:
    return f"{path}/cursors/batch_id={batch_id}"


def known_states(
    spark: SparkSession, path: str, schema: T.StructType, only: Iterable[int] | None = None, before: int | None = None
) -> DataFrame:
    """Stored key states in the buckets ``only``: narrow columns of these folders, folded."""
    narrow = T.StructType([f for f in schema.fields if f.name in (*KEY, *STATE)])
    return read_generation(spark, path, narrow, only, before).select(*KEY, *STATE)


def page_faults(batch: DataFrame, cursors: DataFrame) -> DataFrame:
    """``kind, fault`` of every kind whose rows do not continue its cursor.

    A page holds one generation of a kind, the cursor's, and positions above the cursor, each
    once. ``cursors`` has ``kind, generation, position``; a kind without one may begin anywhere.
    """
    seen = batch.groupBy("kind").agg(
        F.min("generation").alias("_low"),
        F.max("generation").alias("_high"),
        F.count_if(F.col("generation").isNull() | F.col("position").isNull() | (F.col("position") < 1)).alias("_bad"),
        F.min("position").alias("_first"),
        (F.count("*") - F.count_distinct("position")).alias("_again"),
    )
    at = cursors.select(
        F.col("kind").alias("_kind"), F.col("generation").alias("_generation"), F.col("position").alias("_position")
    )
    fault = first_reason(
        (F.col("kind").isNull() | (F.col("_bad") > 0), "position_invalid"),
        (F.col("_low") != F.col("_high"), "mixed_generations"),
        (F.col("_low") != F.col("_generation"), "generation_changed"),
        (F.col("_first") <= F.col("_position"), "not_after_cursor"),
        (F.col("_again") > 0, "not_ascending"),
    )
    return (
        seen.join(at, F.col("kind") == F.col("_kind"), "left")
        .select("kind", fault.alias("fault"))
        .filter("fault IS NOT NULL")
    )


def _matches_intent(spark: SparkSession, intent: DataFrame, path: str) -> bool:
    saved = spark.read.schema(intent.schema).parquet(path)
    return not set_difference(intent, saved, OPERATION).limit(1).count()


def _inspect(batch: DataFrame, folded: DataFrame, cursors: DataFrame, batch_id: int, buckets: int) -> list[int]:
    """The buckets of the page's keys; refuses a page with faults. One job, at most ``buckets`` and ten rows."""
    nothing = F.lit(None).cast("string")
    faults = page_faults(batch, cursors).limit(5).select(F.concat("kind", F.lit(": "), "fault").alias("fault"))
    broken = folded.filter("breaks > 0").limit(5).select(F.concat("id", F.lit(": revisions conflict")).alias("fault"))
    own = folded.select(bucket_of_key(buckets).alias("bucket")).distinct()
    rows = (
        faults.unionByName(broken)
        .withColumn("bucket", F.lit(None).cast("int"))
        .unionByName(own.withColumn("fault", nothing))
        .collect()
    )
    found = [r.fault for r in rows if r.bucket is None]
    if found:
        raise Refused(f"page {batch_id}: " + ", ".join(map(str, found)))
    return [r.bucket for r in rows]


def apply_page(
    batch: DataFrame,
    batch_id: int,
    to_documents: Callable[[DataFrame], DataFrame],
    profile: str,
    path: str,
    buckets: int = BUCKETS,
) -> None:
    """Apply one page; safe to repeat with the same ``batch_id`` and rows.

    A page that is done already must rebuild the intent stored under its id: ids start anew with a new
    checkpoint, and another page under an old id would otherwise be lost.
    """
    spark = batch.sparkSession
    newest = max(numbered(spark, f"{path}/cursors"), default=None)
    done = newest is not None and batch_id <= newest
    folded = folded_with_breaks(to_documents(batch)).persist()
    page = folded.drop("breaks")
    try:
        intent = page.select(*OPERATION)
        stored_intent = intent_path(path, batch_id)
        begun = is_complete(spark, stored_intent)
        if (begun or done) and not (begun and _matches_intent(spark, intent, stored_intent)):
            raise RebuildRequired(f"page {batch_id} no longer matches its intent")
        if done:
            return
        at = read_cursors(spark, path)
        own = _inspect(batch, folded, at, batch_id, buckets)
        base, deltas = committed(spark, path)
        if base is not None or any(n < batch_id for n in deltas):
            # The buckets' other keys count as kept.
            merged = merge_key_state(known_states(spark, path, page.schema, own, batch_id), page)
            require_ok(page_verdict(merged))
        if not begun:
            intent.write.mode("overwrite").parquet(stored_intent)
        write_delta(page, path, batch_id, buckets)
        observed = spark.read.schema(page.schema).parquet(delta_path(path, batch_id))
        # Equal sets of rows match in every respect; only where they differ are the keys' statuses worked out.
        if set_difference(intent, observed, OPERATION).limit(1).count():
            own_target = observed.withColumns({"profile": F.lit(profile), "target": F.lit(path)})
            require_ok(all_ok(reconcile(intent, own_target, profile, path)))
        _move_cursors(batch, at, path, batch_id)
    finally:
        folded.unpersist()


def _move_cursors(batch: DataFrame, at: DataFrame, path: str, batch_id: int) -> None:
    """Store every kind's cursor after this page; it follows the inspected batch, filtered events included."""
    ends = batch.groupBy("kind", "generation").agg(F.max("position").alias("position"))
    every = at.unionByName(ends).groupBy("kind").agg(F.max_by(F.struct("generation", "position"), "position").alias("_c"))
    every.select("kind", "_c.*").coalesce(1).write.mode("overwrite").parquet(cursor_path(path, batch_id))
    for old in numbered(batch.sparkSession, f"{path}/cursors"):
        if old <= batch_id - KEPT_PAGES:
            remove(batch.sparkSession, cursor_path(path, old))
            remove(batch.sparkSession, intent_path(path, old))


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    """Generation and position of each kind after the newest page that is done."""
    newest = max(numbered(spark, f"{path}/cursors"), default=None)
    if newest is None:
        return spark.createDataFrame([], CURSOR)
    return spark.read.schema(CURSOR).parquet(cursor_path(path, newest))


def run_projection(
    stream: DataFrame,
    to_documents: Callable[[DataFrame], DataFrame],
    profile: str,
    path: str,
    checkpoint: str,
    once: bool = False,
    compact_every: int | None = None,
    buckets: int = BUCKETS,
):
    """Start the job over a journal stream; ``once`` stops when the backlog is done.

    ``to_documents`` maps journal rows to operations plus the columns to store. With
    ``compact_every`` the deltas are folded into a new base after that many pages.
    """

    def page(batch: DataFrame, batch_id: int) -> None:
        apply_page(batch, batch_id, to_documents, profile, path, buckets)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, to_documents(batch).schema, buckets)

    writer = stream.writeStream.foreachBatch(page).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
