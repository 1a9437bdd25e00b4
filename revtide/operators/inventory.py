"""Object inventory: archive rows, bindings to stored objects, manifests and recovery."""

from __future__ import annotations

from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.verdicts import Refused, first_reason

# Row limits of the archive model.
NAME_BYTES = 4096
STORE_BYTES = 64
MAX_STORES = 32
OBJECT_BYTES = 64 * 1024 * 1024


class Bindings(NamedTuple):
    bindings: DataFrame
    faults: DataFrame


def inventory_counts(rows: DataFrame, kind: str = "blob") -> DataFrame:
    """Ready, pending, detached, tombstones and rows of other kinds, in one pass.

    Rows have ``kind`` and ``state``; a row of the kind without a state is a tombstone.
    """
    own = F.col("kind") == kind
    return rows.agg(
        F.count_if(own & (F.col("state") == "ready")).alias("ready"),
        F.count_if(own & (F.col("state") == "pending")).alias("pending"),
        F.count_if(own & (F.col("state") == "detached")).alias("detached"),
        F.count_if(own & F.col("state").isNull()).alias("tombstones"),
        F.count_if(~own).alias("other_rows"),
    )


def ready_bindings(
    rows: DataFrame,
    objects: DataFrame,
    stores: Collection[str],
    kind: str = "blob",
    max_object_bytes: int = OBJECT_BYTES,
) -> Bindings:
    """Bind every ready row to exactly one stored object.

    ``rows``: ``kind, id, revision, owner, store, digest, bytes, state, upload_revision``.
    ``objects``: ``row_id, store, key, digest, bytes`` as observed in the stores. Both sides
    and the (store, key) check are collapsed to one row per key with a count first, so a
    group of copies is combined before it moves and is reported as one fault.
    """
    if not 0 < len(set(stores)) <= MAX_STORES:
        raise Refused("between 1 and 32 stores")
    body = ["revision", "owner", "store", "digest", "bytes", "upload_revision"]
    ready = (
        rows.filter((F.col("kind") == kind) & (F.col("state") == "ready"))
        .groupBy("id")
        .agg(F.count("*").alias("_rows"), F.min(F.struct(*body)).alias("r"))
    )
    seen = objects.groupBy(F.col("row_id").alias("id")).agg(
        F.count("*").alias("_objects"),
        F.min(F.struct("store", "key", "digest", "bytes")).alias("o"),
    )
    r, o = F.col("r"), F.col("o")

    def named(name: str):
        return r[name].isNull() | (r[name] == "")

    reason = first_reason(
        (F.col("_rows") > 1, "duplicate_id"),
        (F.col("id").isNull() | (F.col("id") == ""), "invalid_row"),
        (named("owner") | named("store"), "invalid_row"),
        (r["revision"].isNull() | r["upload_revision"].isNull(), "invalid_row"),
        ((r["upload_revision"] < 1) | (r["upload_revision"] > r["revision"]), "invalid_row"),
        (
            (F.octet_length("id") > NAME_BYTES)
            | (F.octet_length(r["owner"]) > NAME_BYTES)
            | (F.octet_length(r["store"]) > STORE_BYTES)
            | (r["bytes"] > max_object_bytes),
            "too_large",
        ),
        (~r["store"].isin(sorted(set(stores))), "unknown_store"),
        (F.col("_objects").isNull(), "object_missing"),
        (F.col("_objects") > 1, "object_ambiguous"),
        (~o["store"].eqNullSafe(r["store"]), "store_mismatch"),
        (~o["bytes"].eqNullSafe(r["bytes"]), "length_mismatch"),
        (~o["digest"].eqNullSafe(r["digest"]), "digest_mismatch"),
    )
    bound = ready.join(seen, "id", "left").withColumn("fault", reason)
    row_faults = bound.filter("fault IS NOT NULL").select(
        "id", r["store"].alias("store"), F.lit(None).cast("string").alias("key"), "fault", "_rows"
    )
    good = bound.filter("fault IS NULL")
    by_key = good.groupBy(o["store"].alias("store"), o["key"].alias("key")).agg(
        F.count("*").alias("_rows"),
        F.min(
            F.struct("id", r["revision"], r["owner"], r["upload_revision"], r["digest"], r["bytes"])
        ).alias("b"),
    )
    shared = by_key.filter("_rows > 1").select(
        F.lit(None).cast("string").alias("id"),
        "store",
        "key",
        F.lit("duplicate_key").alias("fault"),
        "_rows",
    )
    b = F.col("b")
    bindings = by_key.filter("_rows = 1").select(
        b["id"].alias("id"),
        b["revision"].alias("revision"),
        b["owner"].alias("owner"),
        b["upload_revision"].alias("upload_revision"),
        "store",
        "key",
        b["digest"].alias("digest"),
        b["bytes"].alias("bytes"),
    )
    faults = row_faults.unionByName(shared).withColumnRenamed("_rows", "copies")
    return Bindings(bindings, faults)


def store_manifests(bindings: DataFrame) -> DataFrame:
    """Entries and byte total per store alias; namespaces are never merged."""
    return bindings.groupBy("store").agg(
        F.count("*").alias("entries"),
        F.sum(F.col("bytes").cast("decimal(20,0)")).alias("total_bytes"),
    )


def write_manifests(bindings: DataFrame, path: str, files_per_store: int = 64) -> None:
    """One folder per store alias; a large store is spread over several files by key."""
    lane = F.pmod(F.xxhash64("key"), F.lit(files_per_store))
    (
        bindings.select("store", "key", "digest", "bytes")
        .repartition("store", lane)
        .write.mode("errorifexists")
        .partitionBy("store")
        .parquet(path)
    )


def verify_entries(manifest: DataFrame, objects: DataFrame) -> DataFrame:
    """Add ``status`` to every manifest entry: ok, missing, ambiguous, length_ or digest_mismatch.

    Repeated observations of an object are one; if they differ, its entries are ambiguous.

    Objects that no entry lists are no claim and are ignored. Only key, length and digest
    are shuffled, never content.
    """
    seen = F.struct(F.col("digest"), F.col("bytes"))
    have = objects.groupBy("store", "key").agg(F.min(seen).alias("_have"), F.max(seen).alias("_other"))
    status = (
        F.when(F.col("_have").isNull(), "missing")
        .when(F.col("_have") != F.col("_other"), "ambiguous")
        .when(~F.col("_have.bytes").eqNullSafe(F.col("bytes")), "length_mismatch")
        .when(~F.col("_have.digest").eqNullSafe(F.col("digest")), "digest_mismatch")
        .otherwise("ok")
    )
    return manifest.join(have, ["store", "key"], "left").withColumn("status", status).drop("_have", "_other")


def recovery_report(results: DataFrame) -> DataFrame:
    """Counts of the verified prefix and the first failure in manifest order, as one row.

    ``results``: ``seq, bytes, action`` (created or existing) ``, phase, cause``; a NULL
    cause is success. The prefix needs no order over the table, only the lowest failed seq.
    """
    failed = F.col("cause").isNotNull()
    first = results.filter(failed).agg(F.min("seq").alias("seq")).scalar()
    prefix = F.col("_first").isNull() | (F.col("seq") < F.col("_first"))
    at = F.col("seq").eqNullSafe(F.col("_first"))
    return (
        results.withColumn("_first", first)
        .agg(
            F.count_if(prefix).alias("verified"),
            F.coalesce(
                F.sum(F.when(prefix, F.col("bytes").cast("decimal(20,0)"))), F.lit(0)
            ).alias("bytes"),
            F.count_if(prefix & (F.col("action") == "created")).alias("created"),
            F.count_if(prefix & (F.col("action") == "existing")).alias("existing"),
            F.max("_first").alias("failed_seq"),
            F.min(F.when(at, F.col("phase"))).alias("phase"),
            F.min(F.when(at, F.col("cause"))).alias("cause"),
        )
    )
