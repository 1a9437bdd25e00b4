"""Archive counts, schema migration, generation-fenced restore and envelope re-encryption."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.functions.keys import framed
from revtide.operators.joins import lookup_join
from revtide.sources.snapshots import publish_snapshot
from revtide.verdicts import Refused, first_reason

# The record types of an archive, and the largest stored ciphertext.
RECORD_TYPES = (
    "rows",
    "receipts",
    "events",
    "effects",
    "descriptors",
    "references",
    "work",
    "operator_receipts",
)
CIPHERTEXT_BYTES = 16_384


def archive_counts(records: DataFrame, record_type: str = "record_type") -> DataFrame:
    """One row of counts by record type; values are never read."""
    return records.agg(
        *[F.count_if(F.col(record_type) == name).alias(name) for name in RECORD_TYPES]
    )


def migration_preview(before: DataFrame, after: DataFrame, receipts: DataFrame) -> DataFrame:
    """How many kinds change version or are new, and how many receipts stay on an old one.

    ``before`` and ``after``: ``kind, version`` descriptors. ``receipts``: ``kind, version``
    the receipt was written with; they are counted per version before they meet a descriptor.
    """
    new = after.select("kind", F.col("version").alias("_to"))
    changed = new.join(before.select("kind", F.col("version").alias("_from")), "kind", "left").agg(
        F.count_if(~F.col("_from").eqNullSafe(F.col("_to"))).alias("n")
    )
    pinned = (
        receipts.groupBy("kind", "version")
        .agg(F.count("*").alias("_n"))
        .join(new, "kind")
        .filter(F.col("version") < F.col("_to"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("historical_receipts"))
    )
    return pinned.select(changed.scalar().alias("changed_schemas"), "historical_receipts")


def migrate_rows(
    rows: DataFrame,
    converters: Mapping[str, tuple[int, Callable[[Column], Column]]],
    path: str | None = None,
) -> DataFrame:
    """Convert ``value`` per kind with pure column expressions ``kind -> (version, f)``.

    Tombstones and other kinds stay as they are. With ``path`` the result is published to
    a fresh folder; the source is only read.
    """
    value, version = F.col("value"), F.col("version")
    for kind, (target, convert) in converters.items():
        here = (F.col("kind") == kind) & F.col("value").isNotNull()
        value = F.when(here, convert(F.col("value"))).otherwise(value)
        version = F.when(here, F.lit(target)).otherwise(version)
    migrated = rows.select(
        *[
            {"value": value.alias("value"), "version": version.alias("version")}.get(c, F.col(c))
            for c in rows.columns
        ]
    )
    if path is not None:
        publish_snapshot(migrated, path)
    return migrated


def restore_snapshot(
    spark: SparkSession, source: str, destination: str, generation: str
) -> DataFrame:
    """Publish a snapshot into a fresh folder under another journal generation.

    Old cursors then meet a foreign generation and report a gap instead of reading on.
    """
    saved = spark.read.parquet(source)
    invalid = (
        F.col("kind").isNull()
        | F.col("id").isNull()
        | F.coalesce(F.col("revision") < 1, F.lit(True))
        | F.coalesce(F.col("generation") == generation, F.lit(True))
    )
    if "position" in saved.columns:
        invalid = invalid | F.coalesce(F.col("position") < 1, F.lit(True))
    if saved.filter(invalid).limit(1).count():
        raise Refused("snapshot has invalid rows, or the generation does not change")
    # A saved journal has many rows of a key, each at its own position; a saved state has one.
    unique = ["kind", "position"] if "position" in saved.columns else ["kind", "id"]
    if saved.groupBy(*unique).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        raise Refused(f"snapshot repeats {' and '.join(unique)}")
    publish_snapshot(saved.withColumn("generation", F.lit(generation)), destination)
    return spark.read.parquet(destination)


def binding_aad(context: Column, aad: Column) -> Column:
    """Associated data that binds a ciphertext to its context and caller data."""
    return F.concat(framed(F.base64(context)), framed(F.base64(aad)))


def seal(plaintext: Column, key: Column, context: Column, aad: Column) -> Column:
    """AES-GCM under a key column with a fresh random nonce, as base64 text."""
    sealed = F.aes_encrypt(
        plaintext, key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), binding_aad(context, aad)
    )
    return F.base64(sealed)


def unseal(ciphertext: Column, key: Column, context: Column, aad: Column) -> Column:
    """The plaintext, or NULL when key, context, associated data or text do not agree."""
    return F.try_aes_decrypt(
        F.unbase64(ciphertext), key, F.lit("GCM"), F.lit("DEFAULT"), binding_aad(context, aad)
    )


def rekey_envelopes(
    envelopes: DataFrame, keyring: DataFrame, alias: str, version: int
) -> DataFrame:
    """Re-encrypt every envelope under the pinned key ``alias`` and ``version``.

    ``envelopes``: ``id, profile, key_alias, key_version, ciphertext, context, aad``;
    ``keyring``: ``key_alias, key_version, key``. Context and associated data stay, the
    replacement is checked by decrypting it again, the source row is unchanged, and a row
    that fails is returned with its ``reject_reason``. There is no "latest" version.
    """
    if version < 1:
        raise Refused("the destination version must be pinned")
    keys = keyring.select("key_alias", "key_version", F.col("key").alias("_key"))
    pinned = keys.filter((F.col("key_alias") == alias) & (F.col("key_version") == version))
    if pinned.limit(2).count() != 1:
        raise Refused("the keyring holds no single key of that alias and version")
    to = pinned.select("_key").scalar()
    by = ["key_alias", "key_version"]
    joined = lookup_join(envelopes, keys, by).withColumn("_to", to)
    context, aad = F.col("context"), F.col("aad")
    opened = joined.withColumn("_plain", unseal(F.col("ciphertext"), F.col("_key"), context, aad))
    # Through a generator: the replacement has a random nonce and must be made only once.
    made = F.when(F.col("_plain").isNotNull(), seal(F.col("_plain"), F.col("_to"), context, aad))
    sealed = opened.select("*", F.explode(F.array(made)).alias("_new")).withColumn(
        "_again", unseal(F.col("_new"), F.col("_to"), context, aad)
    )
    reason = first_reason(
        (F.col("key_version") < 1, "invalid_version"),
        (F.octet_length("ciphertext") > CIPHERTEXT_BYTES, "ciphertext_too_large"),
        (F.col("_key").isNull(), "unknown_key"),
        (F.col("_plain").isNull(), "not_authentic"),
        (F.octet_length("_new") > CIPHERTEXT_BYTES, "ciphertext_too_large"),
        (~F.col("_again").eqNullSafe(F.col("_plain")), "replacement_differs"),
    )
    good = F.col("reject_reason").isNull()
    return sealed.withColumn("reject_reason", reason).select(
        "id",
        "profile",
        F.when(good, F.lit(alias)).otherwise(F.col("key_alias")).alias("key_alias"),
        F.when(good, F.lit(version)).otherwise(F.col("key_version")).alias("key_version"),
        F.when(good, F.col("_new")).otherwise(F.col("ciphertext")).alias("ciphertext"),
        "context",
        "aad",
        "reject_reason",
    )
