"""Exact resource keys: admission, hashes and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.verdicts import first_reason

# Byte limits of the key model.
KIND_BYTES = 128
ID_BYTES = 1024

KEY_TAG = "revtide/key/v1"


def framed(col: Column) -> Column:
    """Length-framed UTF-8 bytes (four-byte big-endian length), so no separator is needed."""
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(col)), 8, "0")), col.cast("binary"))


def tagged(tag: str) -> Column:
    return F.lit(bytearray(tag.encode()))


def key_hash(kind: Column, id: Column) -> Column:
    """SHA-256 (hex) of the framed kind and id."""
    return F.sha2(F.concat(tagged(KEY_TAG), framed(kind), framed(id)), 256)


def key_uuid(kind: Column, id: Column) -> Column:
    """UUID version 8 from the first 16 bytes of the key hash."""
    digest = key_hash(kind, id)
    # The variant nibble is 10xx: the low two bits of the hash survive.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-8"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def identifier_faults(col: Column, limit: int, name: str) -> list[tuple[Column, str]]:
    """Rules for a non-empty identifier of at most ``limit`` bytes without NUL."""
    return [
        (col.isNull() | (F.octet_length(col) == 0), f"{name}_empty"),
        (F.octet_length(col) > limit, f"{name}_too_large"),
        (F.instr(col, "\0") > 0, f"{name}_nul"),
    ]


def key_reject_reason(kind: Column, id: Column, revision: Column, position: Column) -> Column:
    return first_reason(
        *identifier_faults(kind, KIND_BYTES, "kind"),
        *identifier_faults(id, ID_BYTES, "id"),
        (revision.isNull() | (revision < 1), "revision_invalid"),
        (position.isNull() | (position < 1), "position_invalid"),
    )


def admit_keys(df: DataFrame) -> DataFrame:
    """Add ``reject_reason`` for kind, id, revision and position."""
    reason = key_reject_reason(
        F.col("kind"), F.col("id"), F.col("revision"), F.col("position")
    )
    return df.withColumn("reject_reason", reason)
