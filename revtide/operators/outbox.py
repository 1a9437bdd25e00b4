"""Outbox preparation, signatures, outcome classes, deduplication and notifications."""

from __future__ import annotations

import base64
import hashlib
import hmac
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.operators.joins import lookup_join
from revtide.operators.spacing import spaced
from revtide.verdicts import Refused, first_reason

# Delivery identity, payload limits and the queue profile's shorter id.
ID_PATTERN = r"^[A-Za-z0-9_-]{1,2048}$"
QUEUE_ID_BYTES = 255
DEFAULT_PAYLOAD_BYTES = 65_536
MAX_PAYLOAD_BYTES = 1_048_576

# Notification limits; the time bound is the year 2100 in Unix seconds.
MAILBOX_BYTES = 254
LOCAL_BYTES = 64
SUBJECT_BYTES = 512
TEXT_BYTES = 262_144
MAX_UNIX_SECONDS = 4_102_444_800


def compact_json(payload: Column) -> Column:
    """Compact JSON of any value; wrapping it in an array admits bare strings and numbers."""
    text = F.to_json(F.array(payload), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def prepare_outbox(
    df: DataFrame,
    payload: Column,
    limit: int = DEFAULT_PAYLOAD_BYTES,
    queue_profile: bool = False,
) -> DataFrame:
    """``id, attempt, body, body_bytes, outcome, reject_reason`` per delivery.

    The stable id and the body depend on the delivery only, never on the attempt. A
    delivery that cannot be sent is ``permanent`` and has no body.
    """
    if not 1 <= limit <= MAX_PAYLOAD_BYTES:
        raise Refused("payload limit outside 1..1048576")
    encoded = df.withColumn("body", compact_json(payload)).withColumn(
        "body_bytes", F.octet_length("body").cast("long")
    )
    rules = [(~F.coalesce(F.col("id").rlike(ID_PATTERN), F.lit(False)), "invalid_identity")]
    if queue_profile:
        rules.append((F.octet_length("id") > QUEUE_ID_BYTES, "id_too_large"))
    rules += [
        (F.col("body").isNull(), "invalid_payload"),
        (F.col("body_bytes") > limit, "payload_too_large"),
    ]
    reason = first_reason(*rules)
    return encoded.withColumn("reject_reason", reason).select(
        "id",
        "attempt",
        F.when(F.col("reject_reason").isNull(), F.col("body")).alias("body"),
        "body_bytes",
        F.when(F.col("reject_reason").isNotNull(), "permanent").alias("outcome"),
        "reject_reason",
    )


def sign_outbox(df: DataFrame, current: bytes, previous: bytes | None = None) -> DataFrame:
    """Add ``signature`` over id, Unix ``timestamp`` and body of every prepared row.

    A row without an id, a timestamp or a body has none, and ``signature_reason`` says which
    is missing.

    Keys travel in the function's closure and never appear in a plan. While a previous
    key is active its signature follows, separated by a space.
    """
    keys = [k for k in (current, previous) if k is not None]
    if any(len(k) != 32 for k in keys):
        raise Refused("signing keys have 32 bytes")

    @F.pandas_udf("string")
    def sign(id: pd.Series, timestamp: pd.Series, body: pd.Series) -> pd.Series:
        def one(i, t, b):
            if b is None or i is None or t is None:
                return None
            message = f"{i}.{int(t)}.".encode() + b.encode()
            macs = (hmac.new(k, message, hashlib.sha256).digest() for k in keys)
            return " ".join("v1," + base64.b64encode(m).decode() for m in macs)

        return pd.Series([one(*row) for row in zip(id, timestamp, body)], dtype=object)

    # As text: beside a NULL, whole numbers would reach Python as floats.
    return df.withColumns(
        {
            "signature": sign("id", F.col("timestamp").cast("long").cast("string"), "body"),
            "signature_reason": first_reason(
                (F.col("id").isNull(), "id_missing"),
                (F.col("timestamp").isNull(), "timestamp_missing"),
                (F.col("body").isNull(), "body_missing"),
            ),
        }
    )


def http_outcome(status: Column) -> Column:
    return (
        F.when(status.between(200, 299), "accepted")
        .when(status.isin(408, 425, 429) | status.between(500, 599), "unknown")
        .when(status.between(300, 499), "permanent")
        .otherwise("unknown")
    )


def log_outcome(partition: Column, offset: Column) -> Column:
    """A partitioned log acknowledges with a partition and an offset."""
    return F.when((partition >= 0) & (offset >= 0), "accepted").otherwise("unknown")


def queue_outcome(acknowledged: Column, returned: Column) -> Column:
    """A queue broker acknowledges, and returns code 312 for a message it could not route."""
    return (
        F.when(acknowledged & returned.isNull(), "accepted")
        .when(acknowledged & (returned == 312), "retryable")
        .otherwise("unknown")
    )


def stream_outcome(acknowledged_by: Column, expected: Column, sequence: Column) -> Column:
    """A stream acknowledges with its own name and a positive sequence."""
    return F.when((acknowledged_by == expected) & (sequence > 0), "accepted").otherwise("unknown")


def mail_outcome(reply: Column) -> Column:
    return (
        F.when(reply == 250, "accepted")
        .when(reply.between(400, 499), "retryable")
        .when(reply.between(500, 599), "permanent")
        .otherwise("unknown")
    )


def classify_outcomes(attempts: DataFrame) -> DataFrame:
    """Add ``outcome`` to attempts of any channel.

    Columns by channel: ``http`` and ``mail`` use ``status``; ``log`` uses ``partition`` and
    ``offset``; ``queue`` uses ``acknowledged`` and ``status``; ``stream`` uses
    ``acknowledged_by``, ``expected`` and ``offset``.
    """
    c = F.col
    outcome = (
        F.when(c("channel") == "http", http_outcome(c("status")))
        .when(c("channel") == "mail", mail_outcome(c("status")))
        .when(c("channel") == "log", log_outcome(c("partition"), c("offset")))
        .when(c("channel") == "queue", queue_outcome(c("acknowledged"), c("status")))
        .when(
            c("channel") == "stream",
            stream_outcome(c("acknowledged_by"), c("expected"), c("offset")),
        )
        .otherwise("unknown")
    )
    return attempts.withColumn("outcome", outcome)


def unplaced_deliveries(df: DataFrame) -> DataFrame:
    """Deliveries that deduplication cannot place, with their ``reject_reason``."""
    reason = first_reason((F.col("id").isNull(), "id_missing"), (F.col("ts").isNull(), "ts_missing"))
    return df.withColumn("reject_reason", reason).filter("reject_reason IS NOT NULL")


def dedupe_deliveries(
    df: DataFrame, window: int, order: str = "attempt", span: int | None = None
) -> DataFrame:
    """Deliveries that count: the first per id, then the first at least ``window`` s later.

    Input has ``id``, integer ``ts`` (Unix seconds) and a tie-breaking ``order`` column;
    output is ``id, ts, <order>``. A duplicate does not extend the window. Rows without an id
    or a time cannot be placed; ``unplaced_deliveries`` has them.

    One id may hold most rows and the window may be long: see ``operators.spacing``. ``span``
    is the number of seconds that are walked together.
    """
    if window < 1:
        raise Refused("window must be positive")
    timed = df.filter(F.col("id").isNotNull() & F.col("ts").isNotNull())
    seconds = timed.groupBy("id", F.col("ts").cast("bigint").alias("ts")).agg(F.min(order).alias("first"))
    return spaced(seconds, window, span).withColumnRenamed("first", order)


_MAILBOX = (
    r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
    r"@[A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?(\.[A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?)*$"
)
_DOMAIN_LABEL = r"[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?"


def admit_notifications(df: DataFrame, recipients: DataFrame, domain: str) -> DataFrame:
    """Check one plain-text notification per row and give it a stable ``message_id``.

    Input: ``id, recipient, subject, text, created``; ``recipients`` has ``recipient``, the
    approved mailboxes. Many rows may go to one mailbox; they are spread over tasks.
    """
    if len(domain) > 253 or not re.fullmatch(rf"{_DOMAIN_LABEL}(\.{_DOMAIN_LABEL})+", domain):
        raise Refused("invalid message id domain")
    approved = recipients.select("recipient").distinct().withColumn("_approved", F.lit(True))
    control = r"[\x00-\x1f\x7f-\x9f]"
    # A carriage return is only valid in front of a line feed.
    bad_text = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]|\r(?!\n)"
    local = F.substring_index("recipient", "@", 1)
    reason = first_reason(
        (~F.coalesce(F.col("id").rlike(ID_PATTERN), F.lit(False)), "invalid_identity"),
        (F.octet_length("subject") > SUBJECT_BYTES, "subject_too_large"),
        (F.octet_length("text") > TEXT_BYTES, "text_too_large"),
        (
            (F.octet_length("recipient") > MAILBOX_BYTES)
            | (F.length(local) > LOCAL_BYTES)
            | ~F.coalesce(F.col("recipient").rlike(_MAILBOX), F.lit(False)),
            "invalid_mailbox",
        ),
        (
            F.col("subject").isNull() | (F.col("subject") == "") | F.col("subject").rlike(control),
            "invalid_subject",
        ),
        (F.col("text").isNull() | F.col("text").rlike(bad_text), "invalid_text"),
        (
            F.col("created").isNull() | ~F.col("created").between(0, MAX_UNIX_SECONDS),
            "invalid_time",
        ),
        (F.col("_approved").isNull(), "recipient_denied"),
    )
    message_id = F.concat(F.lit("<"), F.sha2(F.col("id").cast("binary"), 256), F.lit(f"@{domain}>"))
    return (
        lookup_join(df, approved, ["recipient"])
        .withColumn("reject_reason", reason)
        .withColumn("message_id", F.when(F.col("reject_reason").isNull(), message_id))
        .drop("_approved")
    )
