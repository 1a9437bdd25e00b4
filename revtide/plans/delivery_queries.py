"""Outbox queries over conversations, events and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from revtide.operators.outbox import (
    admit_notifications,
    classify_outcomes,
    dedupe_deliveries,
    prepare_outbox,
    sign_outbox,
)
from revtide.plans.registry import query
from revtide.plans.tables import table, text
from revtide.sources.outbox_sink import outbox_records


def _deliveries(spark, sf_dir):
    """One delivery per turn; the id of every seventeenth conversation is malformed."""
    c, t = F.col("conv_id"), F.col("turn")
    bad = F.when(c % 17 == 3, ".").otherwise("-")
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), text("conv_id"), bad, text("turn")).alias("id"),
        (t % 3 + 1).alias("attempt"),
        "role",
        "text",
    )


_PREPARED_SQL = """
  SELECT 'c' || CAST(conv_id AS VARCHAR) || CASE WHEN conv_id % 17 = 3 THEN '.' ELSE '-' END
           || CAST(turn AS VARCHAR) AS id, turn % 3 + 1 AS attempt,
         CAST(to_json({'role': role, 'text': text}) AS VARCHAR) AS body
  FROM conversations
"""


def _prepared(spark, sf_dir, limit=400):
    return prepare_outbox(_deliveries(spark, sf_dir), F.struct("role", "text"), limit)


@query(
    "outbox_prepared",
    f"""SELECT id, attempt, strlen(body) AS body_bytes,
      CASE WHEN NOT regexp_full_match(id, '[A-Za-z0-9_-]+') OR strlen(body) > 400 THEN NULL
           ELSE body END AS body,
      CASE WHEN NOT regexp_full_match(id, '[A-Za-z0-9_-]+') OR strlen(body) > 400
           THEN 'permanent' END AS outcome,
      CASE WHEN NOT regexp_full_match(id, '[A-Za-z0-9_-]+') THEN 'invalid_identity'
           WHEN strlen(body) > 400 THEN 'payload_too_large' END AS reject_reason
    FROM ({_PREPARED_SQL})""",
)
def outbox_prepared(spark, sf_dir):
    return _prepared(spark, sf_dir)


@query(
    "outbox_records",
    f"""SELECT id AS key, sha256(body) AS value_digest, 'content-type' AS header
    FROM ({_PREPARED_SQL})
    WHERE regexp_full_match(id, '[A-Za-z0-9_-]+') AND strlen(body) <= 400""",
)
def outbox_log_records(spark, sf_dir):
    """The records a partitioned log would be sent."""
    records = outbox_records(_prepared(spark, sf_dir))
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.sha2("value", 256).alias("value_digest"),
        F.col("headers")[0]["key"].alias("header"),
    )


def _mac_sql(byte: int, message: str) -> str:
    """HMAC-SHA256 by its definition, for a key of 32 equal bytes."""
    inner = f"{byte ^ 0x36:02x}" * 32 + "36" * 32
    outer = f"{byte ^ 0x5C:02x}" * 32 + "5c" * 32
    first = f"from_hex(sha256(from_hex('{inner}') || encode({message})))"
    return f"'v1,' || base64(from_hex(sha256(from_hex('{outer}') || {first})))"


_MESSAGE = "id || '.' || CAST(1800000000 + attempt AS VARCHAR) || '.' || body"


@query(
    "outbox_signed",
    f"""SELECT id, attempt, {_mac_sql(7, _MESSAGE)} || ' ' || {_mac_sql(9, _MESSAGE)} AS signature
    FROM ({_PREPARED_SQL})
    WHERE regexp_full_match(id, '[A-Za-z0-9_-]+') AND strlen(body) <= 65536""",
)
def outbox_signed(spark, sf_dir):
    """Both signatures of a key rotation over every delivery that can be sent."""
    ready = _prepared(spark, sf_dir, 65_536).filter("reject_reason IS NULL")
    timed = ready.withColumn("timestamp", F.lit(1_800_000_000) + F.col("attempt"))
    signed = sign_outbox(timed, bytes([7]) * 32, bytes([9]) * 32)
    return signed.select("id", "attempt", "signature")


@query(
    "delivery_outcomes",
    """WITH a AS (SELECT conv_id, turn, (conv_id + turn) % 5 AS ch,
        (conv_id * 31 + turn * 17) % 600 AS n FROM conversations)
    SELECT conv_id, turn, CASE
      WHEN ch = 0 THEN CASE WHEN n BETWEEN 200 AND 299 THEN 'accepted'
        WHEN n IN (408, 425, 429) OR n >= 500 THEN 'unknown'
        WHEN n BETWEEN 300 AND 499 THEN 'permanent' ELSE 'unknown' END
      WHEN ch = 1 THEN CASE WHEN n % 7 - 1 >= 0 AND n - 50 >= 0 THEN 'accepted' ELSE 'unknown' END
      WHEN ch = 2 THEN CASE WHEN n % 3 = 0 THEN 'unknown' WHEN n % 3 = 1 THEN 'accepted'
        WHEN n % 2 = 0 THEN 'retryable' ELSE 'unknown' END
      WHEN ch = 3 THEN CASE WHEN n % 4 <> 0 AND n - 50 > 0 THEN 'accepted' ELSE 'unknown' END
      ELSE CASE WHEN n % 4 = 0 THEN 'accepted' WHEN n % 4 = 1 THEN 'retryable'
        WHEN n % 4 = 2 THEN 'permanent' ELSE 'unknown' END END AS outcome
    FROM a""",
)
def delivery_outcomes(spark, sf_dir):
    """Attempts over all five channels."""
    n, ch = F.col("n"), F.col("ch")
    attempts = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        ((F.col("conv_id") + F.col("turn")) % 5).alias("ch"),
        ((F.col("conv_id") * 31 + F.col("turn") * 17) % 600).alias("n"),
    )
    names = F.array(*[F.lit(c) for c in ("http", "log", "queue", "stream", "mail")])
    replies = F.array(F.lit(250), F.lit(421), F.lit(550), F.lit(354))
    returned = F.when(n % 3 == 2, F.when(n % 2 == 0, 312).otherwise(313))
    status = (
        F.when(ch == 0, n)
        .when(ch == 2, returned)
        .when(ch == 4, F.get(replies, (n % 4).cast("int")))
    )
    table_of_attempts = attempts.select(
        "conv_id",
        "turn",
        F.get(names, ch.cast("int")).alias("channel"),
        status.alias("status"),
        (n % 7 - 1).alias("partition"),
        (n - 50).alias("offset"),
        (n % 3 != 0).alias("acknowledged"),
        F.when(n % 4 == 0, "other").otherwise("main").alias("acknowledged_by"),
        F.lit("main").alias("expected"),
    )
    return classify_outcomes(table_of_attempts).select("conv_id", "turn", "outcome")


@query(
    "deliveries_deduped",
    """WITH RECURSIVE d AS (SELECT 'u' || CAST(user_id % 7 AS VARCHAR) AS id,
        event_id * 37 % 50000 AS ts, min(event_id) AS attempt FROM events GROUP BY 1, 2),
    kept(id, ts) AS (
      SELECT id, min(ts) FROM d GROUP BY id
      UNION ALL
      SELECT id, ts FROM (
        SELECT k.id, (SELECT min(d.ts) FROM d WHERE d.id = k.id AND d.ts >= k.ts + 300) AS ts
        FROM kept k) WHERE ts IS NOT NULL)
    SELECT id, ts, attempt FROM kept JOIN d USING (id, ts)""",
)
def deliveries_deduped(spark, sf_dir):
    """Seven busy ids: the first message, then the first one at least 300 s later."""
    sent = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), text(F.col("user_id") % 7)).alias("id"),
        (F.col("event_id") * 37 % 50000).alias("ts"),
        F.col("event_id").alias("attempt"),
    )
    return dedupe_deliveries(sent, 300)


@query(
    "deliveries_deduped_day",
    """WITH RECURSIVE d AS (
      SELECT CASE WHEN event_id % 2 = 0 THEN 'hot' ELSE 'u' || CAST(user_id % 7 AS VARCHAR) END AS id,
        event_id * 97 AS ts, min(event_id) AS attempt FROM events GROUP BY 1, 2),
    kept(id, ts) AS (
      SELECT id, min(ts) FROM d GROUP BY id
      UNION ALL
      SELECT id, ts FROM (
        SELECT k.id, (SELECT min(d.ts) FROM d WHERE d.id = k.id AND d.ts >= k.ts + 86400) AS ts
        FROM kept k) WHERE ts IS NOT NULL)
    SELECT id, ts, attempt FROM kept JOIN d USING (id, ts)""",
)
def deliveries_deduped_day(spark, sf_dir):
    """A window of a day over seconds that grow with the table; one id has half of all rows."""
    event = F.col("event_id")
    sent = table(spark, sf_dir, "events").select(
        F.when(event % 2 == 0, "hot").otherwise(F.concat(F.lit("u"), text(F.col("user_id") % 7))).alias("id"),
        (event * 97).alias("ts"),
        event.alias("attempt"),
    )
    return dedupe_deliveries(sent, 86_400)


@query(
    "notifications_admitted",
    """WITH n AS (SELECT c_custkey, 'n' || CAST(c_custkey AS VARCHAR) AS id, c_custkey % 23 AS m,
        c_custkey IN (SELECT s_suppkey FROM supplier) AS known FROM customer)
    SELECT id, CASE WHEN m = 1 THEN 'invalid_mailbox' WHEN m = 2 THEN 'subject_too_large'
        WHEN m = 3 THEN 'invalid_subject' WHEN m = 4 THEN 'invalid_text'
        WHEN m = 5 THEN 'invalid_time' WHEN NOT known THEN 'recipient_denied' END AS reject_reason,
      CASE WHEN m NOT IN (1, 2, 3, 4, 5) AND known
           THEN '<' || sha256(id) || '@mail.example.org>' END AS message_id
    FROM n""",
)
def notifications_admitted(spark, sf_dir):
    """One notification per customer; suppliers' mailboxes are the approved ones."""
    m = F.col("c_custkey") % 23
    mailbox = F.concat(F.lit("user."), text("c_custkey"), F.lit("@example.org"))
    asked = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("n"), text("c_custkey")).alias("id"),
        F.when(m == 1, F.concat(F.lit(".user"), text("c_custkey"), F.lit("@example.org")))
        .otherwise(mailbox)
        .alias("recipient"),
        F.when(m == 2, F.repeat(F.lit("ä"), 257))
        .when(m == 3, F.concat("c_name", F.lit("\n")))
        .otherwise(F.col("c_name"))
        .alias("subject"),
        F.when(m == 4, F.lit("line\rline"))
        .otherwise(F.concat(F.lit("Dear\r\n\t"), F.col("c_name"), F.lit("\n")))
        .alias("text"),
        F.when(m == 5, F.lit(4_102_444_801)).otherwise(F.col("c_custkey") * 1000).alias("created"),
    )
    approved = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("user."), text("s_suppkey"), F.lit("@example.org")).alias("recipient")
    )
    return admit_notifications(asked, approved, "mail.example.org").select(
        "id", "reject_reason", "message_id"
    )
