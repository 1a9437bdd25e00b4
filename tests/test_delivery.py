import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revtide.operators.outbox import (
    admit_notifications,
    classify_outcomes,
    dedupe_deliveries,
    prepare_outbox,
    sign_outbox,
    unplaced_deliveries,
)
from revtide.sources.outbox_sink import check_topic, outbox_records
from revtide.verdicts import Refused


def test_signature_of_the_published_vector(spark):
    row = spark.createDataFrame(
        [("work-17", 1800000000, "false")], "id string, timestamp long, body string"
    )
    first = "v1,WX/AeAi6pFK/OhodbgM1JIIUf65h5KltwhuSDyu/vKg="
    assert sign_outbox(row, bytes([7]) * 32).first().signature == first
    both = sign_outbox(row, bytes([7]) * 32, bytes([8]) * 32).first().signature.split(" ")
    assert both[0] == first and len(both) == 2 and both[1] != first
    with pytest.raises(Refused):
        sign_outbox(row, b"short")


def test_keys_stay_out_of_the_plan(spark):
    row = spark.createDataFrame([("a", 1, "b")], "id string, timestamp long, body string")
    plan = sign_outbox(row, b"K" * 32)._jdf.queryExecution().toString()
    assert "KKKK" not in plan and (b"K" * 32).hex() not in plan


def test_preparation(spark):
    rows = spark.createDataFrame(
        [("a-1_Z", 1, None), ("", 1, "x"), ("a b", 1, "x"), ("x" * 2048, 1, "x"), ("x" * 2049, 1, "x"),
         (None, 1, "x"), ("long", 2, "y" * 100)],
        "id string, attempt int, text string",
    )
    out = prepare_outbox(rows, F.struct("text"), limit=50).collect()
    assert out[0].body == '{"text":null}' and out[0].outcome is None
    assert [r.reject_reason for r in out] == [
        None, "invalid_identity", "invalid_identity", None, "invalid_identity", "invalid_identity",
        "payload_too_large",
    ]
    assert all(r.outcome == "permanent" and r.body is None for r in out if r.reject_reason)
    bare = prepare_outbox(rows, F.col("text") == "x").collect()
    assert bare[3].body == "true"
    queue = prepare_outbox(rows, F.struct("text"), queue_profile=True).collect()
    assert queue[3].reject_reason == "id_too_large"
    for limit in (0, 1_048_577):
        with pytest.raises(Refused):
            prepare_outbox(rows, F.col("text"), limit)
    record = outbox_records(prepare_outbox(rows, F.struct("text"))).first()
    assert bytes(record.key) == b"a-1_Z" and bytes(record.value) == b'{"text":null}'
    assert record["headers"][0].key == "content-type"


def test_topics():
    assert check_topic("a.b_c-D9") == "a.b_c-D9"
    for bad in ("", ".", "..", "a b", "x" * 250, "ä"):
        with pytest.raises(Refused):
            check_topic(bad)


def test_outcomes(spark):
    cases = [
        ("http", 204, None, None, None, None, "accepted"), ("http", 302, None, None, None, None, "permanent"),
        ("http", 404, None, None, None, None, "permanent"), ("http", 425, None, None, None, None, "unknown"),
        ("http", 503, None, None, None, None, "unknown"), ("http", 100, None, None, None, None, "unknown"),
        ("http", None, None, None, None, None, "unknown"), ("log", None, 0, 0, None, None, "accepted"),
        ("log", None, -1, 4, None, None, "unknown"), ("log", None, None, None, None, None, "unknown"),
        ("queue", None, None, None, True, None, "accepted"), ("queue", 312, None, None, True, None, "retryable"),
        ("queue", 313, None, None, True, None, "unknown"), ("queue", None, None, None, False, None, "unknown"),
        ("stream", None, None, 1, None, "s", "accepted"), ("stream", None, None, 0, None, "s", "unknown"),
        ("stream", None, None, 1, None, "t", "unknown"), ("mail", 250, None, None, None, None, "accepted"),
        ("mail", 421, None, None, None, None, "retryable"), ("mail", 550, None, None, None, None, "permanent"),
        ("mail", 354, None, None, None, None, "unknown"), ("pigeon", 1, None, None, None, None, "unknown"),
    ]
    frame = spark.createDataFrame(
        cases,
        "channel string, status int, partition int, offset long, acknowledged boolean, "
        "acknowledged_by string, want string",
    ).withColumn("expected", F.lit("s"))
    assert [(r.channel, r.outcome) for r in classify_outcomes(frame).collect()] == [
        (c[0], c[-1]) for c in cases
    ]


def kept_by_walking(rows, window):
    out = []
    for key in {r[0] for r in rows}:
        last = None
        for ts in sorted(r[1] for r in rows if r[0] == key):
            if last is None or ts >= last + window:
                out.append((key, ts))
                last = ts
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_dedupe_equals_a_walk(spark, data):
    rng = random.Random(data.draw(st.integers(0, 10**6)))
    window = rng.randrange(1, 30)
    span = rng.choice([None, 1, 5, 40, 200])
    rows = [
        (rng.choice(["hot", "hot", "hot", "a", "b"]), rng.randrange(-300, 700), n) for n in range(250)
    ]
    frame = spark.createDataFrame(rows, "id string, ts long, attempt int")
    got = dedupe_deliveries(frame, window, span=span).collect()
    assert sorted((r.id, r.ts) for r in got) == kept_by_walking(rows, window)
    first = {}
    for key, ts, n in rows:
        first[key, ts] = min(first.get((key, ts), n), n)
    assert all(first[r.id, r.ts] == r.attempt for r in got)


def test_notifications(spark):
    rows = spark.createDataFrame(
        [("n1", "a@example.org", "Hi", "line\r\nnext\tend\n", 0),
         ("n2", "b@example.org", "Hi", "x", 1), ("n3", "a@b@example.org", "Hi", "x", 1),
         ("n4", "a@example.org", "H\u0085i", "x", 1), ("n5", "a@example.org", "Hi", "x\ry", 1),
         ("n6", "a@example.org", "Hi", "x", -1), ("n7", "a@example.org", "", "x", 1),
         ("n8", "a@example.org", "é" * 256, "x", 4102444800), ("n 9", "a@example.org", "Hi", "x", 1),
         ("n10", "é@example.org", "Hi", "x", 1), ("n11", "x" * 65 + "@example.org", "Hi", "x", 1),
         ("n12", "a@example.org", "Hi", "é" * 131073, 1)],
        "id string, recipient string, subject string, text string, created long",
    )
    approved = spark.createDataFrame([("a@example.org",), ("a@example.org",)], "recipient string")
    out = {r.id: r for r in admit_notifications(rows, approved, "m.example.org").collect()}
    assert len(out) == 12
    assert {k: r.reject_reason for k, r in out.items()} == {
        "n1": None, "n2": "recipient_denied", "n3": "invalid_mailbox", "n4": "invalid_subject",
        "n5": "invalid_text", "n6": "invalid_time", "n7": "invalid_subject", "n8": None,
        "n 9": "invalid_identity", "n10": "invalid_mailbox", "n11": "invalid_mailbox",
        "n12": "text_too_large",
    }
    assert out["n1"].message_id.endswith("@m.example.org>") and out["n2"].message_id is None
    with pytest.raises(Refused):
        admit_notifications(rows, approved, "nodots")


def test_a_row_without_id_or_time_is_not_signed(spark):
    rows = spark.createDataFrame(
        [(None, 1, "b"), ("a", None, "b"), ("a", 1, None), ("a", 2**53 + 1, "b")],
        "id string, timestamp long, body string",
    )
    signed = sign_outbox(rows, bytes([7]) * 32).collect()
    assert [r.signature_reason for r in signed] == ["id_missing", "timestamp_missing", "body_missing", None]
    assert [r.signature is None for r in signed] == [True, True, True, False]
    alone = sign_outbox(rows.filter("timestamp > 2"), bytes([7]) * 32).first().signature
    assert signed[3].signature == alone


def test_deliveries_that_cannot_be_placed_are_reported(spark):
    rows = spark.createDataFrame([("a", 1, 1), (None, 1, 1), ("b", None, 1)], "id string, ts long, attempt int")
    assert sorted(r.reject_reason for r in unplaced_deliveries(rows).collect()) == ["id_missing", "ts_missing"]
