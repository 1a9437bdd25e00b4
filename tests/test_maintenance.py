import bisect
import random
import pytest
from pyspark.sql import functions as F

from revtide.operators.maintenance import (
    archive_counts,
    migrate_rows,
    migration_preview,
    rekey_envelopes,
    restore_snapshot,
    seal,
    unseal,
)
from revtide.operators.telemetry import (
    abandoned_operations,
    duration_percentiles,
    duration_sketches,
    duration_histogram,
    latest_status,
    operation_counts,
    rejected_observations,
)
from revtide.sources.journal import check_generation
from revtide.sources.snapshots import publish_snapshot
from revtide.verdicts import Refused


def test_archive_and_migration_counts(spark):
    kinds = spark.createDataFrame([("rows",)] * 3 + [("work",), ("odd",)], "record_type string")
    counts = archive_counts(kinds).first()
    assert (counts["rows"], counts["work"], counts["events"]) == (3, 1, 0)
    schema = "kind string, version int"
    before = spark.createDataFrame([("a", 1), ("b", 1)], schema)
    after = spark.createDataFrame([("a", 2), ("b", 1), ("c", 1)], schema)
    receipts = spark.createDataFrame([("a", 1)] * 5 + [("a", 2), ("b", 1), ("gone", 1)], schema)
    preview = migration_preview(before, after, receipts).first()
    assert (preview.changed_schemas, preview.historical_receipts) == (2, 5)


def test_migration_is_pure_and_fresh(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "1", 1, "x"), ("a", "2", 1, None), ("b", "3", 1, "y")],
        "kind string, id string, version int, value string",
    )
    path = str(tmp_path / "m")
    out = migrate_rows(rows, {"a": (2, F.upper)}, path)
    want = [("1", 2, "X"), ("2", 1, None), ("3", 1, "y")]
    assert sorted((r.id, r.version, r.value) for r in out.collect()) == want
    assert sorted((r.id, r.version, r.value) for r in spark.read.parquet(path).collect()) == want
    with pytest.raises(Exception, match="(?i)exist"):
        migrate_rows(rows, {}, path)


def test_restore_changes_the_generation(spark, tmp_path):
    rows = spark.createDataFrame(
        [("k", "g1", 1, "a", 1)], "kind string, generation string, position long, id string, revision long"
    )
    saved, fresh = str(tmp_path / "s"), str(tmp_path / "r")
    publish_snapshot(rows, saved)
    restored = restore_snapshot(spark, saved, fresh, "g2")
    assert check_generation(restored, "k", "g1").first().status == "gap"
    assert check_generation(restored, "k", "g2").first().status == "ok"
    with pytest.raises(Refused):
        restore_snapshot(spark, saved, str(tmp_path / "x"), "g1")
    with pytest.raises(Exception, match="(?i)exist"):
        restore_snapshot(spark, saved, fresh, "g3")


def test_rekeying(spark):
    keyring = spark.createDataFrame(
        [("k", 1, bytearray(b"1" * 32)), ("k", 2, bytearray(b"2" * 32)), ("j", 1, bytearray(b"3" * 32))],
        "key_alias string, key_version long, key binary",
    )
    plain = spark.createDataFrame(
        [("a", "k", 1, "s1", "c1", "x1"), ("b", "j", 1, "s2", "c2", "x2"), ("tampered", "k", 1, "s3", "c3", "x3"),
         ("lost", "k", 1, "s4", "c4", "x4")],
        "id string, key_alias string, key_version long, secret string, context string, aad string",
    )
    base = plain.join(keyring, ["key_alias", "key_version"])
    sealed = base.select(
        "id", F.lit("p").alias("profile"), "key_alias",
        F.when(F.col("id") == "lost", 7).otherwise(F.col("key_version")).cast("long").alias("key_version"),
        seal(
            F.col("secret").cast("binary"), F.col("key"), F.col("context").cast("binary"),
            F.col("aad").cast("binary"),
        ).alias("ciphertext"),
        F.col("context").cast("binary").alias("context"),
        F.when(F.col("id") == "tampered", "no").otherwise(F.col("aad")).cast("binary").alias("aad"),
    )
    moved = rekey_envelopes(sealed, keyring, "k", 2)
    opened = moved.join(keyring, ["key_alias", "key_version"], "left").withColumn(
        "plain", unseal(F.col("ciphertext"), F.col("key"), F.col("context"), F.col("aad")).cast("string")
    )
    out = {r.id: (r.key_alias, r.key_version, r.profile, r.plain, r.reject_reason) for r in opened.collect()}
    assert out == {
        "a": ("k", 2, "p", "s1", None), "b": ("k", 2, "p", "s2", None),
        "tampered": ("k", 1, "p", None, "not_authentic"), "lost": ("k", 7, "p", None, "unknown_key"),
    }
    for alias, version in (("k", 9), ("k", 0), ("none", 1)):
        with pytest.raises(Refused):
            rekey_envelopes(sealed, keyring, alias, version)


def test_keys_stay_out_of_the_plan(spark):
    keyring = spark.createDataFrame(
        [("k", 1, bytearray(b"K" * 32))], "key_alias string, key_version long, key binary"
    )
    rows = spark.createDataFrame(
        [("a", "p", "k", 1, "x", bytearray(b"c"), bytearray(b"d"))],
        "id string, profile string, key_alias string, key_version long, ciphertext string, context binary, aad binary",
    )
    plan = rekey_envelopes(rows, keyring, "k", 1)._jdf.queryExecution().toString()
    assert "KKKK" not in plan and "4B4B4B4B" not in plan.upper()


def test_outcomes_stay_distinct(spark):
    rows = [("work", r, d) for r, d in (
        ("unknown", 0.5), ("not_committed", 2.0), ("accepted", 20.0), ("accepted", 0.1), ("misc", 1.0),
        (None, 1.0), ("closed", 1.0), ("ok", -1.0), ("ok", float("inf")))] + [("other", "ok", 1.0)]
    frame = spark.createDataFrame(rows, "operation string, result string, duration_s double")
    counts = {(r.operation, r.outcome): r.n for r in operation_counts(frame).collect()}
    assert counts == {
        ("work", "unknown"): 1, ("work", "not_committed"): 1, ("work", "accepted"): 2,
        ("work", "rejected"): 2, ("work", "unavailable"): 1, ("work", "success"): 2,
    }
    hist = {r.outcome: r for r in duration_histogram(frame, [1.0, 10.0]).collect()}
    assert "success" not in hist
    assert (hist["accepted"].n, hist["accepted"].le_0, hist["accepted"].le_1) == (2, 1, 1)
    assert (hist["not_committed"].le_0, hist["not_committed"].le_1) == (0, 1)


def test_failed_samples_keep_the_last_known(spark):
    counts = ["owned_work", "action_permits", "io_permits", "subscription_permits",
              "registered_resources", "registered_reactions", "registered_channels"]
    schema = "ts long, ok boolean, ready boolean, failed boolean, intake string, " + ", ".join(f"{c} long" for c in counts)
    good = (1, True, True, False, "open", 4, 5, 6, 7, 8, 9, 10)
    bad = (2, False, None, None, None, *[None] * 7)
    odd = (3, True, False, True, "stopped", -1, 5, 6, 7, 8, 9, 10)

    def status(*rows):
        out = latest_status(spark.createDataFrame(list(rows), schema)).collect()
        return {(r.instrument, r.label): r.value for r in out}

    first = status(good)
    assert first["available", ""] == 1 and first["status_failures", ""] == 0
    assert first["intake", "open"] == 1 and first["intake", "stopped"] == 0 and first["permits", "io"] == 6
    later = status(good, bad, odd)
    assert later.pop(("available", "")) == 0 and later.pop(("status_failures", "")) == 2
    assert later.items() <= first.items() and len(later) == len(first) - 2
    assert status(bad) == {("available", ""): 0, ("status_failures", ""): 1}


def test_lost_operations_count_once(spark):
    starts = spark.createDataFrame(
        [("a", "work", 0), ("a", "work", 0), ("b", "work", 0), ("c", "query", 0), ("d", "query", 95)],
        "observation string, operation string, ts long",
    )
    finishes = spark.createDataFrame(
        [("a", "ok", 5), ("a", "denied", 6), ("b", "ok", 50)], "observation string, result string, ts long"
    )
    out = abandoned_operations(starts, finishes, 10, 100).collect()
    assert sorted((r.observation, r.outcome) for r in out) == [
        ("a", "success"), ("b", "abandoned"), ("c", "abandoned"), ("d", "open"),
    ]


def test_a_finish_before_its_start_does_not_count(spark):
    starts = spark.createDataFrame([(1, "query", 1000)], "observation long, operation string, ts long")
    finishes = spark.createDataFrame([(1, "denied", 10), (1, "ok", 1010)], "observation long, result string, ts long")
    assert abandoned_operations(starts, finishes, 60, 5000).first().outcome == "success"
    assert abandoned_operations(starts, finishes.limit(1), 60, 5000).first().outcome == "abandoned"


def test_observations_left_out_are_counted(spark):
    rows = [("query", 1.0), ("other", 1.0), (None, 1.0), ("work", -1.0), ("work", float("nan")), ("work", None)]
    frame = spark.createDataFrame(rows, "operation string, duration_s double")
    assert {r.reject_reason: r.n for r in rejected_observations(frame).collect()} == {
        "unknown_operation": 2, "duration_invalid": 3,
    }


def test_a_restored_snapshot_is_validated_whole(spark, tmp_path):
    columns = "kind string, id string, position long, revision long, generation string"
    good = [("k", "a", 1, 1, "g"), ("k", "a", 2, 2, "g")]
    bad = [[*good, ("k", "b", 2, 1, "g")], [("k", "a", 0, 1, "g")], [("k", "a", 1, 1, None)], [("k", "a", None, 1, "g")]]
    for n, rows in enumerate([good, *bad]):
        source = str(tmp_path / f"s{n}")
        publish_snapshot(spark.createDataFrame(rows, columns), source)
        if rows is good:
            assert restore_snapshot(spark, source, str(tmp_path / "d"), "h").count() == 2
        else:
            with pytest.raises(Refused):
                restore_snapshot(spark, source, str(tmp_path / f"d{n}"), "h")


def test_a_replacement_opens_to_the_same_text(spark):
    keys = spark.createDataFrame([("a", 1, bytes(32)), ("b", 2, bytes([5]) * 32)], "key_alias string, key_version int, key binary")
    plain = spark.createDataFrame([("x", b"secret", b"c", b"d")], "id string, plain binary, context binary, aad binary")
    sealed = plain.select(
        "id", F.lit("p").alias("profile"), F.lit("a").alias("key_alias"), F.lit(1).alias("key_version"),
        seal(F.col("plain"), F.lit(bytes(32)), F.col("context"), F.col("aad")).alias("ciphertext"), "context", "aad",
    )
    row = rekey_envelopes(sealed, keys, "b", 2)
    opened = row.select("reject_reason", unseal(F.col("ciphertext"), F.lit(bytes([5]) * 32), F.col("context"), F.col("aad")).alias("p")).first()
    assert opened.reject_reason is None and bytes(opened.p) == b"secret"


def test_sketches_of_hours_merge_to_close_percentiles(spark):
    draw = random.Random(8)
    rows = [(n % 7, "work", "ok", draw.paretovariate(0.8)) for n in range(30_000)]
    rows += [(1, "odd", "ok", 1.0), (1, "work", "ok", None), (1, "work", "ok", -1.0), (1, "work", "ok", float("nan")), (2, "query", "denied", 3.5)]
    frame = spark.createDataFrame(rows, "hour int, operation string, result string, duration_s double").repartition(5)
    hourly = duration_sketches(frame)
    assert hourly.count() == 8
    got = {(r.operation, r.share): (r.n, r.duration_s) for r in duration_percentiles(hourly, [0.01, 0.5, 0.99]).collect()}
    values = sorted(r[3] for r in rows[:30_000])
    for share in (0.01, 0.5, 0.99):
        n, found = got["work", share]
        assert n == 30_000 and abs(bisect.bisect_left(values, found) / n - share) < 0.01
        assert got["query", share] == (1, 3.5)
    some = duration_percentiles(hourly.filter("hour < 3"), [0.5]).filter("operation = 'work'").first()
    part = sorted(r[3] for r in rows[:30_000] if r[0] < 3)
    assert some.n == len(part) and abs(bisect.bisect_left(part, some.duration_s) / len(part) - 0.5) < 0.01
    assert duration_percentiles(hourly.limit(0), [0.5]).count() == 0
