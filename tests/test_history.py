import itertools
import random

import pytest
from pyspark.sql import functions as F

from revtide.operators.history import (
    all_ok,
    check_history,
    fold_latest,
    folded_with_breaks,
    latest,
    merge_key_state,
    page_verdict,
    reconcile,
    replay_buckets,
    replay_matches,
    revision_conflicts,
)
from revtide.operators.ordering import adjacent_pairs
from revtide.sources.journal import check_generation, read_journal
from revtide.verdicts import Refused, require_ok

OPS = "kind string, id string, position long, revision long, tombstone boolean, digest string"


def ops(spark, *rows):
    full = [("k", i, p, r, t, d) for i, p, r, t, d in rows]
    return spark.createDataFrame(full, OPS)


def rows(frame, *cols):
    return sorted(tuple(r) for r in frame.select(*cols).collect())


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_neighbours_across_chunks_equal_a_plain_lag(spark, chunk):
    rng = random.Random(chunk)
    data, expected, last = [], [], {}
    for at in range(400):
        # One key holds most of the rows.
        key = "hot" if rng.random() < 0.7 else f"k{rng.randrange(20)}"
        data.append((key, at * 2, rng.randrange(5)))
        if key in last:
            expected.append((key, last[key], at * 2))
        last[key] = at * 2
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "key string, at long, v int").repartition(5)
    pairs = adjacent_pairs(frame, ["key"], "at", ["at", "v"], chunk)
    assert rows(pairs, "key", "prev.at", "cur.at") == sorted(expected)


def test_conflicts(spark):
    log = ops(
        spark,
        ("a", 1, 2, False, "x"), ("a", 3, 1, False, "x"),
        ("b", 1, 2, False, "x"), ("b", 3, 2, False, "y"),
        ("c", 1, 2, False, "x"), ("c", 3, 2, True, "x"),
        ("d", 1, 2, False, "x"), ("d", 3, 2, False, "x"), ("d", 4, 3, True, "z"),
    )
    for chunk in (1, 2, 100):
        found = rows(revision_conflicts(log, chunk), "id", "fault")
        assert found == [
            ("a", "revision_regressed"), ("b", "content_changed"), ("c", "content_changed"),
        ]


def test_fold_does_not_depend_on_row_order(spark):
    log = [("a", 1, 1, False, "x"), ("a", 5, 3, True, "z"), ("a", 3, 3, True, "z"), ("b", 2, 1, False, "q")]
    for order in itertools.islice(itertools.permutations(log), 0, 24, 7):
        latest = fold_latest(ops(spark, *order).repartition(3)).latest
        assert rows(latest, "id", "position", "revision") == [("a", 5, 3), ("b", 2, 1)]


def test_keys_are_not_joined_by_a_separator(spark):
    data = [("a:b", "c", 1, 1, False, "x"), ("a", "b:c", 2, 1, False, "x"), ("a", "B:c", 3, 1, False, "x")]
    assert fold_latest(spark.createDataFrame(data, OPS)).latest.count() == 3


def test_replay_of_the_old_interval_ignores_the_overrun(spark):
    log = ops(
        spark, ("a", 2, 1, False, "x"), ("a", 4, 2, True, "y"), ("a", 8, 3, False, "z")
    )
    intent = ops(spark, ("a", 4, 2, True, "y"))
    assert replay_matches(log, intent, 0, 5, inspected_end=10).first().status == "ok"
    assert replay_matches(log, intent, 0, 5, inspected_end=4).first().status == "history_gap"
    other = ops(spark, ("a", 4, 2, True, "w"))
    verdict = replay_matches(log, other, 0, 5, inspected_end=10)
    assert verdict.first().status == "rebuild_required"
    with pytest.raises(Refused):
        require_ok(verdict)


def test_replay_refuses_conflicting_revisions(spark):
    log = ops(spark, ("a", 1, 2, False, "x"), ("a", 3, 1, False, "x"))
    assert replay_matches(log, log.limit(0), 0, 5).first().status == "history_gap"
    verdict = replay_matches(log, log.filter("position = 1"), 0, 3).first()
    assert (verdict.status, verdict.conflicts) == ("rebuild_required", 1)


def test_malformed_overrun_is_found(spark):
    batch = spark.createDataFrame(
        [("k", "g", "a", p, 1, n) for n, p in enumerate((2, 6, 5))],
        "kind string, generation string, id string, position long, revision long, arrival long",
    )
    assert rows(check_history(batch, "k", "g", 0, 8, chunk=2), "position", "fault") == [
        (5, "not_ascending")
    ]
    faults = check_history(batch, "k", "other", 0, 5)
    assert {r.fault for r in faults.collect()} == {"foreign_generation", "not_ascending"}


def test_merge_is_monotonic(spark):
    state = ops(spark, ("a", 1, 5, False, "x"), ("b", 2, 5, False, "x"), ("c", 3, 1, False, "x"))
    page = ops(
        spark, ("a", 9, 4, False, "x"), ("b", 9, 5, True, "x"), ("c", 9, 2, True, "y"),
        ("d", 9, 1, False, "n"),
    )
    merged = merge_key_state(state, page)
    assert rows(merged, "id", "revision", "status") == [
        ("a", 5, "conflict"), ("b", 5, "conflict"), ("c", 2, "advanced"), ("d", 1, "inserted"),
    ]
    assert page_verdict(merged).first().status == "conflict"
    again = merge_key_state(state, state)
    assert {r.status for r in again.collect()} == {"repeated"}


def test_an_acknowledged_write_is_no_evidence(spark):
    intent = ops(spark, ("a", 1, 2, False, "x"), ("b", 2, 1, True, "y"))
    nothing = intent.limit(0).withColumn("profile", F.lit("p")).withColumn("target", F.lit("t"))
    lost = reconcile(intent, nothing, "p", "t")
    assert {r.status for r in lost.collect()} == {"missing"}
    assert all_ok(lost).first().status == "mismatch"
    kept = intent.withColumn("profile", F.lit("p")).withColumn("target", F.lit("t"))
    assert all_ok(reconcile(intent, kept, "p", "t")).first().status == "ok"
    assert {r.status for r in reconcile(intent, kept, "p", "u").collect()} == {"foreign"}


def test_generation_gap(spark):
    journal = spark.createDataFrame(
        [("k", "g1", 1, "a", 1), ("k", "g1", 2, "b", 1), ("j", "g9", 7, "c", 1)],
        "kind string, generation string, position long, id string, revision long",
    )
    assert check_generation(journal, "k", "g1").first().status == "ok"
    assert check_generation(journal, "k", "g0").first().status == "gap"
    assert read_journal(journal, "k", "g1", 1).count() == 1
    assert read_journal(journal, "k", "g1", 0, 1).count() == 1


def chain_breaks(history):
    """Breaks along one key by walking it."""
    found, before = 0, None
    for position, revision, tombstone, digest in sorted(history):
        if before and (revision < before[0] or (revision == before[0] and (tombstone, digest) != before[1:])):
            found += 1
        before = (revision, tombstone, digest)
    return found


@pytest.mark.parametrize("chunk", [1, 7, 1_000_000])
def test_fold_with_breaks_equals_a_walk(spark, chunk):
    draw = random.Random(chunk)
    log = [
        (draw.choice(["hot", "hot", "a", "b"]), p, draw.randrange(1, 40) if draw.random() < 0.3 else p // 3 + 1, draw.random() < 0.2, draw.choice("xy"))
        for p in draw.sample(range(1, 400), 250)
    ]
    got = {r.id: (r.position, r.revision, r.tombstone, r.digest, r.breaks) for r in folded_with_breaks(ops(spark, *log).repartition(3), chunk).collect()}
    for key in {r[0] for r in log}:
        own = [r[1:] for r in log if r[0] == key]
        newest = max(own, key=lambda r: (r[1], r[0]))
        assert got[key] == (*newest, chain_breaks(own))
    broken = sum(v[-1] for v in got.values())
    verdict = replay_matches(ops(spark, *log), latest(ops(spark, *log)), 0, 400, inspected_end=400, chunk=chunk).first()
    assert (verdict.differences, verdict.conflicts) == (0, broken)
    assert revision_conflicts(ops(spark, *log), chunk).count() == broken


def test_buckets_name_the_differing_keys(spark):
    log = [(f"k{n}", n, n, n % 5 == 0, "x") for n in range(1, 60)]
    feed = ops(spark, *log)
    changed = [r if r[0] != "k7" else (*r[:4], "y") for r in log if r[0] != "k9"] + [("new", 99, 99, False, "x"), log[20]]
    intent = ops(spark, *changed)
    by = F.substring("id", -1, 1)
    found = {r.bucket: (r.rebuilt_rows, r.intent_rows, r.conflicts) for r in replay_buckets(feed, intent, 0, 60, by).collect()}
    assert found == {"7": (6, 6, 0), "9": (6, 5, 0), "1": (6, 7, 0), "w": (0, 1, 0)}
    verdict = replay_matches(feed, intent, 0, 60, inspected_end=60, bucket=by).first()
    # k7 twice, k9, the new key, and the repeated row.
    assert (verdict.differences, verdict.status) == (5, "rebuild_required")


def test_nulls_in_other_columns_are_told_apart(spark):
    one = ops(spark, ("a", 1, 1, None, "x"))
    two = one.select("kind", "id", "position", "revision", F.lit(False).alias("tombstone"), "digest")
    assert replay_matches(one, two, 0, 1, inspected_end=1).first().differences == 2
    assert replay_matches(one, one, 0, 1, inspected_end=1).first().status == "ok"


def test_a_replay_reads_and_shuffles_the_feed_once(spark, tmp_path):
    log = [(f"k{n % 50}", n, n, False, "x") for n in range(1, 500)]
    ops(spark, *log).write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    latest(feed).write.parquet(str(tmp_path / "intent"))
    verdict = replay_matches(feed, spark.read.parquet(str(tmp_path / "intent")), 0, 500, inspected_end=500)
    assert verdict.collect()[0].status == "ok"
    plan = verdict._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    scans = [part for part in final.split("FileScan parquet")[1:] if "/feed]" in part.split("PushedFilters")[0]]
    assert len(scans) == 1
