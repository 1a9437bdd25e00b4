import json
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from revtide.operators.history import latest
from revtide.sources.generation import (
    bucket_of_key,
    committed,
    compact,
    delta_path,
    numbered,
    read_generation,
    stored_rows,
    write_delta,
    write_generation,
)
from revtide.operators.telemetry import abandoned_operations
from revtide.sources.journal import JOURNAL, open_journal, read_journal, stream_journal
from revtide.streaming.keyed import abandoned_operations_stream, key_state_stream, use_keyed_state
from revtide.streaming import keyed, projection
from revtide.streaming.projection import RebuildRequired, apply_page, known_states, read_cursors, run_projection
from revtide.streaming.windows import abandoned_stream, dedupe_stream, operation_counts_stream
from revtide.verdicts import Refused

PAGE = "kind string, id string, position long, revision long, tombstone boolean, digest string, v string"


def page(spark, *rows):
    return spark.createDataFrame([("k", *r) for r in rows], PAGE)


def state(spark, path, schema):
    rows = read_generation(spark, path, schema).select("id", "revision", "tombstone", "v").collect()
    return sorted(tuple(r) for r in rows)


def test_generation_keeps_the_greatest_revision(spark, tmp_path):
    path = str(tmp_path / "g")
    first = page(spark, ("a", 1, 5, False, "d", "five"), ("b", 2, 1, False, "d", "one"))
    write_generation(first, path, 0)
    write_generation(page(spark, ("a", 3, 4, False, "d", "four"), ("b", 4, 2, True, "d", None)), path, 1)
    write_generation(page(spark, ("a", 5, 5, False, "e", "again")), path, 2)
    want = [("a", 5, False, "five"), ("b", 2, True, None)]
    assert state(spark, path, first.schema) == want
    assert compact(spark, path, first.schema) == 2
    assert committed(spark, path) == (2, [])
    assert state(spark, path, first.schema) == want
    # A page whose writer died before its end is not seen.
    write_delta(page(spark, ("a", 9, 9, False, "d", "unseen")), path, 3)
    (tmp_path / "g" / "deltas" / "batch_id=3" / "_SUCCESS").unlink()
    assert state(spark, path, first.schema) == want
    write_generation(page(spark, ("b", 9, 3, False, "d", "back")), path, 3)
    assert state(spark, path, first.schema)[1] == ("b", 3, False, "back")


def to_documents(rows):
    return rows.select(
        "kind", "id", "position", "revision", F.col("value").isNull().alias("tombstone"),
        F.sha2(F.coalesce("value", F.lit("")), 256).alias("digest"), "value",
    )


def journal(spark, *rows):
    return spark.createDataFrame([("k", "g", *r) for r in rows], JOURNAL)


def test_a_page_is_safe_to_repeat(spark, tmp_path):
    path = str(tmp_path / "p")
    first = journal(spark, (1, "a", 1, "x"), (2, "b", 1, "y"), (5, "a", 2, None))
    schema = to_documents(first).schema
    for _ in range(2):
        apply_page(first, 0, to_documents, "profile", path)
    assert committed(spark, path) == (None, [0])
    assert read_cursors(spark, path).first().position == 5
    # A crash after the intent and the write, before the commit: the same page resolves it.
    second = journal(spark, (7, "b", 2, "z"))
    apply_page(second, 1, to_documents, "profile", path)
    (tmp_path / "p" / "cursors" / "batch_id=1" / "_SUCCESS").unlink()
    assert read_cursors(spark, path).first().position == 5
    with pytest.raises(RebuildRequired):
        apply_page(journal(spark, (7, "b", 2, "other")), 1, to_documents, "profile", path)
    assert read_cursors(spark, path).first().position == 5
    apply_page(second, 1, to_documents, "profile", path)
    assert committed(spark, path) == (None, [0, 1])
    rows = read_generation(spark, path, schema).collect()
    assert {(r.id, r.revision, r.value) for r in rows} == {("a", 2, None), ("b", 2, "z")}


def test_conflicting_pages_are_refused_whole(spark, tmp_path):
    path = str(tmp_path / "p")
    apply_page(journal(spark, (1, "a", 5, "x")), 0, to_documents, "profile", path)
    for bad in (
        journal(spark, (2, "a", 4, "x"), (3, "b", 1, "n")),
        journal(spark, (2, "a", 5, "other")),
        journal(spark, (2, "c", 2, "x"), (3, "c", 1, "x")),
    ):
        with pytest.raises(Refused):
            apply_page(bad, 1, to_documents, "profile", path)
        assert committed(spark, path) == (None, [0])
    apply_page(journal(spark, (2, "a", 5, "x"), (3, "a", 6, None)), 1, to_documents, "profile", path)
    assert committed(spark, path) == (None, [0, 1])


def test_stream_ends_where_a_fold_ends(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "target")
    rows = [
        (p, f"k{p % 7 if p % 3 else 0}", p * 2, None if p % 5 == 0 else json.dumps({"p": p}))
        for p in range(1, 61)
    ]
    for start in range(0, 60, 20):
        journal(spark, *rows[start : start + 20]).coalesce(1).write.mode("append").parquet(feed)
        run_projection(
            stream_journal(spark, feed, 1), to_documents, "profile", path,
            str(tmp_path / "checkpoint"), once=True, compact_every=2,
        ).awaitTermination()
    documents = to_documents(open_journal(spark, feed))
    got = read_generation(spark, path, documents.schema).select(sorted(documents.columns))
    want = latest(documents).select(sorted(documents.columns))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert read_cursors(spark, path).first().position == 60
    assert committed(spark, path) == (1, [2])


def test_stored_journals_are_read_by_pushed_filters(spark, tmp_path):
    journal(spark, (1, "a", 1, "x"), (2, "b", 1, "y")).write.parquet(str(tmp_path / "j"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    feed = read_journal(open_journal(spark, str(tmp_path / "j")), "k", "g", 1, 9)
    plan = feed.select("id")._jdf.queryExecution().toString()
    for pushed in ("GreaterThan(position,1)", "LessThanOrEqual(position,9)", "EqualTo(kind,k)"):
        assert pushed in plan
    assert "value" not in plan.split("ReadSchema")[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def run_memory(frame, name, mode, tmp_path):
    query = (
        frame.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def test_stream_dedupe_and_counts(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00", "action", "ok"), ("a", "2024-01-01 00:00:30", "action", "odd"),
         ("b", "2024-01-01 00:00:10", "query", "denied")],
        "id string, ts string, operation string, result string",
    ).withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run_memory(dedupe_stream(stream, "2 minutes"), "deduped", "append", tmp_path)
    assert sorted(r.id for r in spark.table("deduped").collect()) == ["a", "b"]
    run_memory(operation_counts_stream(stream), "counted", "update", tmp_path)
    assert {(r.operation, r.outcome, r.n) for r in spark.table("counted").collect()} == {
        ("action", "success", 1), ("action", "rejected", 1), ("query", "denied", 1),
    }


def test_stream_of_lost_operations(spark, tmp_path):
    def write(name, schema, *rows):
        frame = spark.createDataFrame(list(rows), schema).withColumn("ts", F.to_timestamp("ts"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(
            str(tmp_path / name)
        )

    begun = "observation string, operation string, ts string"
    ended = "observation string, result string, ts string"
    starts = write("s", begun, ("a", "work", "2024-01-01 00:00:00"), ("b", "work", "2024-01-01 00:00:00"))
    finishes = write("f", ended, ("a", "ok", "2024-01-01 00:01:00"))
    # Later traffic moves the watermark past the timeout.
    write("s", begun, ("z", "work", "2024-01-01 09:00:00"))
    write("f", ended, ("z", "ok", "2024-01-01 09:00:01"))
    run_memory(abandoned_stream(starts, finishes, "10 minutes"), "lost", "append", tmp_path)
    got = {r.observation: r.outcome for r in spark.table("lost").collect()}
    assert got == {"a": "success", "b": "abandoned", "z": "success"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_page_reads_only_its_keys_buckets(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = [(n, f"k{n}", 1, "x") for n in range(1, 41)]
    apply_page(journal(spark, *rows), 0, to_documents, "profile", path)
    apply_page(journal(spark, (50, "k7", 2, "y"), (51, "k9", 2, "y")), 1, to_documents, "profile", path)
    schema = to_documents(journal(spark, *rows)).schema
    keys = spark.createDataFrame([("k", "k7"), ("k", "k9")], "kind string, id string")
    own = [r[0] for r in keys.select(bucket_of_key()).distinct().collect()]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    states = known_states(spark, path, schema, own)
    plan = plan_of(states)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for n in own:
        assert str(n) in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "value" not in plan.split("ReadSchema")[1]
    read = stored_rows(spark, path, schema, own).select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split("bucket=")[1].split("/")[0]) for r in read} == set(own)
    every = {(r.id, r.revision) for r in known_states(spark, path, schema).collect()}
    assert len(every) == 40 and {("k7", 2), ("k9", 2), ("k8", 1)} <= every
    assert {("k7", 2), ("k9", 2)} <= {(r.id, r.revision) for r in states.collect()} < every
    assert {r.revision for r in known_states(spark, path, schema, own, before=1).collect()} == {1}


def test_compaction_removes_what_the_base_before_it_covers(spark, tmp_path):
    path = str(tmp_path / "g")
    first = page(spark, ("a", 1, 1, False, "d", "one"))
    for n in range(6):
        write_generation(page(spark, (f"k{n}", n + 2, 1, False, "d", str(n)), ("a", 9 + n, n + 2, False, "d", str(n))), path, n)
        if n % 2:
            assert compact(spark, path, first.schema) == n
    assert numbered(spark, f"{path}/base") == [3, 5] and numbered(spark, f"{path}/deltas") == [4, 5]
    assert committed(spark, path) == (5, [])
    assert state(spark, path, first.schema) == [("a", 7, False, "5"), *((f"k{n}", 1, False, str(n)) for n in range(6))]


def test_cursors_carry_every_kind_and_old_pages_cannot_return(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(projection, "KEPT_PAGES", 2)
    path = str(tmp_path / "p")
    other = journal(spark, (7, "a", 1, "x")).withColumn("kind", F.lit("other"))
    apply_page(other, 0, to_documents, "profile", path)
    for n in range(1, 4):
        apply_page(journal(spark, (n, f"k{n}", 1, "x")), n, to_documents, "profile", path)
    at = {r.kind: r.position for r in read_cursors(spark, path).collect()}
    assert at == {"other": 7, "k": 3}
    assert numbered(spark, f"{path}/cursors") == [2, 3] == numbered(spark, f"{path}/intents")
    with pytest.raises(RebuildRequired):
        apply_page(other, 0, to_documents, "profile", path)
    apply_page(journal(spark, (2, "k2", 1, "x")), 2, to_documents, "profile", path)


def test_delta_folders_are_named_by_batch():
    assert delta_path("/x", 7) == "/x/deltas/batch_id=7"


def test_pages_that_do_not_continue_the_cursor_are_refused(spark, tmp_path):
    path = str(tmp_path / "p")
    apply_page(journal(spark, (100, "a", 1, "x")), 0, to_documents, "profile", path)
    later = journal(spark, (300, "b", 1, "y"))
    other = later.withColumn("generation", F.lit("g2"))
    for bad in (
        journal(spark, (5, "b", 1, "y")),
        journal(spark, (100, "b", 1, "y")),
        other,
        later.unionByName(other.withColumn("position", F.lit(301).cast("long"))),
        later.unionByName(later),
    ):
        with pytest.raises(Refused):
            apply_page(bad, 1, to_documents, "profile", path)
    assert read_cursors(spark, path).first().position == 100
    apply_page(later, 1, to_documents, "profile", path)
    assert read_cursors(spark, path).first().position == 300


def test_another_page_under_a_used_id_is_not_lost(spark, tmp_path):
    path = str(tmp_path / "p")
    first = journal(spark, (1, "a", 1, "x"))
    apply_page(first, 0, to_documents, "profile", path)
    with pytest.raises(RebuildRequired):
        apply_page(journal(spark, (2, "new", 1, "y")), 0, to_documents, "profile", path)
    apply_page(first, 0, to_documents, "profile", path)


def test_key_states_over_a_stream_equal_merged_pages(spark, tmp_path):
    """Each file is one page; pages that break a key leave its state as it was."""
    draw = random.Random(3)
    pages = []
    for n in range(4):
        rows = [("k", f"i{draw.randrange(25)}", n * 100 + p, n * 100 + p + 1, draw.random() < 0.2, draw.choice("xy")) for p in range(40)]
        if n == 2:
            rows += [("k", "i1", 290, 3, False, "x"), ("k", "i2", 291, 391, False, "x"), ("k", "i2", 292, 391, False, "y")]
        pages.append(rows)
    schema = "kind string, id string, position long, revision long, tombstone boolean, digest string"
    expected, state = [], {}
    for n, rows in enumerate(pages):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for key in {r[1] for r in rows}:
            own = [r[3:] for r in sorted(rows, key=lambda r: r[2]) if r[1] == key]
            broken = any(b[0] < a[0] or (b[0] == a[0] and b != a) for a, b in zip(own, own[1:]))
            new, old = max(reversed(own), key=lambda r: r[0]), state.get(key)
            if broken or (old and (new[0] < old[0] or (new[0] == old[0] and new != old))):
                status = "conflict"
            else:
                status = "inserted" if old is None else "repeated" if new == old else "advanced"
                state[key] = new
            expected.append((n, key, status, state.get(key, (None,))[0]))
    use_keyed_state(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []

    def collect(batch, n):
        seen.extend((n, r.id, r.status, r.revision) for r in batch.collect())

    query = (
        key_state_stream(stream).writeStream.foreachBatch(collect).outputMode("update")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(seen, key=str) == sorted(expected, key=str)
    assert {s for _, _, s, _ in seen} == {"inserted", "advanced", "conflict"}


class Held:
    """The state store's side of one key, with the calls counted."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_operations_of_a_bucket_share_the_store_and_keep_their_times():
    held, work = Held(), keyed._Operations(100)
    work.init(held)
    columns = ["observation", "operation", "result", "ts_s"]
    pages = [
        [("a", "work", None, 10), ("a", "query", None, 5), ("b", "work", None, 400), ("a", None, "ok", 120), ("c", None, "ok", 20)],
        [("a", None, "late", 90), ("b", None, "", 500), ("b", None, "denied", 499), ("b", None, "denied", 399)],
    ]
    for rows in pages:
        assert list(work.handleInputRows((1,), iter([pd.DataFrame(rows, columns=columns)]), None)) == []
    assert held.calls == 2 and held.timers == {105_001}
    got = []
    for watermark in (120_000, 121_000, 501_000):
        for at in sorted(t for t in held.timers if t < watermark):
            held.timers.remove(at)
            fired = SimpleNamespace(getExpiryTimeInMs=lambda at=at: at)
            now = SimpleNamespace(getCurrentWatermarkInMs=lambda watermark=watermark: watermark)
            for frame in work.handleExpiredTimer((1,), now, fired):
                got += [(watermark, *row) for row in frame[["observation", "operation", "ts", "result"]].itertuples(index=False)]
    assert got == [(120_000, "a", "query", 5, "late"), (501_000, "b", "work", 400, "denied")]
    assert held.value is None and held.timers == set()


def test_stream_of_operations_equals_the_batch(spark, tmp_path):
    draw = random.Random(6)
    starts, finishes = [], []
    for n in range(40):
        at = draw.randrange(0, 3000)
        starts += [(f"o{n}", "work", at)] * draw.choice([1, 1, 2])
        if draw.random() < 0.2:
            starts.append((f"o{n}", "query", at + 5))
        for _ in range(draw.choice([0, 1, 1, 2])):
            finishes.append((f"o{n}", draw.choice(["ok", "denied"]), at + draw.randrange(-20, 150)))
    finishes.append(("lone", "ok", 10))
    begun = spark.createDataFrame(starts, "observation string, operation string, ts long")
    ended = spark.createDataFrame(finishes, "observation string, result string, ts long")
    want = {(r.observation, r.operation, r.outcome) for r in abandoned_operations(begun, ended, 100, 10**6).collect()}
    use_keyed_state(spark)
    streams = []
    for name, frame in (("s", begun), ("f", ended)):
        timed = frame.withColumn("ts", F.timestamp_seconds("ts"))
        timed.coalesce(1).write.parquet(str(tmp_path / name))
        later = timed.limit(1).select(*[F.lit("end").alias(c) if c != "ts" else F.timestamp_seconds(F.lit(10**6)).alias(c) for c in timed.columns])
        for _ in range(2):
            later.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        streams.append(spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name)))
    run_memory(abandoned_operations_stream(*streams, 100), "timed", "append", tmp_path)
    got = [(r.observation, r.operation, r.outcome) for r in spark.table("timed").collect() if r.observation != "end"]
    assert len(got) == len(set(got)) and set(got) == want
