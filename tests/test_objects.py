import hashlib
import os

import pytest
from pyspark.sql import functions as F

from revtide.operators.inventory import (
    inventory_counts,
    ready_bindings,
    recovery_report,
    store_manifests,
    verify_entries,
    write_manifests,
)
from revtide.sources.documents import import_documents, read_files
from revtide.sources.objects import copy_objects, list_objects, verify_objects
from revtide.sources.snapshots import publish_snapshot
from revtide.verdicts import Refused

ROW = (
    "kind string, id string, revision long, owner string, store string, digest string, bytes long, "
    "state string, upload_revision long"
)
OBJECT = "row_id string, store string, key string, digest string, bytes long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def row(id, store="s", digest="d", size=1, owner="o", state="ready", upload=1, revision=2):
    return ("blob", id, revision, owner, store, digest, size, state, upload)


def test_bindings(spark):
    rows = [
        row("ok"), row("twin"), row("copy1"), row("copy2"), row("dup"), row("dup"), row("lost"),
        row("cut"), row("other"), row("", owner="o"), row("early", upload=3), row("zero", upload=0),
        row("far", store="t"), row("huge", size=10**12), row("wait", state="pending"),
    ]
    objects = [
        ("ok", "s", "k1", "d", 1), ("twin", "s", "k2", "d", 1), ("copy1", "s", "k3", "d", 1),
        ("copy2", "s", "k3", "d", 1), ("dup", "s", "k4", "d", 1), ("cut", "s", "k5", "d", 2),
        ("other", "s", "k6", "e", 1), ("early", "s", "k7", "d", 1), ("huge", "s", "k8", "d", 10**12),
    ]
    bindings, faults = ready_bindings(
        spark.createDataFrame(rows, ROW), spark.createDataFrame(objects, OBJECT), ["s"]
    )
    # Equal content under two keys is fine; one key for two rows is not.
    assert sorted(r.id for r in bindings.collect()) == ["ok", "twin"]
    assert {(r.id or r.key, r.fault, r.copies) for r in faults.collect()} == {
        ("k3", "duplicate_key", 2), ("dup", "duplicate_id", 2), ("lost", "object_missing", 1),
        ("cut", "length_mismatch", 1), ("other", "digest_mismatch", 1), ("early", "invalid_row", 1),
        ("zero", "invalid_row", 1), ("far", "unknown_store", 1), ("huge", "too_large", 1),
        (None, "invalid_row", 1),
    }
    with pytest.raises(Refused):
        ready_bindings(spark.createDataFrame(rows, ROW), spark.createDataFrame(objects, OBJECT), [])


def test_counts_and_manifests(spark, tmp_path):
    rows = spark.createDataFrame(
        [row("a"), row("b", state="pending"), row("c", state="detached"), row("d", state=None),
         ("other", "e", 1, "o", "s", "d", 1, None, 1)],
        ROW,
    )
    assert inventory_counts(rows).first().asDict() == {
        "ready": 1, "pending": 1, "detached": 1, "tombstones": 1, "other_rows": 1,
    }
    bindings = spark.createDataFrame(
        [("s", "k", "d", 2**62), ("s", "l", "d", 2**62), ("s", "m", "d", 2**62), ("t", "k", "d", 1)],
        "store string, key string, digest string, bytes long",
    )
    totals = {r.store: (r.entries, int(r.total_bytes)) for r in store_manifests(bindings).collect()}
    assert totals == {"s": (3, 3 * 2**62), "t": (1, 1)}
    write_manifests(bindings, str(tmp_path / "m"), 2)
    assert spark.read.parquet(str(tmp_path / "m")).groupBy("store").count().count() == 2


def test_copy_is_create_only_and_resumable(spark, tmp_path):
    source, target = tmp_path / "from", tmp_path / "to"
    os.makedirs(source / "x")
    os.makedirs(target)
    content = {"x/a": "alpha", "b": "beta", "empty": "", "bad": "right", "kept": "same", "gone": "?"}
    for key, text in content.items():
        if key != "gone":
            (source / key).write_text(text)
    (source / "bad").write_text("wrong")
    (target / "kept").write_text("same")
    (target / "b").write_text("other")
    (target / "unlisted").write_text("no claim")
    entries = [(n, k, sha(t), len(t)) for n, (k, t) in enumerate(content.items())]
    entries.append((9, "../escape", sha("x"), 1))
    manifest = spark.createDataFrame(entries, "seq long, key string, digest string, bytes long")
    got = {r.key: (r.action, r.phase, r.cause) for r in copy_objects(manifest, str(source), str(target), 3).collect()}
    assert got == {
        "x/a": ("created", None, None), "empty": ("created", None, None),
        "b": (None, "destination_read", "integrity"), "bad": (None, "source_read", "integrity"),
        "kept": ("existing", None, None), "gone": (None, "source_read", "missing"),
        "../escape": (None, "destination_read", "invalid"),
    }
    assert (target / "b").read_text() == "other" and not list(target.glob("**/*.partial"))
    again = copy_objects(manifest, str(source), f"file://{target}", 3)
    assert {r.action for r in again.filter("cause IS NULL").collect()} == {"existing"}
    seen = {r.key: r.status for r in verify_objects(manifest, str(target), 3).collect()}
    assert seen == {
        "x/a": "ok", "empty": "ok", "kept": "ok", "b": "length_mismatch", "bad": "missing",
        "gone": "missing", "../escape": "invalid",
    }
    listed = verify_entries(
        manifest.withColumn("store", F.lit("t")), list_objects(spark, str(target), "t")
    )
    # The listing has no zero-length files.
    assert {r.key for r in listed.filter("status = 'ok'").collect()} == {"x/a", "kept"}
    with pytest.raises(Refused):
        copy_objects(manifest, "s3://bucket/x", str(target))


def test_report_is_the_verified_prefix(spark):
    schema = "seq long, bytes long, action string, phase string, cause string"
    rows = [(3, 7, "created", None, None), (0, 1, "created", None, None), (1, 2, "existing", None, None),
            (2, 4, None, "source_read", "missing"), (4, 9, None, "create", "unknown")]
    report = recovery_report(spark.createDataFrame(rows, schema)).first()
    assert (report.verified, int(report.bytes), report.created, report.existing) == (2, 3, 1, 1)
    assert (report.failed_seq, report.phase, report.cause) == (2, "source_read", "missing")
    clean = recovery_report(spark.createDataFrame(rows[:3], schema)).first()
    assert (clean.verified, clean.failed_seq, clean.cause) == (3, None, None)
    assert recovery_report(spark.createDataFrame([], schema)).first().verified == 0


#: For each rule of an import one document, and the reason it gives.
IMPORTED = {
    "nested": ('{"list": [1, [2, {"deep": []}], "t"], "map": {"k": {"k": true}}}', None),
    "bare": ("-0.5e3", None),
    "text": ('"caf\\u00e9"', None),
    "wide": ("[1]" + " " * (65_536 - 3), None),
    "wider": ("[1]" + " " * (65_536 - 2), "too_large"),
    "names": ('[{"m": 1, "n": {"o": 2, "o": 3}}]', "duplicate_name"),
    "two": ("[] []", "invalid_json"),
    "open": ('{"m": [}', "invalid_json"),
}


def test_import_of_files(spark, tmp_path):
    for name, (text, _) in IMPORTED.items():
        (tmp_path / name).write_text(text)
    others = {"edited": b"[2]", "stray": b"[3]", "bytes": b'"\xff\xfe"'}
    for name, content in others.items():
        (tmp_path / name).write_bytes(content)
    approved = {name: sha(text) for name, (text, _) in IMPORTED.items()}
    approved |= {"edited": sha("[1]"), "bytes": hashlib.sha256(others["bytes"]).hexdigest(), "lost": sha("[4]")}
    manifest = spark.createDataFrame(
        [(f"file:{tmp_path}/{n}", digest) for n, digest in approved.items()], "path string, sha256 string"
    )
    rows = {r.path.rsplit("/", 1)[1]: r for r in import_documents(read_files(spark, str(tmp_path)), manifest).collect()}
    assert {name: r.reject_reason for name, r in rows.items()} == {
        **{name: reason for name, (_, reason) in IMPORTED.items()},
        "edited": "digest_mismatch", "stray": "not_approved", "bytes": "invalid_json", "lost": "missing",
    }
    assert {rows[n].version for n in ("nested", "bare")} == {f"sha256:{approved[n]}" for n in ("nested", "bare")}


def test_repeated_observations_of_an_object(spark):
    manifest = spark.createDataFrame([("s", "k", "d", 1), ("s", "m", "d", 1)], "store string, key string, digest string, bytes long")
    objects = spark.createDataFrame(
        [("s", "k", "d", 1), ("s", "k", "d", 1), ("s", "m", "d", 1), ("s", "m", "e", 1)], manifest.schema
    )
    assert sorted((r.key, r.status) for r in verify_entries(manifest, objects).collect()) == [("k", "ok"), ("m", "ambiguous")]


def test_snapshots_are_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "s")
    assert publish_snapshot(spark.range(5).toDF("n"), path).first().rows == 5
    with pytest.raises(Exception, match="(?i)exist"):
        publish_snapshot(spark.range(1).toDF("n"), path)
    assert spark.read.parquet(path).count() == 5


def test_entries_without_key_digest_or_length_are_results(spark, tmp_path):
    (tmp_path / "from").mkdir()
    (tmp_path / "to").mkdir()
    (tmp_path / "from" / "a").write_bytes(b"one")
    digest = hashlib.sha256(b"one").hexdigest()
    entries = spark.createDataFrame(
        [(1, "a", digest, 3), (2, None, digest, 3), (3, "a", None, 3), (4, "a", digest, None), (5, "", digest, 3),
         (6, "../a", digest, 3), (7, "a", digest, -1), (None, "a", digest, 3), (9, ".", digest, 3)],
        "seq long, key string, digest string, bytes long",
    )
    copied = {r.seq: (r.action, r.phase, r.cause, r.bytes) for r in copy_objects(entries, str(tmp_path / "from"), str(tmp_path / "to")).collect()}
    assert {copied[1][0], copied[None][0]} == {"created", "existing"}
    assert all(copied[n][:3] == (None, "destination_read", "invalid") for n in (2, 3, 4, 5, 6, 7, 9))
    assert copied[4][3] is None
    status = {r.seq: r.status for r in verify_objects(entries, str(tmp_path / "to")).collect()}
    assert status == {1: "ok", None: "ok", **dict.fromkeys((2, 3, 4, 5, 6, 7, 9), "invalid")}
    assert recovery_report(copy_objects(entries, str(tmp_path / "from"), str(tmp_path / "to"))).first().failed_seq == 2
