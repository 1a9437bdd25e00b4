"""Object inventory, verification and import queries over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from revtide.operators.inventory import (
    inventory_counts,
    ready_bindings,
    recovery_report,
    store_manifests,
    verify_entries,
)
from revtide.plans.registry import query
from revtide.plans.tables import ARCHIVE_SQL, archive_rows, sha, stored_objects, table, text
from revtide.session import scratch_dir
from revtide.sources.documents import import_documents
from revtide.sources.objects import copy_objects, verify_objects
from revtide.sources.snapshots import publish_snapshot

STORES = ["s0", "s1", "s2"]


@query(
    "inventory_counts",
    f"""WITH {ARCHIVE_SQL}
    SELECT count(*) FILTER (kind = 'blob' AND state = 'ready') AS ready,
      count(*) FILTER (kind = 'blob' AND state = 'pending') AS pending,
      count(*) FILTER (kind = 'blob' AND state = 'detached') AS detached,
      count(*) FILTER (kind = 'blob' AND state IS NULL) AS tombstones,
      count(*) FILTER (kind <> 'blob') AS other_rows FROM archive""",
)
def count_inventory(spark, sf_dir):
    return inventory_counts(archive_rows(spark, sf_dir))


def _bound(spark, sf_dir):
    return ready_bindings(archive_rows(spark, sf_dir), stored_objects(spark, sf_dir), STORES)


@query(
    "ready_bindings",
    f"""WITH {ARCHIVE_SQL}
    SELECT id, revision, owner, upload_revision, store, key, digest, bytes
    FROM keyed WHERE copies = 1""",
)
def bind_ready(spark, sf_dir):
    return _bound(spark, sf_dir).bindings


@query(
    "binding_faults",
    f"""WITH {ARCHIVE_SQL}
    SELECT id, store, NULL AS key, fault, 1 AS copies FROM bound WHERE fault IS NOT NULL
    UNION ALL
    SELECT NULL, store, key, 'duplicate_key', count(*) FROM keyed WHERE copies > 1
    GROUP BY store, key""",
)
def binding_faults(spark, sf_dir):
    return _bound(spark, sf_dir).faults


@query(
    "store_manifests",
    f"""WITH {ARCHIVE_SQL}
    SELECT store, count(*) AS entries, CAST(sum(bytes) AS BIGINT) AS total_bytes
    FROM keyed WHERE copies = 1 GROUP BY store""",
)
def manifests_by_store(spark, sf_dir):
    totals = store_manifests(_bound(spark, sf_dir).bindings)
    return totals.withColumn("total_bytes", F.col("total_bytes").cast("bigint"))


def _manifest(spark, sf_dir):
    """One entry per document, in document order."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("s"), text(F.col("doc_id") % 3)).alias("store"),
        F.concat(F.lit("obj-"), text("doc_id")).alias("key"),
        sha(F.col("text")).alias("digest"),
        F.octet_length("text").cast("long").alias("bytes"),
    )


def _unshared(spark, sf_dir):
    objects = stored_objects(spark, sf_dir)
    return objects.withColumn("key", F.concat(F.lit("obj-"), F.col("row_id")))


_STATUS_SQL = """
  SELECT doc_id AS seq, 's' || CAST(doc_id % 3 AS VARCHAR) AS store,
         'obj-' || CAST(doc_id AS VARCHAR) AS key, CAST(strlen(text) AS BIGINT) AS bytes,
         CASE WHEN doc_id % 23 = 7 THEN 'missing' WHEN doc_id % 29 = 8 THEN 'length_mismatch'
              WHEN doc_id % 37 = 4 THEN 'digest_mismatch' ELSE 'ok' END AS status
  FROM documents
"""


@query("objects_verified", f"SELECT seq, store, key, status FROM ({_STATUS_SQL})")
def objects_verified(spark, sf_dir):
    checked = verify_entries(_manifest(spark, sf_dir), _unshared(spark, sf_dir))
    return checked.select("seq", "store", "key", "status")


@query(
    "recovery_report",
    f"""WITH s AS ({_STATUS_SQL}), f AS (SELECT min(seq) AS first FROM s WHERE status <> 'ok'
        AND seq >= 100),
    r AS (SELECT s.*, CASE WHEN seq >= 100 AND status <> 'ok' THEN status END AS cause FROM s)
    SELECT count(*) FILTER (seq < first) AS verified,
      CAST(sum(bytes) FILTER (seq < first) AS BIGINT) AS bytes,
      count(*) FILTER (seq < first AND seq % 2 = 0) AS created,
      count(*) FILTER (seq < first AND seq % 2 = 1) AS existing, max(first) AS failed_seq,
      'destination_read' AS phase, max(cause) FILTER (seq = first) AS cause FROM r, f""",
)
def report_recovery(spark, sf_dir):
    """Failures before entry 100 are forgiven, so the verified prefix is a long one."""
    checked = verify_entries(_manifest(spark, sf_dir), _unshared(spark, sf_dir))
    failed = (F.col("status") != "ok") & (F.col("seq") >= 100)
    results = checked.select(
        "seq",
        "bytes",
        F.when(F.col("seq") % 2 == 0, "created").otherwise("existing").alias("action"),
        F.when(failed, "destination_read").alias("phase"),
        F.when(failed, F.col("status")).alias("cause"),
    )
    report = recovery_report(results)
    return report.withColumn("bytes", F.col("bytes").cast("bigint"))


@query(
    "documents_admitted",
    """WITH c AS (SELECT conv_id, turn, 'f/' || CAST(conv_id AS VARCHAR) || '/' ||
        CAST(turn AS VARCHAR) AS path, conv_id % 13 AS m,
        CAST(to_json({'role': role, 'text': text}) AS VARCHAR) AS body FROM conversations)
    SELECT path, CASE WHEN m = 1 THEN 'not_approved' WHEN m = 2 THEN 'digest_mismatch'
        WHEN m = 3 THEN 'duplicate_name' WHEN m = 4 THEN 'invalid_json' END AS reject_reason,
      CASE WHEN m NOT IN (1, 2, 3, 4) THEN 'sha256:' || sha256(body) END AS version
    FROM c""",
)
def documents_admitted(spark, sf_dir):
    """One file per turn: approved by digest, then read as strict JSON."""
    m = F.col("conv_id") % 13
    body = F.to_json(F.struct("role", "text"))
    doubled = F.concat(F.lit('{"role":1,'), F.substring(body, F.lit(2), F.length(body)))
    content = F.when(m == 3, doubled).when(m == 4, F.concat(body, F.lit(" x"))).otherwise(body)
    files = table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", F.lit("f"), "conv_id", "turn").alias("path"),
        content.cast("binary").alias("content"),
        m.alias("m"),
    )
    files = files.withColumn("bytes", F.octet_length("content").cast("long"))
    manifest = files.filter("m <> 1").select(
        "path",
        F.when(F.col("m") == 2, sha(F.lit("x"))).otherwise(F.sha2("content", 256)).alias("sha256"),
    )
    admitted = import_documents(files.drop("m"), manifest)
    return admitted.select("path", "reject_reason", "version")


@query(
    "objects_copied",
    """SELECT doc_id AS seq, 'obj-' || CAST(doc_id AS VARCHAR) AS key,
      CASE WHEN doc_id % 7 = 2 THEN 'existing' WHEN doc_id % 7 IN (3, 4) THEN NULL
           ELSE 'created' END AS action,
      CASE WHEN doc_id % 7 = 3 THEN 'destination_read'
           WHEN doc_id % 7 = 4 THEN 'source_read' END AS phase,
      CASE WHEN doc_id % 7 = 3 THEN 'integrity' WHEN doc_id % 7 = 4 THEN 'missing' END AS cause,
      CASE WHEN doc_id % 7 = 3 THEN 'length_mismatch' WHEN doc_id % 7 = 4 THEN 'missing'
           ELSE 'ok' END AS status
    FROM documents""",
)
def objects_copied(spark, sf_dir):
    """Real files: a create-only copy, then the destination read back and verified.

    Beforehand a seventh of the objects already is at the destination, a seventh lies there
    with other content, and a seventh is lost at the source.
    """
    source, target = scratch_dir(spark, "objects"), scratch_dir(spark, "objects")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")

    def lay_out(batches):
        import os

        for batch in batches:
            for doc, body in zip(batch["doc_id"], batch["text"]):
                rest = doc % 7
                places = [(source, body)] if rest != 4 else []
                if rest in (2, 3):
                    places.append((target, body if rest == 2 else body + "!"))
                for root, raw in places:
                    os.makedirs(root, exist_ok=True)
                    with open(f"{root}/obj-{doc}", "wb") as file:
                        file.write(raw.encode())
            yield batch[["doc_id"]]

    texts.mapInPandas(lay_out, "doc_id long").agg(F.count("*")).collect()
    manifest = _manifest(spark, sf_dir).withColumn("store", F.lit("to"))
    results = copy_objects(manifest, source, target, tasks=8)
    report = f"{target}-report"
    # Written down, so that listing the destination happens after the copy.
    publish_snapshot(results, report)
    checked = verify_objects(manifest, target, tasks=8).select("seq", "status")
    return (
        spark.read.parquet(report)
        .join(checked, "seq")
        .select("seq", "key", "action", "phase", "cause", "status")
    )


@query("snapshot_published", "SELECT count(*) AS rows FROM documents")
def snapshot_published(spark, sf_dir):
    return publish_snapshot(archive_rows(spark, sf_dir), scratch_dir(spark, "snapshot"))
