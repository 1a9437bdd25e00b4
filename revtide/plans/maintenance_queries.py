"""Archive, migration, restore and re-encryption queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from revtide.operators.maintenance import (
    RECORD_TYPES,
    archive_counts,
    migrate_rows,
    migration_preview,
    rekey_envelopes,
    restore_snapshot,
    seal,
    unseal,
)
from revtide.plans.registry import query
from revtide.plans.tables import journal, table, text
from revtide.session import scratch_dir
from revtide.sources.journal import check_generation
from revtide.sources.snapshots import publish_snapshot

_COUNTS = ", ".join(
    f"count(*) FILTER (l_partkey % 8 = {n}) AS \"{name}\"" for n, name in enumerate(RECORD_TYPES)
)


@query("archive_counts", f"SELECT {_COUNTS} FROM lineitem")
def count_archive(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in RECORD_TYPES])
    records = table(spark, sf_dir, "lineitem").select(
        F.get(names, (F.col("l_partkey") % 8).cast("int")).alias("record_type")
    )
    return archive_counts(records)


@query(
    "migration_preview",
    """WITH r AS (SELECT p_brand AS kind, length(p_brand) % 2 + 1 AS version FROM part),
    b AS (SELECT DISTINCT p_brand AS kind, 2 AS version FROM part),
    a AS (SELECT kind, version + CASE WHEN kind LIKE '%1' THEN 1 ELSE 0 END AS version FROM b
          UNION ALL SELECT DISTINCT p_type, 1 FROM part)
    SELECT (SELECT count(*) FROM a LEFT JOIN b USING (kind)
            WHERE b.version IS NULL OR a.version <> b.version) AS changed_schemas,
      (SELECT count(*) FROM r JOIN a USING (kind) WHERE r.version < a.version)
        AS historical_receipts""",
)
def preview_migration(spark, sf_dir):
    """Brands as kinds with receipts; part types are new kinds."""
    part = table(spark, sf_dir, "part")
    receipts = part.select(
        F.col("p_brand").alias("kind"), (F.length("p_brand") % 2 + 1).alias("version")
    )
    before = part.select(F.col("p_brand").alias("kind")).distinct().withColumn("version", F.lit(2))
    raised = F.when(F.col("kind").endswith("1"), 1).otherwise(0)
    after = before.withColumn("version", F.col("version") + raised).unionByName(
        part.select(F.col("p_type").alias("kind")).distinct().withColumn("version", F.lit(1))
    )
    return migration_preview(before, after, receipts)


def _parts(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("kind"),
        F.lit("g1").alias("generation"),
        text("p_partkey").alias("id"),
        (k + 1).alias("revision"),
        F.lit(1).alias("version"),
        F.when(k % 10 != 0, F.to_json(F.struct("p_name", "p_size"))).alias("value"),
    )


@query(
    "rows_migrated",
    """SELECT CAST(p_partkey AS VARCHAR) AS id,
      CASE WHEN p_partkey % 10 <> 0 AND p_type IN ('ECONOMY', 'STANDARD') THEN 2 ELSE 1 END
        AS version,
      CASE WHEN p_partkey % 10 = 0 THEN NULL
           WHEN p_type = 'ECONOMY' THEN '{"name":"' || upper(p_name) || '"}'
           WHEN p_type = 'STANDARD' THEN '{"size":' || CAST(p_size * 10 AS VARCHAR) || '}'
           ELSE '{"p_name":"' || p_name || '","p_size":' || CAST(p_size AS VARCHAR) || '}' END
        AS value
    FROM part""",
)
def rows_migrated(spark, sf_dir):
    """Two kinds converted by expressions into a fresh folder; tombstones untouched."""

    def name(value):
        return F.to_json(F.struct(F.upper(F.get_json_object(value, "$.p_name")).alias("name")))

    def size(value):
        tenths = F.get_json_object(value, "$.p_size").cast("int") * 10
        return F.to_json(F.struct(tenths.alias("size")))

    path = scratch_dir(spark, "migrated")
    migrate_rows(_parts(spark, sf_dir), {"ECONOMY": (2, name), "STANDARD": (2, size)}, path)
    return spark.read.parquet(path).select("id", "version", "value")


@query(
    "snapshot_restored",
    """SELECT count(*) AS events, count(*) AS foreign_events, 'gap' AS status FROM events""",
)
def snapshot_restored(spark, sf_dir):
    """After a restore, the old generation's cursor meets a gap over every event."""
    saved, fresh = scratch_dir(spark, "saved"), scratch_dir(spark, "restored")
    publish_snapshot(journal(spark, sf_dir), saved)
    restored = restore_snapshot(spark, saved, fresh, "g2")
    verdict = check_generation(restored, "user", "g1")
    return verdict.withColumnRenamed("foreign", "foreign_events")


def _keyring(spark, sf_dir):
    """Three versions of one key, derived from the regions' names."""
    return (
        table(spark, sf_dir, "region")
        .filter("r_regionkey BETWEEN 1 AND 3")
        .select(
            F.lit("rows").alias("key_alias"),
            F.col("r_regionkey").cast("long").alias("key_version"),
            F.unhex(F.sha2(F.col("r_name").cast("binary"), 256)).alias("key"),
        )
    )


@query(
    "envelopes_rekeyed",
    """SELECT c_custkey, CASE WHEN m = 0 THEN 'not_authentic' WHEN m = 1 THEN 'unknown_key' END
        AS reject_reason,
      CASE WHEN m = 0 THEN c_custkey % 2 + 1 WHEN m = 1 THEN 9 ELSE 3 END AS key_version,
      CASE WHEN m NOT IN (0, 1) THEN c_name END AS plaintext
    FROM (SELECT *, c_custkey % 19 AS m FROM customer)""",
)
def envelopes_rekeyed(spark, sf_dir):
    """Names sealed under two key versions, moved to a third and opened again."""
    keyring = _keyring(spark, sf_dir)
    m = F.col("c_custkey") % 19
    names = table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("id"),
        "c_custkey",
        "c_name",
        (F.col("c_custkey") % 2 + 1).alias("key_version"),
        F.col("c_name").cast("binary").alias("context"),
        F.lit(b"v1").alias("aad"),
    )
    sealed = names.join(F.broadcast(keyring), "key_version").select(
        "id",
        F.lit("p1").alias("profile"),
        F.lit("rows").alias("key_alias"),
        F.when(m == 1, F.lit(9)).otherwise(F.col("key_version")).cast("long").alias("key_version"),
        seal(F.col("c_name").cast("binary"), F.col("key"), F.col("context"), F.col("aad")).alias(
            "ciphertext"
        ),
        "context",
        F.when(m == 0, F.lit(b"v2")).otherwise(F.col("aad")).alias("aad"),
    )
    moved = rekey_envelopes(sealed, keyring, "rows", 3)
    opened = moved.join(
        F.broadcast(keyring.select("key_version", "key")), "key_version", "left"
    ).withColumn(
        "plaintext", unseal(F.col("ciphertext"), F.col("key"), F.col("context"), F.col("aad"))
    )
    return opened.select(
        F.col("id").cast("long").alias("c_custkey"),
        "reject_reason",
        "key_version",
        F.col("plaintext").cast("string").alias("plaintext"),
    )
