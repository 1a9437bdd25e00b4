"""The library's logical tables, derived from the driver tables column by column.

No derivation needs a window or a shuffle: revisions grow with the event id, so they grow
along every key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def sha(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def events_as_journal(events: DataFrame) -> DataFrame:
    """Typed journal of kind ``user``: an ``error`` event deletes the key."""
    live = F.col("event_type") != "error"
    return events.select(
        F.lit("user").alias("kind"),
        F.lit("g1").alias("generation"),
        (F.col("event_id") + 1).alias("position"),
        text("user_id").alias("id"),
        (F.expr("event_id * 3 div 2") + 1).alias("revision"),
        (~live).alias("tombstone"),
        F.when(live, F.col("event_type")).alias("event_type"),
        F.when(live, F.col("value")).alias("value"),
        F.when(live, F.col("props")).alias("props"),
    )


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_journal(table(spark, sf_dir, "events"))


#: The same journal in SQL, as a common table expression.
JOURNAL_SQL = """
  SELECT 'user' AS kind, 'g1' AS generation, event_id + 1 AS position,
         CAST(user_id AS VARCHAR) AS id, 1 + (event_id * 3) // 2 AS revision,
         event_type = 'error' AS tombstone,
         CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
         CASE WHEN event_type <> 'error' THEN value END AS value,
         CASE WHEN event_type <> 'error' THEN props END AS props
  FROM events
"""


def operations(rows: DataFrame) -> DataFrame:
    """Journal rows as operations with a cheap content digest of type and props."""
    digest = sha(F.concat(F.coalesce("event_type", F.lit("")), F.coalesce("props", F.lit(""))))
    return rows.select(
        "kind", "id", "position", "revision", "tombstone", digest.alias("digest")
    )


OPERATIONS_SQL = f"""
  SELECT kind, id, position, revision, tombstone,
         sha256(coalesce(event_type, '') || coalesce(props, '')) AS digest
  FROM ({JOURNAL_SQL})
"""

#: Newest operation per key of a table ``o``.
FOLD_SQL = """
  SELECT kind, id, position, revision, tombstone, digest FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY revision DESC, position DESC) AS rn
    FROM o) WHERE rn = 1
"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.lit("vec").alias("kind"),
        text("vec_id").alias("id"),
        (F.col("vec_id") % 3 + 1).alias("revision"),
        (F.col("vec_id") % 19 == 18).alias("tombstone"),
        F.col("embedding").alias("vector"),
        "vec_id",
        "label",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as indexed: live unless the id is a multiple of eleven."""
    return table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("kind"),
        text("doc_id").alias("id"),
        (F.col("doc_id") % 5 + 1).alias("revision"),
        (F.col("doc_id") % 11 == 0).alias("tombstone"),
        "text",
        "lang",
        "source",
        "doc_id",
    )


def current_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as they are now: every seventh has moved on since it was indexed."""
    docs = documents(spark, sf_dir)
    moved = F.when(F.col("doc_id") % 7 == 0, 1).otherwise(0)
    fields = F.create_map(F.lit("text"), F.col("text"), F.lit("lang"), F.col("lang"))
    return docs.select(
        "kind", "id", (F.col("revision") + moved).alias("revision"), "tombstone", "source",
        fields.alias("fields"),
    )


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        (F.col("c_custkey") * 7919 % 36001 / 100.0 - 180.0).alias("lon"),
        (F.col("c_custkey") * 104729 % 18001 / 100.0 - 90.0).alias("lat"),
    )


POINTS_SQL = """
  SELECT c_custkey, c_name, (c_custkey * 7919 % 36001) / 100.0::DOUBLE - 180.0::DOUBLE AS lon,
         (c_custkey * 104729 % 18001) / 100.0::DOUBLE - 90.0::DOUBLE AS lat
  FROM customer
"""


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as archive rows of kind ``blob``; every thirteenth is of another kind."""
    k = F.col("doc_id")
    state = (
        F.when(k % 10 == 0, "pending").when(k % 10 == 1, "detached").when(k % 10 != 2, "ready")
    )
    return table(spark, sf_dir, "documents").select(
        F.when(k % 13 == 5, "other").otherwise("blob").alias("kind"),
        text("doc_id").alias("id"),
        (k % 4 + 2).alias("revision"),
        F.when(k % 97 == 3, "").otherwise(F.col("source")).alias("owner"),
        F.concat(F.lit("s"), text(k % 3)).alias("store"),
        sha(F.col("text")).alias("digest"),
        F.octet_length("text").cast("long").alias("bytes"),
        state.alias("state"),
        (k % 3 + 1).alias("upload_revision"),
    )


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects behind the archive rows, some of them lost, cut, changed or shared."""
    k = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").filter(k % 23 != 7)
    content = F.when(k % 29 == 8, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    key = F.when(k % 31 == 9, "shared").otherwise(F.concat(F.lit("obj-"), text("doc_id")))
    return docs.select(
        text("doc_id").alias("row_id"),
        F.concat(F.lit("s"), text(k % 3)).alias("store"),
        key.alias("key"),
        sha(F.when(k % 37 == 4, F.lit("other")).otherwise(content)).alias("digest"),
        F.octet_length(content).cast("long").alias("bytes"),
    )


#: Archive rows and objects in SQL.
ARCHIVE_SQL = """
  archive AS (
    SELECT CASE WHEN doc_id % 13 = 5 THEN 'other' ELSE 'blob' END AS kind,
           CAST(doc_id AS VARCHAR) AS id, doc_id % 4 + 2 AS revision,
           CASE WHEN doc_id % 97 = 3 THEN '' ELSE source END AS owner,
           's' || CAST(doc_id % 3 AS VARCHAR) AS store, sha256(text) AS digest,
           CAST(strlen(text) AS BIGINT) AS bytes,
           CASE WHEN doc_id % 10 = 0 THEN 'pending' WHEN doc_id % 10 = 1 THEN 'detached'
                WHEN doc_id % 10 <> 2 THEN 'ready' END AS state,
           doc_id % 3 + 1 AS upload_revision
    FROM documents),
  objects AS (
    SELECT CAST(doc_id AS VARCHAR) AS row_id, 's' || CAST(doc_id % 3 AS VARCHAR) AS store,
           CASE WHEN doc_id % 31 = 9 THEN 'shared'
                ELSE 'obj-' || CAST(doc_id AS VARCHAR) END AS key,
           CASE WHEN doc_id % 37 = 4 THEN sha256('other')
                WHEN doc_id % 29 = 8 THEN sha256(text || '!') ELSE sha256(text) END AS digest,
           CAST(CASE WHEN doc_id % 29 = 8 THEN strlen(text) + 1
                     ELSE strlen(text) END AS BIGINT) AS bytes
    FROM documents WHERE doc_id % 23 <> 7),
  bound AS (
    SELECT a.*, o.store AS o_store, o.key, o.digest AS o_digest, o.bytes AS o_bytes,
           CASE WHEN a.owner = '' OR a.upload_revision > a.revision THEN 'invalid_row'
                WHEN o.row_id IS NULL THEN 'object_missing'
                WHEN o.bytes <> a.bytes THEN 'length_mismatch'
                WHEN o.digest <> a.digest THEN 'digest_mismatch' END AS fault
    FROM archive a LEFT JOIN objects o ON o.row_id = a.id
    WHERE a.kind = 'blob' AND a.state = 'ready'),
  keyed AS (
    SELECT *, count(*) OVER (PARTITION BY store, key) AS copies FROM bound WHERE fault IS NULL)
"""


def shown_documents_sql() -> str:
    """Current documents with the fields a reader of ``src0`` rules may see."""
    return """
      SELECT CAST(doc_id AS VARCHAR) AS id,
             doc_id % 5 + 1 + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS revision,
             source <> 'src0' AS has_lang
      FROM documents WHERE doc_id % 11 <> 0 AND source <> 'src1'
    """
