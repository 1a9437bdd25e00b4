"""Journal, projection and history queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.functions.keys import admit_keys, key_hash, key_uuid
from revtide.functions.values import Mapping, content_digest, embed, select_fields, text_digest
from revtide.functions.vectors import (
    canonical_vector,
    l2_norm,
    l2_normalize,
    vector_reject_reason,
)
from revtide.operators.history import (
    advance_cursors,
    check_history,
    latest,
    live,
    merge_key_state,
    reconcile,
    reconcile_vectors,
    replay_buckets,
    replay_matches,
    revision_conflicts,
    tombstones,
)
from revtide.plans.registry import query
from revtide.plans.tables import (
    FOLD_SQL,
    JOURNAL_SQL,
    OPERATIONS_SQL,
    events_as_journal,
    journal,
    operations,
    sha,
    table,
    text,
    vectors,
)
from revtide.session import scratch_dir
from revtide.sources.generation import compact, read_generation, write_generation
from revtide.sources.journal import check_generation, read_journal
from revtide.streaming.keyed import key_state_stream, use_keyed_state
from revtide.streaming.projection import apply_page, page_faults, read_cursors, run_projection


def _feed_end(spark: SparkSession, sf_dir: str) -> int:
    """The last position of the feed; intervals are fractions of it, so they grow with it."""
    return table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] + 1


def _part_sql(n: int, of: int) -> str:
    return f"(SELECT (max(event_id) + 1) * {n} // {of} FROM events)"


@query(
    "current_state",
    f"""WITH j AS ({JOURNAL_SQL})
    SELECT id, max(revision) AS revision, max_by(tombstone, position) AS tombstone,
           arg_max_null(event_type, position) AS event_type,
           arg_max_null(value, position) AS value, arg_max_null(props, position) AS props
    FROM j GROUP BY id""",
)
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every key now: read, narrow, mark deletions, fold."""
    feed = read_journal(journal(spark, sf_dir), "user", "g1", after=0)
    newest = latest(feed)
    return newest.select("id", "revision", "tombstone", "event_type", "value", "props")


@query(
    "journal_read",
    f"""SELECT id, position, revision FROM ({JOURNAL_SQL})
    WHERE position > {_part_sql(1, 10)} AND position <= {_part_sql(8, 10)}""",
)
def journal_read(spark, sf_dir):
    """Seven tenths of the feed; the interval reaches the stored column, so the scan can skip the rest."""
    end = _feed_end(spark, sf_dir)
    after, upto = end // 10, end * 8 // 10
    # A position is its event's id and one more.
    stored = table(spark, sf_dir, "events").filter(F.col("event_id").between(after, upto - 1))
    feed = read_journal(events_as_journal(stored), "user", "g1", after=after, upto=upto)
    return feed.select("id", "position", "revision")


@query(
    "journal_gap",
    "SELECT count(*) AS events, count(*) AS foreign_events, 'gap' AS status FROM events",
)
def journal_gap(spark, sf_dir):
    """A reader holding a cursor of an older generation."""
    verdict = check_generation(journal(spark, sf_dir), "user", "g0")
    return verdict.withColumnRenamed("foreign", "foreign_events")


def _json_journal(spark, sf_dir) -> DataFrame:
    """The journal with JSON values: value is null for clicks and missing for views."""
    rows = journal(spark, sf_dir)
    body = F.when(
        F.col("event_type") == "click",
        F.concat(F.lit('{"value":null,"event_type":"click","n":'), text("position"), F.lit("}")),
    ).when(
        F.col("event_type") == "view",
        F.concat(F.lit('{"event_type":"view","n":'), text("position"), F.lit("}")),
    ).otherwise(
        F.concat(
            F.lit('{"n":'), text("position"), F.lit(',"value":'), text("revision"),
            F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'),
        )
    )
    return rows.select(
        "kind", "generation", "position", "id", "revision", "tombstone",
        F.when(~F.col("tombstone"), body).alias("value"),
    )


@query(
    "fields_selected",
    f"""SELECT position, NOT tombstone AS has_fields,
      CASE WHEN event_type IS NOT NULL THEN '"' || event_type || '"' END AS event_type,
      CASE WHEN event_type = 'click' THEN 'null'
           WHEN event_type <> 'view' THEN CAST(revision AS VARCHAR) END AS value,
      coalesce(event_type <> 'view', false) AS has_value
    FROM ({JOURNAL_SQL})""",
)
def fields_selected(spark, sf_dir):
    """JSON field selection that tells missing from null; ``n`` is not selected."""
    picked = select_fields(_json_journal(spark, sf_dir), ["value", "event_type"])
    fields = F.col("fields")
    return picked.filter("reject_reason IS NULL").select(
        "position",
        fields.isNotNull().alias("has_fields"),
        fields["event_type"].alias("event_type"),
        fields["value"].alias("value"),
        F.coalesce(F.map_contains_key("fields", "value"), F.lit(False)).alias("has_value"),
    )


DIGEST_MAPPING = Mapping("bench", "table", "v1", ("event_type", "n"))


def _digest_sql() -> str:
    head = b"revtide/content/v1" + (lambda i: len(i).to_bytes(4, "big") + i)(
        DIGEST_MAPPING.identity
    )

    def framed(e: str) -> str:
        return f"from_hex(printf('%08x', strlen({e}))) || encode({e})"

    body = (
        "from_hex('6f00000002') || from_hex('0000000a') || encode('event_type') || encode('s') || "
        f"{framed('event_type')} || from_hex('00000001') || encode('n') || encode('u') || "
        "from_hex(printf('%016x', position))"
    )
    return f"""WITH j AS ({JOURNAL_SQL}), b AS (
      SELECT *, CASE WHEN tombstone THEN from_hex('') ELSE {body} END AS body FROM j)
    SELECT id, position, sha256(from_hex('{head.hex()}') || {framed("kind")} || {framed("id")}
      || from_hex(printf('%016x', revision))
      || from_hex(CASE WHEN tombstone THEN '01' ELSE '00' END)
      || from_hex(printf('%08x', octet_length(body))) || body || from_hex('00')) AS digest
    FROM b"""


@query("content_digests", _digest_sql())
def content_digests(spark, sf_dir):
    """Content identity of every revision, read from its JSON value."""
    rows = _json_journal(spark, sf_dir)
    digest = content_digest(
        DIGEST_MAPPING, F.col("kind"), F.col("id"), F.col("revision"), F.col("value")
    )
    return rows.select("id", "position", digest["digest"].alias("digest"))


@query("content_digests_typed", _digest_sql())
def content_digests_typed(spark, sf_dir):
    """The same identity from typed columns, entirely inside the JVM."""
    rows = journal(spark, sf_dir).withColumn("n", F.col("position"))
    digest = text_digest(
        DIGEST_MAPPING,
        F.col("kind"),
        F.col("id"),
        F.col("revision"),
        ~F.col("tombstone"),
        {"event_type": F.col("event_type"), "n": F.col("n")},
        strings={"event_type"},
    )
    return rows.select("id", "position", digest.alias("digest"))


@query(
    "vector_admission",
    """SELECT CAST(vec_id AS VARCHAR) AS id,
      CASE WHEN vec_id % 19 = 18 AND vec_id % 2 = 0 THEN 'vector_forbidden'
           WHEN vec_id % 19 = 18 THEN NULL
           WHEN vec_id % 17 = 3 THEN 'vector_missing'
           WHEN vec_id % 17 = 4 THEN 'dimension_mismatch'
           WHEN vec_id % 17 = 5 THEN 'vector_not_finite' END AS reject_reason
    FROM embeddings""",
)
def vector_admission(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    k, v = F.col("vec_id"), F.col("vector")
    infinite = F.transform(v, lambda x, i: F.when(i == 7, F.lit(float("inf")).cast("float")).otherwise(x))
    nothing = F.lit(None).cast("array<float>")
    changed = (
        F.when(F.col("tombstone"), F.when(k % 2 == 0, v).otherwise(nothing))
        .when(k % 17 == 3, nothing)
        .when(k % 17 == 4, F.slice(v, 1, 63))
        .when(k % 17 == 5, infinite)
        .otherwise(v)
    )
    return rows.withColumn("vector", changed).select(
        "id",
        vector_reject_reason(F.col("vector"), 64, F.col("tombstone")).alias("reject_reason"),
    )


@query(
    "vector_normalized",
    """WITH n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    m AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS len FROM n)
    SELECT CAST(vec_id AS VARCHAR) AS id, round(len, 5) AS norm,
           round(CAST(CAST(v[1] / len AS FLOAT) AS DOUBLE), 5) AS first,
           round(CAST(CAST(v[64] / len AS FLOAT) AS DOUBLE), 5) AS last
    FROM m""",
)
def vector_normalized(spark, sf_dir):
    rows = vectors(spark, sf_dir).withColumn("vector", canonical_vector(F.col("vector")))
    unit = rows.withColumn("norm", l2_norm(F.col("vector"))).withColumn(
        "unit", l2_normalize(F.col("vector"), F.col("norm"))
    )
    return unit.select(
        "id",
        F.round("norm", 5).alias("norm"),
        F.round(F.col("unit")[0].cast("double"), 5).alias("first"),
        F.round(F.col("unit")[63].cast("double"), 5).alias("last"),
    )


_KEY_SQL = """sha256(encode('revtide/key/v1') || from_hex(printf('%08x', strlen(kind)))
  || encode(kind) || from_hex(printf('%08x', strlen(id))) || encode(id))"""


@query(
    "key_hash",
    f"""WITH k AS (SELECT lang AS kind, source || '/' || CAST(doc_id AS VARCHAR) || 'é' AS id
      FROM documents), h AS (SELECT kind, id, {_KEY_SQL} AS h FROM k)
    SELECT kind, id, h AS key_hash,
      substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-8' || substr(h, 14, 3) || '-' ||
      translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3)
      || '-' || substr(h, 21, 12) AS key_uuid FROM h""",
)
def key_hashes(spark, sf_dir):
    keys = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("kind"),
        F.concat("source", F.lit("/"), text("doc_id"), F.lit("é")).alias("id"),
    )
    return keys.select(
        "kind",
        "id",
        key_hash(F.col("kind"), F.col("id")).alias("key_hash"),
        key_uuid(F.col("kind"), F.col("id")).alias("key_uuid"),
    )


def _length_model():
    """A stand-in for a host's embedding model: two numbers from the text."""

    def predict(rows):
        texts = [row.get("text") or "" for row in rows]
        return np.array([[len(t), t.count(" ")] for t in texts], dtype="f4")

    return predict


@query(
    "embedded_documents",
    """SELECT CAST(doc_id AS VARCHAR) AS id,
      CASE WHEN doc_id % 11 <> 0 THEN CAST(length(text) AS DOUBLE) END AS characters,
      CASE WHEN doc_id % 11 <> 0
           THEN CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) END AS spaces
    FROM documents""",
)
def embedded_documents(spark, sf_dir):
    """Whole texts through an Arrow-batched host model; tombstones never reach it."""
    mapping = Mapping("bench", "table", "v1", ("text",), model="length-v1", dimension=2)
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        text("doc_id").alias("id"),
        F.when(k % 11 != 0, F.create_map(F.lit("text"), F.col("text"))).alias("fields"),
    )
    out = embed(rows, mapping, _length_model, "length-v1")
    v = F.col("vector")
    return out.select(
        "id", v[0].cast("double").alias("characters"), v[1].cast("double").alias("spaces")
    )


@query(
    "keys_admitted",
    """SELECT event_id, CASE
      WHEN event_id % 41 = 0 THEN 'kind_empty' WHEN event_id % 41 = 1 THEN 'kind_too_large'
      WHEN event_id % 41 = 2 THEN 'id_too_large' WHEN event_id % 41 = 3 THEN 'id_nul'
      WHEN event_id % 41 = 4 THEN 'revision_invalid'
      WHEN event_id % 41 = 5 THEN 'position_invalid' END AS reject_reason
    FROM events""",
)
def keys_admitted(spark, sf_dir):
    k = F.col("event_id") % 41
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(k == 0, "").when(k == 1, F.repeat(F.lit("é"), 65)).otherwise("user").alias("kind"),
        F.when(k == 2, F.repeat(F.lit("x"), 1025))
        .when(k == 3, F.concat(text("user_id"), F.lit("\0")))
        .otherwise(text("user_id"))
        .alias("id"),
        F.when(k == 4, 0).otherwise(F.col("event_id") + 1).alias("revision"),
        F.when(k == 5, 0).otherwise(F.col("event_id") + 1).alias("position"),
    )
    return admit_keys(rows).select("event_id", "reject_reason")


_ARRIVAL_SQL = """event_id * 2 + CASE WHEN event_id % 50 = 0 THEN 7 ELSE 0 END"""


@query(
    "history_check",
    f"""WITH a AS (SELECT event_id + 1 AS position, CAST(user_id AS VARCHAR) AS id,
        1 + (event_id * 3) // 2 AS revision, {_ARRIVAL_SQL} AS arrival FROM events)
    SELECT position, id, CASE WHEN position <= {_part_sql(1, 100)} THEN 'before_cursor'
      ELSE 'beyond_end' END AS fault FROM a
    WHERE position <= {_part_sql(1, 100)} OR position > {_part_sql(9, 10)}
    UNION ALL
    SELECT position, id, 'not_ascending' FROM (
      SELECT *, lag(position) OVER (ORDER BY arrival) AS before FROM a)
    WHERE position <= before""",
)
def history_check(spark, sf_dir):
    """A batch whose rows partly arrive out of order or lie outside the interval."""
    event = F.col("position") - 1
    late = F.when(event % 50 == 0, 7).otherwise(0)
    rows = journal(spark, sf_dir).withColumn("arrival", event * 2 + late)
    end = _feed_end(spark, sf_dir)
    faults = check_history(rows, "user", "g1", after=end // 100, end=end * 9 // 10)
    return faults.select("position", "id", "fault")


_COARSE_SQL = f"""
  SELECT kind, id, position, tombstone, digest,
         greatest(1, 1 + position // 1000 - CASE WHEN position % 97 = 0 THEN 2 ELSE 0 END)
           AS revision
  FROM ({OPERATIONS_SQL})
"""


@query(
    "history_conflicts",
    f"""WITH o AS ({_COARSE_SQL}), l AS (
      SELECT *, lag(revision) OVER w AS pr, lag(tombstone) OVER w AS pt, lag(digest) OVER w AS pd
      FROM o WINDOW w AS (PARTITION BY kind, id ORDER BY position))
    SELECT kind, id, position, revision, pr AS previous_revision,
           CASE WHEN revision < pr THEN 'revision_regressed' ELSE 'content_changed' END AS fault
    FROM l WHERE revision < pr
       OR (revision = pr AND (tombstone <> pt OR digest <> pd))""",
)
def history_conflicts(spark, sf_dir):
    """Coarse revisions, some of them set back: every break along a key."""
    ops = operations(journal(spark, sf_dir))
    back = F.when(F.col("position") % 97 == 0, 2).otherwise(0)
    coarse = ops.withColumn("revision", F.greatest(F.lit(1), F.expr("position div 1000") + 1 - back))
    return revision_conflicts(coarse)


@query(
    "replay_interval",
    f"""WITH o AS (SELECT * FROM ({OPERATIONS_SQL}) WHERE position > {_part_sql(1, 20)} AND position <= {_part_sql(9, 10)}),
    f AS ({FOLD_SQL}),
    d AS (SELECT count(*) AS n FROM f WHERE CAST(id AS BIGINT) % 13 = 0),
    r AS (SELECT coalesce(max(position), 0) >= {_part_sql(9, 10)} AS covered FROM ({OPERATIONS_SQL}))
    SELECT n * 2 AS differences, 0::BIGINT AS conflicts, covered,
      CASE WHEN NOT covered THEN 'history_gap' WHEN n > 0 THEN 'rebuild_required'
           ELSE 'ok' END AS status FROM d, r""",
)
def replay_interval(spark, sf_dir):
    """An interval rebuilt against an intent in which every thirteenth key was altered."""
    ops = operations(journal(spark, sf_dir))
    end = _feed_end(spark, sf_dir)
    after, upto = end // 20, end * 9 // 10
    interval = ops.filter((F.col("position") > after) & (F.col("position") <= upto))
    altered = F.when(F.col("id").cast("long") % 13 == 0, sha(F.lit("x"))).otherwise(F.col("digest"))
    intent = latest(interval).withColumn("digest", altered)
    return replay_matches(ops, intent, after, upto, inspected_end=end)


@query(
    "replay_buckets",
    f"""WITH o AS (SELECT * FROM ({OPERATIONS_SQL}) WHERE position > {_part_sql(1, 20)} AND position <= {_part_sql(9, 10)}),
    f AS (SELECT CAST(id AS BIGINT) AS n, ('0x' || substr(md5(id), 1, 2))::INT AS bucket FROM ({FOLD_SQL}))
    SELECT bucket, count(*) AS rebuilt_rows, count(*) FILTER (n % 29 <> 3) AS intent_rows, 0::BIGINT AS conflicts
    FROM f GROUP BY bucket HAVING count(*) FILTER (n % 29 = 3 OR n % 41 = 0) > 0""",
)
def replay_differing_buckets(spark, sf_dir):
    """Where an intent that lost some keys and has others altered differs from the feed."""
    ops = operations(journal(spark, sf_dir))
    end = _feed_end(spark, sf_dir)
    after, upto = end // 20, end * 9 // 10
    n = F.col("id").cast("long")
    kept = latest(ops.filter((F.col("position") > after) & (F.col("position") <= upto))).filter(n % 29 != 3)
    intent = kept.withColumn("digest", F.when(n % 41 == 0, sha(F.lit("x"))).otherwise(F.col("digest")))
    by = F.conv(F.substring(F.md5(F.col("id").cast("binary")), 1, 2), 16, 10).cast("int")
    return replay_buckets(ops, intent, after, upto, by)


@query(
    "replay_clean",
    f"""SELECT 0::BIGINT AS differences, 0::BIGINT AS conflicts, true AS covered, 'ok' AS status
    FROM ({OPERATIONS_SQL}) HAVING max(position) >= 1""",
)
def replay_clean(spark, sf_dir):
    """An intent that the feed rebuilds exactly."""
    ops = operations(journal(spark, sf_dir))
    end = _feed_end(spark, sf_dir)
    return replay_matches(ops, latest(ops), 0, end, inspected_end=end)


_SPLIT_SQL = f"""
  s AS (SELECT * FROM ({FOLD_SQL.replace("FROM o)", f"FROM ({OPERATIONS_SQL}) WHERE position <= {_part_sql(1, 2)})")})),
  p AS (SELECT kind, id, CASE WHEN CAST(id AS BIGINT) % 17 = 0 THEN 1 ELSE revision END AS revision,
               tombstone, digest
        FROM ({FOLD_SQL.replace("FROM o)", f"FROM ({OPERATIONS_SQL}) WHERE position > {_part_sql(1, 2)})")}))
"""


@query(
    "key_state_merge",
    f"""WITH {_SPLIT_SQL}
    SELECT coalesce(s.id, p.id) AS id,
      CASE WHEN s.id IS NULL THEN p.revision WHEN p.revision > s.revision THEN p.revision
           ELSE s.revision END AS revision,
      CASE WHEN p.id IS NULL THEN 'kept' WHEN s.id IS NULL THEN 'inserted'
           WHEN p.revision = s.revision AND p.tombstone = s.tombstone AND p.digest = s.digest
             THEN 'repeated'
           WHEN p.revision > s.revision THEN 'advanced' ELSE 'conflict' END AS status
    FROM s FULL JOIN p ON s.kind = p.kind AND s.id = p.id""",
)
def key_state_merge(spark, sf_dir):
    """Stored states met by a page in which every seventeenth key falls back."""
    ops = operations(journal(spark, sf_dir))
    half = _feed_end(spark, sf_dir) // 2
    state = latest(ops.filter(F.col("position") <= half))
    back = F.when(F.col("id").cast("long") % 17 == 0, F.lit(1)).otherwise(F.col("revision"))
    page = latest(ops.filter(F.col("position") > half)).withColumn("revision", back.cast("long"))
    return merge_key_state(state, page).select("id", "revision", "status")


_QUARTER_SQL = f"""
  o AS (SELECT *, (position - 1) * 4 // (SELECT max(event_id) + 1 FROM events) AS q,
        CASE WHEN (position - 1) * 4 // (SELECT max(event_id) + 1 FROM events) = 3 AND CAST(id AS BIGINT) % 17 = 0
             THEN 1 ELSE revision END AS own FROM ({OPERATIONS_SQL})),
  p AS (SELECT id, q, max_by(own, position) AS revision, count(DISTINCT digest || tombstone) AS contents FROM o GROUP BY id, q)
"""


@query(
    "key_state_stream",
    f"""WITH {_QUARTER_SQL}
    SELECT id, coalesce(max(revision) FILTER (NOT (q = 3 AND CAST(id AS BIGINT) % 17 = 0)), 1) AS revision,
      count(*) FILTER (q = 3 AND CAST(id AS BIGINT) % 17 = 0) AS conflicts
    FROM p GROUP BY id""",
)
def key_state_in_pages(spark, sf_dir):
    """The feed as a stream of four pages; in the last every seventeenth key falls back and keeps its state."""
    path = scratch_dir(spark, "keyed")
    ops = operations(journal(spark, sf_dir))
    end = _feed_end(spark, sf_dir)
    for n in range(4):
        quarter = ops.filter(F.floor((F.col("position") - 1) * 4 / F.lit(end)) == n)
        if n == 3:
            back = F.when(F.col("id").cast("long") % 17 == 0, F.lit(1)).otherwise(F.col("revision"))
            quarter = quarter.withColumn("revision", back.cast("long"))
        quarter.coalesce(1).write.mode("append").parquet(f"{path}/in")
    use_keyed_state(spark)
    stream = spark.readStream.schema(ops.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")

    def store(batch, number):
        batch.withColumn("page", F.lit(number)).write.mode("overwrite").parquet(f"{path}/out/page={number}")

    job = key_state_stream(stream).writeStream.foreachBatch(store).outputMode("update")
    job.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.parquet(f"{path}/out")
    return seen.groupBy("id").agg(F.max("revision").alias("revision"), F.count_if(F.col("status") == "conflict").alias("conflicts"))


@query(
    "reconcile_status",
    f"""WITH o AS ({OPERATIONS_SQL}), f AS ({FOLD_SQL}),
    k AS (SELECT id, revision, CAST(id AS BIGINT) % 13 AS m FROM f)
    SELECT id, CASE m WHEN 0 THEN 'missing' WHEN 1 THEN 'digest_mismatch'
      WHEN 2 THEN 'higher_revision' WHEN 3 THEN 'duplicate' WHEN 5 THEN 'foreign'
      WHEN 6 THEN 'tombstone_mismatch' WHEN 7 THEN 'lower_revision' ELSE 'ok' END AS status FROM k
    UNION ALL SELECT 'x' || id, 'extra' FROM k WHERE m = 4""",
)
def reconcile_status(spark, sf_dir):
    """Read-back with lost, altered, repeated, foreign and unexpected rows."""
    intent = latest(operations(journal(spark, sf_dir)))
    m = F.col("id").cast("long") % 13
    shift = F.when(m == 2, 1).when(m == 7, -1).otherwise(0)
    stored = intent.filter(m != 0).select(
        "kind",
        "id",
        (F.col("revision") + shift).alias("revision"),
        F.when(m == 6, ~F.col("tombstone")).otherwise(F.col("tombstone")).alias("tombstone"),
        F.when(m == 1, sha(F.lit("x"))).otherwise(F.col("digest")).alias("digest"),
        F.when(m == 5, "other").otherwise("profile-a").alias("profile"),
        F.lit("target-a").alias("target"),
        m.alias("m"),
    )
    twice = stored.filter("m = 3")
    extra = stored.filter("m = 4").withColumn("id", F.concat(F.lit("x"), "id"))
    observed = stored.unionByName(twice).unionByName(extra).drop("m")
    return reconcile(intent, observed, "profile-a", "target-a").select("id", "status")


@query(
    "vector_reconciliation",
    """SELECT CAST(vec_id AS VARCHAR) AS id, CASE vec_id % 13 WHEN 0 THEN 'missing'
      WHEN 1 THEN 'vector_mismatch' WHEN 2 THEN 'payload_mismatch' WHEN 3 THEN 'duplicate'
      WHEN 4 THEN 'dimension_mismatch' ELSE 'ok' END AS status FROM embeddings""",
)
def vector_reconciliation(spark, sf_dir):
    """Stored vectors that differ in one bit, in payload, in length, or are repeated."""
    unit = (
        vectors(spark, sf_dir)
        .withColumn("_n", l2_norm(F.col("vector")))
        .withColumn("vector", l2_normalize(canonical_vector(F.col("vector")), F.col("_n")))
        .withColumn("digest", sha(F.col("id")))
        .select("kind", "id", "revision", "digest", "vector", "vec_id")
    )
    m, v = F.col("vec_id") % 13, F.col("vector")
    nudged = F.transform(
        v, lambda x, i: F.when(i == 5, x * F.lit(1.0000002).cast("float")).otherwise(x)
    )
    actual = unit.filter(m != 0).select(
        "kind", "id", "revision",
        F.when(m == 2, sha(F.lit("x"))).otherwise(F.col("digest")).alias("digest"),
        F.when(m == 1, nudged).when(m == 4, F.slice(v, 1, 63)).otherwise(v).alias("vector"),
        "vec_id",
    )
    observed = actual.unionByName(actual.filter(m == 3))
    return reconcile_vectors(unit, observed).select("id", "status")


@query(
    "cursor_advance",
    """WITH e AS (SELECT event_type AS kind, max(event_id) + 1 AS top FROM events GROUP BY 1)
    SELECT kind, CASE kind WHEN 'signup' THEN 'g0' ELSE 'g1' END AS generation,
      CASE kind WHEN 'click' THEN top WHEN 'view' THEN top + 5 WHEN 'purchase' THEN top
                WHEN 'signup' THEN 7 END AS position,
      CASE kind WHEN 'click' THEN 'advanced' WHEN 'view' THEN 'backward'
                WHEN 'purchase' THEN 'unchanged' WHEN 'signup' THEN 'generation_gap'
                ELSE 'no_cursor' END AS status
    FROM e""",
)
def cursor_advance(spark, sf_dir):
    """Five feeds: one moves on, the others are refused for five different reasons."""
    inspected = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kind"),
        F.lit("g1").alias("generation"),
        (F.col("event_id") + 1).alias("position"),
    )
    kind = F.col("kind")
    cursors = (
        inspected.groupBy("kind")
        .agg(F.max("position").alias("top"))
        .filter(kind != "error")
        .select(
            "kind",
            F.when(kind == "signup", "g0").otherwise("g1").alias("generation"),
            F.when(kind == "click", F.lit(10))
            .when(kind == "view", F.col("top") + 5)
            .when(kind == "purchase", F.col("top"))
            .otherwise(F.lit(7))
            .alias("position"),
        )
    )
    return advance_cursors(cursors, inspected)


@query(
    "live_and_deleted",
    f"""WITH o AS ({OPERATIONS_SQL}), f AS ({FOLD_SQL})
    SELECT id, revision, NOT tombstone AS visible FROM f""",
)
def live_and_deleted(spark, sf_dir):
    """Current keys; a deleted one keeps its identity and revision only."""
    newest = latest(operations(journal(spark, sf_dir)))
    seen = live(newest).select("id", "revision", F.lit(True).alias("visible"))
    gone = tombstones(newest, "digest").select("id", "revision", F.lit(False).alias("visible"))
    return seen.unionByName(gone)


def _stored(rows: DataFrame) -> DataFrame:
    """Operations with the columns a projection stores."""
    digest = sha(F.concat(F.coalesce("event_type", F.lit("")), F.coalesce("props", F.lit(""))))
    return rows.withColumn("digest", digest).select(
        "kind", "id", "position", "revision", "tombstone", "digest", "event_type"
    )


_END_STATE_SQL = f"""WITH j AS ({JOURNAL_SQL})
  SELECT id, max(position) AS position, max(revision) AS revision,
         max_by(tombstone, position) AS tombstone,
         arg_max_null(event_type, position) AS event_type FROM j GROUP BY id"""


@query("generation_upsert", _END_STATE_SQL)
def generation_upsert(spark, sf_dir):
    """Three pages in the wrong order, one of them twice, with a compaction between."""
    path = scratch_dir(spark, "generation")
    rows = _stored(journal(spark, sf_dir))
    for batch, page in enumerate((2, 0, 1)):
        write_generation(rows.filter(F.col("position") % 3 == page), path, batch)
        if batch == 1:
            compact(spark, path, rows.schema)
    write_generation(rows.filter(F.col("position") % 3 == 1), path, 2)
    return read_generation(spark, path, rows.schema).select(
        "id", "position", "revision", "tombstone", "event_type"
    )


def _project(spark, sf_dir, path):
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    run_projection(
        events_as_journal(stream), _stored, "profile-a", path, f"{path}-checkpoint", once=True
    ).awaitTermination()


@query("projection_end_state", _END_STATE_SQL)
def projection_end_state(spark, sf_dir):
    """The streaming projection job run to the end of the feed."""
    path = scratch_dir(spark, "projection")
    _project(spark, sf_dir, path)
    schema = _stored(journal(spark, sf_dir)).schema
    return read_generation(spark, path, schema).select(
        "id", "position", "revision", "tombstone", "event_type"
    )


@query(
    "projection_cursor",
    """SELECT 'user' AS kind, 'g1' AS generation, max(event_id) + 1 AS position FROM events""",
)
def projection_cursor(spark, sf_dir):
    """Where the streaming job's cursor stands after its last committed page."""
    path = scratch_dir(spark, "projection")
    _project(spark, sf_dir, path)
    return read_cursors(spark, path)


_PAGE_SQL = """WITH n AS (SELECT max(event_id) + 1 AS last, (max(event_id) + 1) // 2 AS half FROM events)
SELECT * FROM (VALUES ('backward', 'user', 'not_after_cursor'), ('changed', 'user', 'generation_changed'),
  ('mixed', 'user', 'mixed_generations'), ('repeated', 'user', 'not_ascending')) t("case", kind, fault), n"""


@query("projection_page_faults", f"""SELECT "case", kind, fault, half AS position FROM ({_PAGE_SQL})""")
def projection_page_faults(spark, sf_dir):
    """The second half of the feed after cursors that it does and does not continue."""
    feed = events_as_journal(table(spark, sf_dir, "events"))
    last = feed.agg(F.max("position")).first()[0]
    page = feed.filter(F.col("position") > last // 2)
    odd = F.when(F.col("position") == last, "g0").otherwise(F.col("generation"))
    cases = {
        "fits": (page, "g1", last // 2),
        "backward": (page, "g1", last // 2 + 1),
        "changed": (page, "g0", last // 2),
        "mixed": (page.withColumn("generation", odd), "g1", last // 2),
        "repeated": (page.unionByName(page.filter(F.col("position") == last)), "g1", last // 2),
    }
    found = None
    for name, (rows, generation, position) in cases.items():
        cursor = spark.createDataFrame([("user", generation, position)], "kind string, generation string, position long")
        faults = page_faults(rows, cursor).select(
            F.lit(name).alias("case"), "kind", "fault", F.lit(last // 2).cast("long").alias("position")
        )
        found = faults if found is None else found.unionByName(faults)
    return found


@query("projection_pages", _END_STATE_SQL)
def projection_pages(spark, sf_dir):
    """The feed applied as four pages in order, each after the cursor of the one before."""
    path = scratch_dir(spark, "projection")
    feed = events_as_journal(table(spark, sf_dir, "events"))
    last = feed.agg(F.max("position")).first()[0]
    for n in range(4):
        inside = F.col("position").between(n * last // 4 + 1, (n + 1) * last // 4)
        apply_page(feed.filter(inside), n, _stored, "profile-a", path)
    schema = _stored(journal(spark, sf_dir)).schema
    return read_generation(spark, path, schema).select("id", "position", "revision", "tombstone", "event_type")
