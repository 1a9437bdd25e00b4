"""Text and vector retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from revtide.functions.text import query_terms, tokens
from revtide.functions.values import Mapping
from revtide.operators.pivots import pivot_candidates, read_pivot_store, write_pivot_store
from revtide.operators.retrieval import (
    admit_candidates,
    authorized_view,
    hydrate,
    refused_vectors,
    search_many,
    search_text,
    search_vectors,
    vector_candidates,
    vector_candidates_many,
)
from revtide.operators.textindex import (
    build_text_index,
    read_text_index,
    scan_text_candidates,
    text_candidates,
    write_text_index,
)
from revtide.plans.registry import query
from revtide.plans.tables import (
    current_documents,
    documents,
    shown_documents_sql,
    table,
    text,
    vectors,
)
from revtide.session import scratch_dir

_TERMS_SQL = r"""
  tokens AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, doc_id % 5 + 1 AS revision,
           list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS ts
    FROM documents WHERE doc_id % 11 <> 0),
  postings AS (
    SELECT id, revision, len(ts) AS doc_len, term, count(*) AS tf
    FROM (SELECT id, revision, ts, unnest(ts) AS term FROM tokens)
    GROUP BY id, revision, len(ts), term)
"""


@query(
    "text_index_terms",
    f"""WITH {_TERMS_SQL}
    SELECT term, count(*) AS documents, CAST(sum(tf) AS BIGINT) AS occurrences,
           CAST(sum(doc_len) AS BIGINT) AS lengths
    FROM postings GROUP BY term""",
)
def text_index_terms(spark, sf_dir):
    """Every posting of the whole corpus, summed up by term."""
    index = build_text_index(documents(spark, sf_dir), ["text"])
    return index.postings.groupBy("term").agg(
        F.count("*").alias("documents"),
        F.sum("tf").alias("occurrences"),
        F.sum("doc_len").alias("lengths"),
    )


@query(
    "text_index_stats",
    f"""WITH {_TERMS_SQL} SELECT 'doc' AS kind, 'text' AS field, count(*) AS n_docs,
      CAST(sum(len(ts)) AS BIGINT) AS total_len FROM tokens WHERE len(ts) > 0""",
)
def text_index_stats(spark, sf_dir):
    return build_text_index(documents(spark, sf_dir), ["text"]).stats.drop("profile")


def _candidates_sql(terms: list[str], mode: str, budget: int) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    every = f"HAVING count(*) = {len(terms)}" if mode == "all" else ""
    return f"""{_TERMS_SQL},
      corpus AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(len(ts)) / CAST(count(*) AS DOUBLE)
                 AS mean FROM tokens WHERE len(ts) > 0),
      hits AS (SELECT * FROM postings WHERE term IN ({listed})),
      df AS (SELECT term, count(*) AS df FROM hits GROUP BY term),
      scored AS (
        SELECT id, revision, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
               / (tf + 1.2 * (0.25 + 0.75 * doc_len / mean)) ORDER BY term) AS score
        FROM hits JOIN df USING (term), corpus GROUP BY id, revision {every}),
      candidates AS (
        SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, revision
        FROM scored QUALIFY rank <= {budget})"""


def _stored_index(spark, sf_dir):
    """The documents' index, analysed once and stored."""
    path = scratch_dir(spark, "text-index")
    write_text_index(build_text_index(documents(spark, sf_dir), ["text"], scratch=f"{path}/analysis"), path)
    return read_text_index(spark, path)


ALL_TEXT = "The then: THE, on"
ANY_TEXT = "der et the benchmark"


@query(
    "text_all",
    f"""WITH {_candidates_sql(["on", "the", "then"], "all", 256)}
    SELECT rank, 'doc' AS kind, id, revision FROM candidates""",
)
def text_all(spark, sf_dir):
    path = scratch_dir(spark, "text-scan")
    docs = documents(spark, sf_dir)
    return scan_text_candidates(docs, "doc", "text", ALL_TEXT, "all", scratch=path)


@query(
    "text_any",
    f"""WITH {_candidates_sql(["benchmark", "der", "et", "the"], "any", 256)}
    SELECT rank, 'doc' AS kind, id, revision FROM candidates""",
)
def text_any(spark, sf_dir):
    path = scratch_dir(spark, "text-scan")
    docs = documents(spark, sf_dir)
    return scan_text_candidates(docs, "doc", "text", ANY_TEXT, "any", scratch=path)


@query(
    "text_stored_index",
    f"""WITH {_candidates_sql(["on", "the", "then"], "all", 40)}
    SELECT rank, 'doc' AS kind, id, revision FROM candidates""",
)
def text_stored_index(spark, sf_dir):
    """The same from an index stored by zone and term, of which only what can rank is read."""
    return text_candidates(_stored_index(spark, sf_dir), "doc", "text", ALL_TEXT, "all", 40)


@query(
    "text_any_stored",
    f"""WITH {_candidates_sql(["benchmark", "der", "et", "the"], "any", 40)}
    SELECT rank, 'doc' AS kind, id, revision FROM candidates""",
)
def text_any_stored(spark, sf_dir):
    """Any of the terms, from a stored index."""
    return text_candidates(_stored_index(spark, sf_dir), "doc", "text", ANY_TEXT, "any", 40)


def _first_vector(spark, sf_dir) -> list[float]:
    """The request vector: the embedding of the lowest id."""
    rows = table(spark, sf_dir, "embeddings")
    return list(rows.filter(F.col("vec_id") == 0).select("embedding").first()[0])


_SCORES = {
    "dot": ("list_inner_product(v, q)", "DESC"),
    "euclid": ("list_distance(v, q)", ""),
    "manhattan": ("list_sum(list_transform(list_zip(v, q), lambda p: abs(p[1] - p[2])))", ""),
    "cosine": ("list_inner_product(v, q)", "DESC"),
}


def _knn_sql(metric: str, budget: int) -> str:
    score, order = _SCORES[metric]
    raw = "CAST(embedding AS DOUBLE[])"
    unit = (
        f"CAST(list_transform({raw}, lambda x: CAST(x / sqrt(list_inner_product({raw}, {raw})) AS FLOAT))"
        " AS DOUBLE[])"
    )
    v = unit if metric == "cosine" else raw
    return f"""SELECT row_number() OVER (ORDER BY score {order}, id) AS rank, 'vec' AS kind, id,
      revision FROM (
        SELECT CAST(vec_id AS VARCHAR) AS id, vec_id % 3 + 1 AS revision, {score} AS score
        FROM (SELECT vec_id, {v} AS v FROM embeddings WHERE vec_id % 19 <> 18 AND vec_id <> 0),
             (SELECT {v} AS q FROM embeddings WHERE vec_id = 0))
      QUALIFY rank <= {budget}"""


def _register_knn(metric: str) -> None:
    @query(f"knn_{metric}", _knn_sql(metric, 100))
    def knn(spark, sf_dir):
        wanted = _first_vector(spark, sf_dir)
        return vector_candidates(
            vectors(spark, sf_dir), wanted, metric, "vec", budget=100, exclude="0"
        )


for _metric in _SCORES:
    _register_knn(_metric)


@query("knn_euclid_pivots", _knn_sql("euclid", 100))
def knn_euclid_pivots(spark, sf_dir):
    """The same vectors as the scan's, from a store clustered by distances to pivots."""
    path = scratch_dir(spark, "pivots")
    write_pivot_store(vectors(spark, sf_dir), path, "euclid")
    return pivot_candidates(read_pivot_store(spark, path), _first_vector(spark, sf_dir), "vec", budget=100, exclude="0")


@query(
    "knn_many",
    """WITH q AS (SELECT label AS query, embedding AS q FROM (
        SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label)),
    s AS (SELECT CAST(query AS VARCHAR) AS query, CAST(vec_id AS VARCHAR) AS id,
        vec_id % 3 + 1 AS revision,
        list_distance(CAST(embedding AS DOUBLE[]), CAST(q AS DOUBLE[])) AS score
      FROM embeddings, q WHERE vec_id % 19 <> 18)
    SELECT query, row_number() OVER (PARTITION BY query ORDER BY score, id) AS rank,
      'vec' AS kind, id, revision FROM s QUALIFY rank <= 25""",
)
def knn_many(spark, sf_dir):
    """The first vector of every label as one request each, in one pass over the table."""
    first = (
        table(spark, sf_dir, "embeddings")
        .groupBy("label")
        .agg(F.min_by("embedding", "vec_id").alias("q"))
    )
    requests = {str(row.label): list(row.q) for row in first.collect()}
    return vector_candidates_many(vectors(spark, sf_dir), requests, "euclid", "vec", budget=25)


@query(
    "knn_dot_tiny",
    _knn_sql("dot", 100).replace("CAST(embedding AS DOUBLE[])", "CAST(list_transform(embedding, lambda x: CAST(x * 0.0001 AS FLOAT)) AS DOUBLE[])"),
)
def knn_dot_tiny(spark, sf_dir):
    """Scores of about 1e-8 rank by their full value, as large ones do."""
    tiny = F.transform("vector", lambda x: (x.cast("double") * 0.0001).cast("float"))
    rows = vectors(spark, sf_dir).withColumn("vector", tiny)
    wanted = list(rows.filter("id = '0'").select("vector").first()[0])
    return vector_candidates(rows, wanted, "dot", "vec", budget=100, exclude="0")


@query(
    "vectors_refused",
    """SELECT reject_reason, count(*) AS n FROM (
      SELECT CASE WHEN vec_id % 23 = 4 THEN 'dimension_mismatch' WHEN vec_id % 29 = 5 THEN 'zero_vector' END
        AS reject_reason
      FROM embeddings WHERE vec_id % 19 <> 18) WHERE reject_reason IS NOT NULL GROUP BY 1""",
)
def vectors_without_rank(spark, sf_dir):
    """Short and zero vectors, which a cosine search of 64 components cannot rank, are reported."""
    k = F.col("vec_id")
    odd = F.when(k % 23 == 4, F.slice("vector", 1, 3)).when(
        k % 29 == 5, F.transform("vector", lambda x: F.lit(0.0).cast("float"))
    )
    rows = vectors(spark, sf_dir).withColumn("vector", F.coalesce(odd, "vector"))
    return refused_vectors(rows, 64, "cosine", "vec").groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(
    "text_profiles",
    f"""WITH {_TERMS_SQL}
    SELECT profile, CAST(count(DISTINCT id) AS BIGINT) AS documents, count(*) AS postings
    FROM (SELECT id, 'p' || (CAST(id AS BIGINT) % 2) AS profile, term FROM postings) GROUP BY profile""",
)
def text_profiles(spark, sf_dir):
    """Texts that two mappings indexed stay apart."""
    docs = documents(spark, sf_dir)
    docs = docs.withColumn("profile", F.concat(F.lit("p"), text(F.col("id").cast("long") % 2)))
    return (
        build_text_index(docs, ["text"])
        .postings.groupBy("profile")
        .agg(F.count_distinct("id").alias("documents"), F.count("*").alias("postings"))
    )


@query(
    "candidate_admission",
    """SELECT count(*) AS candidates, count(*) FILTER (vec_id % 5 = 0) AS foreign_kind,
      0::BIGINT AS revision_invalid, 1::BIGINT AS excluded_key, 0::BIGINT AS duplicate_key,
      0::BIGINT AS duplicate_rank, 0::BIGINT AS score_order,
      CASE WHEN count(*) > 64 THEN 'over_budget' ELSE 'rejected' END AS status
    FROM embeddings""",
)
def candidate_admission(spark, sf_dir):
    """A whole table offered as candidates: refused, not trimmed."""
    k = F.col("vec_id")
    offered = vectors(spark, sf_dir).select(
        (k + 1).alias("rank"),
        F.when(k % 5 == 0, "other").otherwise("vec").alias("kind"),
        "id",
        "revision",
        (F.lit(1.0) / (k + 1)).alias("score"),
    )
    return admit_candidates(offered, "vec", 64, exclude="3", order="desc")


def _readable(spark, sf_dir):
    """What reader ``r1`` may see: no ``src1`` rows; ``lang`` is masked for ``src0``."""
    return authorized_view(
        current_documents(spark, sf_dir),
        lambda actor: F.col("source") != "src1",
        {"text": lambda actor: F.lit(True), "lang": lambda actor: F.col("source") != "src0"},
        "r1",
    )


@query(
    "authorized_documents",
    f"SELECT id, revision, has_lang FROM ({shown_documents_sql()})",
)
def authorized_documents(spark, sf_dir):
    return _readable(spark, sf_dir).select(
        "id", "revision", F.map_contains_key("fields", "lang").alias("has_lang")
    )


_HYDRATED_SQL = f"""WITH {_candidates_sql(["benchmark", "der", "et", "the"], "any", 200)}
  SELECT rank, id, c.revision FROM candidates c
  JOIN ({shown_documents_sql()}) d USING (id)
  WHERE d.revision = c.revision AND has_lang ORDER BY rank LIMIT 50"""


@query("search_hydrated", _HYDRATED_SQL)
def search_hydrated(spark, sf_dir):
    """Candidates joined to current readable rows that still show text and lang."""
    docs = documents(spark, sf_dir)
    path = scratch_dir(spark, "text-scan")
    found = scan_text_candidates(docs, "doc", "text", ANY_TEXT, "any", 200, scratch=path)
    kept = hydrate(found, _readable(spark, sf_dir), ["text", "lang"], 50)
    return kept.select("rank", "id", "revision")


@query("search_text", _HYDRATED_SQL)
def search_text_request(spark, sf_dir):
    """The whole request, with the host policy asked around every read."""
    path = scratch_dir(spark, "text-scan")
    index = build_text_index(documents(spark, sf_dir), ["text"], query_terms(ANY_TEXT), path)
    found = search_text(
        index, _readable(spark, sf_dir), "doc", "text", ANY_TEXT, "any", ["text", "lang"], 50, 200
    )
    return found.select("rank", "id", "revision")


_REQUESTS_SQL = r"""
  words AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS ws
            FROM benchmark),
  requests AS (SELECT item_id * 5 + j AS request, list_distinct(ws[4 * j + 1 : 4 * j + 2]) AS ts
               FROM words, (SELECT unnest(range(5)) AS j))
"""

_MANY_SQL = f"""WITH {_TERMS_SQL}, {_REQUESTS_SQL},
  corpus AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(len(ts)) / CAST(count(*) AS DOUBLE) AS mean FROM tokens WHERE len(ts) > 0),
  asked AS (SELECT request, len(ts) AS n_terms, unnest(ts) AS term FROM requests),
  df AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
  scored AS (
    SELECT request, id, revision, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
           / (tf + 1.2 * (0.25 + 0.75 * doc_len / mean)) ORDER BY term) AS score
    FROM asked JOIN df USING (term) JOIN postings USING (term), corpus
    GROUP BY request, id, revision, n_terms HAVING count(*) = n_terms),
  candidates AS (
    SELECT request, row_number() OVER (PARTITION BY request ORDER BY score DESC, id) AS rank, id, revision
    FROM scored QUALIFY rank <= 40),
  shown AS (
    SELECT request, rank, id, c.revision FROM candidates c JOIN ({shown_documents_sql()}) d USING (id)
    WHERE d.revision = c.revision AND has_lang
    QUALIFY row_number() OVER (PARTITION BY request ORDER BY rank) <= 10)"""


def _many(spark, sf_dir):
    """Five pairs of neighbouring words of every benchmark text as one request each."""
    words = table(spark, sf_dir, "benchmark").select("item_id", tokens(F.col("text")).alias("ws"))
    requests = words.select(
        "item_id", "ws", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("j")
    ).select((F.col("item_id") * 5 + F.col("j")).alias("request"), F.array_join(F.slice("ws", F.col("j") * 4 + 1, 2), " ").alias("text"))
    index = build_text_index(documents(spark, sf_dir), ["text"], scratch=scratch_dir(spark, "text-scan"))
    return search_many(index, _readable(spark, sf_dir), requests, "doc", "text", "all", ["text", "lang"], 10, 40)


@query("search_many", f"{_MANY_SQL} SELECT request, rank, id, revision FROM shown")
def search_many_requests(spark, sf_dir):
    """All requests as one plan."""
    return _many(spark, sf_dir).found.select("request", "rank", "id", "revision")


@query(
    "search_many_verdicts",
    f"""{_MANY_SQL}
    SELECT request, CASE WHEN len(ts) = 0 THEN 'invalid' ELSE 'ok' END AS status,
      (SELECT count(*) FROM candidates c WHERE c.request = r.request) AS candidates,
      (SELECT count(*) FROM shown s WHERE s.request = r.request) AS shown
    FROM requests r""",
)
def search_many_verdicts(spark, sf_dir):
    """One verdict for each request."""
    return _many(spark, sf_dir).verdicts


@query(
    "search_vectors",
    f"""WITH c AS ({_knn_sql("cosine", 100)})
    SELECT rank, id, revision, label FROM (
      SELECT c.rank, c.id, c.revision, CAST(e.label AS VARCHAR) AS label
      FROM c JOIN embeddings e ON CAST(e.vec_id AS VARCHAR) = c.id
      WHERE e.vec_id % 7 <> 0) ORDER BY rank LIMIT 20""",
)
def search_vectors_request(spark, sf_dir):
    """Nearest vectors of one mapping whose current row has the indexed revision."""
    mapping = Mapping("bench", "table", "v1", ("label",), model="given-v1", dimension=64)
    rows = vectors(spark, sf_dir).withColumn("profile", F.lit(mapping.fingerprint))
    moved = F.when(F.col("vec_id") % 7 == 0, 1).otherwise(0)
    view = rows.select(
        "kind",
        "id",
        (F.col("revision") + moved).alias("revision"),
        "tombstone",
        F.create_map(F.lit("label"), text("label")).alias("fields"),
    )
    wanted = _first_vector(spark, sf_dir)
    found = search_vectors(
        rows, view, "vec", wanted, "cosine", mapping, ["label"], 20, 100, exclude="0"
    )
    return found.select("rank", "id", "revision", F.col("fields")["label"].alias("label"))
