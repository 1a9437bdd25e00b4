"""One registered query for each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import (
    alignment,
    decontam,
    htmltext,
    lexical,
    linededup,
    packing,
    pseudonyms,
    quality,
    simhash,
    sketches,
    tokencount,
    toxicity,
    urlfilter,
)
from revtide.llm.common import table
from revtide.llm.registry import query

RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
#: The demonstration's key; a real one comes from the caller's secret store.
PSEUDONYM_KEY = "revtide-demonstration-key"


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op2_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole=True)


@query("op3_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, RULES, urlfilter.train(urlfilter.labelled_by_words(pages)))


@query("op4_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


@query("op5_pii_pseudonyms")
def pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@query("op6_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query("op8_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_versions(table(spark, sf_dir, "documents"))


@query("op9_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_components(table(spark, sf_dir, "documents"), size=3)


@query("op10_toxicity")
def toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = toxicity.table_categories(table(spark, sf_dir, "labels"))
    return toxicity.score(docs, toxicity.train(docs, labels, toxicity.CATEGORIES))


@query("op11_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.score(docs, quality.train(docs, labels))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_ranked_lexical_search",
    f"""WITH items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    docs AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS terms FROM documents),
    sizes AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
    corpus AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
    tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
      WHERE term IN (SELECT term FROM items) GROUP BY ALL),
    df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
    parts AS (SELECT r, term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l))) AS part
      FROM tf JOIN df USING (term) JOIN sizes USING (r), corpus),
    scores AS (SELECT item_id, doc_id, r, sum(part)::BIGINT AS score
      FROM items JOIN parts USING (term) JOIN sizes USING (r) GROUP BY ALL HAVING sum(part) > 0)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INT AS rank,
      doc_id, score FROM scores QUALIFY rank <= 50""",
)
def ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


@query("op13_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))
