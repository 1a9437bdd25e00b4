"""Inverted text index and ranked text candidates.

Ranking is the published BM25 formula; what a caller may rely on is membership (all or any
of the terms) and the live, kind and profile filters. No score leaves the operator.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.functions.text import query_terms, run_starts, term_counts, tokens
from revtide.functions.values import check_fields, check_name
from revtide.verdicts import Refused

# BM25 parameters, and the bounds of one text request.
K1 = 1.2
B = 0.75
QUERY_BYTES = 4096
MAX_LIMIT = 64
MAX_BUDGET = 256


#: A stored index deals its documents by length into zones, ``ZONES_PER_DOUBLING`` for each doubling, and
#: a zone's documents into blocks of about so many.
ZONES_PER_DOUBLING = 4
BLOCK_DOCS = 128
#: Terms of texts, repeats included, whose postings make up one file of a stored index at most; while
#: there are fewer files than cores, a file is made for each ``SMALL_FILE_TERMS``.
FILE_TERMS, SMALL_FILE_TERMS = 8_000_000, 250_000
#: A term of so many documents at most has no stored bounds; a request takes them from its few postings.
RARE_DOCS = 256
#: What rounding may add to a sum of parts.
SLACK = 1e-9


class TextIndex(NamedTuple):
    postings: DataFrame
    stats: DataFrame
    rejected: DataFrame
    lengths: DataFrame


_OWN = "profile string, kind string, field string, term string"
#: Tables of a stored index.
STORED = {
    "postings": f"{_OWN}, id string, revision long, tf long, doc_len long, block long, top double, zone int",
    "blocks": f"{_OWN}, block long, top double, n long, zone int",
    "zones": f"{_OWN}, zone int, top double, n long",
    "terms": f"{_OWN}, df long",
    "stats": "profile string, kind string, field string, n_docs long, total_len long",
}


class StoredTextIndex(NamedTuple):
    """Postings in folders by zone, clustered by term, with what tells which of them a request needs.

    ``terms`` has each term's number of documents; ``blocks`` and ``zones`` have, for each term that is not
    rare, the largest part of a score that it has in a block or zone.
    """

    postings: DataFrame
    stats: DataFrame
    rejected: DataFrame
    terms: DataFrame
    blocks: DataFrame
    zones: DataFrame


FIELD = ["profile", "kind", "field"]


def check_bounds(limit: int, budget: int, max_limit=MAX_LIMIT, max_budget=MAX_BUDGET) -> None:
    if not 1 <= limit <= max_limit or not limit <= budget <= max_budget:
        raise Refused("need 1 <= limit <= max_limit and limit <= budget <= max_budget")


def _profile(docs: DataFrame):
    """The mapping that indexed a row; empty where the table has no ``profile`` column."""
    return F.coalesce("profile", F.lit("")) if "profile" in docs.columns else F.lit("")


def _texts(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Live (kind, id, revision, field, text), with ``bad`` where a value is no string."""
    pieces = []
    for name in names:
        if name in docs.columns:
            if docs.schema[name].dataType != T.StringType():
                raise Refused(f"text field {name} is not a string column")
            text, bad = F.col(name), F.lit(False)
        else:
            raw = F.try_element_at("fields", F.lit(name))
            text = F.variant_get(F.try_parse_json(raw), "$", "string")
            bad = raw.isNotNull() & (raw != "null") & ~raw.startswith('"')
        pieces.append(F.struct(F.lit(name).alias("field"), text.alias("text"), bad.alias("bad")))
    return (
        docs.filter(~F.col("tombstone"))
        .select(
            _profile(docs).alias("profile"), "kind", "id", "revision", F.explode(F.array(*pieces)).alias("_f")
        )
        .select("profile", "kind", "id", "revision", "_f.*")
    )


def _analysed(texts: DataFrame, terms: list[str] | None) -> DataFrame:
    """Per text its length and the (term, tf) runs, of all terms or of the given ones."""
    split = texts.filter(~F.col("bad") & F.col("text").isNotNull()).withColumn(
        "_all", tokens(F.col("text"))
    )
    wanted = F.col("_all") if terms is None else F.filter("_all", lambda t: t.isin(terms or [""]))
    return (
        split.withColumn("doc_len", F.size("_all").cast("long"))
        .withColumn("_tokens", F.sort_array(wanted))
        .withColumn("_starts", run_starts(F.col("_tokens")))
        .withColumn("runs", term_counts(F.col("_tokens"), F.col("_starts")))
        .select("profile", "kind", "field", "id", "revision", "doc_len", "runs")
    )


def _postings(analysed: DataFrame) -> DataFrame:
    # The outer form: for a plain explode the optimizer infers a size filter and pushes it
    # below the projections, which would sort every text again for each of its terms.
    return (
        analysed.select(
            "profile", "kind", "field", "id", "revision", "doc_len", F.explode_outer("runs").alias("_r")
        )
        .filter("_r IS NOT NULL")
        .select("profile", "kind", "field", "_r.term", "id", "revision", "_r.tf", "doc_len")
    )


def _stats(lengths: DataFrame) -> DataFrame:
    return (
        lengths.filter("doc_len > 0")
        .groupBy("profile", "kind", "field")
        .agg(F.count("*").alias("n_docs"), F.sum("doc_len").alias("total_len"))
    )


def build_text_index(
    docs: DataFrame,
    fields: list[str],
    terms: list[str] | None = None,
    scratch: str | None = None,
) -> TextIndex:
    """Postings, per-field statistics and refused values of the chosen text fields.

    A field is a string column of ``docs`` or a name in its ``fields`` map of JSON texts,
    where only a string or null is accepted. Counting terms needs no shuffle. ``terms``
    keeps the postings of one request only, for a table that has no stored index. With
    ``scratch``, a fresh shared folder, the analysis is written there once; without, each
    use of the postings and of the statistics reads the texts again.
    """
    texts = _texts(docs, check_fields(fields))
    rejected = texts.filter("bad").select(
        "kind", "id", "revision", "field", F.lit("unsupported_text").alias("reject_reason")
    )
    if scratch is not None:
        # A file may come as one piece, and analysing takes far longer than reading: the texts are dealt out first.
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        analysed = _analysed(texts.repartition(parts, "kind", "id", "revision", "field"), terms)
        analysed.write.mode("errorifexists").parquet(scratch)
        stored = docs.sparkSession.read.schema(analysed.schema).parquet(scratch)
        return TextIndex(_postings(stored), _stats(stored), rejected, stored.select(*FIELD, "doc_len"))
    analysed = _analysed(texts, terms)
    lengths = texts.filter(~F.col("bad")).select(
        "profile", "kind", "field", F.size(tokens(F.col("text"))).cast("long").alias("doc_len")
    )
    return TextIndex(_postings(analysed), _stats(lengths), rejected, lengths)


def _part(mean: Column) -> Column:
    """A term's share of a score but for its rarity."""
    length = F.lit(1.0 - B) + F.lit(B) * F.col("doc_len") / mean
    return F.col("tf") * F.lit(K1 + 1.0) / (F.col("tf") + F.lit(K1) * length)


def _zone() -> Column:
    return F.floor(F.log2("doc_len") * ZONES_PER_DOUBLING).cast("int")


def write_text_index(index: TextIndex, path: str, files: int | None = None) -> None:
    """Store the index by zone and clustered by term; a common term spreads over several files by id.

    Built with ``scratch``, the texts are analysed once. Without ``files`` their number follows from the
    terms of all texts.
    """
    spark = index.stats.sparkSession
    index.stats.write.mode("errorifexists").parquet(f"{path}/stats")
    stats = _stored_table(spark, path, "stats")
    if files is None:
        total = stats.agg(F.sum("total_len")).first()[0] or 0
        files = max(1, -(-total // FILE_TERMS), min(spark.sparkContext.defaultParallelism, total // SMALL_FILE_TERMS))
    sizes = (
        index.lengths.filter("doc_len > 0")
        .groupBy(*FIELD, _zone().alias("zone"))
        .agg(F.ceil(F.count("*") / F.lit(BLOCK_DOCS)).alias("_blocks"))
    )
    means = stats.select(*FIELD, (F.col("total_len") / F.col("n_docs")).alias("_mean"))
    placed = (
        index.postings.withColumn("zone", _zone())
        # A few rows for each field; a merge join would sort all postings of a zone in one task.
        .join(F.broadcast(sizes.join(means, FIELD)), [*FIELD, "zone"])
        .withColumns({"block": F.pmod(F.xxhash64("kind", "id"), "_blocks"), "top": _part(F.col("_mean"))})
    )
    by_term = [*FIELD, "term"]
    _store(placed, path, "postings", ["zone", *by_term, "id"], files)
    postings = _stored_table(spark, path, "postings")
    _store(postings.groupBy(*by_term).agg(F.count("*").alias("df")), path, "terms", by_term, max(1, files // 16))
    common = _stored_table(spark, path, "terms").filter(F.col("df") > RARE_DOCS).select(*by_term)
    by_block = postings.join(common, by_term).groupBy(*by_term, "block", "zone").agg(F.max("top").alias("top"), F.count("*").alias("n"))
    _store(by_block, path, "blocks", ["zone", *by_term, "block"], max(1, files // 8))
    by_zone = _stored_table(spark, path, "blocks").groupBy(*by_term, "zone").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    _store(by_zone, path, "zones", by_term, max(1, files // 64))


def _stored_table(spark, path: str, name: str) -> DataFrame:
    return spark.read.schema(STORED[name]).parquet(f"{path}/{name}")


def _store(rows: DataFrame, path: str, name: str, order: list[str], files: int) -> None:
    """One table of the index in order; in folders by zone if its order begins with it."""
    columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in STORED[name].split(", ")]
    writer = rows.select(*columns).repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("errorifexists")
    (writer.partitionBy("zone") if order[0] == "zone" else writer).parquet(f"{path}/{name}")


def read_text_index(spark, path: str) -> StoredTextIndex:
    postings, stats, terms, blocks, zones = (_stored_table(spark, path, name) for name in ("postings", "stats", "terms", "blocks", "zones"))
    empty = postings.limit(0).select("kind", "id", "revision", "field", F.lit("").alias("reject_reason"))
    return StoredTextIndex(postings, stats, empty, terms, blocks, zones)


def check_text_query(field: str, text: str) -> list[str]:
    check_name(field)
    if len(text.encode()) > QUERY_BYTES or not text.strip() or "\0" in text:
        raise Refused("query text must be 1..4096 bytes, not blank, without NUL")
    return query_terms(text)


def ranked(scored: DataFrame, descending: bool, budget: int) -> DataFrame:
    """Best ``budget`` rows by score, equal scores by id, as ``rank`` without the score."""
    score = F.col("score").desc() if descending else F.col("score").asc()
    best = scored.orderBy(score, F.col("id")).limit(budget)
    # The window runs over at most ``budget`` rows.
    place = F.row_number().over(Window.orderBy(score, F.col("id")))
    return best.select(place.cast("long").alias("rank"), "kind", "id", "revision")


def score_hits(weighed: DataFrame, *by: str) -> DataFrame:
    """Scores of documents, for each value of ``by``, from their hits (``term``, ``part``)."""
    return (
        weighed.select(*by, "kind", "id", "revision", F.struct("term", "part").alias("_part"))
        .groupBy(*by, "kind", "id", "revision")
        .agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
        .select(
            *by,
            "kind",
            "id",
            "revision",
            # Added up in the order of terms, one for each query term at most: equal texts then
            # have equal scores to the last bit, and the id settles their order.
            F.aggregate("_parts", F.lit(0.0), lambda total, p: total + p["part"]).alias("score"),
            F.size("_parts").alias("_matched"),
        )
    )


def weigh_hits(hits: DataFrame, n: Column, df: Column, mean: Column) -> DataFrame:
    idf = F.log1p((n - df + 0.5) / (df + 0.5))
    length = F.lit(1.0 - B) + F.lit(B) * F.col("doc_len") / mean
    return hits.withColumn("part", idf * F.col("tf") * F.lit(K1 + 1.0) / (F.col("tf") + F.lit(K1) * length))


class Request(NamedTuple):
    """One checked request against a stored index, with the rarity of its terms."""

    wanted: Column
    terms: list[str]
    df: dict[str, int]
    n: int
    mean: float
    every: bool

    def idf(self, term: str) -> float:
        return math.log1p((self.n - self.df[term] + 0.5) / (self.df[term] + 0.5))

    def idf_column(self) -> Column:
        pairs = [F.lit(x) for t in self.df for x in (t, self.idf(t))]
        return F.element_at(F.create_map(*pairs), F.col("term"))

    def scored(self, hits: DataFrame) -> DataFrame:
        pairs = [F.lit(x) for t, d in self.df.items() for x in (t, float(d))]
        df = F.element_at(F.create_map(*pairs), F.col("term"))
        found = score_hits(weigh_hits(hits, F.lit(float(self.n)), df, F.lit(self.mean)))
        return found.filter(F.col("_matched") == len(self.terms)) if self.every else found


def _request(index: StoredTextIndex, kind: str, field: str, terms: list[str], mode: str, profile: str) -> Request | None:
    """None where nothing can be found. At most one row for each term of the request is read."""
    wanted = (F.col("profile") == profile) & (F.col("kind") == kind) & (F.col("field") == field)
    if not terms:
        return None
    df = {r.term: r.df for r in index.terms.filter(wanted & F.col("term").isin(terms)).select("term", "df").collect()}
    corpus = index.stats.filter(wanted).agg(F.sum("n_docs").alias("n"), (F.sum("total_len") / F.sum("n_docs")).alias("mean")).first()
    if not df or (mode == "all" and len(df) < len(terms)):
        return None
    return Request(wanted, terms, df, corpus.n, corpus.mean, mode == "all")


def _bounds(request: Request, index: StoredTextIndex, stored: DataFrame, by: list[str]) -> DataFrame:
    """The best score that each group of documents can reach, by its terms' largest parts, and most and fewest documents of a term."""
    rare = [t for t, d in request.df.items() if d <= RARE_DOCS]
    kept = stored.filter(request.wanted & F.col("term").isin([t for t in request.df if t not in rare] or [""]))
    few = index.postings.filter(request.wanted & F.col("term").isin(rare or [""])).groupBy(*by, "term")
    own = kept.select(*by, "term", "top", "n").unionByName(few.agg(F.max("top").alias("top"), F.count("*").alias("n")))
    reached = own.groupBy(*by).agg(
        F.sum(request.idf_column() * F.col("top")).alias("bound"), F.count("*").alias("_terms"), F.max("n").alias("most"), F.min("n").alias("least")
    )
    return reached.filter(F.col("_terms") == len(request.terms)) if request.every else reached


def pruned_hits(index: StoredTextIndex, request: Request, budget: int) -> DataFrame:
    """The postings that a request needs for its ``budget`` best documents, and maybe some more.

    Zones with the highest bounds are scored first, as many as should hold ``budget`` documents.
    The last of these scores is a limit that every document of the result reaches, so zones, and within them blocks,
    whose bound lies below it are skipped: zones as folders, blocks before their postings are grouped.
    """
    own = index.postings.filter(request.wanted & F.col("term").isin(list(request.df)))
    # A zone is a class of lengths: a few hundred rows at most.
    zones = sorted(_bounds(request, index, index.zones, ["zone"]).collect(), key=lambda z: -z.bound)
    seeds, sure = [], 0
    for zone in zones:
        if sure >= budget:
            break
        seeds.append(zone.zone)
        sure += zone.least // 4 if request.every else zone.most
    first = request.scored(own.filter(F.col("zone").isin(seeds)))
    least = first.orderBy(F.desc("score")).limit(budget).agg(F.min("score").alias("score"), F.count("*").alias("n")).first()
    if least.n < budget:
        return own
    limit = least.score - SLACK * abs(least.score)
    needed = [z.zone for z in zones if z.bound >= limit]
    inside = F.col("zone").isin(needed)
    blocks = _bounds(request, index, index.blocks, ["zone", "block"]).filter(inside & (F.col("bound") >= limit))
    return own.filter(inside).join(blocks.select("zone", "block"), ["zone", "block"], "left_semi")


def _stored_candidates(index: StoredTextIndex, kind: str, field: str, terms: list[str], mode: str, budget: int, profile: str) -> DataFrame:
    request = _request(index, kind, field, terms, mode, profile)
    if request is None:
        nothing = index.postings.limit(0).select("kind", "id", "revision", F.lit(0.0).alias("score"))
        return ranked(nothing, True, budget)
    return ranked(request.scored(pruned_hits(index, request, budget)), True, budget)


def text_candidates(
    index: TextIndex | StoredTextIndex,
    kind: str,
    field: str,
    text: str,
    mode: str,
    budget: int = MAX_BUDGET,
    max_budget: int = MAX_BUDGET,
    profile: str = "",
) -> DataFrame:
    """Top ``budget`` live documents holding ``all`` or ``any`` of the terms of ``text``.

    Only texts that the mapping ``profile`` indexed are counted and found. A stored index
    is asked for its bounds first, by small jobs, and read only where the best may be.
    """
    if mode not in ("all", "any"):
        raise Refused("mode is all or any")
    check_bounds(1, budget, max_budget=max_budget)
    terms = check_text_query(field, text)
    if isinstance(index, StoredTextIndex):
        return _stored_candidates(index, kind, field, terms, mode, budget, profile)
    wanted = (F.col("profile") == profile) & (F.col("kind") == kind) & (F.col("field") == field)
    hits = index.postings.filter(wanted & F.col("term").isin(terms or [""]))
    if not terms:
        hits = hits.limit(0)
    # One entry per query term at most.
    per_term = hits.groupBy("term").agg(F.count("*").alias("n"))
    document_count = per_term.agg(
        F.map_from_entries(F.collect_list(F.struct("term", "n"))).alias("m")
    ).scalar()
    corpus = index.stats.filter(wanted).agg(
        F.struct(
            F.sum("n_docs").cast("double").alias("n"),
            (F.sum("total_len") / F.sum("n_docs")).alias("mean"),
        ).alias("s")
    ).scalar()
    counted = hits.withColumn("_c", corpus).withColumn("_df", F.element_at(document_count, F.col("term")).cast("double"))
    scored = score_hits(weigh_hits(counted, F.col("_c.n"), F.col("_df"), F.col("_c.mean")))
    if mode == "all":
        scored = scored.filter(F.col("_matched") == len(terms))
    return ranked(scored, True, budget)


def scan_text_candidates(
    docs: DataFrame,
    kind: str,
    field: str,
    text: str,
    mode: str,
    budget: int = MAX_BUDGET,
    max_budget: int = MAX_BUDGET,
    scratch: str | None = None,
    profile: str = "",
) -> DataFrame:
    """``text_candidates`` over a table without a stored index: only the query's terms are
    counted while the whole texts are read, once if ``scratch`` names a fresh folder."""
    index = build_text_index(docs, [field], check_text_query(field, text), scratch)
    return text_candidates(index, kind, field, text, mode, budget, max_budget, profile)
