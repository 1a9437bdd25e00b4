"""Vector candidates, candidate admission, hydration and the searches built on them.

Candidates carry a rank, a key and the indexed revision: no value and no score. Hydration
joins them to the rows a reader may see now and drops whatever is stale, deleted, hidden
or masked. A *view* has ``kind, id, revision, tombstone`` and a ``fields`` map.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.text import tokens
from revtide.functions.values import check_name
from revtide.functions.vectors import (
    check_query_vector,
    descending,
    l2_norm,
    l2_normalize,
    vector_score,
)
from revtide.operators.ordering import adjacent_pairs
from revtide.operators.textindex import (
    MAX_BUDGET,
    MAX_LIMIT,
    QUERY_BYTES,
    StoredTextIndex,
    TextIndex,
    check_bounds,
    ranked,
    score_hits,
    text_candidates,
    weigh_hits,
)
from revtide.verdicts import Refused, require_ok

CANDIDATE = "rank long, kind string, id string, revision long"

#: Query components, and result slots, held by one task in a pass of many queries.
PASS_COMPONENTS = 1_000_000


class Denied(PermissionError):
    """The host policy refused the search."""


def searchable(vectors: DataFrame, kind: str, profile: str | None, exclude: str | None) -> DataFrame:
    rows = vectors.filter((F.col("kind") == kind) & ~F.col("tombstone"))
    if profile is not None:
        rows = rows.filter(F.col("profile") == profile)
    return rows if exclude is None else rows.filter(F.col("id") != exclude)


def _unit(values: Sequence[float]) -> list[float]:
    doubles = np.asarray(values, dtype="f4").astype("f8")
    return [float(x) for x in (doubles / np.sqrt((doubles * doubles).sum())).astype("f4")]


def refused_vectors(
    vectors: DataFrame, dimension: int, metric: str, kind: str, profile: str | None = None
) -> DataFrame:
    """Live vectors that no search of this dimension and metric can rank: ``id, revision, reject_reason``."""
    rows = searchable(vectors, kind, profile, None)
    zero = F.lit(metric == "cosine") & ~F.exists("vector", lambda x: x != 0)
    reason = (
        F.when(F.col("vector").isNull(), "vector_missing")
        .when(F.size("vector") != dimension, "dimension_mismatch")
        .when(zero, "zero_vector")
    )
    return rows.select("id", "revision", reason.alias("reject_reason")).filter("reject_reason IS NOT NULL")


def vector_candidates(
    vectors: DataFrame,
    query: Sequence[float],
    metric: str,
    kind: str,
    budget: int = MAX_BUDGET,
    exclude: str | None = None,
    profile: str | None = None,
    max_budget: int = MAX_BUDGET,
) -> DataFrame:
    """Exact scan for one query: dot and cosine descend, euclid and manhattan ascend.

    Every task keeps its best rows only, so nothing but ``budget`` rows per task moves.
    """
    values = check_query_vector(query, metric)
    check_bounds(1, budget, max_budget=max_budget)
    rows = searchable(vectors, kind, profile, exclude)
    rows = rows.filter(F.size("vector") == len(values))
    if metric == "cosine":
        values = _unit(values)
        rows = rows.withColumn("_norm", l2_norm(F.col("vector"))).filter("_norm > 0")
        rows = rows.withColumn("vector", l2_normalize(F.col("vector"), F.col("_norm")))
    wanted = F.array(*[F.lit(x) for x in values])
    scored = rows.select(
        "kind", "id", "revision", vector_score(F.col("vector"), wanted, metric).alias("score")
    )
    return ranked(scored, descending(metric), budget)


def _partial_top(names: list[str], matrix: np.ndarray, metric: str, budget: int):
    """Arrow batches of vectors -> the best ``budget`` rows per query of one partition."""
    sign = -1.0 if descending(metric) else 1.0

    def scores(block: np.ndarray) -> np.ndarray:
        # One component after the other, as a single query's scan adds them up.
        total = np.zeros((len(matrix), len(block)))
        for component, values in zip(matrix.T, block.T):
            if metric in ("dot", "cosine"):
                total += np.multiply.outer(component, values)
            elif metric == "euclid":
                total += np.subtract.outer(component, values) ** 2
            else:
                total += np.abs(np.subtract.outer(component, values))
        return np.sqrt(total) if metric == "euclid" else total

    def run(batches):
        best = [None] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            block = flat.reshape(batch.num_rows, -1).astype("f8")
            ids = np.asarray(batch.column(0).to_pylist(), dtype=object)
            revisions = batch.column(1).to_numpy(zero_copy_only=False)
            for at, row in enumerate(scores(block)):
                keep = slice(None)
                if len(row) > budget:
                    # Rows tied with the last kept score stay, so the id decides among them.
                    edge = np.partition(sign * row, budget - 1)[budget - 1]
                    keep = sign * row <= edge
                part = (row[keep], ids[keep], revisions[keep])
                if best[at] is not None:
                    part = tuple(np.concatenate(pair) for pair in zip(best[at], part))
                order = sorted(range(len(part[0])), key=lambda n: (sign * part[0][n], part[1][n]))
                best[at] = tuple(column[order[:budget]] for column in part)
        for name, part in zip(names, best):
            if part is not None:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(part[0]), pa.string()),
                        pa.array(list(part[1]), pa.string()),
                        pa.array(part[2], pa.int64()),
                        pa.array(part[0], pa.float64()),
                    ],
                    names=["query", "id", "revision", "score"],
                )

    return run


def vector_candidates_many(
    vectors: DataFrame,
    queries: Mapping[str, Sequence[float]],
    metric: str,
    kind: str,
    budget: int = MAX_BUDGET,
    profile: str | None = None,
    max_budget: int = MAX_BUDGET,
) -> DataFrame:
    """Exact top ``budget`` for many request vectors: ``query, rank, kind, id, revision``.

    Every partition scores Arrow blocks against all queries of a pass and hands on its own
    best rows; queries beyond one pass's memory bound take a further pass over the table.
    """
    check_bounds(1, budget, max_budget=max_budget)
    checked = {name: check_query_vector(q, metric) for name, q in queries.items()}
    if not checked or len({len(q) for q in checked.values()}) != 1:
        raise Refused("queries must be non-empty and share one dimension")
    dimension = len(next(iter(checked.values())))
    rows = searchable(vectors, kind, profile, None).filter(F.size("vector") == dimension)
    if metric == "cosine":
        checked = {name: _unit(q) for name, q in checked.items()}
        rows = rows.withColumn("_norm", l2_norm(F.col("vector"))).filter("_norm > 0")
        rows = rows.withColumn("vector", l2_normalize(F.col("vector"), F.col("_norm")))
    rows = rows.select("id", "revision", "vector")
    step = max(1, PASS_COMPONENTS // max(dimension, budget))
    names = sorted(checked)
    passes = []
    for at in range(0, len(names), step):
        part = names[at : at + step]
        matrix = np.asarray([checked[n] for n in part], dtype="f8")
        passes.append(
            rows.mapInArrow(
                _partial_top(part, matrix, metric, budget),
                "query string, id string, revision long, score double",
            )
        )
    best = reduce(DataFrame.unionByName, passes)
    score = F.col("score").desc() if descending(metric) else F.col("score").asc()
    # Two levels, so the last step of a query sees a few thousand rows however many
    # partitions the table has.
    first = Window.partitionBy("query", "_lane").orderBy(score, "id")
    final = Window.partitionBy("query").orderBy(score, "id")
    return (
        best.withColumn("_lane", F.pmod(F.xxhash64("id"), F.lit(64)))
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= budget)
        .withColumn("rank", F.row_number().over(final).cast("long"))
        .filter(F.col("rank") <= budget)
        .select("query", "rank", F.lit(kind).alias("kind"), "id", "revision")
    )


def admit_candidates(
    candidates: DataFrame,
    kind: str,
    budget: int,
    exclude: str | None = None,
    order: str | None = None,
) -> DataFrame:
    """One verdict row for a whole candidate response; refuse it whole, never trim it.

    ``order`` is ``desc`` or ``asc`` when the response carries a ``score`` to check. Ranks must be
    unique, and scores must not run against them.
    """
    faults = {
        "foreign_kind": F.count_if(~F.col("kind").eqNullSafe(kind)),
        "revision_invalid": F.count_if(F.col("revision").isNull() | (F.col("revision") < 1)),
        "excluded_key": F.count_if(F.col("id").eqNullSafe(F.lit(exclude)) & F.lit(exclude is not None)),
        "duplicate_key": F.count("*") - F.count_distinct("kind", "id"),
        "duplicate_rank": F.count("*") - F.count_distinct("rank"),
    }
    if order is not None:
        infinite = F.col("score").isNull() | F.isnan("score") | (F.abs("score") == float("inf"))
        negative = F.lit(order == "asc") & (F.col("score") < 0)
        faults["score_order"] = F.count_if(infinite | negative)
    counted = candidates.agg(F.count("*").alias("candidates"), *[c.alias(n) for n, c in faults.items()])
    if order is not None:
        pairs = adjacent_pairs(candidates, [], "rank", ["score"])
        risen = F.col("cur.score") > F.col("prev.score")
        fallen = F.col("cur.score") < F.col("prev.score")
        broken = pairs.agg(F.count_if(risen if order == "desc" else fallen).alias("n")).scalar()
        counted = counted.withColumn("score_order", F.col("score_order") + broken)
    any_fault = reduce(Column.__or__, [F.col(n) > 0 for n in faults])
    return counted.withColumn(
        "status",
        F.when(F.col("candidates") > budget, "over_budget")
        .when(any_fault, "rejected")
        .otherwise("ok"),
    )


def authorized_view(
    rows: DataFrame,
    row_policy: Callable[[object], Column],
    field_policy: Mapping[str, Callable[[object], Column]],
    actor: object,
) -> DataFrame:
    """Live rows the actor may read, with the fields disclosed to that actor.

    A hidden field is absent from the map, which differs from null; a field without a
    policy stays hidden.
    """
    visible = [
        (name, F.coalesce(allowed(actor), F.lit(False))) for name, allowed in field_policy.items()
    ]

    def shown(name: Column, _: Column) -> Column:
        return reduce(Column.__or__, [(name == n) & ok for n, ok in visible], F.lit(False))

    return (
        rows.filter(~F.col("tombstone"))
        .filter(row_policy(actor))
        .withColumn("fields", F.map_filter("fields", shown))
    )


def hydrate(
    candidates: DataFrame,
    view: DataFrame,
    required: Sequence[str],
    limit: int,
    budget: int = MAX_BUDGET,
) -> DataFrame:
    """Candidates whose current row is readable, live, of the same revision and complete.

    Order is the candidates'; the first ``limit`` are kept and missing ones are not
    replaced. More than ``budget`` candidates fail the query, none are dropped.
    """
    complete = reduce(
        Column.__and__, [F.map_contains_key("fields", n) for n in required], F.lit(True)
    )
    offered = candidates.agg(F.count("*").alias("n")).scalar()
    fits = F.when(offered > budget, F.raise_error(F.lit(f"more than {budget} candidates"))).otherwise(F.lit(True))
    few = candidates.filter(fits.cast("boolean"))
    current = view.filter(~F.col("tombstone")).filter(complete)
    return (
        current.join(few, ["kind", "id", "revision"])
        .select("rank", "kind", "id", "revision", "fields")
        .orderBy("rank")
        .limit(limit)
    )


def _search(candidates, view, kind, required, limit, budget, policy, exclude):
    spark = view.sparkSession

    def checked(step: Callable):
        if not policy():
            raise Denied("search not permitted")
        try:
            return step()
        except Exception:
            if not policy():
                raise Denied("search not permitted") from None
            raise

    # A request's candidates and results are bounded by budget and limit, so they are
    # materialised here: the policy is asked before, between and after the two reads.
    few = checked(lambda: candidates().collect())
    frame = spark.createDataFrame(few, CANDIDATE)
    checked(lambda: require_ok(admit_candidates(frame, kind, budget, exclude)))
    ids = [row["id"] for row in few]
    narrowed = view.filter((F.col("kind") == kind) & F.col("id").isin(ids or [""]))
    found = checked(lambda: hydrate(frame, narrowed, required, limit, budget))
    rows = checked(found.collect)
    if not policy():
        raise Denied("search not permitted")
    return spark.createDataFrame(rows, found.schema)


def search_text(
    index: TextIndex,
    view: DataFrame,
    kind: str,
    field: str,
    text: str,
    mode: str,
    required: Sequence[str],
    limit: int,
    budget: int,
    policy: Callable[[], bool] = lambda: True,
    mapping=None,
) -> DataFrame:
    """Text candidates of one mapping, admitted and hydrated, with the host policy asked around every read."""
    check_bounds(limit, budget)
    profile = mapping.fingerprint if mapping is not None else ""
    found = lambda: text_candidates(index, kind, field, text, mode, budget, profile=profile)
    return _search(found, view, kind, required, limit, budget, policy, None)


def search_vectors(
    vectors: DataFrame,
    view: DataFrame,
    kind: str,
    query: Sequence[float],
    metric: str,
    mapping,
    required: Sequence[str],
    limit: int,
    budget: int,
    exclude: str | None = None,
    policy: Callable[[], bool] = lambda: True,
) -> DataFrame:
    """Vector candidates of one mapping, admitted and hydrated under the host policy."""
    check_bounds(limit, budget, MAX_LIMIT)
    if mapping.dimension != len(query):
        raise Refused("query dimension differs from the mapping")
    if mapping.metric is not None and mapping.metric != metric:
        raise Refused("metric differs from the mapping")
    found = lambda: vector_candidates(
        vectors, query, metric, kind, budget, exclude, mapping.fingerprint
    )
    return _search(found, view, kind, required, limit, budget, policy, exclude)


class ManyFound(NamedTuple):
    """``found``: ``request, rank, kind, id, revision, fields``; ``verdicts``: ``request, status, candidates, shown``."""

    found: DataFrame
    verdicts: DataFrame


def _request_candidates(index, terms: DataFrame, kind: str, field: str, every: bool, budget: int, profile: str) -> DataFrame:
    """``request, rank, kind, id, revision``: each request's best ``budget`` texts."""
    wanted = (F.col("profile") == profile) & (F.col("kind") == kind) & (F.col("field") == field)
    # Only postings of terms that some request has are counted and dealt out.
    asked = terms.select("term").distinct()
    postings = index.postings.filter(wanted).select("term", "kind", "id", "revision", "tf", "doc_len").join(asked, "term", "left_semi")
    if isinstance(index, StoredTextIndex):
        counts = index.terms.filter(wanted).select("term", "df")
    else:
        counts = postings.groupBy("term").agg(F.count("*").alias("df"))
    known = terms.join(counts, "term")
    if every:
        # A request's rarest term names all texts that can have every term; the others are looked up by term and text,
        # so a common term's postings never meet a request as a whole.
        first = (
            known.groupBy("request", "_n")
            .agg(F.count("*").alias("_known"), F.min_by("term", F.struct("df", "term")).alias("term"))
            .filter(F.col("_known") == F.col("_n"))
        )
        named = first.join(postings.select("term", "kind", "id", "revision"), "term").drop("term")
        hits = named.join(known.select("request", "term", "df"), "request").join(postings, ["term", "kind", "id", "revision"])
    else:
        hits = known.join(postings, "term")
    corpus = index.stats.filter(wanted).agg(
        F.struct(F.sum("n_docs").cast("double").alias("n"), (F.sum("total_len") / F.sum("n_docs")).alias("mean")).alias("s")
    ).scalar()
    weighed = weigh_hits(hits.withColumn("_c", corpus), F.col("_c.n"), F.col("df").cast("double"), F.col("_c.mean"))
    scored = score_hits(weighed, "request", "_n")
    if every:
        scored = scored.filter(F.col("_matched") == F.col("_n"))
    # The planner keeps each task's best rows of a request before they are shuffled.
    best = Window.partitionBy("request").orderBy(F.desc("score"), "id")
    return (
        scored.withColumn("rank", F.row_number().over(best).cast("long"))
        .filter(F.col("rank") <= budget)
        .select("request", "rank", "kind", "id", "revision")
    )


def search_many(
    index: TextIndex | StoredTextIndex,
    view: DataFrame,
    requests: DataFrame,
    kind: str,
    field: str,
    mode: str,
    required: Sequence[str],
    limit: int,
    budget: int,
    profile: str = "",
) -> ManyFound:
    """``search_text`` for a table of requests (``request`` unique, ``text``): candidates, admission and hydration as one plan.

    Requests are rows that meet the postings, so nothing passes the driver and any number of them may be asked. The
    verdict of a request is ``ok``; ``invalid`` for a text that ``search_text`` would not take; or
    ``rejected``, if its candidates repeat a key. Only ``ok`` requests show rows.
    """
    check_bounds(limit, budget)
    check_name(field)
    if mode not in ("all", "any"):
        raise Refused("mode is all or any")
    text = F.col("text")
    fits = F.coalesce(
        (F.octet_length(text) <= QUERY_BYTES) & (F.trim(F.regexp_replace(text, r"\s", " ")) != "") & ~text.contains("\0"), F.lit(False)
    )
    checked = requests.select("request", "text", fits.alias("_fits"))
    split = checked.filter("_fits").select("request", F.array_distinct(tokens(text)).alias("_terms"))
    terms = split.select("request", F.size("_terms").alias("_n"), F.explode("_terms").alias("term"))
    candidates = _request_candidates(index, terms, kind, field, mode == "all", budget, profile)
    # At most ``budget`` rows of a request.
    admitted = candidates.groupBy("request").agg(
        F.count("*").alias("candidates"), (F.count("*") - F.count_distinct("id")).alias("_again")
    )
    complete = reduce(Column.__and__, [F.map_contains_key("fields", n) for n in required], F.lit(True))
    current = view.filter(~F.col("tombstone") & (F.col("kind") == kind)).filter(complete)
    shown = (
        candidates.join(current.select("kind", "id", "revision", "fields"), ["kind", "id", "revision"])
        .join(admitted.filter("_again = 0").select("request"), "request", "left_semi")
        .withColumn("_place", F.row_number().over(Window.partitionBy("request").orderBy("rank")))
        .filter(F.col("_place") <= limit)
        .select("request", "rank", "kind", "id", "revision", "fields")
    )
    status = F.when(~F.col("_fits"), "invalid").when(F.col("_again") > 0, "rejected").otherwise("ok")
    verdicts = (
        checked.select("request", "_fits")
        .join(admitted, "request", "left")
        .join(shown.groupBy("request").agg(F.count("*").alias("shown")), "request", "left")
        .select(
            "request",
            status.alias("status"),
            F.coalesce("candidates", F.lit(0)).alias("candidates"),
            F.coalesce("shown", F.lit(0)).alias("shown"),
        )
    )
    return ManyFound(shown, verdicts)
