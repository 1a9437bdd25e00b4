import random

import pytest
from pyspark.sql import functions as F

from revtide.functions.values import Mapping
from revtide.operators.pivots import pivot_candidates, read_pivot_store, within_reach, write_pivot_store
from revtide.operators.retrieval import (
    Denied,
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
from revtide.operators import textindex
from revtide.operators.textindex import (
    build_text_index,
    read_text_index,
    scan_text_candidates,
    text_candidates,
    write_text_index,
)
from revtide.verdicts import Refused

VECTORS = "kind string, id string, revision long, tombstone boolean, profile string, vector array<float>"
CANDIDATES = "rank int, kind string, id string, revision long"


def ids(frame):
    return [r.id for r in frame.orderBy("rank").collect()]


def vectors(spark, **by_id):
    data = [("k", i, 1, False, "p", v) for i, v in by_id.items()]
    return spark.createDataFrame(data, VECTORS)


def test_metrics_rank_as_defined(spark):
    rows = vectors(spark, a=[1.0, 0.0, 0.0], b=[3.0, 0.0, 0.0], c=[2.0, 3.0, 0.0])
    query = [1.0, 0.0, 0.0]
    assert ids(vector_candidates(rows, query, "dot", "k")) == ["b", "c", "a"]
    assert ids(vector_candidates(rows, query, "euclid", "k")) == ["a", "b", "c"]
    assert ids(vector_candidates(rows, query, "manhattan", "k")) == ["a", "b", "c"]
    turned = vectors(spark, a=[1.0, 0.0, 0.0], b=[0.0, 3.0, 0.0], c=[2.0, 3.0, 0.0])
    assert ids(vector_candidates(turned, query, "cosine", "k")) == ["a", "c", "b"]
    assert ids(vector_candidates(rows, query, "dot", "k", budget=1, exclude="b")) == ["c"]


def test_only_live_rows_of_kind_profile_and_dimension_are_searched(spark):
    rows = spark.createDataFrame(
        [("k", "a", 1, False, "p", [1.0, 0.0]), ("j", "b", 1, False, "p", [1.0, 0.0]),
         ("k", "c", 1, True, "p", [1.0, 0.0]), ("k", "d", 1, False, "q", [1.0, 0.0]),
         ("k", "e", 1, False, "p", [1.0]), ("k", "z", 1, False, "p", [0.0, 0.0])],
        VECTORS,
    )
    assert ids(vector_candidates(rows, [1.0, 0.0], "cosine", "k", profile="p")) == ["a"]


def test_request_bounds(spark):
    rows = vectors(spark, a=[1.0])
    for query, metric, budget in (
        ([], "dot", 1), ([float("nan")], "dot", 1), ([0.0], "cosine", 1), ([1.0], "other", 1),
        ([1.0] * 4097, "dot", 1), ([1.0], "dot", 0), ([1.0], "dot", 257),
    ):
        with pytest.raises(Refused):
            vector_candidates(rows, query, metric, "k", budget=budget)
    index = build_text_index(docs(spark), ["text"])
    for text in ("", "  ", "a\0b", "x" * 4097):
        with pytest.raises(Refused):
            text_candidates(index, "doc", "text", text, "all")
    with pytest.raises(Refused):
        text_candidates(index, "doc", "text", "a", "some")


@pytest.mark.parametrize("metric", ["dot", "cosine", "euclid", "manhattan"])
def test_many_queries_equal_single_ones(spark, metric):
    rng = random.Random(3)
    # Coarse components make ties, which the id must settle alike on both ways.
    data = {f"v{n}": [float(rng.randrange(-1, 2)) or 1.0, float(rng.randrange(-1, 2)), 1.0] for n in range(300)}
    rows = vectors(spark, **data).repartition(7)
    queries = {"q1": [1.0, 2.0, 3.0], "q2": [0.5, -1.0, 0.0]}
    many = vector_candidates_many(rows, queries, metric, "k", budget=20).collect()
    for name, query in queries.items():
        got = [r.id for r in sorted(many, key=lambda r: r["rank"]) if r.query == name]
        assert got == ids(vector_candidates(rows, query, metric, "k", budget=20))


def docs(spark):
    return spark.createDataFrame(
        [("doc", "1", 1, False, "The quick brown fox"), ("doc", "2", 1, False, "quick quick dog"),
         ("doc", "3", 1, True, "quick fox"), ("doc", "4", 1, False, "Écoute, ÉCOUTE: le chien 42"),
         ("doc", "5", 1, False, None), ("doc", "6", 1, False, "... !!")],
        "kind string, id string, revision long, tombstone boolean, text string",
    )


def test_text_membership(spark, tmp_path):
    index = build_text_index(docs(spark), ["text"])

    def found(text, mode):
        got = text_candidates(index, "doc", "text", text, mode)
        again = scan_text_candidates(docs(spark), "doc", "text", text, mode)
        scratch = str(tmp_path / f"{mode}{len(list(tmp_path.iterdir()))}")
        once = scan_text_candidates(docs(spark), "doc", "text", text, mode, scratch=scratch)
        assert ids(got) == ids(again) == ids(once)
        return ids(got)

    assert found("quick", "any") == ["2", "1"]
    assert found("fox QUICK", "all") == ["1"]
    assert set(found("fox dog", "any")) == {"1", "2"}
    assert found("écoute 42", "all") == ["4"]
    assert found("absent", "any") == [] and found("?!", "any") == []
    assert index.stats.first().n_docs == 3
    counts = {(r.id, r.term): r.tf for r in index.postings.collect()}
    assert counts["2", "quick"] == 2 and counts["4", "écoute"] == 2


def test_text_fields_hold_strings_or_null(spark):
    rows = docs(spark).drop("text").withColumn(
        "fields",
        F.create_map(
            F.lit("t"),
            F.when(F.col("id") == "1", "7").when(F.col("id") == "2", "null").otherwise('"a \\"b"'),
        ),
    )
    index = build_text_index(rows, ["t"])
    assert [r.id for r in index.rejected.collect()] == ["1"]
    assert {r.term for r in index.postings.collect()} == {"a", "b"}
    with pytest.raises(Refused):
        build_text_index(docs(spark).withColumn("n", F.lit(1)), ["n"])


def view(spark):
    return spark.createDataFrame(
        [("k", "a", 1, False, {"t": "x", "n": "y"}), ("k", "b", 1, False, {"t": "x"}),
         ("k", "stale", 2, False, {"t": "x", "n": "y"}), ("k", "tomb", 2, True, None),
         ("k", "denied", 1, False, {"t": "x", "n": "y"})],
        "kind string, id string, revision long, tombstone boolean, fields map<string,string>",
    )


def candidates(spark, *keys):
    return spark.createDataFrame([(n, "k", i, r) for n, (i, r) in enumerate(keys, 1)], CANDIDATES)


def readable(spark, **fields):
    shown = fields or {"t": lambda a: F.lit(True), "n": lambda a: F.lit(True)}
    return authorized_view(view(spark), lambda actor: F.col("id") != actor, shown, "denied")


def test_hydration_drops_what_may_not_be_seen(spark):
    found = candidates(
        spark, ("stale", 1), ("denied", 1), ("missing", 1), ("tomb", 2), ("b", 1), ("a", 1)
    )
    assert ids(hydrate(found, readable(spark), ["t"], 10)) == ["b", "a"]
    assert ids(hydrate(found, readable(spark), ["t", "n"], 10)) == ["a"]
    assert ids(hydrate(found, readable(spark), ["t"], 1)) == ["b"]
    masked = readable(spark, t=lambda a: F.lit(True), n=lambda a: F.col("id") != "a")
    assert ids(hydrate(found, masked, ["t", "n"], 10)) == []
    row = [r for r in masked.collect() if r.id == "a"][0]
    assert row.fields == {"t": "x"}


def test_admission_refuses_and_never_trims(spark):
    good = candidates(spark, ("a", 1), ("b", 1))
    assert admit_candidates(good, "k", 2).first().status == "ok"
    assert admit_candidates(good, "k", 1).first().status == "over_budget"
    assert admit_candidates(good, "j", 2).first().status == "rejected"
    assert admit_candidates(good, "k", 2, exclude="b").first().status == "rejected"
    twice = candidates(spark, ("a", 1), ("a", 1))
    assert admit_candidates(twice, "k", 2).first().duplicate_key == 1
    assert admit_candidates(candidates(spark, ("a", 0)), "k", 2).first().status == "rejected"
    scored = good.withColumn("score", F.col("rank").cast("double"))
    assert admit_candidates(scored, "k", 2, order="asc").first().status == "ok"
    assert admit_candidates(scored, "k", 2, order="desc").first().status == "rejected"
    assert admit_candidates(candidates(spark, ("a", 1)).union(candidates(spark, ("b", 1))), "k", 2).first().duplicate_rank == 1
    many = spark.range(1, 400).select(
        F.col("id").alias("rank"), F.lit("k").alias("kind"), F.col("id").cast("string").alias("id"), F.lit(1).alias("revision")
    )
    assert admit_candidates(many, "k", 5).first().candidates == 399
    with pytest.raises(Exception, match="more than 5 candidates"):
        hydrate(many, view(spark), [], 5, 5).collect()
    broken = good.withColumn("score", F.lit(float("nan")))
    assert admit_candidates(broken, "k", 2, order="desc").first().status == "rejected"


def test_policy_is_asked_around_every_read(spark):
    mapping = Mapping("d", "p", "m", ("t",), model="m1", dimension=2)
    rows = vectors(spark, a=[1.0, 0.0], b=[0.0, 1.0], denied=[1.0, 1.0]).withColumn(
        "profile", F.lit(mapping.fingerprint)
    )

    def run(policy, query=(1.0, 0.0)):
        return search_vectors(
            rows, readable(spark), "k", query, "dot", mapping, ["t"], 5, 10, policy=policy
        )

    asked = []
    assert ids(run(lambda: asked.append(1) or True)) == ["a", "b"]
    assert len(asked) >= 3
    for allowed in range(len(asked)):
        left = iter([True] * allowed)
        with pytest.raises(Denied):
            run(lambda left=left: next(left, False))
    with pytest.raises(Refused):
        run(lambda: True, query=(1.0,))


def test_denial_wins_over_a_failing_read(spark):
    index = build_text_index(docs(spark), ["text"])
    broken = index._replace(postings=index.postings.withColumn("tf", F.raise_error(F.lit("x"))))
    answers = iter([True])
    with pytest.raises(Denied):
        search_text(
            broken, readable(spark), "doc", "text", "quick", "any", [], 1, 1,
            policy=lambda: next(answers, False),
        )


def test_small_scores_rank_by_their_full_value(spark):
    rows = vectors(spark, **{str(n): [n * 1e-8, 0.0] for n in range(1, 10)})
    assert ids(vector_candidates(rows, [1.0, 0.0], "dot", "k", budget=3)) == ["9", "8", "7"]
    many = vector_candidates_many(rows, {"q": [1.0, 0.0]}, "dot", "k", budget=3)
    assert ids(many) == ["9", "8", "7"]


def test_vectors_that_cannot_rank_are_reported(spark):
    rows = vectors(spark, a=[1.0, 2.0], b=[1.0], c=[0.0, 0.0], d=None)
    got = {r.id: r.reject_reason for r in refused_vectors(rows, 2, "cosine", "k").collect()}
    assert got == {"b": "dimension_mismatch", "c": "zero_vector", "d": "vector_missing"}
    assert "c" not in {r.id for r in refused_vectors(rows, 2, "dot", "k").collect()}


def test_a_mapping_finds_its_own_texts_only(spark):
    both = docs(spark).withColumn("profile", F.lit("p")).union(docs(spark).limit(1).withColumn("profile", F.lit("q")))
    index = build_text_index(both, ["text"])
    assert ids(text_candidates(index, "doc", "text", "quick", "any", profile="q")) == ["1"]
    assert ids(text_candidates(index, "doc", "text", "quick", "any", profile="p")) == ["2", "1"]
    assert ids(text_candidates(index, "doc", "text", "quick", "any")) == []


def test_the_metric_belongs_to_the_mapping(spark):
    mapping = Mapping("d", "p", "m", ("t",), model="m1", dimension=2, metric="dot")
    assert mapping.fingerprint != Mapping("d", "p", "m", ("t",), model="m1", dimension=2).fingerprint
    with pytest.raises(Refused):
        search_vectors(vectors(spark, a=[1.0, 0.0]), view(spark), "k", [1.0, 0.0], "euclid", mapping, [], 1, 1)
    with pytest.raises(Refused):
        Mapping("d", "p", "m", ("t",), metric="dot")


def stored(spark, tmp_path, docs, name="index"):
    write_text_index(build_text_index(docs, ["text"], scratch=str(tmp_path / f"{name}-analysis")), str(tmp_path / name))
    return read_text_index(spark, str(tmp_path / name))


def many_texts(spark, n=900, seed=4):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(2000)]
    rows = []
    for i in range(n):
        text = " ".join(draw.choices(words, k=draw.choice([3, 8, 30, 120, 400])))
        rows.append(("doc" if i % 9 else "other", str(i), i % 4 + 1, i % 13 == 5, text if i % 17 else None, f"p{i % 2}"))
    return spark.createDataFrame(rows, "kind string, id string, revision int, tombstone boolean, text string, profile string")


@pytest.mark.parametrize("mode", ["any", "all"])
def test_stored_index_equals_a_scan_and_skips(spark, tmp_path, mode, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK_DOCS", 8)
    monkeypatch.setattr(textindex, "RARE_DOCS", 5)
    docs = many_texts(spark)
    index = stored(spark, tmp_path, docs)
    skipped = 0
    for profile, texts in (("p0", ("w3 W40, w7", "w11 w1")), ("p1", ("absent w1",))):
        for text in texts:
            for budget in (1, 20):
                got = text_candidates(index, "doc", "text", text, mode, budget, profile=profile).collect()
                want = scan_text_candidates(docs, "doc", "text", text, mode, budget, profile=profile).collect()
                assert got == want
            terms = textindex.check_text_query("text", text)
            request = textindex._request(index, "doc", "text", terms, mode, profile)
            if request:
                every = index.postings.filter(request.wanted & F.col("term").isin(terms)).count()
                needed = textindex.pruned_hits(index, request, 1).count()
                assert needed <= every
                skipped += every - needed
    assert skipped > 0


def test_a_request_names_the_zones_it_needs(spark, tmp_path):
    """Short texts hold the term often; the zones of long texts are not read."""
    rows = [("doc", str(i), 1, False, "rare " * 3 if i % 2 else "rare " + "filler " * (200 + i)) for i in range(300)]
    docs = spark.createDataFrame(rows, "kind string, id string, revision int, tombstone boolean, text string")
    index = stored(spark, tmp_path, docs)
    request = textindex._request(index, "doc", "text", ["rare"], "any", "")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    hits = textindex.pruned_hits(index, request, 20)
    filters = hits._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "zone" in filters
    read = {r.zone for r in hits.select("zone").distinct().collect()}
    assert len(read) == 1 < index.postings.select("zone").distinct().count()
    assert {r.df for r in index.terms.filter("term = 'rare'").collect()} == {300}


def test_stored_index_of_nothing(spark, tmp_path):
    docs = many_texts(spark, 0)
    index = stored(spark, tmp_path, docs)
    assert text_candidates(index, "doc", "text", "w1", "any", 5).collect() == []


@pytest.mark.parametrize("mode", ["all", "any"])
def test_many_requests_equal_one_at_a_time(spark, tmp_path, mode):
    docs = many_texts(spark, 200).withColumn("profile", F.lit("")).filter("text IS NOT NULL")
    view = docs.filter("kind = 'doc'").select(
        "kind", "id", F.when(F.col("id").cast("int") % 5 == 0, 9).otherwise(F.col("revision")).alias("revision"), "tombstone",
        F.create_map(F.lit("text"), F.col("text")).alias("fields"),
    )
    texts = {1: "w1 w2", 2: "w3, W1 w3", 3: "absent w1", 4: "w7", 5: "", 6: None, 7: " . ", 8: "x" * 5000, 9: "a\0b"}
    requests = spark.createDataFrame(list(texts.items()), "request int, text string")
    index = build_text_index(docs, ["text"], scratch=str(tmp_path / "scratch"))
    many = search_many(index, view, requests, "doc", "text", mode, ["text"], 4, 9)
    verdicts = {r.request: (r.status, r.candidates, r.shown) for r in many.verdicts.collect()}
    rows = many.found.collect()
    for request, text in texts.items():
        own = sorted((r.rank, r.id, r.revision) for r in rows if r.request == request)
        if request in (5, 6, 8, 9):
            assert verdicts[request] == ("invalid", 0, 0) and own == []
            continue
        alone = search_text(index, view, "doc", "text", text, mode, ["text"], 4, 9).collect()
        assert own == sorted((r["rank"], r.id, r.revision) for r in alone)
        assert verdicts[request][0] == "ok" and verdicts[request][2] == len(own)


def scanned_rows(frame):
    """Rows of the row groups that the scan read, after it ran."""
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("metric", ["euclid", "manhattan"])
def test_pivots_find_what_a_scan_finds_and_skip_row_groups(spark, tmp_path, metric):
    draw = random.Random(13)
    centres = [[draw.uniform(-50, 50) for _ in range(8)] for _ in range(12)]
    rows = []
    for n in range(4000):
        centre = draw.choice(centres)
        vector = [x + draw.gauss(0, 1) for x in centre] if n % 50 else [0.0] * 8
        rows.append(("vec", str(n), 1, n % 19 == 3, vector if n % 333 else None))
    rows += [("vec", "short", 1, False, [1.0, 2.0]), ("other", "x", 1, False, centres[0])]
    frame = spark.createDataFrame(rows, "kind string, id string, revision int, tombstone boolean, vector array<float>")
    write_pivot_store(frame, str(tmp_path / "store"), metric, group_bytes=4096)
    store = read_pivot_store(spark, str(tmp_path / "store"))
    assert store.vectors.count() == len(rows)
    for query, exclude in ((centres[0], None), (rows[7][4], "7"), ([500.0] * 8, None), ([0.0] * 8, None)):
        got = pivot_candidates(store, query, "vec", 20, exclude)
        assert got.collect() == vector_candidates(frame, query, metric, "vec", 20, exclude).collect()
    near = within_reach(store, centres[0], "vec", 20, None, None).select("id")
    assert 20 <= len(near.collect()) < len(rows)
    assert 0 < scanned_rows(near) < len(rows) / 2
    assert pivot_candidates(store, [1.0, 2.0], "vec", 5).collect() == vector_candidates(frame, [1.0, 2.0], metric, "vec", 5).collect()


def test_a_store_of_nothing(spark, tmp_path):
    frame = spark.createDataFrame([("vec", "a", 1, False, None)], "kind string, id string, revision int, tombstone boolean, vector array<float>")
    write_pivot_store(frame, str(tmp_path / "store"), "euclid")
    assert pivot_candidates(read_pivot_store(spark, str(tmp_path / "store")), [1.0], "vec", 5).collect() == []
    with pytest.raises(Refused):
        write_pivot_store(frame, str(tmp_path / "other"), "cosine")


def one_file_of_texts(spark, path):
    rows = [("doc", str(n), 1, False, f"w{n % 7} w{n % 11} w{n % 13} common {'far ' * (n % 30)}") for n in range(400)]
    spark.createDataFrame(rows, "kind string, id string, revision long, tombstone boolean, text string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_texts_of_one_file_are_analysed_by_many_tasks(spark, tmp_path):
    docs = one_file_of_texts(spark, str(tmp_path / "docs"))
    build_text_index(docs, ["text"], scratch=str(tmp_path / "analysis"))
    assert len(list((tmp_path / "analysis").glob("part-*.parquet"))) > 1


def test_no_zone_of_a_stored_index_is_sorted_in_one_task(spark, tmp_path, monkeypatch):
    plans, store = {}, textindex._store

    def kept(rows, path, name, order, files):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        store(rows, path, name, order, files)

    monkeypatch.setattr(textindex, "_store", kept)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = one_file_of_texts(spark, str(tmp_path / "docs"))
        write_text_index(build_text_index(docs, ["text"], scratch=str(tmp_path / "analysis")), str(tmp_path / "index"))
        outer = plans["postings"].split("BroadcastExchange")[0]
        assert "BroadcastHashJoin" in outer and "SortMergeJoin" not in outer
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_many_requests_deal_out_postings_of_their_terms_alone(spark):
    docs = spark.createDataFrame(
        [("doc", str(n), 1, False, f"w{n % 7} other{n}", {"text": "x"}) for n in range(30)],
        "kind string, id string, revision long, tombstone boolean, text string, fields map<string,string>",
    )
    requests = spark.createDataFrame([(1, "w3"), (2, "w3 other10"), (3, "none")], "request long, text string")
    many = search_many(build_text_index(docs, ["text"]), docs, requests, "doc", "text", "all", ["text"], 9, 9)
    assert "LeftSemi, (term#" in many.found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.request, r.id) for r in many.found.collect()) == [(1, "10"), (1, "17"), (1, "24"), (1, "3"), (2, "10")]
