"""Extra columns named like what the operators use inside, or return."""

import pytest
from pyspark.sql import functions as F

from revtide.llm import decontam, linededup, packing, pseudonyms, quality, simhash, toxicity
from tests.llm import brute

NAMES = (
    "_d", "_v", "_doc", "_version", "_lines", "_runs", "_gone", "_matches", "_kinds", "_new", "_text_id", "_kept_id",
    "_kept_text", "_tainted", "_id", "_order", "group_id", "text_id", "bin_id", "done", "root", "deleted_lines", "found", "odd name",
)


def clashing(spark):
    line = "one two three four five six seven eight nine ten eleven twelve, "
    rows = [
        (1, line * 3 + "the first. card 4111 1111 1111 1111", "en", "s", 1),
        (2, "other words before. " + line * 3 + "the second end", "en", "s", 1),
        (3, None, None, None, None),
        (None, "", None, None, None),
        (5, "a quite different text of no interest", "en", "s", 1),
        (5, "a quite different text of no interest", "en", "s", 1),
    ]
    docs = brute.documents(spark, rows)
    return docs, docs.withColumns({n: F.lit(f"{n}!") for n in NAMES})


def operators(spark):
    items = spark.createDataFrame([(1, "a quite different text of no interest")], "item_id long, text string")
    chain = toxicity.Chain(["toxic"], [toxicity.Linear()], 2.0)
    return {
        "lines": (linededup.drop_repeated_runs, "deleted_lines"),
        "pseudonyms": (lambda d: pseudonyms.pseudonymise(d, "k"), "found"),
        "near copies": (simhash.one_of_each_group, None),
        "leaks": (lambda d: decontam.without_leaks(d, items), None),
        "toxic": (lambda d: toxicity.without_toxic(d, chain), None),
    }


@pytest.mark.parametrize("name", ["lines", "pseudonyms", "near copies", "leaks", "toxic"])
def test_names_of_the_operators_own_columns(spark, name):
    work, added = operators(spark)[name]
    plain, wide = clashing(spark)
    want, got = work(plain), work(wide)
    assert got.columns == [c for c in wide.columns if c != added] + ([added] if added else [])
    same = sorted(map(str, want.select(*want.columns).collect()))
    assert sorted(map(str, got.select(*want.columns).collect())) == same
    others = [n for n in NAMES if n != added]
    assert all(r[n] == f"{n}!" for r in got.collect() for n in others)


def test_results_without_the_inputs_columns(spark):
    _, wide = clashing(spark)
    assert packing.pack(wide).count() == wide.count()
    assert quality.score(wide, quality.train(wide, spark.createDataFrame([], "doc_id long, label int"))).count() == wide.count()
