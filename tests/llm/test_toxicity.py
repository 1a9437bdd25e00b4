import random

import numpy as np

from revtide.llm import toxicity
from tests.llm import brute

BAD = ["vile", "foulest", "grubby"]


def corpus(n=600, seed=1):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        text = draw.choices(words, k=draw.randrange(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(draw.randrange(1, 5)):
                text.insert(draw.randrange(len(text)), draw.choice(BAD) + draw.choice(["", ",", "ish"]))
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, int(not toxic or i % 10 == 0), int(toxic)))
    return docs, labels


def chain_of(spark, docs, labels):
    table = toxicity.table_categories(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return toxicity.train(brute.documents(spark, docs), table, toxicity.CATEGORIES)


def test_held_out_accuracy_and_rejection(spark):
    docs, labels = corpus()
    chain = chain_of(spark, docs, labels[:400])
    assert [len(m.odds) for m in chain.models] == [0, 1]
    held = brute.documents(spark, docs[400:])
    rows = {r.doc_id: r for r in toxicity.score(held, chain).collect()}
    truth = {d: bool(t) for d, _, t in labels[400:]}
    wrong = [d for d, t in truth.items() if rows[d].toxic != t]
    assert len(rows) == 200 and len(wrong) <= 4
    kept = {r.doc_id for r in toxicity.without_toxic(held, chain).collect()}
    assert kept == {d for d, r in rows.items() if not r.toxic}
    assert all(0 < r.p_low_quality < 1 and 0 < r.p_toxic < 1 for r in rows.values())


def test_odd_rows(spark):
    docs, labels = corpus(200)
    odd = brute.with_clashes(brute.documents(spark))
    chain = chain_of(spark, docs + brute.ODD, labels + [(2, None, None), (None, 1, 1), (9999, 0, 1)])
    assert len(toxicity.score(odd, chain).collect()) == len(brute.ODD)
    assert toxicity.without_toxic(odd, chain).columns == odd.columns
    assert toxicity.score(brute.documents(spark, []), chain).collect() == []


def test_without_labels_nothing_is_rejected(spark):
    docs, labels = corpus(50)
    for own in ([], [x for x in labels if x[2] == 0], [(d, None, None) for d, *_ in labels]):
        chain = chain_of(spark, docs, own)
        assert toxicity.without_toxic(brute.documents(spark, docs), chain).count() == 50


def test_later_models_meet_out_of_fold_odds():
    rows = [np.array([i % 7, 7 + i % 2]) for i in range(210)]
    first = np.array([i % 2 for i in range(210)], float)
    chain = toxicity.fit_chain(rows, {"a": first, "b": first.copy()}, np.arange(210) % 3)
    assert chain.models[1].odds[0] > 0
    assert 0 < chain.threshold < 1
    hits = toxicity.Hits(set())
    assert toxicity._probabilities(chain, hits, None) == toxicity._probabilities(chain, hits, "")


def test_the_sample_is_bounded(spark):
    docs, labels = corpus(300)
    table = toxicity.table_categories(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    seen = []
    original, toxicity.fit_chain = toxicity.fit_chain, lambda rows, *_: seen.append(len(rows))
    try:
        toxicity.train(brute.documents(spark, docs), table, toxicity.CATEGORIES, sample=20)
    finally:
        toxicity.fit_chain = original
    assert seen == [40]
