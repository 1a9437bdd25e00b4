import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from revtide.llm import lexical
from tests.llm import brute

ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def restated(docs, items, k=50):
    """Every document scored for every item by the formula."""
    own = [(d, Counter(terms(t))) for d, t, *_ in docs]
    own = [(d, c) for d, c in own if c]
    number, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for d, c in own:
            m = 100 - 50 + (50 * sum(c.values()) * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in wanted & set(c)
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank, None if n else d, -s) for rank, (s, n, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=50, parts=1):
    index = lexical.build_index(brute.with_clashes(brute.documents(spark, docs)).repartition(parts))
    return sorted(map(tuple, lexical.search(index, spark.createDataFrame(items, ITEMS), k).collect()), key=str)


def corpus(n=400, seed=2, most=80):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.6))}" for _ in range(3000)]
    return [(i, " ".join(draw.choices(words, k=draw.randrange(0, most))), "en", "s", 1) for i in range(n)]


QUERIES = [(0, "w1 w2 w3, W4"), (1, "w7 w1000 w12"), (2, "w1"), (3, None), (4, ""), (5, "absent-word"), (6, "w2 w2 w2"), (None, "w3 w9"), (6, "w5"), (None, "w1")]


@pytest.mark.parametrize("parts", [1, 6])
def test_equals_the_formula(spark, monkeypatch, parts):
    monkeypatch.setattr(lexical, "SEGMENT_TERMS", 1500)
    monkeypatch.setattr(lexical, "BLOCK", 8)
    monkeypatch.setattr(lexical, "WINDOW", 16)
    docs = corpus()
    assert found(spark, docs, QUERIES, 20, parts) == restated(docs, QUERIES, 20)


def test_ties_and_odd_rows(spark):
    same = [(i, "equal words here", "en", "s", 1) for i in range(120, 0, -1)]
    docs = [*brute.ODD, *same, (None, "equal words here", None, None, None)]
    items = [(1, "Equal HERE"), (2, "日本語 é İstanbul ²½"), (3, "long word same id"), (4, "\x1c ​ | !")]
    assert found(spark, docs, items) == restated(docs, items)
    assert len([r for r in found(spark, docs, items) if r[0] == 1]) == 50


def test_empty_tables(spark):
    assert found(spark, [], QUERIES) == []
    assert found(spark, corpus(20), []) == []
    assert found(spark, [(1, None, None, None, None), (2, " .,", None, None, None)], QUERIES) == []


def test_chunks_of_queries_give_the_same(spark, monkeypatch):
    docs = corpus(150)
    monkeypatch.setattr(lexical, "QUERIES", 2)
    assert found(spark, docs, QUERIES) == restated(docs, QUERIES)


@pytest.mark.parametrize("seed", range(3))
def test_numbers_survive_packing(seed):
    draw = random.Random(seed)
    values = np.array([draw.randrange(1 << draw.randrange(1, 33)) for _ in range(500)])
    packed, ends = lexical.pack_numbers(values)
    assert lexical.unpack_numbers(packed).tolist() == values.tolist()
    assert ends[-1] == len(packed)


def segment(docs):
    vocabulary = {}
    found = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in lexical.terms_of(x)], np.int32) for _, x in docs]
    rows = pa.Table.from_batches(lexical._segment_rows(0, [d for d, _ in docs], found, vocabulary))
    corpus = lexical.Statistics(len(docs), sum(map(len, found)))
    return lexical.Lists(rows, corpus), Counter(t for _, x in docs for t in set(lexical.terms_of(x)))


def test_blocks_that_cannot_matter_stay_packed(monkeypatch):
    """A rare term decides; most blocks of the common term are rejected by their maxima."""
    monkeypatch.setattr(lexical, "BLOCK", 16)
    monkeypatch.setattr(lexical, "WINDOW", 64)
    docs = [(i, "common " * ((40 if i < 16 else 1) * (i % 2)) + ("rare " * 5 if i % 97 == 3 else "") + "filler " * 20) for i in range(2000)]
    lists, df = segment(docs)
    query = {t: lexical.weight(len(docs), df[t]) for t in (b"common", b"rare")}
    best = lexical.best_of_segment(lists, query, 5)
    every = sorted(
        ((sum(query[t] * int(lexical.Lists.part(c[t], lists.m[i])) for t in query if c[t]), -i) for i, c in enumerate(Counter(lexical.terms_of(x)) for _, x in docs)),
        reverse=True,
    )[:5]
    assert sorted(best) == sorted((s, -i) for s, i in every)
    opened = sum(t == b"common" for t, _ in lists.opened)
    assert 0 < opened < len(lists.rows[b"common"][2]) / 2


def test_impacts_bound_a_block_exactly(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    docs = [(d, t) for d, t, *_ in corpus(60, 9) if t]
    lists, _ = segment(docs)
    for term, (_, ends, lasts, most, top) in lists.rows.items():
        parts = [lists.open(term, b)[1].max() for b in range(len(lasts))]
        assert parts == most.tolist() and top == max(parts)
        assert [lists.open(term, b)[0][-1] for b in range(len(lasts))] == lasts.tolist()
