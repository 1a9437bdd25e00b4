import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from revtide.llm import quality
from tests.llm import brute

MARKS = ["|", "$$$", "###"]


def corpus(n=600, seed=1):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        text = draw.choices(words, k=draw.randrange(20, 120))
        good = i % 5 > 0
        if not good:
            text = [w if draw.random() < 0.5 else w + draw.choice(MARKS) for w in text]
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, int(good)))
    return docs, labels


def model_of(spark, docs, labels, **more):
    return quality.train(brute.documents(spark, docs), spark.createDataFrame(labels, "doc_id long, label int"), **more)


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def plain_features(text):
    """Places and amounts by definition."""
    words = [zlib.crc32(w.encode()) for w in re.findall(r"\w+|[^\w\s]+", text or "")]
    places = [w * 0xC2B2AE35 % 2**64 for w in words]
    places += [((a * 0x9E3779B1 + b + 1) % 2**64) * 0x85EBCA6B % 2**64 for a, b in zip(words, words[1:])]
    times = Counter((p & 0xFFFFFFFF) >> 12 for p in places)
    norm = math.sqrt(sum((1 + math.log(t)) ** 2 for t in times.values())) or 1.0
    return {p: (1 + math.log(t)) / norm for p, t in times.items()}


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    model = model_of(spark, docs, labels)
    rows = {r.doc_id: r for r in quality.score(brute.documents(spark, docs), model).collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == is_held_out(d) and r.predicted == int(r.score >= 0.5) for d, r in rows.items())
    held = [d for d in rows if is_held_out(d)]
    assert sum(rows[d].predicted == labels[d][1] for d in held) >= 0.97 * len(held)


def test_scores_are_dot_products_of_whole_texts(spark):
    docs, labels = corpus(200)
    docs += [(900, "late " * 3000 + "$$$ | ###", "en", "s", 1), (901, None, None, None, None), (902, "", None, None, None)]
    model = model_of(spark, docs, labels)
    weights = dict(zip(model.places.tolist(), model.weights.tolist()))
    for r in quality.score(brute.documents(spark, docs), model).collect():
        odds = model.bias + sum(weights.get(p, 0.0) * x for p, x in plain_features(docs_text(docs, r.doc_id)).items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-6)


def docs_text(docs, doc_id):
    return next(t for d, t, *_ in docs if d == doc_id)


def test_learning_follows_the_regularised_leader(spark):
    """The stored model equals the update rule replayed over the same rows in the same order."""
    docs, labels = corpus(90)
    model = model_of(spark, docs, labels, epochs=2)
    rows = [(d, y) for d, y in labels if not is_held_out(d)]
    hashed = spark.createDataFrame(rows, "_id long, label int").selectExpr("_id", "label", "xxhash64(_id, 29) AS o").collect()
    z, n = Counter(), Counter()

    def weight(p):
        if abs(z[p]) <= quality.L1:
            return 0.0
        return -(z[p] - math.copysign(quality.L1, z[p])) / ((quality.BETA + math.sqrt(n[p])) / quality.ALPHA + quality.L2)

    for _ in range(2):
        for r in sorted(hashed, key=lambda r: (r.o, r._id)):
            x = plain_features(docs_text(docs, r._id)) | {"bias": 1.0}
            now = {p: weight(p) for p in x}
            error = 1 / (1 + math.exp(-sum(now[p] * v for p, v in x.items()))) - r.label
            for p, v in x.items():
                g = error * v
                z[p] += g - (math.sqrt(n[p] + g * g) - math.sqrt(n[p])) / quality.ALPHA * now[p]
                n[p] += g * g
    for p, w in zip(model.places.tolist(), model.weights.tolist()):
        assert w == pytest.approx(weight(p), abs=2e-3)
    assert model.bias == pytest.approx(weight("bias"), abs=2e-3)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(150)
    turned = [(d, 1 - y if is_held_out(d) else y) for d, y in labels]
    a, b = model_of(spark, docs, labels), model_of(spark, docs, turned)
    assert a.bias == b.bias and np.array_equal(a.places, b.places) and np.array_equal(a.weights, b.weights)


def test_odd_rows(spark):
    docs, labels = corpus(150)
    odd = brute.with_clashes(brute.documents(spark)).withColumnsRenamed({"a": "label", "b": "_id", "at": "places"})
    table = spark.createDataFrame(labels + [(2, None), (None, 1), (None, None), (9999, 0), (4, 0), (4, 1)], "doc_id long, label int")
    model = quality.train(brute.documents(spark, docs + brute.ODD), table)
    rows = quality.score(odd, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, *_ in brute.ODD)
    assert all(0 < r.score < 1 and r.held_out == is_held_out(r.doc_id) for r in rows)
    assert quality.score(brute.documents(spark, []), model).collect() == []


def test_without_both_labels(spark):
    docs, labels = corpus(60)
    for own, share in (([], 0.5), ([(d, 1) for d, _ in labels[:9] if not is_held_out(d)], None), ([(1, None)], 0.5)):
        model = model_of(spark, docs, own)
        scores = {r.score for r in quality.score(brute.documents(spark, docs), model).collect()}
        assert len(scores) == 1 and (scores == {0.5} if share else min(scores) > 0.5)
    assert len(model_of(spark, [], labels).places) == 0


def test_the_sample_is_bounded(spark):
    docs, labels = corpus(300)
    own = spark.createDataFrame([(d, float(y)) for d, y in labels if not is_held_out(d)], "_id long, label double")
    copies = brute.documents(spark, docs + [(d, t + " again", *rest) for d, t, *rest in docs])
    rows = quality._sample(copies, own, 10).collect()
    assert Counter(r.label for r in rows) == {0.0: 10, 1.0: 10}
    assert len({r._id for r in rows}) == 20


def test_memory_keeps_no_long_words(monkeypatch):
    monkeypatch.setattr(quality, "CACHE", 3)
    hashes = quality.Hashes()
    for word in ["a", "b", "c", "d", "x" * 1000]:
        assert hashes[word] == zlib.crc32(word.encode())
    assert set(hashes) == {"d"}
