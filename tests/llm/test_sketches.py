import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from revtide.llm import sketches
from tests.llm import brute


def in_order(docs):
    return sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))


def paragraphs(text):
    return Counter(p.strip(" ") for p in (text or "").split("\n") if p)


def alike(a, b):
    one, two = paragraphs(a), paragraphs(b)
    total = sum(one.values()) + sum(two.values())
    return 1.0 if not total else 1.0 - (sum((one - two).values()) + sum((two - one).values())) / total


def expected(docs):
    order = in_order(docs)
    for i, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        yield (
            str(doc_id),
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            round(alike(text, changed), 9),
            round(alike(text, following), 9),
        )


def some_documents(n=150):
    draw = random.Random(11)
    lines = [f"line {i} é日" for i in range(60)]
    return [
        (draw.randrange(10**9) * 3 + i, "\n".join(draw.choices(lines, k=draw.randrange(0, 40))), "en", "s", 0)
        for i in range(n)
    ]


def check(spark, docs):
    rows = sketches.compare_versions(brute.with_clashes(brute.documents(spark, docs))).collect()
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows)
    assert got == sorted(expected(docs))
    return rows


def test_versions_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sketches, "CHUNK", 16)
    docs = some_documents()
    rows = check(spark, docs)
    by_text = {}
    for r in rows:
        by_text.setdefault(dict((d, t) for d, t, *_ in docs)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len({next(iter(f)) for f in by_text.values()}) == len(by_text)


def test_odd_rows(spark):
    check(spark, brute.ODD)
    check(spark, [(5, "alone\nhere", "en", "s", 0)])
    check(spark, [(None, None, None, None, None)])
    assert sketches.compare_versions(brute.documents(spark, [])).collect() == []


def test_peeling_recovers_and_retries_larger(spark, monkeypatch):
    draw = random.Random(4)
    pairs = []
    for size in (0, 1, 5, 40, 300):
        common = [draw.getrandbits(62) for _ in range(size)]
        pairs.append((common + [draw.getrandbits(62) for _ in range(size)], common + [draw.getrandbits(62) for _ in range(2 * size)]))
    frame = spark.createDataFrame(pairs, "x array<long>, y array<long>")
    stuck = frame.select(F.expr(sketches._peeled("x", "y", 4)).alias("n")).collect()
    assert [r.n for r in stuck][:2] == [0, 3] and stuck[-1].n is None
    for sizes in (sketches.SIZES, (4, 16, 1024), (4,)):
        monkeypatch.setattr(sketches, "SIZES", sizes)
        rows = frame.select(F.expr(sketches.difference_size("x", "y")).alias("n")).collect()
        assert [r.n for r in rows] == [0, 3, 15, 120, 900]


def test_long_texts_and_no_python(spark):
    text = "\n".join(f"p{i}" for i in range(3000))
    check(spark, [(1, text, "en", "s", 0), (2, text[:5000], "en", "s", 0)])
    frame = sketches.compare_versions(brute.documents(spark))
    assert "Python" not in frame._jdf.queryExecution().toString()
