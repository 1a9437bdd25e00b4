import random

from revtide.llm import simhash
from tests.llm import brute


def some_texts(n=120, seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(draw.choices(words, k=draw.randrange(3, 120))) for _ in range(n // 4)]
    texts = []
    for _ in range(n):
        text = draw.choice(base).split()
        for _ in range(draw.randrange(3)):
            text[draw.randrange(len(text))] = draw.choice(words)
        texts.append(" ".join(text))
    return texts


def test_components_equal_brute_force(spark):
    docs = [(i, t, "en", "s", 0) for i, t in enumerate(some_texts())] + [r for r in brute.ODD if r[0] is None or r[0] > 6]
    docs = [(d + 1000 if d is not None and len(t or "") > 400 else d, t, *r) for d, t, *r in docs]
    rows = simhash.fingerprint_components(brute.with_clashes(brute.documents(spark, docs)), 3).collect()
    assert len(rows) == len(docs)
    fps = {t: brute.simhash(t, 3) for _, t, *_ in docs}
    root = brute.groups(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d, t, *_ in docs:
        if d is not None:
            least[root[fps[t]]] = min(d, least.get(root[fps[t]], d))
    expected = sorted((str(d), f"{fps[t]:016x}", str(least.get(root[fps[t]]))) for d, t, *_ in docs)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == expected


def test_every_pair_within_the_radius_shares_a_table():
    masks = simhash.covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_links_of_close_fingerprints(spark):
    draw = random.Random(1)
    fps = {draw.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for fp in list(fps):
        for _ in range(6):
            fp ^= 1 << draw.randrange(64)
            fps.add(fp)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    found = {r.node: r.root for r in simhash.link_fingerprints(spark.createDataFrame([(s,) for s in signed.values()], "fp long")).collect()}
    root = brute.groups(signed.values(), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {f: found.get(f, f) for f in signed.values()} == root


def test_near_copies_lose_all_but_one(spark):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    docs, families = [], {}
    for family in range(12):
        base = draw.choices(words, k=draw.randrange(60, 500))
        for copy in range(4):
            text = base[:]
            for _ in range(copy * len(base) // 200):
                text[draw.randrange(len(text))] = draw.choice(words)
            docs.append((100 * copy + family, " ".join(text), "en", "s", 1))
            families[docs[-1][0]] = family
    docs += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "lone words stand here alone", "en", "s", 0)]
    docs += [docs[0], (None, "an unnamed row", None, None, None)]
    kept = simhash.one_of_each_group(brute.documents(spark, docs)).collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids)) and {900, 902, None} <= set(ids) and 901 not in ids
    assert set(range(12)) <= set(ids)
    texts = {d: set(brute.shingles(t, 5)) for d, t, *_ in docs if d in families}
    linked = lambda a, b: len(texts[a] & texts[b]) >= 0.8 * len(texts[a] | texts[b])
    expected = {d for d, r in brute.groups(texts, linked).items() if d == r}
    assert {i for i in ids if i in families} == expected


def test_distinct_texts_with_a_common_passage_stay(spark):
    draw = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(80))
    docs = [(i, " ".join(f"x{draw.randrange(10**6)}" for _ in range(150)) + " " + passage, "en", "s", 1) for i in range(60)]
    assert simhash.one_of_each_group(brute.documents(spark, docs)).count() == 60


def test_empty_tables(spark):
    none = brute.documents(spark, [])
    assert simhash.fingerprint_components(none).collect() == []
    assert simhash.one_of_each_group(none).collect() == []


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    text = " ".join(f"w{i % 37}" for i in range(300))
    assert simhash.text_fingerprint(text, 3) % (1 << 64) == brute.simhash(text, 3)
    assert len(simhash.part_fingerprints(text, 5, 4)) > 5


def edited_family(copies, seed=5):
    """A text of 300 words, and copies with five words changed: near the text, not near one another."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    docs = [(copies, " ".join(base), "en", "s", 1)]
    for i in range(copies):
        text = base[:]
        for at in draw.sample(range(10, 290, 6), 5):
            text[at] = f"x{draw.randrange(10**6)}"
        docs.append((i, " ".join(text), "en", "s", 1))
    return docs


def left_by_brute_force(docs):
    texts = {d: set(brute.shingles(t, 5)) for d, t, *_ in docs}
    linked = lambda a, b: len(texts[a] & texts[b]) >= 0.8 * len(texts[a] | texts[b])
    return {d for d, r in brute.groups(texts, linked).items() if d == r}


def test_a_family_of_edited_copies_is_one_group(spark):
    docs = edited_family(300)
    assert left_by_brute_force(docs) == {0}
    assert [r.doc_id for r in simhash.one_of_each_group(brute.documents(spark, docs)).collect()] == [0]


def test_large_classes_are_compared_in_blocks(spark, monkeypatch):
    for name, value in (("SMALL", 2), ("ROUNDS", 0), ("BLOCK_TEXTS", 16), ("MATRIX", 64)):
        monkeypatch.setattr(simhash, name, value)
    docs = edited_family(60) + [(100 + d, t + " more", *r) for d, t, *r in edited_family(20, 6)]
    kept = {r.doc_id for r in simhash.one_of_each_group(brute.documents(spark, docs)).collect()}
    assert kept == left_by_brute_force(docs) == {0, 100}


def test_short_texts_with_a_changed_word_are_found(spark):
    draw = random.Random(12)
    docs = []
    for i, n in enumerate(n for n in (49, 50, 52, 55, 60, 65, 80, 110, 150) for _ in range(25)):
        base = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        text = base[:]
        for at in draw.sample(range(n), max(1, n // 50)):
            text[at] = f"x{draw.randrange(10**6)}"
        docs += [(i, " ".join(base), "en", "s", 1), (1000 + i, " ".join(text), "en", "s", 1)]
    kept = {r.doc_id for r in simhash.one_of_each_group(brute.documents(spark, docs)).collect()}
    assert kept == left_by_brute_force(docs)
    assert sum(d >= 1000 for d in kept) < 225 / 2


def test_close_fingerprints_are_candidates_of_the_groups(spark, monkeypatch):
    asked, link = [], simhash.link_fingerprints

    def seen(fps):
        asked.append({r.fp for r in fps.collect()})
        return link(fps)

    monkeypatch.setattr(simhash, "link_fingerprints", seen)
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(["a b c d e f", "a b c d e", "", None, "x y z"])]
    docs += [(9, "a b c d e f", "en", "s", 1)]
    assert {r.doc_id for r in simhash.one_of_each_group(brute.documents(spark, docs)).collect()} == {0, 1, 2, 4}
    assert asked == [{simhash.text_fingerprint(t, 5) for t in ("a b c d e f", "a b c d e", "", "x y z")}]
    prints = spark.createDataFrame([(5, 0b1000), (3, 0b1011), (8, 7 << 40), (9, 0b1000), (7, 0b110000001)], "text_id long, fp long")
    assert sorted((r.a, r.b) for r in simhash._close_texts(prints).collect()) == [(3, 5), (3, 9)]


def test_texts_that_share_their_last_shingles_alone_are_not_compared(spark):
    # Of 100 shingles each, a shingle at place 15 leaves 85, too few for a similarity of 0.8 (89); at place 5 it leaves 95.
    rows = [(1, n, 100, 15) for n in range(20)] + [(2, n, 100, 5) for n in range(3)] + [(2, 9, 110, 15), (2, 8, 125, 25), (3, 1, 100, 2)]
    classes = spark.createDataFrame(rows, "key long, text_id long, n long, place int")
    assert sorted((r.key, r.text_id) for r in simhash._able(classes, 0.8).collect()) == [(2, 0), (2, 1), (2, 2), (2, 9)]


def test_texts_that_share_too_few_shingles_are_not_compared(spark, monkeypatch):
    # A text of 100 shingles shares 5 with a similar one: 1 + 80 // 20.
    rows = [(key, 1, 100, 3 * key) for key in range(6)] + [(key, 2, 100, key) for key in range(4)] + [(7, 2, 100, -1)]
    able = simhash._of_able_texts(spark.createDataFrame(rows, "key long, text_id long, n long, place int"), 0.8)
    assert sorted((r.text_id, r.place, r.spare) for r in able.collect() if r.place >= 0) == [(1, 3 * key, 1 - key) for key in range(6)]
    assert {r.text_id for r in able.collect() if r.place < 0} == {2}

    held, write = {}, simhash.written

    def seen(frame, name):
        out = write(frame, name)
        held[name] = out.count()
        return out

    monkeypatch.setattr(simhash, "written", seen)
    monkeypatch.setattr(simhash, "ORDER_SHINGLES", 0)
    draw = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, " ".join(f"x{draw.randrange(10**6)}" for _ in range(150)) + " " + passage, "en", "s", 1) for i in range(60)]
    assert simhash.one_of_each_group(brute.documents(spark, docs)).count() == 60
    assert held["texts"] == 0


def test_a_pair_among_texts_with_a_common_passage_is_found(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", 2)
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, " ".join(f"x{draw.randrange(10**6)}" for _ in range(60 + 5 * i)) + " " + passage, "en", "s", 1) for i in range(30)]
    docs += [(100 + i, text.replace(" p7 ", f" y{i} "), *r) for i, text, *r in docs[::3]]
    kept = {r.doc_id for r in simhash.one_of_each_group(brute.documents(spark, docs)).collect()}
    assert kept == left_by_brute_force(docs) == set(range(30))
