import random

from revtide.llm import decontam
from tests.llm import brute

ITEMS = [
    (1, "Yesterday Alice bought 5 kg of sweet red apples and then gave 3 of them to her brother, how many are left?"),
    (2, "the quick brown fox jumps over the lazy dog while seven silver swans swim slowly past"),
    (3, "short item of five words"),
    (4, None),
    (5, ""),
    (2, "the quick brown fox jumps over the lazy dog while seven silver swans swim slowly past"),
]


def found(spark, docs, items=ITEMS):
    rows = decontam.leaks(
        brute.with_clashes(brute.documents(spark, [(d, t, "en", "s", 0) for d, t in docs])),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    return {(r.doc_id, r.item_id): r.exact for r in rows}


def test_leaks_and_decoys(spark):
    new = ITEMS[0][1].replace("Alice", "Robert").replace("5", "12").replace("3", "7")
    mixed = "Yesterday Alice bought 5 kg of sweet red apples and then gave 5 of them to her brother, how many are left?"
    docs = [
        (1, f"Before it. {ITEMS[0][1]} After it."),
        (2, f"Words. {new}"),
        (3, mixed),
        (4, "He said the quick brown fox jumps over a fence"),
        (5, f"x y z\n{ITEMS[1][1].upper()}\nx y z"),
        (6, "short item of five words"),
        (7, "a text with a short item of five words inside"),
        (8, None),
        (9, ""),
        (None, ITEMS[1][1]),
        (10, "the quick brown fox jumps over the lazy dog then other words while seven silver swans swim slowly past"),
        (11, "filler " * 40_000 + ITEMS[1][1]),
    ]
    got = found(spark, docs)
    assert got == {(1, 1): True, (2, 1): False, (5, 2): True, (6, 3): True, (None, 2): True, (11, 2): True}


def test_random_passages_against_a_search(spark):
    draw = random.Random(3)
    word = lambda: f"{draw.choice('abcdefgh')}{'xyz'[draw.randrange(3)] * draw.randrange(1, 4)}{draw.choice('klmn') * draw.randrange(1, 5)}"
    items = [(i, " ".join(word() for _ in range(draw.randrange(14, 40)))) for i in range(20)]
    docs = []
    for i in range(150):
        text = " ".join(word() for _ in range(draw.randrange(0, 80)))
        if i % 3 == 0:
            text += " " + draw.choice(items)[1] + " " + word()
        docs.append((i, text))
    got = set(found(spark, docs, items))
    planted = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {t} "}
    assert planted and planted <= got
    for d, i in got - planted:
        a, b = dict(docs)[d].split(), dict(items)[i].split()
        assert any(a[k : k + 8] == b[j : j + 8] for k in range(len(a)) for j in range(len(b)))


def test_clean_documents_stay(spark):
    docs = [(1, ITEMS[1][1], "en", "s", 1), (2, "clean", "en", "s", 1), (None, None, None, None, None), (2, "clean", "en", "s", 1)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.without_leaks(brute.documents(spark, docs), items)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "None"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.without_leaks(brute.documents(spark, docs), none).count() == 4
    assert decontam.leaks(brute.documents(spark, []), items).collect() == []


def test_templates():
    windows = decontam.template_windows("Then Bob paid 5 km and $ 3,5 for it. Anna ran")
    assert windows[0][3] == "then <name> paid <number> <unit> and $ <number>"
    assert windows[0][4] == ["bob", "5", "km", "3,5"]
    assert decontam.template_windows("1 2 3 4 5 6 7 8 9") == []


def found_whole(spark, docs, items):
    documents = brute.documents(spark, [(d, t, "en", "s", 0) for d, t in docs])
    rows = decontam.leaks(documents, spark.createDataFrame(items, "item_id long, text string"), whole=True).collect()
    return {(r.doc_id, r.item_id): r.exact for r in rows}


def test_exact_copies_of_short_and_dense_items(spark):
    items = [
        (1, "short item of five words"),
        (2, "12 + 30 = 42, 7 + 8 = 15, 20 + 21 = 41"),
        (3, "Add up 5 kg, 3 kg and 10 kg for Bob"),
        (4, "The old lighthouse keeper counted seven passing ships before dawn"),
        (5, "3 + 4"),
    ]
    docs = [(i, f"some text ahead {t} and some text after it") for i, t in items]
    docs += [(10, "a short item of six words"), (11, "12 + 31 = 43, 7 + 9 = 16, 20 + 22 = 42")]
    got = found_whole(spark, docs, items)
    assert got == {(i, i): True for i, _ in items}


def test_reparameterised_names_at_sentence_starts_and_unrelated_equal_numbers(spark):
    items = [
        (1, "Anna has 5 apples in her bag. Anna buys 3 pears from him. Anna eats 2 plums at home."),
        (2, "the farmer sold 3 baskets of ripe cherries at noon and bought 3 sacks of dry seed before he went home"),
    ]
    docs = [(1, f"Read this. {items[0][1].replace('Anna', 'Tom')}"), (2, items[1][1].replace("3 b", "4 b").replace("3 s", "6 s"))]
    assert found_whole(spark, docs, items) == {(1, 1): False, (2, 2): False}
