import random
import time

from pyspark.sql import functions as F

from revtide.llm import linededup
from revtide.llm.common import written
from tests.llm import brute


def cleaned(spark, docs, **kw):
    rows = linededup.drop_repeated_runs(brute.documents(spark, docs), **kw).collect()
    return {r.doc_id: (r.text, r.deleted_lines) for r in rows}


def sentence(draw, n=7):
    return " ".join(f"w{draw.randrange(10**5)}" for _ in range(n)) + draw.choice(".,!") + " "


def test_lines_put_together_are_the_text(spark):
    texts = ["a, b.c\n\n d!? e", "...", "no mark", "", " \n x", "tail  \n"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in frame.select("text", linededup._lines("text").alias("l")).collect():
        assert "".join(row.l) == row.text and row.l == brute.lines(row.text)


def test_planted_passages_go_from_later_documents_only(spark):
    draw = random.Random(4)
    passage = "".join(sentence(draw) for _ in range(9))
    own = {i: ["".join(sentence(draw) for _ in range(draw.randrange(4, 12))) for _ in range(2)] for i in range(40)}
    docs = [(i, f"{a}{passage if i % 3 == 0 else ''}{b}", "en", "s", 0) for i, (a, b) in own.items()]
    got = cleaned(spark, docs)
    for i, (a, b) in own.items():
        if i == 0:
            assert got[i] == (docs[0][1], 0)
        else:
            assert got[i][0] == a + b
            assert got[i][1] == (9 if i % 3 == 0 else 0)


def test_a_passage_inside_a_line_loses_its_whole_lines(spark):
    draw = random.Random(5)
    passage = "".join(sentence(draw, 8) for _ in range(8))
    docs = [(i, f"start{i} of it {passage}end{i} of it.", "en", "s", 0) for i in range(6)]
    got = cleaned(spark, docs)
    first = brute.lines(passage)[0]
    assert got[0][0] == docs[0][1]
    for i in range(1, 6):
        assert got[i][0] == f"start{i} of it {first}end{i} of it."


def test_short_repeats_stay_and_every_line_survives_somewhere(spark):
    draw = random.Random(6)
    lines = [sentence(draw, draw.randrange(1, 14)) for _ in range(30)]
    docs = [(i, "".join(draw.choices(lines, k=draw.randrange(1, 25))), "en", "s", 0) for i in range(60)]
    docs += [(100, lines[0] * 3, "en", "s", 0), (101, lines[0], "en", "s", 0)]
    got = cleaned(spark, docs)
    before = {x.strip() for _, t, *_ in docs for x in brute.lines(t)}
    after = {x.strip() for t, _ in got.values() for x in brute.lines(t)}
    assert before == after
    assert got[101][0] == lines[0]
    assert sum(n for _, n in got.values()) > 0


def test_copies_lose_all_and_odd_rows_pass(spark):
    draw = random.Random(7)
    text = "".join(sentence(draw) for _ in range(12))
    docs = [(50, text, "en", "s", 0), (60, text, "en", "s", 0), (60, text, "en", "s", 0), *brute.ODD]
    rows = linededup.drop_repeated_runs(brute.with_clashes(brute.documents(spark, docs))).collect()
    assert len(rows) == len(docs)
    assert [r.text for r in rows if r.doc_id == 50] == [text]
    assert [r.text for r in rows if r.doc_id == 60] == ["", ""]
    odd = sorted((str(r.doc_id), str(r.text)) for r in rows if r.doc_id not in (50, 60))
    assert odd == sorted((str(d), str(t)) for d, t, *_ in brute.ODD)
    assert linededup.drop_repeated_runs(brute.documents(spark, [])).collect() == []


def test_a_long_line_repeats_by_itself(spark):
    draw = random.Random(9)
    line = " ".join(f"w{draw.randrange(10**5)}" for _ in range(60))
    docs = [(i, f"intro{i}. {line}.\nclosing{i}.", "en", "s", 0) for i in range(3)]
    got = cleaned(spark, docs)
    assert got[0][1] == 0
    assert got[2][0].replace("\n", "") == "intro2. closing2."


def test_no_python_in_the_plan(spark):
    frame = linededup.drop_repeated_runs(brute.documents(spark)).withColumn("n", F.length("text"))
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_a_fingerprint_of_very_many_places_may_be_dealt_to_many_tasks(spark):
    # The planner splits joins of shuffles of its own only, so none may be fixed by a number of partitions.
    docs = brute.documents(spark, [(i, f"one{i}. Same line here. Same line there. two{i}.", "en", "s", 0) for i in range(40)])
    plan = linededup.repeated_lines(linededup.fingerprint_places(docs))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "REPARTITION_BY" not in plan
    # Both sides come sorted from a shuffle, and no first place is sought again in the join.
    assert plan.count("Exchange hashpartitioning(fp") == 2 and "SortAggregate" not in plan


def test_shuffle_files_go_before_the_texts_are_dealt_out(spark):
    def files():
        # Names of shuffle files on this process's disk.
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in found if "/shuffle_" in f}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs = brute.documents(spark, [(i, "Same line here. Same line there. " * 9, "en", "s", 0) for i in range(40)])
    before, set_before = files(), spark.conf.get(setting, None)
    places = linededup.fingerprint_places(docs)
    found = written(places.groupBy("fp").agg(F.count("*").alias("n")), "counted")
    frame = linededup.drop_repeated_runs(docs)
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.05)
    assert not files() - before
    assert found.agg(F.sum("n")).first()[0] == places.count()
    # Neither the first places nor the places are left in what deals out the texts.
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(fp" not in plan and "xxhash64" not in plan
    assert frame.filter("text <> ''").count() == 1
    assert spark.conf.get(setting, None) == set_before
