"""Line dedup by winnowing over line hashes, in DataFrame and SQL functions only.

A line ends at a newline or at a mark of punctuation, so that a passage pasted into the middle of
a paragraph still has lines of its own; the lines of a text put together are the text. Every two
neighbouring lines are hashed as one, and of every ``WINDOW`` neighbouring hashes the least is a
fingerprint: a run of ``WINDOW + 1`` lines that two places share has a fingerprint that both
selected. A long line is a fingerprint by itself, too.

The places of one fingerprint are joined with its first place (least ``doc_id``, then position),
never with one another, and each match is extended both ways over the two lines before and after,
beyond which a shared run has a further fingerprint of its own. The matched lines of a document
are joined into runs, and the later runs of ``min_words`` words or more are deleted. As a deleted
line always equals an earlier one, the first occurrence of every line survives.

Cases: a NULL text stays NULL. An empty text stays as it is. Rows that share ``doc_id`` and text
count as one document and are treated alike; NULL ``doc_id`` comes before all others. A text all
of whose lines are deleted becomes empty. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import others_aside, written

WINDOW = 3
MIN_WORDS = 25
#: Characters from which a line is a fingerprint by itself.
LONG_LINE = 120

LINE = r"[^.,;:!?\n]*+[.,;:!?\n]++\s*+|[^.,;:!?\n]++"

_TOP = "9223372036854775807L"


def _lines(text: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(LINE), 0)


def _document(docs: DataFrame) -> tuple[Column, Column]:
    """What tells documents apart: the id, NULL before all others, and 32 bits of the text's hash."""
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))), F.hash(docs["text"])


def fingerprint_places(docs: DataFrame) -> DataFrame:
    """``fp, doc, place, left, right``: each selected fingerprint and where it is.

    ``place`` holds the 32 bits that tell the text, its first line and whether it has two lines or
    one; ``left`` and ``right`` hold 32 bits of the hashes of the two lines before and after it, 0
    where there is none.
    """
    doc, version = _document(docs)
    hashed = docs.select(doc.alias("doc"), version.alias("version"), _lines("text").alias("lines")).select(
        "doc",
        "version",
        F.expr("transform(lines, l -> xxhash64(trim(l)))").alias("h"),
        F.expr(f"transform(lines, l -> char_length(l) >= {LONG_LINE})").alias("wide"),
    )
    paired = hashed.select(
        "doc", "version", "h", "wide", F.expr("transform(h, (x, i) -> xxhash64(x, get(h, i + 1)))").alias("p")
    )
    least = " or ".join(
        f"(x <= coalesce(get(p, i + {a}), {_TOP}) and x <= coalesce(get(p, i + {b}), {_TOP}))"
        for a, b in ((-2, -1), (-1, 1), (1, 2))
    )

    def around(near: int, far: int) -> str:
        return f"(coalesce(get(h, i + {near}), 0L) & 4294967295L) | shiftleft(coalesce(get(h, i + {far}), 0L), 32)"

    place = "shiftleft(bigint(version), 32) | shiftleft(bigint(i), 1)"
    pair = f"struct(x as fp, {place} | 1L as place, {around(-1, -2)} as left, {around(2, 3)} as right)"
    wide = f"struct(xxhash64(x, 1) as fp, {place} as place, {around(-1, -2)} as left, {around(1, 2)} as right)"
    return paired.select(
        "doc",
        F.inline(
            F.expr(
                f"filter(concat(transform(p, (x, i) -> if({least}, {pair}, null)),"
                f" transform(h, (x, i) -> if(get(wide, i), {wide}, null))), e -> e is not null)"
            )
        ),
    )


def repeated_lines(places: DataFrame) -> DataFrame:
    """``doc, version, first, last``: line ranges that repeat an earlier place, extended both ways.

    First places are combined per task before they are dealt out, and written, so that their shuffle files go before the
    places are dealt out for the join. A fingerprint of very many places is one row of a task there, and in the join the
    planner may split it.
    """
    first = written(
        places.groupBy("fp")
        .agg(F.min(F.struct("doc", "place", "left", "right")).alias("o"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("fp", "o"),
        "first",
    )
    matched = places.join(first.hint("merge"), "fp").filter("doc <> o.doc or place <> o.place")
    low, high = "({c} & 4294967295L)", "shiftrightunsigned({c}, 32)"

    def reach(side: str) -> str:
        near = f"({low.format(c=side)} <> 0 and {low.format(c=side)} = {low.format(c='o.' + side)})"
        far = f"({high.format(c=side)} <> 0 and {high.format(c=side)} = {high.format(c='o.' + side)})"
        return f"case when not {near} then 0 when not {far} then 1 else 2 end"

    at = "int(shiftrightunsigned(place & 4294967295L, 1))"
    return matched.select(
        "doc",
        F.expr("int(shiftright(place, 32))").alias("version"),
        F.expr(f"{at} - {reach('left')}").alias("first"),
        F.expr(f"{at} + int(place & 1L) + {reach('right')}").alias("last"),
    )


#: Ranges in order -> runs: ranges that overlap or touch become one.
_RUNS = """
aggregate(sort_array(ranges), cast(array() as array<struct<first: int, last: int>>), (runs, r) ->
  if(size(runs) > 0 and r.first <= element_at(runs, -1).last + 1,
     concat(slice(runs, 1, size(runs) - 1),
            array(named_struct('first', element_at(runs, -1).first,
                               'last', greatest(element_at(runs, -1).last, r.last)))),
     concat(runs, array(named_struct('first', r.first, 'last', r.last)))))
"""


def drop_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows and columns of ``docs``, with ``text`` freed of later repeated runs, and ``deleted_lines``.

    A column ``deleted_lines`` of ``docs`` gives way to the operator's.
    """
    return others_aside(lambda own: _without_runs(own, min_words), docs)


def _without_runs(docs: DataFrame, min_words: int) -> DataFrame:
    # Written, so that the shuffle files of the places go before the texts are dealt out.
    ranges = written(
        repeated_lines(fingerprint_places(docs))
        .groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_version"))
        .agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
        .select("_doc", "_version", F.expr(_RUNS).alias("_runs")),
        "runs",
    )
    doc, version = _document(docs)
    joined = docs.withColumns({"_d": doc, "_v": version}).join(
        ranges, (F.col("_d") == F.col("_doc")) & (F.col("_v") == F.col("_version")), "left"
    )
    words = "size(filter(split(array_join(slice(_lines, r.first + 1, r.last - r.first + 1), ''), '\\\\s+'), w -> w <> ''))"
    kept = (
        "concat(coalesce(array_join(transform(_gone, (r, i) -> array_join(slice(_lines,"
        " if(i = 0, 0, _gone[i - 1].last + 1) + 1, r.first - if(i = 0, 0, _gone[i - 1].last + 1)), '')), ''), ''),"
        " array_join(slice(_lines, element_at(_gone, -1).last + 2, size(_lines)), ''))"
    )
    cut = (
        joined.withColumn("_lines", F.when(F.col("_runs").isNotNull(), _lines("text")))
        .withColumn("_gone", F.expr(f"filter(_runs, r -> {words} >= {min_words})"))
        .withColumns(
            {
                "text": F.when(F.size("_gone") > 0, F.expr(kept)).otherwise(F.col("text")),
                "deleted_lines": F.coalesce(
                    F.expr("aggregate(_gone, 0, (n, r) -> n + r.last - r.first + 1)"), F.lit(0)
                ),
            }
        )
    )
    return cut.select(*docs.columns, "deleted_lines")
