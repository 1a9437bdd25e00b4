"""Document fingerprints by invertible Bloom lookup sketches, in DataFrame and SQL functions only.

A text's paragraphs are hashed (equal ones told apart by their count), and each digest goes to one
cell of each of three tables. A cell holds a count, the digests' exclusive or and that of their
check hashes. Two sketches subtract cell by cell; what both texts have in common cancels. Peeling
takes a cell that holds a single digest, notes it as lost or gained, and takes it out of its other
cells, until the difference is empty. If it gets stuck, the sketches of four times as many cells
are subtracted, and so on; beyond the largest, the digests themselves are compared.

Sketches are written sparsely: cells that hold nothing take no room, so a larger sketch costs
no more than a smaller one. The fingerprint string is the base sketch.

Cases: a NULL text counts as empty and has the empty fingerprint; two empty texts have likeness 1.
Repeated rows stand beside one another in the order of documents, by their text. NULL ``doc_id``
comes last in that order. An empty table gives an empty result; a single document is its own next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cells of each of the three tables, base first.
SIZES = (64, 256, 1024, 4096, 16_384, 262_144)
#: Rounds of peeling; each takes all single cells at once, so few are needed.
ROUNDS = 12
#: Documents per chunk of the order, on average.
CHUNK = 2048

#: A paragraph ends at a newline.
PARAGRAPH = r"[^\n]++"


def digests(text: str) -> str:
    """SQL: distinct 64-bit digests of the paragraphs of ``text``; repeats are told apart by their count."""
    pieces = f"transform(regexp_extract_all({text}, r'{PARAGRAPH}', 0), p -> xxhash64(trim(p)))"
    # In order, a digest's place less the place of the first of its equals is its count.
    return (
        f"transform(array(sort_array({pieces})), p -> if(size(array_distinct(p)) = size(p), p,"
        " transform(p, (x, i) -> if(i > 0 and p[i - 1] = x, xxhash64(x, i + 1 - array_position(p, x)), x))))[0]"
    )


def _entries(keys: str, sign: str, size: int) -> str:
    """SQL: a cell for each digest of ``keys`` in each of the three tables."""
    cell = (
        f"named_struct('c', int(pmod(xxhash64(k, t), {size}L)) + t * {size}, 'n', {sign}, 'k', k, 'h', xxhash64(k, 3))"
    )
    return f"flatten(transform({keys}, k -> transform(array(0, 1, 2), t -> {cell})))"


def _summed(cells: str) -> str:
    """SQL: cells of the same place added up, those that hold nothing left out.

    The cells are sorted once; a sum begins wherever the place changes, so the work is linear.
    """
    starts = "filter(sequence(0, size(d) - 1), i -> i = 0 or d[i - 1].c <> d[i].c)"
    total = (
        "aggregate(sequence(i + 1, z - 1), d[i], (s, x) -> named_struct('c', s.c, 'n', s.n + d[x].n,"
        " 'k', s.k ^ d[x].k, 'h', s.h ^ d[x].h))"
    )
    each = f"transform(a, (i, j) -> transform(array(coalesce(get(a, j + 1), size(d))), z -> if(z = i + 1, d[i], {total}))[0])"
    return (
        f"transform(array(sort_array({cells})), d -> if(size(d) = 0, d,"
        f" filter(transform(array({starts}), a -> {each})[0], e -> e.n <> 0 or e.k <> 0L or e.h <> 0L)))[0]"
    )


def sketch(keys: str, size: int = SIZES[0]) -> str:
    """SQL: the sketch of an array of digests, its cells in order."""
    return _summed(_entries(keys, "1", size))


def printed(cells: str) -> str:
    """SQL: a sketch as text."""
    each = "concat_ws('.', e.c, e.n, lower(hex(e.k)), lower(hex(e.h)))"
    return f"array_join(transform({cells}, e -> {each}), ' ')"


def _peeled(left: str, right: str, size: int) -> str:
    """SQL: the number of digests by which two sketches differ, NULL where peeling gets stuck."""
    negated = f"transform({sketch(right, size)}, e -> named_struct('c', e.c, 'n', -e.n, 'k', e.k, 'h', e.h))"
    difference = _summed(f"concat({sketch(left, size)}, {negated})")
    # Both signs apart: distinct numbers are found by hashing, distinct structs are not.
    single = "array_distinct(transform(filter(s.d, e -> e.n = {n} and e.h = xxhash64(e.k, 3)), e -> e.k))"
    lost, gained = single.format(n=1), single.format(n=-1)
    taken = f"concat({_entries('one.lost', '-1', size)}, {_entries('one.gained', '1', size)})"
    step = (
        f"transform(array(named_struct('lost', {lost}, 'gained', {gained})), one ->"
        " if(size(one.lost) + size(one.gained) = 0, s,"
        f" named_struct('d', {_summed(f'concat(s.d, {taken})')},"
        " 'found', s.found + size(one.lost) + size(one.gained))))[0]"
    )
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('d', {difference}, 'found', 0),"
        f" (s, r) -> if(size(s.d) = 0, s, {step}), s -> if(size(s.d) = 0, s.found, null))"
    )


def difference_size(left: str, right: str) -> str:
    """SQL: the number of digests that only one of two texts has: peeled, with larger sketches on failure."""
    exact = f"size(array_except({left}, {right})) + size(array_except({right}, {left}))"
    return "coalesce(" + ", ".join([*(_peeled(left, right, size) for size in SIZES), exact]) + ")"


def likeness(left: str, right: str) -> str:
    """SQL: the share of both texts' digests that cancel."""
    return (
        f"if(size({left}) + size({right}) = 0, 1.0D,"
        f" 1.0D - {difference_size(left, right)} / cast(size({left}) + size({right}) as double))"
    )


def beside_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next``: each text beside the next document's, by descending id; the first follows the last.

    Documents are dealt out into ranges of ids of ``CHUNK`` on average, and a range's last document
    is joined with the first of the next range that has any, so no task orders the whole table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = found.low or 0, found.high or 0
    width = max(1, (high - low + 1) * CHUNK // max(1, found.n))
    chunk = F.coalesce(F.expr(f"cast(floor((doc_id - ({low}L)) / {width}) as bigint)"), F.lit(-1))
    cut = rows.withColumn("chunk", chunk)
    order = (F.col("doc_id").desc_nulls_last(), F.col("text"))
    inside = Window.partitionBy("chunk").orderBy(*order)
    placed = cut.withColumn("next", F.lead("text").over(inside))
    # One row for each range: the text of its first document, and the range that comes after it.
    heads = cut.groupBy("chunk").agg(F.max("doc_id").alias("head"))
    firsts = (
        cut.join(heads.withColumnRenamed("chunk", "of"), (F.col("chunk") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("of")
        .agg(F.min("text").alias("across"))
    )
    every = Window.partitionBy()
    follow = (
        heads.select("chunk")
        .select("chunk", F.coalesce(F.lag("chunk").over(every.orderBy("chunk")), F.max("chunk").over(every)).alias("after"))
        .join(firsts, F.col("after") == F.col("of"))
        .select(F.col("chunk").alias("of_chunk"), "across")
    )
    return placed.join(follow, F.col("chunk") == F.col("of_chunk"), "left").select(
        "doc_id", "text", F.coalesce("next", "across").alias("next")
    )


def edited(text: str, following: str) -> str:
    """SQL: ``text`` with its last third (rounded down) replaced by as many code points of ``following``, or all it has."""
    third = f"(char_length({text}) div 3)"
    return f"concat(substr({text}, 1, char_length({text}) - {third}), substr({following}, 1, {third}))"


def compare_versions(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how alike it is to that and to the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    texts = beside_next(docs).withColumn("edited", F.expr(edited("text", "next")))
    keyed = texts.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(digests("text")).alias("own"),
        F.expr(digests("edited")).alias("changed"),
        F.expr(digests("next")).alias("following"),
    )
    return keyed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.expr(printed(sketch("own"))).alias("fingerprint"),
        F.expr(printed(sketch("changed"))).alias("edited_fingerprint"),
        F.expr(likeness("own", "changed")).alias("near_edited"),
        F.expr(likeness("own", "following")).alias("near_next"),
    )
