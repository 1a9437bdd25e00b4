"""Benchmark decontamination by template windows.

A text becomes a template: numbers, names and units turn into typed placeholders, every other word
is lower-cased. Windows of ``WINDOW`` template words are hashed, and the documents' windows are
joined with the benchmark's by hash and text. A sentence's capitalised first word stands in them as
a word and, in a second template, as a name. The values that stand in the slots of one alignment of
a document and an item are then checked, each type of slot by itself (``_agreeing``). Alignments
whose slots contradict one another are no leaks.

A bitmap of fixed size with the benchmark's window hashes goes to every task and lets those
windows pass that may match, however large the benchmark is; the join decides.

Cases: NULL and empty texts have no windows. A text or item shorter than a window has one short
window. Rows that share a ``doc_id`` are looked at together; a NULL id forms a group like any
other. Empty tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import hash_filter, in_filter, others_aside, slices, stored

WINDOW = 8
#: Words of a window that must be literal, so that a row of placeholders says nothing.
LITERAL = 4
#: A leak covers so many words of an item with matched windows, or all of a shorter item.
MIN_WORDS = 13
#: Bits of the filter that every task gets.
BITMAP = 1 << 22
#: Of so many pairs of values of one type one may contradict the others.
CONTRADICTIONS = 4
#: Distinct words that one Python worker remembers.
CACHE = 200_000
#: Texts whose windows are hashed at once.
TOGETHER = 32

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n]|[%$€£°]")

# Units of measure and signs that stand for one.
UNITS = frozenset(
    "mm cm m km mg g kg t ml cl l s sec secs second seconds min mins minute minutes h hr hrs hour "
    "hours day days week weeks month months year years inch inches ft foot feet yard yards mile "
    "miles oz lb lbs pound pounds dollar dollars euro euros cent cents percent degree degrees "
    "meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram "
    "kilograms liter liters litre litres mph kmh hz khz mhz ghz kb mb gb tb v w kw % $ € £ °".split()
)

WORD, NAME, NUMBER, UNIT, END = range(5)
PLACEHOLDER = {NAME: "<name>", NUMBER: "<number>", UNIT: "<unit>"}

COLUMNS = "id long, hash long, at int, words int, template string, slots array<string>"


def _kind(token: str) -> int:
    if token[0].isdigit():
        return NUMBER
    if token in ".!?\n":
        return END
    if token.lower() in UNITS:
        return UNIT
    if len(token) > 1 and token[0].isupper() and token[1:].islower():
        return NAME
    return WORD


class Words(dict):
    """Token -> number; ``kinds`` and ``hashes`` have its kind and its literal hash by number."""

    def __init__(self):
        super().__init__()
        self.kinds, self.hashes = array("b"), array("Q")

    def __missing__(self, token: str) -> int:
        import xxhash

        number = self[token] = len(self.kinds)
        self.kinds.append(_kind(token))
        self.hashes.append(xxhash.xxh64_intdigest(token.lower().encode()))
        return number


@lru_cache(maxsize=1)
def _worker_words() -> list[Words]:
    return [Words()]


def _words() -> Words:
    held = _worker_words()
    if len(held[0]) > CACHE:
        held[0] = Words()
    return held[0]


@lru_cache(maxsize=1)
def _slot_hashes():
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh64_intdigest(PLACEHOLDER.get(k, "").encode()) for k in range(5)], np.uint64)


def _mixed(hashes):
    import numpy as np

    hashes = hashes ^ (hashes >> np.uint64(29))
    hashes = hashes * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))


def _rolled(hashes, size: int):
    import numpy as np

    rolled = np.full(len(hashes) - size + 1, np.uint64(size))
    for j in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : len(hashes) - size + 1 + j]
    return _mixed(rolled)


def text_windows(texts: list[str], passes=None, whole: bool = False, short: tuple[int, ...] = ()):
    """``number of the text, hash, at, words of the text, template, slot values`` of the windows that ``passes`` lets through.

    A capitalised word is a name unless it begins a sentence; a unit follows a number. A window with
    a capitalised word that begins a sentence comes a second time with it as a name, and, if ``whole``
    is set, each window with placeholders comes once more with all values as words. ``short`` has the
    sizes below ``WINDOW`` in which all windows of longer texts are taken, too.
    """
    import numpy as np

    tokens: list[str] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        tokens.append("\n")
        tokens += TOKEN.findall(text)
        ends[i + 1] = len(tokens)
    if len(tokens) == len(texts):
        return
    words = _words()
    numbers = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
    kinds = np.frombuffer(words.kinds, np.int8)[numbers]
    before = np.concatenate([[END], kinds[:-1]])
    kinds[(kinds == UNIT) & (before != NUMBER)] = WORD
    named = kinds
    kinds = np.where((kinds == NAME) & (before == END), WORD, kinds)
    kept = np.flatnonzero(kinds != END)
    if not len(kept):
        return
    kinds, named, owner = kinds[kept], named[kept], np.searchsorted(ends, kept, "right") - 1
    plain = np.frombuffer(words.hashes, np.uint64)[numbers[kept]]
    lengths = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(lengths)])
    forms = [kinds]
    if (named != kinds).any():
        forms.append(named)
    if whole:
        forms.append(np.full_like(kinds, WORD))
    hashed = [plain if (f == WORD).all() else np.where(f == WORD, plain, _slot_hashes()[f]) for f in forms]
    changed = [np.concatenate([[0], np.cumsum(f != kinds)]) for f in forms]
    literal = [np.concatenate([[0], np.cumsum(f == WORD)]) for f in forms]
    for size in range(1, min(WINDOW, len(kept)) + 1):
        fits = owner[: len(kept) - size + 1] == owner[size - 1 :]
        if size < WINDOW and size not in short:
            fits &= lengths[owner[: len(fits)]] == size
        if not fits.any():
            continue
        for number, form in enumerate(forms):
            good = fits & (literal[number][size:] - literal[number][: len(fits)] >= min(LITERAL, size))
            if number:
                good &= changed[number][size:] > changed[number][: len(fits)]
            if not good.any():
                continue
            if size < WINDOW and not short:
                # Few texts are so short; no need to hash all others' windows.
                starts = np.flatnonzero(good)
                rolled = np.array([_rolled(hashed[number][at : at + size], size)[0] for at in starts], np.uint64)
            else:
                rolled = _rolled(hashed[number], size)
                if passes is not None:
                    good &= passes(rolled.view(np.int64))
                starts = np.flatnonzero(good)
                rolled = rolled[starts]
            if passes is not None and len(starts):
                through = passes(rolled.view(np.int64))
                starts, rolled = starts[through], rolled[through]
            for at, value in zip(starts.tolist(), rolled.view(np.int64).tolist(), strict=True):
                own = [(int(k), tokens[i].lower()) for k, i in zip(form[at : at + size], kept[at : at + size], strict=True)]
                template = " ".join(PLACEHOLDER.get(k, t) for k, t in own)
                text = int(owner[at])
                slots = [t for k, t in own if k in PLACEHOLDER]
                yield text, value, at - int(begin[text]), int(lengths[text]), template, slots


def template_windows(text: str, passes=None) -> list[tuple[int, int, int, str, list[str]]]:
    """``hash, at, words of the text, template, slot values`` of the windows of one text."""
    return [found[1:] for found in text_windows([text], passes)]


def windows(rows: DataFrame, id_column: str, passing=None, whole: bool = False, short: tuple[int, ...] = ()) -> DataFrame:
    """``COLUMNS`` of the windows of every text; ``passing`` is a broadcast of the filter's packed bits."""

    def compute(batches):
        import pyarrow as pa

        passes = in_filter(passing.value) if passing is not None else None
        for batch in slices(batches):
            out = [[] for _ in range(6)]
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for at in range(0, len(texts), TOGETHER):
                for text, *found in text_windows(texts[at : at + TOGETHER], passes, whole, short):
                    for column, value in zip(out, (ids[at + text], *found), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()))
            names = ("id", "hash", "at", "words", "template", "slots")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=list(names))

    selected = rows.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return selected.mapInArrow(compute, COLUMNS)


def _agreeing(kind: str) -> str:
    """SQL: whether the values of one type of slot go together, but for one in ``CONTRADICTIONS`` of their pairs.

    Different values of the item have different counterparts. Equal names and units have equal ones;
    equal numbers may be unrelated quantities.
    """
    of = f"filter(pairs, p -> p.types = '{kind}')"
    sides = ("slots",) if kind == PLACEHOLDER[NUMBER] else ("slots", "item_slots")
    return " and ".join(
        f"size(array_distinct(transform({of}, p -> p.{side}))) >= size({of}) - size({of}) div {CONTRADICTIONS}" for side in sides
    )


def leaks(docs: DataFrame, benchmark: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id, item_id, matched_words, item_words, exact`` of every document that leaks an item.

    ``exact`` tells whether all slot values are the item's own. ``docs`` has ``doc_id`` and ``text``,
    ``benchmark`` has ``item_id`` and ``text``. With ``whole``, items shorter than a window are also
    found inside longer documents, and windows full of placeholders where their values are equal.
    """
    context = docs.sparkSession.sparkContext
    items = windows(benchmark, "item_id", whole=whole)
    short = ()
    if whole:
        items = stored(items)
        short = tuple(r.words for r in items.filter(F.col("words") < WINDOW).select("words").distinct().collect())
    passing = context.broadcast(hash_filter(items, BITMAP))
    own = items.select(
        "hash",
        "template",
        F.col("id").alias("item_id"),
        F.col("at").alias("item_at"),
        F.col("words").alias("item_words"),
        F.col("slots").alias("item_slots"),
    )
    matched = windows(docs, "doc_id", passing, whole, short).join(own, ["hash", "template"])
    aligned = (
        matched.withColumn("shift", F.col("at") - F.col("item_at"))
        .withColumn("types", F.expr("regexp_extract_all(template, '<[a-z]+>', 0)"))
        .groupBy(F.col("id").alias("doc_id"), "item_id", "item_words", "shift")
        .agg(
            F.collect_set("item_at").alias("ats"),
            F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("types", "item_slots", "slots")))).alias("pairs"),
        )
        .filter(" and ".join(_agreeing(t) for t in PLACEHOLDER.values()))
    )
    # Alignments of one pair cover different words of the item: an inserted word shifts the rest.
    return (
        aligned.select(
            "doc_id",
            "item_id",
            "item_words",
            F.expr(f"flatten(transform(ats, a -> sequence(a, a + least({WINDOW}, item_words) - 1)))").alias("covered"),
            F.expr("forall(pairs, p -> p.item_slots = p.slots)").alias("same"),
        )
        .groupBy("doc_id", "item_id", "item_words")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("covered")))).alias("matched_words"),
            F.bool_and("same").alias("exact"),
        )
        .filter(F.col("matched_words") >= F.least(F.lit(MIN_WORDS), "item_words"))
        .select("doc_id", "item_id", "matched_words", "item_words", "exact")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that leak no item."""
    return others_aside(lambda own: _clean(own, benchmark), docs)


def _clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    tainted = leaks(docs, benchmark, whole=True).select(F.col("doc_id").alias("_tainted")).distinct()
    return docs.join(tainted, docs["doc_id"].cast("long").eqNullSafe(F.col("_tainted")), "left_anti")
