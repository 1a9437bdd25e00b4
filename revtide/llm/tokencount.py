"""Token counts by a map-side two-tier lookup.

Tier one is a table of the frequent pre-tokens' lengths that every task gets as a broadcast: the
``FREQUENT`` commonest words of the whole table, found by one partially aggregated sketch of fixed
size. Tier two is a memory of the Python worker for the words that the table lacks; each is
encoded once by the library itself. No pre-token is ever shuffled, and neither tier decides a
count: they hold what the library gave.

Cases: a NULL text counts as empty (0 bytes, 0 tokens). NULL ``doc_id`` and repeated rows are
returned as they are, one row for each input row. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import slices
from revtide.llm.encoding import CACHE, ENDS, OTHER, VOCABULARY, letter_ids, whole_ids

#: Entries of the broadcast table, a fixed bound.
FREQUENT = 16_384
#: Words that a sketch follows.
TRACKED = 32_768
#: Sketches that are merged at once, and how often that is done before the last merge.
FAN_IN, LEVELS = 32, 2

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def frequent_words(docs: DataFrame) -> list[str]:
    """The commonest words of all texts, at most ``FREQUENT``; their counts are approximate.

    The tasks' sketches are merged ``FAN_IN`` at a time, so no task reads those of all others.
    """
    words = docs.select(
        F.explode(F.split(F.lower("text"), r"\s+")).alias("word"),
        F.floor(F.spark_partition_id() / FAN_IN).alias("part"),
    )
    sketches = words.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(word, {TRACKED})").alias("s"))
    for _ in range(LEVELS):
        sketches = sketches.groupBy(F.floor(F.col("part") / FAN_IN).alias("part")).agg(
            F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s")
        )
    # Grouped by a constant: without rows there is no group, and nothing to merge.
    top = sketches.groupBy(F.lit(0).alias("part")).agg(F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s")).select(
        F.expr(f"approx_top_k_estimate(s, {FREQUENT})").alias("top")
    )
    row = top.select(F.expr("transform(top, t -> t.item)").alias("words")).first()
    return [w for w in ((row and row.words) or []) if w]


class WordLengths(dict):
    """Word -> number of tokens, over the broadcast table."""

    def __init__(self, vocabulary: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.vocabulary, self.frequent = vocabulary, frequent

    def __missing__(self, word: str) -> int:
        stem, mark = word[:-1], word[-1]
        if mark in ENDS and stem.isalpha():
            seen = stem in self
            value = self[stem] + self[mark]
            if not seen:
                return value
        elif word.isalpha():
            value = len(letter_ids(self.vocabulary, word))
        else:
            value = len(whole_ids(self.vocabulary, word))
        if len(self) >= CACHE:
            self.clear()
            self.update(self.frequent)
        self[word] = value
        return value


_LENGTHS: dict[tuple[str, str], WordLengths] = {}


def _lengths(vocabulary: str, name: str, frequent: dict[str, int]) -> WordLengths:
    """The worker's memory for this table; an earlier table's is let go."""
    if (vocabulary, name) not in _LENGTHS:
        _LENGTHS.clear()
        _LENGTHS[vocabulary, name] = WordLengths(vocabulary, frequent)
    return _LENGTHS[vocabulary, name]


def text_tokens(lengths: WordLengths, text: str) -> int:
    if OTHER.search(text):
        return len(whole_ids(lengths.vocabulary, text))
    return sum(map(lengths.__getitem__, text.lower().split()))


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (``doc_id``, ``text``)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    frequent = {w: len(whole_ids(vocabulary, w)) for w in frequent_words(rows) if not OTHER.search(w)}
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    name = uuid.uuid4().hex

    def count(batches):
        import pyarrow as pa

        lengths = _lengths(vocabulary, name, table.value)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [text_tokens(lengths, t) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_tokens": pa.array(tokens, pa.int64()),
                    "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
                }
            )

    return rows.mapInArrow(count, COUNTS)
