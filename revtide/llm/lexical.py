"""Ranked lexical search over a stored index of compressed blocks, by Block-Max MaxScore.

**Index.** Every input task cuts its rows into segments of at most ``SEGMENT_ROWS`` documents and
about ``SEGMENT_TERMS`` terms and writes, for every term of a segment, one posting list: documents by
ascending id, in blocks of ``BLOCK`` postings, each block a run of variable-length numbers (gaps and
frequencies). A block also keeps its last document and its *impacts*: the (frequency, length) pairs
that no other pair of the block beats on both counts. From them a search gets the exact largest
score of a block for any corpus statistics. No text is shuffled and every document is indexed.

**Search.** Corpus statistics and document frequencies are sums over the stored lists. The lists of the
queries' terms meet by segment. A segment answers one query after the other: a term's largest score in
the segment is its global bound; lists by ascending bound whose sum stays below the 50th best score
so far are non-essential. Documents come from the other, essential lists, window by window. A
document is rejected by the sum of the global bounds, then by the non-essential lists' block maxima,
and only what is left has those blocks decompressed, list by list, with the bounds of the rest. Each
segment's heap of best documents goes to a merge by query. Bounds reject only what is strictly
below the heap's last score, so the result is exact.

Queries go to the tasks in chunks of at most ``QUERIES`` items and ``QUERY_BYTES`` bytes of distinct terms.

Cases: NULL, empty and termless texts hold no terms, are not counted and never ranked; items without
terms have no rows. Rows of one ``item_id`` (NULL too) form one item with the terms of all. Every
document row is ranked by itself; a NULL ``doc_id`` comes after all others at equal scores. Equal
rows of one ``doc_id`` keep an arbitrary order among themselves. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import slices, written

SEGMENT_ROWS = 16_384
SEGMENT_TERMS = 1_500_000
BLOCK = 128
#: Documents of a segment that are scored at once.
WINDOW = 2048
#: Items, and bytes of distinct terms, of one chunk of queries.
QUERIES, QUERY_BYTES = 2000, 4_000_000

INDEX = (
    "segment long, term binary, df int, postings binary, ends binary, lasts binary, "
    "tops binary, impact_tf binary, impact_n binary"
)
HITS = "item_id long, doc_id long, score long"

#: Every ASCII character that is no digit or letter parts terms; A-Z are lower-cased.
_SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return (text or "").encode().translate(_SPLIT).split()


def pack_numbers(values):
    """(bytes, end of each number's bytes): seven bits a byte, the low ones first, the last byte below 128."""
    import numpy as np

    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 5):
        size += values >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - size
    for k in range(5):
        own = size > k
        part = (values[own] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[own] + k] = part + np.where(size[own] > k + 1, 128, 0).astype(np.uint64)
    return out, ends


def unpack_numbers(packed):
    """The numbers of one block."""
    import numpy as np

    last = packed < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(packed)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((packed & 127).astype(np.int64) << (7 * place), starts)


def _segment_rows(segment: int, ids: list, found: list, vocabulary: dict):
    """One Arrow batch: the posting lists of a segment, and its documents in a row without a term."""
    import numpy as np
    import pyarrow as pa

    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    known = np.array([ids[i] is not None for i in order], np.uint8)
    numbers = np.array([ids[i] or 0 for i in order], np.int64)
    lengths = np.array([len(found[i]) for i in order], np.int64)
    words = np.concatenate([found[i] for i in order]).astype(np.int64)
    # One number for each (term, document), sorted; the repeats are the frequencies.
    pairs, tf = np.unique(words << 32 | np.repeat(np.arange(len(order)), lengths), return_counts=True)
    term, doc = pairs >> 32, pairs & 0xFFFFFFFF
    n = lengths[doc]
    starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    df = np.diff(np.append(starts, len(term)))
    rank = np.arange(len(term)) - np.repeat(starts, df)
    opens = rank % BLOCK == 0
    block = np.cumsum(opens) - 1
    heads = np.flatnonzero(opens)
    gaps = np.where(opens, doc, doc - np.concatenate([[0], doc[:-1]]))
    packed, ends = pack_numbers(np.column_stack([gaps, tf]).ravel())
    closes = np.append(heads[1:], len(term)) - 1
    block_ends = ends[2 * closes + 1]
    first = block[starts]  # each term's first block
    blocks = np.diff(np.append(first, len(heads)))
    bytes_before = np.concatenate([[0], block_ends])[first]
    relative = block_ends - np.repeat(bytes_before, blocks)
    # Impacts: by falling frequency, those shorter than all before them in the block.
    by = np.lexsort((n, -tf, block))
    falling = n[by] - block[by] * (1 << 40)
    least = np.minimum.accumulate(falling)
    kept = np.concatenate([[True], falling[1:] < least[:-1]])
    impact = by[kept]
    tops = np.cumsum(np.bincount(block[impact], minlength=len(heads)))
    tops_before = np.concatenate([[0], tops])[first]
    tops_relative = tops - np.repeat(tops_before, blocks)

    def cut(values, kind, offsets):
        data = np.ascontiguousarray(values.astype(kind))
        places = (offsets * data.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data.tobytes())])

    by_block = np.append(first, len(heads))
    by_impact = np.append(tops_before, len(impact))
    names = list(vocabulary)
    lists = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(starts), segment)),
            pa.array([names[t] for t in term[starts].tolist()], pa.binary()),
            pa.array(df.astype(np.int32)),
            cut(packed, np.uint8, np.append(bytes_before, len(packed))),
            cut(relative, np.uint32, by_block),
            cut(doc[closes], np.uint32, by_block),
            cut(tops_relative, np.uint32, by_block),
            cut(tf[impact], np.uint32, by_impact),
            cut(n[impact], np.uint32, by_impact),
        ],
        names=[c.split()[0] for c in INDEX.split(", ")],
    )
    empty = pa.array([b""], pa.binary())
    documents = pa.RecordBatch.from_arrays(
        [
            pa.array([segment]),
            pa.array([None], pa.binary()),
            pa.array([len(order)], pa.int32()),
            pa.array([numbers.tobytes()], pa.binary()),
            pa.array([known.tobytes()], pa.binary()),
            pa.array([lengths.astype(np.uint32).tobytes()], pa.binary()),
            empty,
            empty,
            empty,
        ],
        names=lists.schema.names,
    )
    for at in range(0, lists.num_rows, 4096):
        yield lists.slice(at, 4096)
    yield documents


class Index(NamedTuple):
    """``lists`` has a row for each (segment, term) and, with a NULL term, for each segment's documents."""

    lists: DataFrame


def build_index(docs: DataFrame) -> Index:
    """Index every row of ``docs`` (``doc_id``, ``text``) and store the lists in the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def compute(batches):
        import numpy as np
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        count, ids, found, total = 0, [], [], 0
        vocabulary: dict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        for batch in slices(batches, 64):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                ids.append(doc_id)
                found.append(np.fromiter(map(vocabulary.__getitem__, terms), np.int32, len(terms)))
                total += len(terms)
                if total >= SEGMENT_TERMS or len(ids) >= SEGMENT_ROWS:
                    yield from _segment_rows(base + count, ids, found, vocabulary)
                    count, ids, found, total = count + 1, [], [], 0
                    vocabulary.clear()
        if ids:
            yield from _segment_rows(base + count, ids, found, vocabulary)

    return Index(written(rows.mapInArrow(compute, INDEX), "lexical"))


class Statistics(NamedTuple):
    """``documents`` with at least one term, and all their terms."""

    documents: int
    terms: int


def statistics(index: Index) -> Statistics:
    """Sums over the segments' document rows."""

    def add(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            totals = [int(np.frombuffer(b, np.uint32).sum(dtype=np.int64)) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"n": batch.column(0).cast(pa.int64()), "l": pa.array(totals, pa.int64())})

    rows = index.lists.filter("term IS NULL").select("df", "lasts").mapInArrow(add, "n long, l long")
    sums = rows.agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return Statistics(sums.n or 0, sums.l or 0)


class Lists:
    """One segment's lists of the queries' terms, for given corpus statistics."""

    def __init__(self, batch, corpus: Statistics):
        import numpy as np

        self.corpus, self.rows, self.opened = corpus, {}, {}
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for at, term in enumerate(columns["term"]):
            own = {name: values[at] for name, values in columns.items()}
            if term is None:
                self.ids = np.frombuffer(own["postings"], np.int64)
                self.known = np.frombuffer(own["ends"], np.uint8)
                self.lengths = np.frombuffer(own["lasts"], np.uint32).astype(np.int64)
                self.m = self.shift(self.lengths)
                continue
            tops = np.frombuffer(own["tops"], np.uint32).astype(np.int64)
            parts = self.part(
                np.frombuffer(own["impact_tf"], np.uint32).astype(np.int64),
                self.shift(np.frombuffer(own["impact_n"], np.uint32).astype(np.int64)),
            )
            most = np.maximum.reduceat(parts, np.concatenate([[0], tops[:-1]]))
            self.rows[term] = (
                np.frombuffer(own["postings"], np.uint8),
                np.concatenate([[0], np.frombuffer(own["ends"], np.uint32).astype(np.int64)]),
                np.frombuffer(own["lasts"], np.uint32).astype(np.int64),
                most,
                int(most.max()),
            )

    def shift(self, n):
        """A document's m."""
        return 100 - 50 + (50 * n * self.corpus.documents) // self.corpus.terms

    @staticmethod
    def part(tf, m):
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)

    def open(self, term: bytes, block: int):
        """(documents, parts of the score) of one block; opened once for all queries of the segment."""
        import numpy as np

        if (term, block) not in self.opened:
            packed, ends = self.rows[term][:2]
            numbers = unpack_numbers(packed[ends[block] : ends[block + 1]])
            docs = np.cumsum(numbers[::2])
            self.opened[term, block] = docs, self.part(numbers[1::2], self.m[docs])
        return self.opened[term, block]


def best_of_segment(lists: Lists, query: dict[bytes, int], k: int) -> list[tuple[int, int]]:
    """The segment's ``k`` best (score, document) for ``query``, term -> weight, by Block-Max MaxScore."""
    import numpy as np

    own = sorted(((w * lists.rows[t][4], t, w) for t, w in query.items() if w > 0 and t in lists.rows))
    if not own:
        return []
    bounds = np.cumsum([b for b, _, _ in own])
    heap: list[tuple[int, int]] = []  # (score, -document): at equal scores the later document goes first
    for low in range(0, len(lists.ids), WINDOW):
        high = min(low + WINDOW, len(lists.ids))
        least = heap[0][0] if len(heap) == k else 1
        first = int(np.searchsorted(bounds, least))  # lists before it cannot reach ``least`` together
        if first == len(own):
            break  # nothing can any more
        sums = np.zeros(high - low, np.int64)
        for _, term, weight in own[first:]:
            lasts = lists.rows[term][2]
            for block in range(int(np.searchsorted(lasts, low)), len(lasts)):
                docs, parts = lists.open(term, block)
                if docs[0] >= high:
                    break
                a, b = np.searchsorted(docs, (low, high))
                sums[docs[a:b] - low] += weight * parts[a:b]
        rest = int(bounds[first - 1]) if first else 0
        docs = np.flatnonzero(sums + rest >= least)
        docs = docs[sums[docs] > 0]
        scores, docs = sums[docs], docs + low
        if first and len(docs):
            # What each non-essential list can add to each document at most, by its block.
            blocks, caps = [], []
            for _, term, weight in own[:first]:
                lasts, most = lists.rows[term][2:4]
                at = np.searchsorted(lasts, docs)
                blocks.append(at)
                caps.append(np.where(at < len(lasts), weight * most[np.minimum(at, len(lasts) - 1)], 0))
            ahead = np.cumsum(caps, axis=0)
            alive = np.arange(len(docs))
            for j in range(first - 1, -1, -1):
                alive = alive[scores[alive] + ahead[j][alive] >= least]
                _, term, weight = own[j]
                at = blocks[j][alive]
                for block in np.unique(at[at < len(lists.rows[term][2])]).tolist():
                    members, parts = lists.open(term, block)
                    mine = alive[at == block]
                    place = np.minimum(np.searchsorted(members, docs[mine]), len(members) - 1)
                    hit = members[place] == docs[mine]
                    scores[mine[hit]] += weight * parts[place[hit]]
            alive = alive[scores[alive] >= least]
            scores, docs = scores[alive], docs[alive]
        if len(scores) > k:
            chosen = np.lexsort((docs, -scores))[:k]
            scores, docs = scores[chosen], docs[chosen]
        for score, doc in zip(scores.tolist(), docs.tolist(), strict=True):
            if len(heap) < k:
                heapq.heappush(heap, (score, -doc))
            elif (score, -doc) > heap[0]:
                heapq.heapreplace(heap, (score, -doc))
    return [(score, -doc) for score, doc in heap]


def _chunks(queries: DataFrame) -> Iterator[dict]:
    """Item -> its distinct terms, a bounded number of items at a time."""
    items = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chunk: dict = {}
    size, last = 0, None
    for row in items.orderBy("item_id").toLocalIterator():
        if chunk and row.item_id != last and (len(chunk) >= QUERIES or size >= QUERY_BYTES):
            yield chunk
            chunk, size = {}, 0
        last = row.item_id
        fresh = set(terms_of(row.text)) - chunk.get(last, set())
        if fresh:
            chunk.setdefault(last, set()).update(fresh)
            size += sum(map(len, fresh))
    if chunk:
        yield chunk


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _hits(index: Index, chunk: dict, corpus: Statistics, k: int) -> DataFrame:
    """Every segment's best documents for the items of one chunk."""
    context = index.lists.sparkSession.sparkContext
    asked = context.broadcast(frozenset().union(*chunk.values()))

    def asked_lists(batches):
        import pyarrow as pa

        for batch in batches:
            own = [t is None or t in asked.value for t in batch.column(1).to_pylist()]
            yield batch.filter(pa.array(own, pa.bool_()))

    lists = index.lists.mapInArrow(asked_lists, INDEX)
    found = index.lists.select("segment", "term", "df").mapInArrow(asked_lists, "segment long, term binary, df int")
    # At most one row for each term of the chunk.
    df = {bytes(r.term): r.df for r in found.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()}
    weights = {item: {t: weight(corpus.documents, df[t]) for t in terms if t in df} for item, terms in chunk.items()}
    shared = context.broadcast(weights)

    def search(table):
        import pyarrow as pa

        # A segment is bounded when it is built, and so is what a search reads of it.
        segment = Lists(table.combine_chunks(), corpus)
        rows: dict[str, list] = {"item_id": [], "doc_id": [], "score": []}
        for item, query in shared.value.items():
            for score, doc in best_of_segment(segment, query, k):
                rows["item_id"].append(item)
                rows["doc_id"].append(int(segment.ids[doc]) if segment.known[doc] else None)
                rows["score"].append(score)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in rows.items()})

    return lists.groupBy("segment").applyInArrow(search, HITS)


def search(index: Index, queries: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item of ``queries`` (``item_id``, ``text``)."""
    corpus = statistics(index)
    parts = [_hits(index, chunk, corpus, k) for chunk in _chunks(queries)] if corpus.documents else []
    spark = index.lists.sparkSession
    hits = parts[0] if parts else spark.createDataFrame([], HITS)
    for part in parts[1:]:
        hits = hits.unionAll(part)
    # The planner keeps the best rows of each item in every task before they are shuffled.
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
