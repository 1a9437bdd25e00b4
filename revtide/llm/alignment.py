"""Alignment of two tokenizers' tokens, with corpus-wide pair counts by external spill counting.

**Documents.** Each text is encoded by a byte-level BPE (side A, over a space and the text) and by a piece
model (side B, which adds the space). Both cut the same bytes; places where tokens of both sides end cut
the text into groups, and every stretch between two neighbouring ends, of whatever side, is one link,
an overlapping pair of tokens.

**Runs.** Tasks gather documents up to about ``RUN_LINKS`` links into a run. The run's
distinct (A id, B id, document) records are radix-partitioned by A id into ``RADIX`` parts, sorted by
pair, and written as zstd: a list of pairs with their numbers of documents, and beside it the
records. Only these runs are stored; no text and no link is shuffled.

**Counts.** For every part the pair lists of up to ``FAN_IN`` runs are merged by a k-way heap, frame by
frame, and equal pairs' counts added up; merged lists are merged again until one is left. It is in order of the
A id, so the last merge sees each id's pairs together and writes their highest count beside them. A list
never has more entries than its part has distinct pairs.

**Contributions.** Counts go back to ``RUNS_AT_ONCE`` runs of a part at a time, so a part that holds most records
(a comma's, say) is spread over tasks. Each gives sums per document, and a run's documents add up
their parts' sums.

Cases: texts that are NULL, empty or not given back by both sides' bytes have no tokens: zeros and an empty
``groups_sha256``. Every row is a document of its own, NULL and repeated ``doc_id`` included; a pair counts
once for each row that holds it. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import setting, slices, written

BYTES_SIDE, PIECES_SIDE = "byte_bpe_50k.json", "piece_bpe_32k.model"
RADIX = 64
#: Links of one run, and documents of it.
RUN_LINKS, RUN_DOCS = 2_000_000, 1 << 16
#: Texts that are encoded together: at most so many, of about so many characters.
BATCH_DOCS, BATCH_CHARS = 256, 1 << 20
FAN_IN, RUNS_AT_ONCE = 32, 32
#: Entries of one zstd frame.
FRAME = 1 << 15

DOCUMENTS = "array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>"
RUNS = f"run long, radix int, pairs binary, records binary, documents {DOCUMENTS}"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

#: Texts of these characters are split alike by both libraries that know side A's vocabulary.
PLAIN = re.compile("[\t\n\r -~\xa0-ɏ]*")


@lru_cache(maxsize=1)
def _byte_side(name: str):
    """(encode, bytes of each id): the file's own library, and a faster one with the same vocabulary for plain texts."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    table = _entry_bytes(library)
    special = {t.content for t in library.get_added_tokens_decoder().values()}
    ranks = {table[i]: i for entry, i in library.get_vocab(with_added_tokens=False).items() if entry not in special}
    fast = tiktoken.Encoding("side_a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if PLAIN.fullmatch(text):
            return fast.encode_ordinary(text)
        return library.encode(text, add_special_tokens=False).ids

    return encode, table


def _entry_bytes(library) -> list[bytes]:
    """Each id's bytes: the entry's characters stand for bytes, printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}
    entries = sorted((i, entry) for entry, i in library.get_vocab(with_added_tokens=True).items())
    return [bytes(byte[c] for c in entry) for _, entry in entries]


@lru_cache(maxsize=1)
def _piece_side(name: str):
    """(encode, bytes of each id)."""
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    table = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
    return library.encode, table


@lru_cache(maxsize=1)
def _tables(a: str, b: str):
    """Lengths of both sides' tokens, and each id's digits with the separators that may follow it."""
    import numpy as np

    sides = [_byte_side(a)[1], _piece_side(b)[1]]
    lengths = [np.array([len(t) for t in table], np.int64) for table in sides]
    most = max(map(len, sides))
    digits = [f"{i}{mark}" for mark in ("", ",", "|", ";") for i in range(most)]
    return (*lengths, digits, most)


class Encoded:
    """Both sides' tokens of some texts one after the other, and what follows from them."""

    def __init__(self, texts: list[str | None], a: str, b: str):
        import numpy as np

        encode_a, bytes_a = _byte_side(a)
        encode_b, bytes_b = _piece_side(b)
        len_a, len_b, digits, most = _tables(a, b)
        first, second = [], []
        for text in texts:
            own, pieces = [], []
            if text:
                whole = " " + text
                raw, own, pieces = whole.encode(), encode_a(whole), encode_b(text)
                if b"".join([bytes_a[i] for i in own]) != raw or b"".join([bytes_b[i] for i in pieces]) != raw:
                    own, pieces = [], []
            # An array holds a text's ids in a tenth of what a list takes.
            first.append(np.array(own, np.int32))
            second.append(np.array(pieces, np.int32))
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (first, second))
        ids_a, ids_b = (np.concatenate(side).astype(np.int64) for side in (first, second))
        del first, second
        ends_a, ends_b = np.cumsum(len_a[ids_a]), np.cumsum(len_b[ids_b])
        # Each stretch ends where a token of either side does; documents end on both sides.
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        shared_a = np.isin(ends_a, ends_b, assume_unique=True)
        shared_b = np.isin(ends_b, ends_a, assume_unique=True)
        doc_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(doc_a[shared_a], minlength=len(texts))
        self.doc = doc_a[at_a]
        self.n_links = np.bincount(self.doc, minlength=len(texts))
        self.pair = ids_a[at_a] << 16 | ids_b[at_b]
        del ends, ends_a, ends_b, at_a, at_b, doc_a
        # The groups' text: A ids, B ids, group after group.
        group_a = np.cumsum(shared_a) - shared_a
        group_b = np.cumsum(shared_b) - shared_b
        n = len(group_a) and int(group_a[-1]) + 1
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n))])
        before_a = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=n))])
        codes = np.empty(len(ids_a) + len(ids_b), np.int32)
        last_b = np.zeros(len(ids_b), bool)
        last_b[np.cumsum(self.n_b)[self.n_b > 0] - 1] = True
        codes[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + most * np.where(shared_a, 2, 1)
        codes[np.arange(len(ids_b)) + before_a[group_b + 1]] = ids_b + most * np.where(last_b, 0, np.where(shared_b, 3, 1))
        self.codes, self.digits = codes, digits

    def groups(self):
        """Each document's groups as text, one document at a time."""
        at = 0
        for size in (self.n_a + self.n_b).tolist():
            yield "".join([self.digits[c] for c in self.codes[at : at + size].tolist()])
            at += size


def _frames(*columns) -> bytes:
    """Columns of equal length as zstd frames of ``FRAME`` entries, each behind its size."""
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=3)
    out = []
    for at in range(0, len(columns[0]), FRAME):
        part = [c[at : at + FRAME] for c in columns]
        frame = zip_.compress(b"".join(c.tobytes() for c in part))
        out.append(len(frame).to_bytes(4, "little") + len(part[0]).to_bytes(4, "little") + frame)
    return b"".join(out)


def _unframed(data: bytes, kinds: tuple[str, ...]):
    """The frames' columns, one frame at a time."""
    import numpy as np
    import zstandard

    unzip, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        size, rows = (int.from_bytes(data[at + k : at + k + 4], "little") for k in (0, 4))
        raw, place, columns = unzip.decompress(data[at + 8 : at + 8 + size]), 0, []
        for kind in kinds:
            width = np.dtype(kind).itemsize * rows
            columns.append(np.frombuffer(raw[place : place + width], kind))
            place += width
        yield columns
        at += 8 + size


#: Entries of pair lists, merged lists (with the A id's highest count) and records.
PAIR = ("<u4", "<i8")
BEST = ("<u4", "<i8", "<i8")
RECORD = ("<u4", "<u4", "<u4")


def _radix(pairs):
    return (pairs >> 16) % RADIX


class Run:
    """Documents and distinct (pair, document, links) records gathered so far.

    A record is one number, its part, pair and document in this order of bits, beside its links.
    """

    def __init__(self):
        self.parts, self.documents, self.links = [], [], 0

    def add(self, ids: list, encoded: Encoded) -> None:
        import numpy as np

        base = len(self.documents)
        keys, links = np.unique(encoded.pair << 20 | encoded.doc, return_counts=True)
        self.parts.append((_radix(keys >> 20) << 52 | (keys + base), links.astype("<u4")))
        self.links += len(encoded.pair)
        counts = (encoded.n_a, encoded.n_b, encoded.n_groups, encoded.n_links)
        for doc_id, text, *numbers in zip(ids, encoded.groups(), *(c.tolist() for c in counts), strict=True):
            digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
            self.documents.append((doc_id, *numbers, digest))

    def rows(self, run: int):
        """The run's rows; its records are gone after it."""
        import numpy as np
        import pyarrow as pa

        names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        keys, links = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(keys)
        keys, links = keys[order], links[order]
        del order
        cuts = np.searchsorted(keys, np.arange(RADIX + 1) << 52)
        rows = []
        for radix in range(RADIX):
            own = slice(cuts[radix], cuts[radix + 1])
            pairs, docs = (keys[own] >> 20).astype("<u4"), (keys[own] & 0xFFFFF).astype("<u4")
            distinct, counts = np.unique(pairs, return_counts=True)
            if len(distinct):
                listed = _frames(distinct, counts.astype("<i8"))
                rows.append({"run": run, "radix": radix, "pairs": listed, "records": _frames(pairs, docs, links[own])})
        rows.append({"run": run, "documents": [dict(zip(names, d, strict=True)) for d in self.documents]})
        yield from pa.Table.from_pylist(rows, schema=_schema()).to_batches()


def _schema():
    import pyarrow as pa

    number = pa.int64()
    fields = [(n, number) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    document = pa.struct([*fields, ("groups_sha256", pa.string())])
    return pa.schema(
        [("run", number), ("radix", pa.int32()), ("pairs", pa.binary()), ("records", pa.binary()), ("documents", pa.list_(document))]
    )


def encode_runs(docs: DataFrame, a: str = BYTES_SIDE, b: str = PIECES_SIDE) -> DataFrame:
    """The stored runs: a row for each (run, radix part), and one with the run's documents."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def compute(batches):
        from pyspark import TaskContext

        number, run = TaskContext.get().partitionId() << 32, Run()
        for batch in slices(batches, BATCH_DOCS):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                end, chars = at, 0
                while end < len(ids) and (end == at or chars < BATCH_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                run.add(ids[at:end], Encoded(texts[at:end], a, b))
                at = end
                if run.links >= RUN_LINKS or len(run.documents) >= RUN_DOCS:
                    yield from run.rows(number)
                    number, run = number + 1, Run()
        if run.documents:
            yield from run.rows(number)

    # A task and its worker hold one batch of texts each, and need not hold more than are encoded together.
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_DOCS)):
        return written(rows.mapInArrow(compute, RUNS), "alignment-runs")


def merged(lists: list[bytes]):
    """(pair, count) in order of the pair, counts of equal pairs added up, by a heap over the lists' frames."""

    def entries(data):
        for pairs, counts in _unframed(data, PAIR):
            yield from zip(pairs.tolist(), counts.tolist(), strict=True)

    last, total = -1, 0
    for pair, count in heapq.merge(*map(entries, lists)):
        if pair != last:
            if total:
                yield last, total
            last, total = pair, 0
        total += count
    if total:
        yield last, total


def _columns(entries) -> list:
    import numpy as np

    flat = np.fromiter((x for entry in entries for x in entry), np.int64)
    return [flat[::2], flat[1::2]]


def with_best(pairs, counts):
    """The highest count among each A id's pairs, beside each of them; ``pairs`` is in order."""
    import numpy as np

    ids = pairs >> 16
    opens = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    if not len(opens):
        return counts
    return np.repeat(np.maximum.reduceat(counts, opens), np.diff(np.append(opens, len(ids))))


def _dealt(name: str, groups: int, seed: int):
    """Which of ``groups`` a run or list belongs to."""
    return F.pmod(F.xxhash64(name, F.lit(seed)), F.lit(groups)).cast("long")


def pair_counts(runs: DataFrame, many: int) -> DataFrame:
    """``radix, counts``: one list for each radix part, of all its pairs, counts and A ids' highest counts.

    ``many`` is the number of runs. A merge takes about ``FAN_IN`` lists.
    """

    def merge(key, table):
        import pyarrow as pa

        pairs, counts = _columns(merged(table.column("pairs").to_pylist()))
        data = _frames(pairs.astype("<u4"), counts.astype("<i8"))
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "run": [key[1].as_py()], "pairs": [data]})

    def finish(key, table):
        import pyarrow as pa

        pairs, counts = _columns(merged(table.column("pairs").to_pylist()))
        data = _frames(pairs.astype("<u4"), counts.astype("<i8"), with_best(pairs, counts).astype("<i8"))
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "counts": [data]})

    lists, level = runs.filter("radix IS NOT NULL").select("radix", "run", "pairs"), 0
    while many > FAN_IN:
        many, level = -(-many // FAN_IN), level + 1
        groups = lists.withColumn("run", _dealt("run", many, level)).groupBy("radix", "run")
        lists = groups.applyInArrow(merge, "radix int, run long, pairs binary")
    return lists.groupBy("radix").applyInArrow(finish, "radix int, counts binary")


def _contributions(runs: DataFrame, counts: DataFrame, many: int) -> DataFrame:
    """``run, sums``: for each run and part, n_best and count_sum of the run's documents."""

    def add(records, counted):
        import numpy as np
        import pyarrow as pa

        lists = [c for data in counted.column("counts").to_pylist() for c in _unframed(data, BEST)]
        pairs, counts, best = (np.concatenate(c) for c in zip(*lists, strict=True))
        out: dict[str, list] = {"run": records.column("run").to_pylist(), "sums": []}
        for data in records.column("records").to_pylist():
            frames = list(_unframed(data, RECORD))
            # A run's last batch may bring it past RUN_DOCS documents.
            top = max(int(docs.max()) for _, docs, _ in frames) + 1
            n_best, count_sum = np.zeros(top, np.int64), np.zeros(top, np.int64)
            for own, docs, links in frames:
                at = np.searchsorted(pairs, own)
                links = links.astype(np.int64)
                np.add.at(n_best, docs, links * (counts[at] == best[at]))
                np.add.at(count_sum, docs, links * counts[at])
            out["sums"].append(_frames(n_best, count_sum))
        return pa.table({"run": pa.array(out["run"], pa.int64()), "sums": pa.array(out["sums"], pa.binary())})

    groups = -(-many // RUNS_AT_ONCE)
    records = runs.filter("radix IS NOT NULL").select("run", "radix", "records", _dealt("run", groups, 0).alias("chunk"))
    spread = counts.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return records.groupBy("radix", "chunk").cogroup(spread.groupBy("radix", "chunk")).applyInArrow(add, "run long, sums binary")


def _finished(runs: DataFrame, sums: DataFrame) -> DataFrame:
    """Every document of a run with its parts' sums added up."""

    def add(documents, sums):
        import numpy as np
        import pyarrow as pa

        listed = documents.column("documents").combine_chunks().flatten()
        best, total = np.zeros(len(listed), np.int64), np.zeros(len(listed), np.int64)
        for data in sums.column("sums").to_pylist():
            at = 0
            for n_best, count_sum in _unframed(data, ("<i8", "<i8")):
                best[at : at + len(n_best)] += n_best
                total[at : at + len(n_best)] += count_sum
                at += len(n_best)
        columns = {name: listed.field(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        columns |= {"n_best": pa.array(best), "count_sum": pa.array(total), "groups_sha256": listed.field("groups_sha256")}
        return pa.table(columns)

    documents = runs.filter("radix IS NULL").select("run", "documents")
    return documents.groupBy("run").cogroup(sums.groupBy("run")).applyInArrow(add, ALIGNED)


def align(docs: DataFrame, a: str = BYTES_SIDE, b: str = PIECES_SIDE) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs`` (``doc_id``, ``text``)."""
    runs = encode_runs(docs, a, b)
    many = runs.filter("radix IS NULL").count()
    return _finished(runs, _contributions(runs, pair_counts(runs, many), max(many, 1)))
