"""Best-fit packing by hierarchical residual rounds.

Each input partition cuts its documents into pieces and packs them best-fit decreasing. Bins that
are nearly full are final. The others become items of the next round, where the bins of
``FAN_IN`` neighbouring groups meet in one group and are packed best-fit again, as wholes.

A group that is packed leaves at most one bin that is half full or less, since two such would have become one. So
at most ``FAN_IN`` bins of a next round can still find room in others, and of the bins over half full a group
sends up no more than ``FAN_IN`` of each fill: more could never meet a partner and are final. Nothing is
lost by that, and however large the input is, a task holds at most ``FAN_IN`` bins of each fill from
each of ``FAN_IN`` groups.

Cases: a NULL or empty text is one piece that holds the end token alone. A row with a NULL
``doc_id`` is packed and returned under NULL. Repeated rows are packed once each. An empty table
gives an empty result. Other columns of ``docs`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import slices, stored
from revtide.llm.encoding import VOCABULARY, text_ids

CAPACITY = 2048
END_ID = 0
#: A bin with at most so many free places is final when it is first packed.
NEARLY_FULL = 16
FAN_IN = 16
#: Rounds after the local one.
ROUNDS = 3

PIECE = "doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint"
BINS = f"group_id long, bin_id long, fill int, done boolean, pieces array<struct<{PIECE}>>"


def _arrow_schema():
    import pyarrow as pa

    names = ("doc_id", "piece", "start", "length", "ids_crc32", "offset")
    piece = pa.struct([(n, pa.int32() if n == "piece" else pa.int64()) for n in names])
    return pa.schema(
        [("group_id", pa.int64()), ("bin_id", pa.int64()), ("fill", pa.int32()), ("done", pa.bool_()), ("pieces", pa.list_(piece))]
    )


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each item: items in descending length, each into the fullest bin it fits."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has r free places
    placed, made = [0] * len(lengths), 0
    for item in order:
        need = lengths[item]
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, target = capacity, made
            made += 1
        placed[item] = target
        left = room - need
        if not by_room[left]:
            rooms |= 1 << left
        by_room[left].append(target)
    return placed


def _pieces(doc_id, text: str | None, vocabulary: str, capacity: int) -> Iterator[dict]:
    ids = text_ids(vocabulary, text or "") + END_ID.to_bytes(4, "little")
    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at : at + 4 * capacity]
        yield {
            "doc_id": doc_id,
            "piece": number,
            "start": at // 4,
            "length": len(part) // 4,
            "ids_crc32": zlib.crc32(part),
        }


def _packed(group: int, level: int, items: list[tuple[int, list[dict]]], capacity: int) -> list[dict]:
    """Items, each a fill and its pieces, packed into bins of one group."""
    placed = best_fit([fill for fill, _ in items], capacity)
    bins: dict[int, dict] = {}
    for (fill, pieces), target in zip(items, placed, strict=True):
        own = bins.setdefault(
            target,
            {
                "group_id": group,
                "bin_id": ((group << 30) + target) * (ROUNDS + 1) + level,
                "fill": 0,
                "pieces": [],
            },
        )
        own["pieces"] += [{**p, "offset": p.get("offset", 0) + own["fill"]} for p in pieces]
        own["fill"] += fill
    sent: dict[int, int] = {}
    for own in bins.values():
        fill = own["fill"]
        sent[fill] = sent.get(fill, 0) + 1
        full = fill >= capacity - NEARLY_FULL or (2 * fill > capacity and sent[fill] > FAN_IN)
        own["done"] = full or level == ROUNDS
    return list(bins.values())


def _local_bins(vocabulary: str, capacity: int):
    def pack(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        schema = _arrow_schema()
        group = TaskContext.get().partitionId()
        items = []
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                items += [(p["length"], [p]) for p in _pieces(doc_id, text, vocabulary, capacity)]
        bins = _packed(group, 0, items, capacity)
        for at in range(0, len(bins), 2000):
            yield pa.RecordBatch.from_pylist(bins[at : at + 2000], schema=schema)

    return pack


def _merged_bins(level: int, capacity: int):
    def pack(key, batch):
        import pyarrow as pa

        rows = batch.sort_by("bin_id").to_pylist()
        items = [(r["fill"], r["pieces"]) for r in rows]
        return pa.Table.from_pylist(_packed(key[0].as_py(), level, items, capacity), schema=_arrow_schema())

    return pack


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``docs`` has ``doc_id`` and ``text``.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bins = stored(rows.mapInArrow(_local_bins(vocabulary, capacity), BINS))
    final, rest = bins.filter("done"), bins.filter("NOT done")
    for level in range(1, ROUNDS + 1):
        rest = rest.withColumn("group_id", F.floor(F.col("group_id") / FAN_IN).cast("long"))
        packed = stored(rest.groupBy("group_id").applyInArrow(_merged_bins(level, capacity), BINS))
        final, rest = final.unionByName(packed.filter("done")), packed.filter("NOT done")
    return final.select(F.col("bin_id").alias("sequence_id"), F.explode("pieces").alias("p")).select(
        "p.doc_id",
        "p.piece",
        "p.start",
        "p.length",
        "p.ids_crc32",
        "sequence_id",
        "p.offset",
    )
