"""Greedy spacing of events: the first second of a key, then the first at least ``window`` later.

Which seconds count depends on all earlier ones, but only through one number, the earliest second
allowed next. A range of seconds is therefore a function from the allowed second on entry to the last
second it keeps: a rising step function, stored as rows ``(upto, exit)``, entries up to ``upto`` leave
with ``exit``. Functions of neighbouring ranges compose into one of the same kind, so

* every range of a key gets its steps from its own seconds;
* ``FAN_IN`` neighbouring ranges at a time are composed, level by level;
* the top blocks of a key are walked in order, with one number of state;
* entries are pushed down the same levels, until every range knows its own, and is walked by itself.

Only entries within ``window`` of a block's begin can occur, so a function has at most one step
for each of these seconds. All work is dealt by (key, block), so that a key with most of the rows is spread
like any other, and no list of a key's seconds exists anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Neighbouring blocks that are composed into one, and how often that is done.
FAN_IN = 128
LEVELS = 2
#: Seconds of a range, unless the window is longer.
SPAN = 1 << 18


def _whole_groups(batches, keys: int) -> Iterator:
    """Tables that hold every group of equal leading ``keys`` columns as a whole; batches come in order.

    Yields (table, number of the group of each row, counted from 0).
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def begins(table):
        """Whether a row begins a group."""
        first = np.zeros(table.num_rows, bool)
        first[:1] = True
        for name in table.schema.names[:keys]:
            column = table.column(name).combine_chunks()
            first[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        return first

    held: list = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if not begins(pa.concat_tables([last, table.slice(table.num_rows - 1)]))[1]:
                held.append(table)
                continue
        held.append(table)
        whole = pa.concat_tables(held)
        first = begins(whole)
        cut = int(np.flatnonzero(first)[-1])
        if cut:
            yield whole.slice(0, cut), np.cumsum(first[:cut]) - 1
        held = [whole.slice(cut)]
    if held:
        whole = pa.concat_tables(held)
        yield whole, np.cumsum(begins(whole)) - 1


def _followers(group, ts, origin, window: int, span: int):
    """For each second the index of the next one that may follow it in its group, or its own if none."""
    import numpy as np

    place = ts - origin + group * (span + window + 1)
    after = np.searchsorted(place, place + window)
    inside = np.minimum(after, len(ts) - 1)
    own = np.arange(len(ts))
    return np.where((after < len(ts)) & (group[inside] == group), inside, own)


def _last_of_runs(group, exits):
    """Rows after which the exit changes or the group ends."""
    import numpy as np

    return np.append((group[1:] != group[:-1]) | (exits[1:] != exits[:-1]), True)


def _range_steps(window: int, span: int):
    """Steps of every range from its seconds: ``id, _range, ts`` in, ``id, _range, upto, exit`` out."""

    def compute(batches):
        import numpy as np

        for table, group in _whole_groups(batches, 2):
            ts = table.column("ts").to_numpy()
            origin = table.column("_range").to_numpy() * span
            jump = _followers(group, ts, origin, window, span)
            while True:
                further = jump[jump]
                if np.array_equal(further, jump):
                    break
                jump = further
            exits = ts[jump]
            late = ts - origin >= window
            before = np.concatenate([[False], late[:-1] & (group[1:] == group[:-1])])
            starts = np.flatnonzero(~(late & before))  # all early seconds and the first late one
            kept = starts[_last_of_runs(group[starts], exits[starts])]
            yield from table.take(kept).drop_columns(["ts"]).append_column("upto", [ts[kept]]).append_column("exit", [exits[kept]]).to_batches()

    return compute


def _composed(children: list, begin: int, window: int):
    """One step function from those of neighbouring blocks in order, for entries below ``begin + window``."""
    import numpy as np

    upto, exits = children[0]
    for own_upto, own_exits in children[1:]:
        at = np.searchsorted(own_upto, exits + window)
        through = np.where(at < len(own_upto), own_exits[np.minimum(at, len(own_upto) - 1)], exits)
        if upto[-1] < begin + window:
            beyond = own_upto > upto[-1]
            upto, through = np.concatenate([upto, own_upto[beyond]]), np.concatenate([through, own_exits[beyond]])
        last = np.append(through[1:] != through[:-1], True)
        upto, exits = upto[last], through[last]
    needed = int(np.searchsorted(upto, begin + window)) + 1
    return upto[:needed], exits[:needed]


def _pieces(number) -> list[tuple[int, int]]:
    """Begin and end of each run of equal numbers."""
    import numpy as np

    edges = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _block_steps(window: int, width: int):
    """Steps of blocks from their children's: ``id, _block, _range, upto, exit`` in, without ``_range`` out.

    ``width`` is a block's seconds.
    """

    def compute(batches):
        import numpy as np
        import pyarrow as pa

        for table, group in _whole_groups(batches, 2):
            block, child, upto, exits = (table.column(n).to_numpy() for n in ("_block", "_range", "upto", "exit"))
            lone = np.ones(int(group[-1]) + 1, bool)
            lone[group[1:][(group[1:] == group[:-1]) & (child[1:] != child[:-1])]] = False
            names = table.select(["id", "_block"])
            alone = np.flatnonzero(lone[group])
            parts = [(alone, upto[alone], exits[alone])]
            many = np.flatnonzero(~lone[group])
            for low, high in _pieces(group[many]) if len(many) else []:
                rows = many[low:high]
                children = [(upto[rows[a:b]], exits[rows[a:b]]) for a, b in _pieces(child[rows])]
                own_upto, own_exits = _composed(children, int(block[rows[0]]) * width, window)
                parts.append((np.full(len(own_upto), rows[0]), own_upto, own_exits))
            for rows, own_upto, own_exits in parts:
                if len(rows):
                    out = names.take(pa.array(rows)).append_column("upto", [own_upto]).append_column("exit", [own_exits])
                    yield from out.to_batches()

    return compute


def _entries(window: int, keys: int):
    """The entry of every child from its block's: a block's row with a NULL child holds its own entry.

    In: ``id[, _block], _range, upto, exit`` with children in order. Out: ``id, _range, entry``.
    """

    def compute(batches):
        import numpy as np
        import pyarrow as pa

        for table, group in _whole_groups(batches, keys):
            child, upto, exits = (table.column(n) for n in ("_range", "upto", "exit"))
            known = child.is_valid().to_numpy()
            child = child.fill_null(0).to_numpy()
            upto, exits, entered = upto.fill_null(0).to_numpy(), exits.fill_null(0).to_numpy(), exits.is_valid().to_numpy()
            rows, found = [], []
            for low, high in _pieces(group):
                allowed = None
                if not known[low]:
                    allowed = int(exits[low]) if entered[low] else None
                    low += 1
                for a, b in _pieces(child[low:high]) if high > low else []:
                    a, b = a + low, b + low
                    rows.append(a)
                    found.append(allowed)
                    at = a if allowed is None else a + int(np.searchsorted(upto[a:b], allowed))
                    if at < b:
                        allowed = int(exits[at]) + window
            out = table.select(["id", "_range"]).take(pa.array(rows, pa.int64()))
            yield from out.append_column("entry", pa.array(found, pa.int64())).to_batches()

    return compute


def _kept(window: int, span: int):
    """The seconds that count: ``id, _range, ts, entry, first`` in, with the entry in the row without ``ts``."""

    def compute(batches):
        import numpy as np
        import pyarrow as pa

        for table, group in _whole_groups(batches, 2):
            real = np.flatnonzero(table.column("ts").is_valid().to_numpy())
            if not len(real):
                continue
            entry = table.column("entry").take(pa.array(np.flatnonzero(np.append(True, group[1:] != group[:-1]))))
            least = entry.fill_null(-(1 << 62)).to_numpy()
            own = table.take(pa.array(real)).drop_columns(["entry"])
            group, ts = group[real], own.column("ts").to_numpy()
            origin = own.column("_range").to_numpy() * span
            jump = _followers(group, ts, origin, window, span)
            allowed = ts >= least[group]
            # The first allowed second of each range begins its walk.
            earlier = np.concatenate([[False], allowed[:-1] & (group[1:] == group[:-1])])
            at = np.flatnonzero(allowed & ~earlier)
            kept = np.zeros(len(ts), bool)
            while len(at):
                kept[at] = True
                at = at[jump[at] != at]
                at = jump[at]
            yield from own.take(pa.array(np.flatnonzero(kept))).to_batches()

    return compute


def _dealt(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of equal ``keys`` in one task, in order."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def spaced(
    seconds: DataFrame, window: int, span: int | None = None, fan_in: int = FAN_IN, levels: int = LEVELS
) -> DataFrame:
    """Rows of ``seconds`` (``id``, ``ts`` bigint, ``first``; a second at most once per id, no NULL id or ts) that count.

    A range holds at most ``span`` seconds, ``window`` at least.
    """
    span = max(window, span or min(SPAN, 512 * window))
    key = seconds.schema["id"].dataType.simpleString()
    first = seconds.schema["first"].dataType.simpleString()
    cut = seconds.select("id", F.floor(F.col("ts") / F.lit(span)).cast("long").alias("_range"), "ts", "first")
    steps = _dealt(cut.select("id", "_range", "ts"), ["id", "_range"], ["ts"]).mapInArrow(
        _range_steps(window, span), f"id {key}, _range long, upto long, exit long"
    )
    built, width = [steps], span
    for _ in range(levels):
        width *= fan_in
        parents = built[-1].withColumn("_block", F.floor(F.col("_range") / F.lit(fan_in)).cast("long"))
        blocks = _dealt(parents.select("id", "_block", "_range", "upto", "exit"), ["id", "_block"], ["_range", "upto"]).mapInArrow(
            _block_steps(window, width), f"id {key}, _block long, upto long, exit long"
        )
        built.append(blocks.withColumnRenamed("_block", "_range"))
    entries = _dealt(built[-1], ["id"], ["_range", "upto"]).mapInArrow(_entries(window, 1), f"id {key}, _range long, entry long")
    for below in reversed(built[:-1]):
        nothing = F.lit(None).cast("long")
        children = below.select("id", F.floor(F.col("_range") / F.lit(fan_in)).cast("long").alias("_block"), "_range", "upto", "exit")
        own = entries.select("id", F.col("_range").alias("_block"), nothing.alias("_range"), nothing.alias("upto"), F.col("entry").alias("exit"))
        entries = _dealt(children.unionByName(own), ["id", "_block"], [F.asc_nulls_first("_range"), "upto"]).mapInArrow(
            _entries(window, 2), f"id {key}, _range long, entry long"
        )
    unknown = F.lit(None).cast("long")
    marked = cut.select("id", "_range", "ts", unknown.alias("entry"), "first").unionByName(
        entries.select("id", "_range", unknown.alias("ts"), "entry", F.lit(None).cast(first).alias("first"))
    )
    walked = _dealt(marked, ["id", "_range"], [F.asc_nulls_first("ts")]).mapInArrow(
        _kept(window, span), f"id {key}, _range long, ts long, first {first}"
    )
    return walked.select("id", "ts", "first")
