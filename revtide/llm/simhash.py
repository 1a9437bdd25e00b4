"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a vector of three bits. Each of the seven other combinations of those
three bits is a table, whose mask keeps the positions whose vector has an odd product with it.
Two differing positions put at most two linear conditions on three bits, so some combination is
zero on both, and its mask covers neither: each pair within two bits falls into one bucket of
some table. No list of candidates is sampled or cut.

Buckets of three or more are not paired out. A fingerprint in one emits itself and its neighbours
over the positions that its buckets leave open; fingerprints that meet in one neighbour are at
most two bits apart, and any two at most two bits apart meet in one. Each such meeting is tied to
its least member, so a group of n copies costs n links.

Two operators use it. ``fingerprint_components`` links whole texts' fingerprints.
``near_duplicate_groups`` finds texts whose word shingles are similar: texts whose fingerprints link
are checked first, and settle most of a large class. A whole-text fingerprint moves by about ten of
64 bits at a similarity of 0.8, beyond any affordable radius, so an exact similarity join of the
shingle sets by prefix filter adds the rest and no pair is missed.

Joins that grow with the corpus are merge joins by hint: the planner's guess of the size of a
computed table may be far too low, and would send it to the driver.

Cases: a NULL text counts as empty; a text without words has fingerprint zero. Rows with a NULL
``doc_id`` take part, but give no component number. Repeated rows stay. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import hash_filter, in_filter, others_aside, release, slices, stored, written
from revtide.llm.components import connected_components

BITS = 64
RADIUS = 2
SEED = 42
#: Shingles are turned into bits so many at a time, which bounds the memory of a long text.
BLOCK = 1 << 15
SHINGLE_WORDS = 5
#: Bits of the filter of texts to be checked.
FILTER = 1 << 22
MIN_SIMILARITY = 0.8
#: Texts, on average, whose shingles are counted, and the shingles kept, to take common ones last.
ORDER_TEXTS, ORDER_SHINGLES = 4000, 1 << 17
#: The place that tells a text's fingerprint from the shingles of its prefix.
FINGERPRINT = -1
#: Texts of a class up to which its pairs are counted out.
SMALL = 16
#: Times that the texts of large classes are held against a few before all are compared.
ROUNDS = 3
#: Texts of a block, on average, and shingles of the matrix that is held at once.
BLOCK_TEXTS, MATRIX = 128, 4096
#: Shingles of texts that a task remembers while it checks pairs.
HELD_SHINGLES = 1 << 22


def shingle_hashes(text: str, size: int):
    """XXH64 of the text's word shingles in order, repeats included, as unsigned 64-bit numbers.

    Only A-Z are lower-cased, and words end at the six ASCII white-space characters.
    """
    import numpy as np
    import xxhash

    words = text.encode().lower().split()
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64)


def _majority(hashes, starts) -> list[int]:
    """Signed 64-bit fingerprints of the runs of ``hashes`` that begin at ``starts``."""
    import numpy as np

    counts = np.zeros((len(starts), BITS), np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK]
        bits = np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.searchsorted(starts, at, "right") - 1
        last = np.searchsorted(starts, at + len(block), "left")
        cuts = np.maximum(starts[first:last] - at, 0)
        counts[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(hashes)))
    packed = np.packbits(counts * 2 > sizes[:, None], axis=1)
    return packed.reshape(-1).view(">i8").tolist()


def text_fingerprint(text: str, size: int) -> int:
    import numpy as np

    hashes = shingle_hashes(text, size)
    return _majority(hashes, np.zeros(1, np.int64))[0] if len(hashes) else 0


def part_fingerprints(text: str, size: int, part: int) -> list[int]:
    """Fingerprints of the runs of shingles that end where a hash is a multiple of ``part``."""
    import numpy as np

    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return [0]
    ends = np.flatnonzero(hashes[:-1] % np.uint64(part) == 0) + 1
    return _majority(hashes, np.concatenate([[0], ends]).astype(np.int64))


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, fp`` of every row, the fingerprint as a signed 64-bit number."""

    def compute(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found = [text_fingerprint(t or "", size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(found, pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(compute, "doc_id long, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def covering_masks() -> list[int]:
    """The masks of the seven tables, as signed 64-bit numbers."""
    vectors = [1 + i % ((1 << (RADIUS + 1)) - 1) for i in range(BITS)]
    return [
        _signed(sum(1 << i for i, v in enumerate(vectors) if (v & table).bit_count() % 2))
        for table in range(1, 1 << (RADIUS + 1))
    ]


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """``node, root`` for every fingerprint of ``fps`` (``fp``, distinct) that has another within two bits."""
    masks = covering_masks()
    # The table's number stands in the low bits of a bucket's key. A clash of keys only adds a
    # candidate; whether fingerprints are close is settled where they meet.
    keys = [F.xxhash64(F.col("fp").bitwiseAND(F.lit(m))).bitwiseAND(F.lit(-8)).bitwiseOR(F.lit(n)) for n, m in enumerate(masks)]
    partitions = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("key")).repartition(partitions, "key")
    # Dealt out by bucket once; whether a bucket has two members or more shows in the neighbours.
    bucket = Window.partitionBy("key").orderBy("fp")
    beside = {f"b{n}": F.lag("fp", -n).over(bucket) for n in (-2, -1, 1, 2)}
    placed = stored(keyed.withColumns(beside).filter("coalesce(`b-1`, b1) is not null"))
    more = F.expr("`b-2` is not null or b2 is not null or (`b-1` is not null and b1 is not null)")
    # Two in a bucket are held against one another at once; more meet by way of their neighbours.
    two = placed.filter(~more & F.col("b1").isNotNull()).filter(f"bit_count(fp ^ b1) <= {RADIUS}")
    open_bits = F.array(*[F.lit(~m) for m in masks])
    near = (
        placed.filter(more)
        .groupBy("fp")
        .agg(F.bit_or(F.element_at(open_bits, (F.col("key").bitwiseAND(F.lit(7)) + 1).cast("int"))).alias("open"))
    )
    turned = near.select(
        "fp",
        F.explode(
            F.expr(
                f"concat(array(fp), transform(filter(sequence(0, {BITS - 1}),"
                " i -> (shiftright(open, i) & 1L) = 1L), i -> fp ^ shiftleft(1L, i)))"
            )
        ).alias("z"),
    )
    meetings = turned.groupBy("z").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    links = turned.join(meetings.select("z", "low").hint("merge"), "z").filter("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return connected_components(links.unionAll(two.select(F.col("fp").alias("a"), F.col("b1").alias("b"))))


def fingerprint_components(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id``: fingerprints within two bits are linked.

    ``component_id`` is the least ``doc_id`` that links reach. ``docs`` has ``doc_id`` and ``text``.
    """
    rows = stored(fingerprints(docs, size))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = link_fingerprints(classes.select("fp"))
    rooted = classes.join(roots.hint("merge"), classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(least.hint("merge"), "root").select("fp", "component_id"))
    return rows.join(named.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _seen_shingles(size: int):
    def compute(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"key": np.unique(shingle_hashes(text, size)).view(np.int64)})

    return compute


def common_shingles(texts: DataFrame, size: int):
    """Hashes in order, and their ranks, of the commonest shingles of a sample of ``texts``.

    They only settle the order in which prefixes are taken, so that common shingles come last;
    any order finds the same pairs.
    """
    import numpy as np

    some = texts.sample(min(1.0, ORDER_TEXTS / max(texts.count(), 1)), seed=SEED)
    counts = some.select("text").mapInArrow(_seen_shingles(size), "key long").groupBy("key").count().filter("count > 2")
    found = counts.orderBy(F.desc("count"), "key").limit(ORDER_SHINGLES).toPandas()
    keys = found["key"].to_numpy(np.int64)
    places = np.argsort(keys)
    return keys[places], found["count"].to_numpy(np.int64)[places]


def shared_at_least(n: int) -> int:
    """How many prefix shingles a text of ``n`` shares at least with any similar one that has as many or more."""
    return 1 + n // 20


def prefix(own, often, ranks, minimum: float):
    """Of distinct shingles those that come first, so many that similar texts share ``shared_at_least`` of them.

    Texts of x and y shingles with a similarity of ``minimum`` share ``minimum * max(x, y)`` or more.
    Of the first ``n - minimum * n + k`` of each, in one order for all texts, they share k.
    """
    import numpy as np

    n = len(own)
    length = n - math.ceil(minimum * n - 1e-9) + shared_at_least(n)
    if len(often):
        at = np.minimum(np.searchsorted(often, own), len(often) - 1)
        own = own[np.lexsort((own, np.where(often[at] == own, ranks[at], 0)))]
    return own[:length]


def _prefixes(size: int, minimum: float, order):
    """The prefix of each text with the places in it, and its fingerprint as a key at the place ``FINGERPRINT``."""

    def compute(batches):
        import numpy as np
        import pyarrow as pa

        often, ranks = order.value
        for batch in slices(batches):
            sizes, keys, places = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_hashes(text, size)
                own = np.unique(hashes.view(np.int64))
                # Texts without words are all alike and meet in one class.
                first = prefix(own, often, ranks, minimum) if len(own) else np.zeros(1, np.int64)
                bits = _majority(hashes, np.zeros(1, np.int64)) if len(hashes) else [0]
                keys.append(np.append(first, np.array(bits, np.int64)))
                places.append(np.append(np.arange(len(first), dtype=np.int32), np.int32(FINGERPRINT)))
                sizes.append(len(own))
            lengths = [len(k) for k in keys]
            ids = np.repeat(batch.column(0).to_numpy(), lengths)
            keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            places = np.concatenate(places) if places else np.zeros(0, np.int32)
            n = np.repeat(np.array(sizes, np.int64), lengths)
            yield pa.RecordBatch.from_pydict({"text_id": ids, "n": n, "key": keys, "place": places})

    return compute


def _packed_texts(wanted):
    """The texts, compressed, that the filter ``wanted``, a broadcast, lets through: a third of what their shingles would take."""

    def compute(batches):
        import pyarrow as pa
        import zstandard

        passes, pack = in_filter(wanted.value), zstandard.ZstdCompressor().compress
        for batch in slices(batches):
            some = batch.filter(pa.array(passes(batch.column(0).to_numpy())))
            texts = pa.array([pack(t.encode()) for t in some.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_pydict({"text_id": some.column(0), "packed": texts})

    return compute


def _unpacked(packed, size: int):
    """The set of shingles of a compressed text, in order."""
    import numpy as np
    import zstandard

    return np.unique(shingle_hashes(zstandard.ZstdDecompressor().decompress(packed).decode(), size)).view(np.int64)


def _similar(size: int, minimum: float):
    def check(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches):
            keep, held, room = [], {}, HELD_SHINGLES
            for a, b, x, y in zip(*(batch.column(i) for i in range(4)), strict=True):
                sets = []
                for name, packed in ((a.as_py(), x), (b.as_py(), y)):
                    own = held.get(name)
                    if own is None:
                        own = _unpacked(packed.as_buffer(), size)
                        room -= len(own)
                        if room < 0:
                            held.clear()
                            room = HELD_SHINGLES
                        held[name] = own
                    sets.append(own)
                common = len(np.intersect1d(*sets, assume_unique=True))
                union = len(sets[0]) + len(sets[1]) - common
                keep.append(union == 0 or common >= minimum * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def _text_id(docs: DataFrame):
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def _block_links(size: int, minimum: float):
    """Links that join the similar texts of one block, a tree for each of its groups."""

    def compute(table):
        import numpy as np
        import pyarrow as pa

        ids = table.column("text_id").to_numpy()
        sets = [_unpacked(p.as_buffer(), size) for p in table.column("packed")]
        m, lengths = len(ids), np.array([len(own) for own in sets], np.int64)
        _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(m), lengths)
        # Shingles that only one text has are in no intersection.
        column = np.cumsum(counts > 1) - 1
        kept = counts[place] > 1
        owner, column = owner[kept], column[place[kept]]
        ordered = np.argsort(column, kind="stable")
        owner, column = owner[ordered], column[ordered]
        common = np.zeros((m, m))
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, MATRIX):
            begin, end = np.searchsorted(column, (low, low + MATRIX))
            has = np.zeros((m, MATRIX), np.float32)
            has[owner[begin:end], column[begin:end] - low] = 1
            common += has @ has.T
        alike = np.triu(common >= minimum * (lengths[:, None] + lengths[None, :] - common), 1)
        parent = list(range(m))

        def top(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for x, y in np.argwhere(alike).tolist():
            p, q = top(x), top(y)
            if p != q:
                parent[q] = p
                found.append((ids[x], ids[y]))
        left, right = ([pair[i] for pair in found] for i in (0, 1))
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return compute


def _all_pairs(classes: DataFrame, kept: DataFrame, size: int, minimum: float) -> DataFrame:
    """``a, b``: links among the texts of each class (``key, text_id``), dealt out in pairs of blocks."""
    seen = classes.groupBy("key").agg(F.count("*").alias("m"), F.sum(F.xxhash64("text_id").cast("decimal(38,0)")).alias("of"))
    # Classes of the same texts are looked at once.
    once = seen.groupBy("m", "of").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("m") / BLOCK_TEXTS).alias("blocks"))
    dealt = (
        classes.join(once.hint("merge"), "key")
        .withColumn("own", F.pmod(F.xxhash64("text_id"), F.col("blocks")))
        .select("text_id", "key", "own", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
        .select("text_id", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    rows = dealt.join(kept.hint("merge"), "text_id")
    return rows.groupBy("key", "i", "j").applyInArrow(_block_links(size, minimum), "a long, b long")


def _close_texts(prints: DataFrame) -> DataFrame:
    """``a, b``: each text of ``prints`` (``text_id, fp``) with the least of those that its fingerprint links to."""
    roots = link_fingerprints(prints.select("fp").distinct())
    rooted = prints.join(roots.hint("merge"), prints["fp"] == roots["node"], "left").select(
        "text_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("text_id").alias("a"))
    return rooted.join(least.hint("merge"), "root").filter("text_id <> a").select("a", F.col("text_id").alias("b"))


def _able(rows: DataFrame, minimum: float) -> DataFrame:
    """``key, text_id, n, reach``: the texts of each class that can be similar to another that meets them first in this class.

    Two texts have nothing in common before the first shingle that they share, so at its ``place`` a text of ``n``
    shingles has ``n - place`` left, and is similar to texts of at most ``reach`` shingles. The lesser of two similar texts
    reaches its own number. A pair is looked for in the class of its first shared shingle, so no pair is lost.
    """
    left = F.col("n") - F.col("place")
    reach = left * F.lit((1 + minimum) / minimum) - F.col("n") + F.lit(1e-6)
    lesser = F.col("reach") >= F.col("n")
    of_class = Window.partitionBy("key")
    bounds = {"low": F.min(F.when(lesser, F.col("n"))).over(of_class), "high": F.max(F.when(lesser, F.col("reach"))).over(of_class)}
    able = rows.withColumn("reach", reach).withColumns(bounds).filter((F.col("low") <= F.col("reach")) & (F.col("high") >= F.col("n")))
    return able.withColumn("m", F.count("*").over(of_class)).filter("m > 1").select("key", "text_id", "n", "reach")


def _of_several(rows: DataFrame) -> DataFrame:
    """The ``rows`` of classes of two texts or more with their number ``m``; those at the place ``FINGERPRINT`` pass."""
    members = F.count_if(F.col("place") >= 0).over(Window.partitionBy("key"))
    return rows.withColumn("m", members).filter((F.col("m") > 1) | (F.col("place") < 0))


def _of_able_texts(rows: DataFrame, minimum: float) -> DataFrame:
    """``rows`` (``key, text_id, n, place``) without texts in fewer classes than any two similar texts share, and ``spare``.

    A text of ``n`` shingles shares ``shared_at_least`` of ``minimum * n`` with a similar one, the least that this may have.
    ``spare`` tells how many classes more than these a text has from the row's place on: two texts meet first in a class
    where neither's is negative, as all that they share follow it. Rows at the place ``FINGERPRINT`` pass.
    """
    needed = F.expr(f"1 + ceil({minimum}D * n - 1e-9D) div 20")
    of_text = Window.partitionBy("text_id").orderBy(F.desc("place"))
    every = of_text.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = F.col("place") >= 0
    counted = rows.withColumns({"spare": F.count_if(shared).over(of_text) - needed, "most": F.count_if(shared).over(every) - needed})
    return counted.filter(~shared | (F.col("most") >= 0)).drop("most")


def near_duplicate_groups(docs: DataFrame, size: int = SHINGLE_WORDS, minimum: float = MIN_SIMILARITY) -> DataFrame:
    """``text_id, group_id``: texts (by 64-bit hash) in one group with others, and the group's least text.

    Two texts are linked if their sets of ``size``-word shingles have a Jaccard similarity of
    ``minimum`` or more. Texts whose SimHash fingerprints link are checked against the least of their
    group. All that may be similar are the texts with a common shingle among their first ones
    (``prefix``); no such pair is passed over. Pairs of small classes are counted out and checked.
    Texts that share fewer shingles with others than similar ones must are left out (``_of_able_texts``), and of a large
    class only texts that can be similar to another by what follows the shingle take part (``_able``).
    They are first held against a few of it, those with the most links; as long
    as a class has texts of more than one group, in the end all of these are compared in blocks. A text
    in no group is not returned.
    """
    spark = docs.sparkSession
    texts = docs.select(_text_id(docs).alias("text_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = spark.sparkContext.broadcast(common_shingles(texts, size))
    keyed = texts.mapInArrow(_prefixes(size, minimum, order), "text_id long, n long, key long, place int")
    dealt = keyed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").dropDuplicates(["key", "text_id", "place"])
    # Without the texts that share too little, some classes have one text left, and so may other texts.
    stored_rows = written(_of_several(_of_able_texts(_of_several(dealt), minimum).drop("spare")), "classes")
    classes = stored_rows.filter((F.col("place") >= 0) & (F.col("m") > 1))
    crowded = classes.filter(F.col("m") > SMALL)
    able = _of_able_texts(classes, minimum).filter((F.col("m") > SMALL) & (F.col("spare") >= 0))
    large = stored(_able(able, minimum))

    near = F.least("na", "nb") >= F.lit(minimum) * F.greatest("na", "nb") - F.lit(1e-9)
    each = (
        "transform(t, (x, i) -> transform(slice(t, i + 2, size(t)),"
        " y -> named_struct('a', x.text_id, 'na', x.n, 'b', y.text_id, 'nb', y.n)))"
    )
    counted = (
        classes.filter(F.col("m") <= SMALL)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("text_id", "n"))).alias("t"))
        .select(F.inline(F.expr(f"flatten({each})")))
        .filter(near)
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"), F.min(F.least("na", "nb")).alias("least"))
    )
    # What two texts share in large classes is not counted out: at most the lesser number of theirs.
    inside = crowded.groupBy("text_id").agg(F.count("*").alias("more"))
    for side in ("a", "b"):
        own = inside.select(F.col("text_id").alias(side), F.col("more").alias(f"more_{side}"))
        counted = counted.join(own.hint("merge"), side, "left")
    rest = F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0)))
    shared = counted.filter(F.col("shared") + rest >= F.expr("1 + least div 20")).select("a", "b")
    close = _close_texts(stored_rows.filter(F.col("place") < 0).select("text_id", F.col("key").alias("fp")))
    small = stored(shared.unionAll(close).distinct())

    wanted = stored(small.select(F.explode(F.array("a", "b")).alias("text_id")).unionAll(large.select("text_id")).distinct())
    # A filter of fixed size spares most texts the way; the join decides.
    passing = spark.sparkContext.broadcast(hash_filter(wanted.select(F.col("text_id").alias("hash")), FILTER))
    kept = written(
        texts.mapInArrow(_packed_texts(passing), "text_id long, packed binary")
        .dropDuplicates(["text_id"])
        .join(wanted.hint("merge"), "text_id", "left_semi"),
        "texts",
    )

    def checked(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(kept.select(F.col("text_id").alias("a"), F.col("packed").alias("x")).hint("merge"), "a")
            .join(kept.select(F.col("text_id").alias("b"), F.col("packed").alias("y")).hint("merge"), "b")
            .select("a", "b", "x", "y")
            .mapInArrow(_similar(size, minimum), "a long, b long")
        )

    dealt = counted = shared = close = None
    release(spark)
    links = stored(checked(small))
    release(spark)
    roots = connected_components(links)
    tried = None
    for turn in range(ROUNDS + 1):
        if large.isEmpty():
            break
        rooted = large.join(roots.hint("merge"), large.text_id == roots.node, "left").select(
            "key", "text_id", "n", "reach", F.coalesce("root", "text_id").alias("root")
        )
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
        open_rows = stored(rooted.join(mixed.select("key").hint("merge"), "key", "left_semi"))
        large = open_rows.select("key", "text_id", "n", "reach")
        if open_rows.isEmpty():
            break
        if turn == ROUNDS:
            found = _all_pairs(large.select("key", "text_id"), kept, size, minimum)
        else:
            ends = links.select(F.explode(F.array("a", "b")).alias("text_id")).groupBy("text_id").agg(F.count("*").alias("links"))
            left = large if tried is None else large.join(tried.hint("merge"), ["key", "text_id"], "left_anti")
            chosen = left.join(ends.hint("merge"), "text_id", "left").groupBy("key").agg(
                F.max(F.struct(F.coalesce("links", F.lit(0)), "text_id")).alias("most"), F.min("text_id").alias("least")
            )
            chosen = stored(chosen.select("key", F.explode(F.array_distinct(F.array("most.text_id", "least"))).alias("text_id")))
            tried = chosen if tried is None else tried.unionAll(chosen)
            held = open_rows.join(chosen.hint("merge"), ["key", "text_id"], "left_semi").select(
                "key", F.col("text_id").alias("end"), F.col("n").alias("nb"), F.col("reach").alias("reach_b"), F.col("root").alias("of")
            )
            pairs = (
                open_rows.withColumnRenamed("n", "na")
                .join(held.hint("merge"), "key")
                .filter("root <> of")
                .filter(near)
                .filter("na <= reach_b and nb <= reach")
                .select(F.least("text_id", "end").alias("a"), F.greatest("text_id", "end").alias("b"))
                .distinct()
            )
            found = checked(pairs)
        # Dealt out anew, as the parts of a union would grow in number with every round.
        links = stored(links.unionAll(found).distinct())
        found = pairs = None
        release(spark)
        roots = connected_components(links)
    return roots.select(F.col("node").alias("text_id"), F.col("root").alias("group_id"))


def one_of_each_group(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` (all columns) without near and exact copies: of each group the row with the least ``doc_id`` stays."""
    return others_aside(lambda own: _least_of_groups(own, **settings), docs)


def _least_of_groups(docs: DataFrame, **settings) -> DataFrame:
    marked = docs.withColumn("_text_id", _text_id(docs))
    groups = near_duplicate_groups(docs, **settings)
    ids = marked.select("doc_id", "_text_id")
    kept = (
        ids.join(groups.hint("merge"), ids["_text_id"] == groups["text_id"], "left")
        .select("doc_id", "_text_id", F.coalesce("group_id", "_text_id").alias("group_id"))
        .groupBy("group_id")
        .agg(F.min(F.struct("doc_id", "_text_id")).alias("k"))
        .select(F.col("k.doc_id").alias("_kept_id"), F.col("k._text_id").alias("_kept_text"))
    )
    left = marked.join(kept.hint("merge"), marked["_text_id"] == kept["_kept_text"]).filter(
        F.col("doc_id").eqNullSafe(F.col("_kept_id"))
    )
    # Repeated rows are rare, and to find one row of each the texts have to be dealt out again.
    if ids.groupBy("doc_id", "_text_id").count().filter("count > 1").limit(1).count():
        left = left.dropDuplicates(["_text_id"])
    return left.select(*docs.columns)
