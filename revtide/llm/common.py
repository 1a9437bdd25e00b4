"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> None:
    """See that checkpoints go to the cluster's shared folder; a local one only where none is named."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="revtide-")
    context.setCheckpointDir(folder)


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no rerun.

    Spark removes the files when the frame is no longer referenced and
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Has Spark (4.1 on) remove the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """The session's ``key`` is ``value`` inside, and as before after it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, column by column.

    The write's own shuffle files go as soon as it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    shared_folder(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    with setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of frames that are no longer referenced removed now.

    Spark's cleaner goes by the driver's garbage collector, which may not run for long where the driver is idle. Python
    tells the driver's JVM up to a second later which frames it dropped, so those dropped last may stay.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def others_aside(work, docs: DataFrame, own: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``work(docs)`` with the columns that are not its ``own`` under names that no operator uses, then under their names again.

    So a column may be called as the operator's inner ones are. Where ``work`` adds a column of the name of one of
    the others, the added one stands in the result.
    """
    aside = {c: c if c in own else f"__other_{n}" for n, c in enumerate(docs.columns)}
    done = work(docs.toDF(*aside.values()))
    added = [c for c in done.columns if c not in aside.values()]
    kept = [F.col(a).alias(c) for c, a in aside.items() if c not in added]
    return done.select(*kept, *added)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_filter(hashes: DataFrame, bits: int) -> bytes:
    """Packed bits of a filter of fixed size over ``hash``, a column of 64-bit hashes.

    Each hash sets two places; at most ``bits`` places reach the driver, whatever the table's size.
    """
    import numpy as np

    places = hashes.select(
        F.explode(
            F.array(F.expr(f"pmod(hash, {bits}L)"), F.expr(f"pmod(shiftrightunsigned(hash, 32), {bits}L)"))
        ).alias("place")
    ).distinct()
    bitmap = np.zeros(bits, bool)
    bitmap[places.toPandas()["place"].to_numpy(np.int64)] = True
    return np.packbits(bitmap).tobytes()


def in_filter(packed: bytes):
    """A function on arrays of signed 64-bit hashes: which of them the filter may hold."""
    import numpy as np

    bitmap = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
    bits = np.uint64(len(bitmap))

    def passes(hashes):
        unsigned = hashes.view(np.uint64)
        low = (hashes % np.int64(bits)).astype(np.int64)
        high = ((unsigned >> np.uint64(32)) % bits).astype(np.int64)
        return bitmap[low] & bitmap[high]

    return passes


def slices(batches, rows: int = 512):
    """Arrow batches in parts of at most ``rows``, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
