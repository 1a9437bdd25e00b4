"""A projection target of plain Parquet folders, dealt by key.

Layout: ``base/upto=N`` (compacted) and ``deltas/batch_id=N`` (one folded page each), both partitioned by
``bucket``, a hash of the key. A page is overwritten as a whole under its batch id, so writing it again
changes nothing, and Spark's own success marker makes a folder visible. Whoever looks for certain
keys names their buckets, and the scan reads no other folder.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.operators.history import KEY, latest

#: Folders of a page or a base, fit for some hundred GB; a larger target names more. Every writer of one
#: target must name the same number.
BUCKETS = 16
BASE_BATCH = -1
DEALT = T.StructField("bucket", T.IntegerType())


def bucket_of_key(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def delta_path(path: str, batch_id: int) -> str:
    return f"{path}/deltas/batch_id={batch_id}"


def base_path(path: str, upto: int) -> str:
    return f"{path}/base/upto={upto}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def numbered(spark: SparkSession, path: str) -> list[int]:
    """N of the complete folders ``<name>=N`` below ``path``, in order."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    names = [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
    return sorted(int(n.partition("=")[2]) for n in names if "=" in n and is_complete(spark, f"{path}/{n}"))


def remove(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    dealt = rows.withColumn("bucket", bucket_of_key(buckets)).repartition("bucket")
    dealt.write.partitionBy("bucket").mode("overwrite").parquet(path)


def write_delta(page: DataFrame, path: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Store one folded page under its batch id; idempotent."""
    _write(page, delta_path(path, batch_id), buckets)


def committed(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """(newest base, later deltas), those that were written to their end."""
    base = max(numbered(spark, f"{path}/base"), default=None)
    return base, [n for n in numbered(spark, f"{path}/deltas") if base is None or n > base]


def write_generation(page: DataFrame, path: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Fold a page and store it."""
    write_delta(latest(page), path, batch_id, buckets)


def stored_rows(
    spark: SparkSession, path: str, schema: T.StructType, only: Iterable[int] | None = None, before: int | None = None
) -> DataFrame:
    """All stored rows with the ``batch_id`` that wrote them.

    ``only``: the buckets to read; ``before``: pages with a lower id alone.
    """
    base, deltas = committed(spark, path)
    deltas = [n for n in deltas if before is None or n < before]
    parts = []
    if base is not None:
        saved = spark.read.schema(T.StructType([*schema.fields, DEALT])).parquet(base_path(path, base))
        parts.append(saved.withColumn("batch_id", F.lit(BASE_BATCH).cast("long")))
    if deltas:
        named = T.StructType([*schema.fields, DEALT, T.StructField("batch_id", T.LongType())])
        reader = spark.read.schema(named).option("basePath", f"{path}/deltas")
        parts.append(reader.parquet(*[delta_path(path, n) for n in deltas]))
    if not parts:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("long"))
    if only is not None:
        wanted = sorted(only)
        parts = [p.filter(F.col("bucket").isin(wanted)) for p in parts]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.drop("bucket")


def read_generation(
    spark: SparkSession, path: str, schema: T.StructType, only: Iterable[int] | None = None, before: int | None = None
) -> DataFrame:
    """Current row per key: the highest revision; the first write of a revision stands.

    A stored row is thus replaced only by a strictly greater revision of the same key, and
    a tombstone keeps its key row.
    """
    rows = stored_rows(spark, path, schema, only, before).withColumn("_earlier", -F.col("batch_id"))
    return latest(rows, KEY, ["revision", "_earlier"]).drop("_earlier", "batch_id")


def compact(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> int | None:
    """Rewrite base and deltas as one base; what the base before it covers is removed, so running readers end well."""
    base, deltas = committed(spark, path)
    if not deltas:
        return base
    upto = deltas[-1]
    _write(read_generation(spark, path, schema).select(schema.fieldNames()), base_path(path, upto), buckets)
    for old in numbered(spark, f"{path}/base"):
        if base is not None and old < base:
            remove(spark, base_path(path, old))
    for old in numbered(spark, f"{path}/deltas"):
        if base is not None and old <= base:
            remove(spark, delta_path(path, old))
    return upto
