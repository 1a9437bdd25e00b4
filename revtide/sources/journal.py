"""Reading one kind's feed from a journal table or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.functions.values import check_name

JOURNAL = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("generation", T.StringType(), False),
        T.StructField("position", T.LongType(), False),
        T.StructField("id", T.StringType(), False),
        T.StructField("revision", T.LongType(), False),
        T.StructField("value", T.StringType(), True),
    ]
)


def open_journal(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOURNAL).parquet(path)


def stream_journal(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The journal folder as a stream; one micro-batch is one page."""
    return (
        spark.readStream.schema(JOURNAL).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def read_journal(
    df: DataFrame, kind: str, generation: str, after: int, upto: int | None = None
) -> DataFrame:
    """Events of one kind and generation in ``(after, upto]``; plain, pushable predicates."""
    check_name(kind)
    check_name(generation)
    feed = df.filter(
        (F.col("kind") == kind)
        & (F.col("generation") == generation)
        & (F.col("position") > F.lit(after))
    )
    return feed if upto is None else feed.filter(F.col("position") <= F.lit(upto))


def check_generation(df: DataFrame, kind: str, generation: str) -> DataFrame:
    """One verdict row: ``gap`` when the kind's feed has another generation or no rows."""
    of_kind = df.filter(F.col("kind") == kind)
    return of_kind.agg(
        F.count("*").alias("events"),
        F.count_if(F.col("generation") != generation).alias("foreign"),
    ).withColumn(
        "status", F.when((F.col("foreign") > 0) | (F.col("events") == 0), "gap").otherwise("ok")
    )
