"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes
every stage's result as Parquet in the cluster's shared folder and reads it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import decontam, linededup, packing, simhash, toxicity
from revtide.llm.common import release, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; it is fitted on the labelled documents among ``docs``."""
    labels = toxicity.table_categories(table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, toxicity.train(docs, labels, toxicity.CATEGORIES))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go from the texts; ``n_chars`` follows."""
    cut = linededup.drop_repeated_runs(docs)
    length = F.when(F.col("deleted_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies the document of least id stays."""
    return simhash.one_of_each_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: Tokens and a fitted classifier are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        # The next stage needs the disk that this one's shuffle files hold.
        release(spark)
    return docs
