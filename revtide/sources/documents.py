"""Whole-file import: only approved bytes, only strict JSON."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.functions import strict_json
from revtide.operators.joins import lookup_join
from revtide.verdicts import Refused, first_reason


def read_files(spark: SparkSession, glob: str, max_bytes: int = strict_json.DOCUMENT_BYTES):
    """``path, bytes, content`` of the files; content of a file beyond the limit is not read."""
    files = spark.read.format("binaryFile").load(glob)
    small = files.filter(F.col("length") <= max_bytes).select(
        "path", F.col("length").alias("bytes"), "content"
    )
    large = files.filter(F.col("length") > max_bytes).select(
        "path", F.col("length").alias("bytes"), F.lit(None).cast("binary").alias("content")
    )
    return small.unionByName(large)


@F.pandas_udf(T.StringType())
def json_reject_reason(content: pd.Series) -> pd.Series:
    """Why these bytes are not one strict, bounded JSON document; NULL if they are."""

    def one(raw):
        if raw is None:
            return None
        try:
            strict_json.check_document(strict_json.parse(bytes(raw).decode("utf-8")))
        except strict_json.Unfit as fault:
            return str(fault)
        except UnicodeDecodeError:
            return "invalid_json"
        return None

    return pd.Series([one(raw) for raw in content], dtype=object)


def import_documents(
    files: DataFrame, manifest: DataFrame, max_bytes: int = strict_json.DOCUMENT_BYTES
) -> DataFrame:
    """Admit files (``path, bytes, content``) by the approved ``manifest`` (``path, sha256``).

    Adds ``version`` (``sha256:<hex>``), ``text`` and ``reject_reason``. Bytes are checked
    against size and digest before anything is parsed. An approved file that was not read,
    being absent or empty, is reported as ``missing``.
    """
    if not 1 <= max_bytes <= strict_json.DOCUMENT_BYTES:
        raise Refused("document limit outside 1..65536")
    approved = manifest.groupBy("path").agg(
        F.count_distinct("sha256").alias("_grants"), F.min("sha256").alias("_sha256")
    )
    digest: Column = F.sha2("content", 256)
    admitted = first_reason(
        (F.col("_sha256").isNull(), "not_approved"),
        (F.col("_grants") > 1, "ambiguous_grant"),
        (F.col("bytes") > max_bytes, "too_large"),
        (~F.coalesce(F.col("_digest") == F.col("_sha256"), F.lit(False)), "digest_mismatch"),
    )
    checked = lookup_join(files.withColumn("_digest", digest), approved, ["path"]).withColumn("_bytes_reason", admitted)
    # Only bytes that passed reach the parser.
    parsed = json_reject_reason(F.when(F.col("_bytes_reason").isNull(), F.col("content")))
    judged = checked.withColumn("_json_reason", parsed).withColumn(
        "reject_reason", F.coalesce("_bytes_reason", "_json_reason")
    )
    good = F.col("reject_reason").isNull()
    read = judged.select(
        "path",
        "bytes",
        F.when(good, F.concat(F.lit("sha256:"), F.col("_digest"))).alias("version"),
        F.when(good, F.decode("content", "UTF-8")).alias("text"),
        "reject_reason",
    )
    # Listed paths without a file: only names meet here, content is neither read nor moved.
    nothing = F.lit(None).cast("string")
    missing = approved.join(files.select("path"), "path", "left_anti").select(
        "path",
        F.lit(None).cast("bigint").alias("bytes"),
        nothing.alias("version"),
        nothing.alias("text"),
        F.lit("missing").alias("reject_reason"),
    )
    return read.unionByName(missing)
