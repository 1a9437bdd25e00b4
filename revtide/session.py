"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the operators are tuned for; a cluster's own values win where it sets them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Plans name whole paths, however long the folder.
    "spark.sql.maxMetadataStringLength": "2000",
}


def build_session(app: str = "revtide", cores: int | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``cores`` selects local mode."""
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only where that is unset (tests, local runs) is a local folder taken.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="revtide-")
    return f"{shared.rstrip('/')}/revtide/{name}-{uuid.uuid4().hex}"
