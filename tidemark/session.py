"""Session settings for cluster runs, and the checkpoint folder."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join keys even where it costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session that brings its own configuration the settings the plans rely on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=1)
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    A temporary folder, one per session, is used only in a local session that names none, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _own_folder(context.applicationId)
    return folder.rstrip("/")


#: the most rows of a few numbers that one task takes in each pass of a fit
ROWS_A_TASK = 200_000


def dealt(df: DataFrame, rows: int, worth: int = 1) -> DataFrame:
    """The frame's ``rows`` rows dealt out evenly: to all cores, where ``worth`` rows are worth a task, or more.

    Adaptive execution joins small partitions by bytes, so that a fit whose rows are few and whose passes are
    long would run in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(min(cores, -(-rows // worth)), -(-rows // ROWS_A_TASK), 1))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
