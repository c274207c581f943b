"""Session settings the operators rely on, and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; all can be changed on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split an oversized join partition even where the join feeds another
    # operator on the same key; the extra shuffle is cheaper than one hot task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the session's own setting.

    A temporary folder serves only where driver and executors are one local process; on a cluster an unset folder
    is an error, since executors could not share it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="metaskein-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Materialize ``df`` reliably: the result survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written as Parquet in the checkpoint folder and read back: made once, and read with column pruning."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def handed_over(df: DataFrame) -> DataFrame:
    """``df`` stored, for the next stage; the files of the shuffles that made it are deleted at once.

    Spark otherwise keeps them until the driver happens to collect garbage, so that the shuffles of all stages are on disk together. The
    setting holds for this write only: a result that a caller collects twice still finds its shuffles.
    """
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, None)
    conf.set(FREE_SHUFFLES, "true")
    try:
        return stored(df, compression="zstd")
    finally:
        conf.unset(FREE_SHUFFLES) if before is None else conf.set(FREE_SHUFFLES, before)
