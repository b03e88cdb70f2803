"""Session helpers: local sessions for tests and lineage cuts for loops."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when it was counted and found at most this long.
BROADCAST_ROW_LIMIT = 200_000


def local_session(cpus: str | int = "*", app: str = "secflow", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the caller passes its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, which the session then checkpoints to.

    A temporary one is made only for a local master with the setting missing, so a lost executor
    never loses a checkpoint.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="secflow-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """A broadcast lookup table when ``df`` has at most ``limit`` rows, else ``df`` for a shuffle join.

    The rows are read once, so a lookup that is costly to derive is not derived again per join.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def shuffle_buckets(spark: SparkSession, most: int = 256) -> int:
    """Number of range buckets for global ranks: follows the shuffle width up to ``most``."""
    return max(2, min(most, int(spark.conf.get("spark.sql.shuffle.partitions"))))
