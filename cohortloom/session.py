"""Session settings, shared storage and the size limits the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with more rows than this is split over several tasks.  At most
# total_rows / HOT_ROWS keys can be hot, which bounds every broadcast of hot keys.
HOT_ROWS = 1_000_000

# Rows that one task may number in a window.
PIECE_ROWS = 1_000_000

# Tables with no more rows than this may be broadcast after they were counted.
BROADCAST_ROWS = 200_000


def build_session(app: str = "cohortloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the session's checkpoint folder.

    A local folder is chosen only when none is set and the master is local.
    """
    context = spark.sparkContext
    chosen = context.getCheckpointDir()
    if chosen:
        return chosen
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="cohortloom-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write data-sized rows as parquet below the shared folder and read them from there.

    Used where several parts of a plan must see the very same rows (row
    positions, splits, folds).  Later reads prune columns.  A caller that gives
    the path can ``discard`` it once nothing reads the rows any more.
    """
    path = path or scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete rows ``saved`` at a path of ``scratch_path``; nothing may read them any more."""
    if not path.startswith(f"{shared_dir(spark).rstrip('/')}/scratch-"):
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def freeze(df: DataFrame) -> DataFrame:
    """Checkpoint a small table (counts, brackets, group moments) to the shared folder.

    It is computed once, its lineage is cut, and it survives executor loss.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a frozen table when its counted size allows, else leave it to a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df
