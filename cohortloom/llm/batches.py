"""Session settings for the jobs of one operator."""

from __future__ import annotations

import contextlib

from pyspark.sql import SparkSession

FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}  # as soon as a job has ended


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Set the session's values for the jobs that start while the body runs."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def small_batches(spark: SparkSession, rows: int):
    """Send at most so many rows at a time to Python."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})
