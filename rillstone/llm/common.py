"""Helpers shared by the training-data operators: the shared folder and the size of Arrow batches."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rillstone.storage import discard, materialize, new_folder, remove, shared_dir, spread

__all__ = ["BATCH_ROWS", "bound_batches", "discard", "materialize", "new_folder", "remove", "shared_dir", "spread"]

#: Rows of an Arrow batch at most: rows hold whole texts, and a batch lies in memory several times on its way.
BATCH_ROWS = 2000


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS; smaller ones stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
