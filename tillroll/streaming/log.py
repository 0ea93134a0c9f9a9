"""Rows of the log, read by the folder names of their batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.sources.shared import matching
from tillroll.streaming import journal

OK = "ok"
REJECTED = "rejected"


def read_batches(
    spark: SparkSession, path: str, batches: Iterable[journal.Batch], status: str = OK
) -> DataFrame:
    """Log rows of these batches."""
    folders = [f"{path}/log/{journal.folder_of(batch)}" for batch in batches]
    if not folders:
        return spark.createDataFrame([], schemas.LOG)
    reader = spark.read.schema(schemas.LOG).option("basePath", f"{path}/log")
    return reader.parquet(*folders).filter(F.col("status") == status)


def read_log(
    spark: SparkSession, path: str, status: str = OK, state: journal.State | None = None
) -> DataFrame:
    """Log rows of all finished batches whose folders are still there. Those that a base version
    covers may be removed; the tail has to be whole, and reading fails if it is not."""
    state = state or journal.read_state(spark, path)
    there = [journal.batch_of(x) for x in matching(spark, f"{path}/log/epoch=*/batch_id=*")]
    covered = [batch for batch in there if state.covers(batch)]
    return read_batches(spark, path, [*covered, *state.tail], status)
