"""What an ingest did, batch by batch and in total."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.streaming.journal import read_journal

_BATCH = ["epoch", "batch_id"]


def _seconds(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000, 2)


def _rate(rows: Column, seconds: Column) -> Column:
    """Rows per second; null for a run too short to have a duration."""
    return F.round(F.try_divide(rows, seconds), 2)


def ingest_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Per finished batch: rows, rejects, stores, amount, event times, seconds, rows/s. The journal
    has them all, also of batches whose rows were removed."""
    seconds = _seconds(F.col("started_at"), F.col("finished_at"))
    return (
        read_journal(spark, path)
        .select(
            *_BATCH,
            "rows",
            "rejected",
            "stores",
            "amount",
            "first_event",
            "last_event",
            seconds.alias("seconds"),
            _rate(F.col("rows"), seconds).alias("rows_per_second"),
        )
        .orderBy(*_BATCH)
    )


def ingest_totals(spark: SparkSession, path: str) -> DataFrame:
    """Per epoch: batches, rows, rejects, seconds from first start to last end, rows/s."""
    seconds = _seconds(F.min("started_at"), F.max("finished_at"))
    rows = F.sum("rows")
    return (
        read_journal(spark, path)
        .groupBy("epoch")
        .agg(
            F.count(F.lit(1)).alias("batches"),
            rows.alias("rows"),
            F.sum("rejected").alias("rejected"),
            seconds.alias("seconds"),
            _rate(rows, seconds).alias("rows_per_second"),
        )
        .orderBy("epoch")
    )
