"""Cleaned events as a stream: every stage of the cleaning that looks at one row.

Repeats of a transaction stay, as in the log: the latest row of each is chosen on reading, by
`operators.ranking.deduplicate_latest`, since it may arrive at any time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import fixed
from tillroll.operators.events import decode_events
from tillroll.operators.ranking import deduplicate_latest
from tillroll.operators.row_keys import with_key_stream
from tillroll.operators.validity import remove_invalid_records
from tillroll.plans.cleaning import clean_rows
from tillroll.plans.history import DAY


def clean_events(
    stream: DataFrame, zone: str | None = None, pattern: str = fixed.STORE_PATTERN_LITERAL
) -> DataFrame:
    """Wire events, decoded, valid, keyed and cleaned. Batches and streams; no shuffle, no state.

    The row key is that of the log, from the codes as they were sent.
    """
    good, _ = decode_events(stream, zone)
    keyed = with_key_stream(remove_invalid_records(good), time="event_time")
    return clean_rows(keyed, pattern)


def start_enriched(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    zone: str | None = None,
    pattern: str = fixed.STORE_PATTERN_LITERAL,
) -> StreamingQuery:
    """Run a wire stream into Parquet files by day. Spark's file sink lists the files of each
    finished batch, so readers see every event once, also after a stop within a batch."""
    return (
        clean_events(stream, zone, pattern)
        .writeStream.format("parquet")
        .partitionBy(DAY)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": fixed.TRIGGER_INTERVAL}))
        .start()
    )


def latest_enriched(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of each transaction among those that arrived so far; equal times go to the
    highest amount."""
    rows = spark.read.parquet(path)
    return deduplicate_latest(rows, order="event_time", tie_break=(F.col("total_amount").desc(),))
