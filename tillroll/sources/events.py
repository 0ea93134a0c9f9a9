"""Event streams in and out.

Incoming rows are normalised to `value` (text) and `seq` (place in the source).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import fixed, schemas
from tillroll.operators.events import encode_events


def read_event_stream(
    spark: SparkSession,
    kind: str = "kafka",
    starting: str = "earliest",
    fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """A stream of wire events.

    kind "kafka": needs Spark's Kafka connector; pass `kafka.bootstrap.servers` and, for
    another topic, `subscribe` as options. kind "files": text files under `path`, one
    event per line; such a source starts with the files it finds and has no positions.
    """
    if kind == "kafka":
        settings = {
            "subscribe": fixed.EVENT_TOPIC,
            "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
            **options,
        }
        rows = spark.readStream.format("kafka").options(**settings).load()
        return rows.select(
            F.col("value").cast("string").alias("value"),
            F.struct("partition", "offset").cast(schemas.SEQ).alias("seq"),
        )
    if kind == "files":
        if starting != "earliest":
            raise ValueError("a file stream always starts with the files it finds")
        rows = spark.readStream.format("text").options(**options).load()
        return rows.select("value", F.lit(None).cast(schemas.SEQ).alias("seq"))
    raise ValueError(f"unknown kind of stream: {kind}")


def send_events(df: DataFrame, kind: str = "kafka", **options: str) -> None:
    """Write the event fields of `df` as wire events, to where `read_event_stream` reads.

    kind "kafka": pass `kafka.bootstrap.servers` and, for another topic, `topic`. Events have
    no key, so a topic with several partitions does not keep their order. kind "files":
    adds text files under `path`. All tasks write at once in both cases.
    """
    wire = encode_events(df).write
    if kind == "kafka":
        settings = {
            "topic": fixed.EVENT_TOPIC,
            "kafka.batch.size": str(fixed.SEND_BATCH_BYTES),
            "kafka.linger.ms": str(fixed.SEND_LINGER_MS),
            **options,
        }
        wire.format("kafka").options(**settings).save()
    elif kind == "files":
        wire.mode("append").format("text").options(**options).save()
    else:
        raise ValueError(f"unknown kind of stream: {kind}")
