"""Declared schemas. Nothing in the library infers a type from data."""

from pyspark.sql import types as T

from tillroll import fixed

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

SALES = T.StructType([T.StructField(name, T.StringType()) for name in fixed.SALES_FIELDS])

EVENT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

# Where an event sat in its source; null for sources without a position.
SEQ = T.StructType(
    [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
)

# One ingested row. `status` and `salt` are directories, the rest is in the files.
LOG = T.StructType(
    [
        *EVENT.fields,
        T.StructField("event_time", T.TimestampType()),
        T.StructField("rowkey", T.StringType()),
        T.StructField("seq", SEQ),
        T.StructField("value", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("salt", T.IntegerType()),
    ]
)

# One row per finished micro-batch, with the figures of its good rows.
JOURNAL = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("stores", T.LongType()),
        T.StructField("amount", T.DecimalType(38, 10)),
        T.StructField("first_event", T.TimestampType()),
        T.StructField("last_event", T.TimestampType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Current rows folded by a compaction. `period` and `salt` are directories.
BASE = T.StructType(
    [
        *EVENT.fields,
        T.StructField("event_time", T.TimestampType()),
        T.StructField("rowkey", T.StringType()),
        T.StructField("seq", SEQ),
        T.StructField("epoch", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("period", T.StringType()),
        T.StructField("salt", T.IntegerType()),
    ]
)

# The base version that holds each period and salt.
PARTS = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("salt", T.IntegerType()),
        T.StructField("held_by", T.LongType()),
    ]
)

# For each epoch, the last batch that a base version contains.
MANIFEST = T.StructType(
    [
        T.StructField("epoch", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("version", T.LongType()),
    ]
)

# The store ranking after a batch.
RANKING = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField(fixed.RANK_COUNT, T.LongType()),
        T.StructField(fixed.RANK_REVENUE, T.DecimalType(38, 10)),
    ]
)


def history(grain: str = "day") -> T.StructType:
    """The history table: the day is a column of the files where months are the folders."""
    day = T.StructField("transaction_date", T.DateType())
    return T.StructType(
        [
            T.StructField("rowkey", T.StringType()),
            T.StructField("store_id", T.StringType()),
            T.StructField("amount", T.DoubleType()),
            T.StructField("payment", T.StringType()),
            T.StructField("customer_id", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
            day,
            *([T.StructField("transaction_month", T.StringType())] if grain == "month" else []),
        ]
    )
