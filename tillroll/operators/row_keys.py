"""The four row keys as columns. A null part makes the key null."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import fixed
from tillroll.functions import clock, keys


def with_key_stream(
    df: DataFrame,
    time: str = "timestamp",
    zone: str | None = None,
    salts: int = fixed.STREAM_SALTS,
    name: str = "rowkey",
) -> DataFrame:
    """salt by transaction _ store _ epoch seconds _ last 8 of the transaction"""
    transaction = F.col("transaction_id")
    return df.withColumn(
        name,
        keys.joined(
            keys.stream_salt(transaction, salts).cast("string"),
            F.col("store_id"),
            clock.epoch_seconds(df, time, zone).cast("string"),
            keys.last_chars(transaction, 8),
        ),
    )


def with_key_salted(
    df: DataFrame,
    time: str = "timestamp",
    salts: int = fixed.STORE_SALTS,
    name: str = "rowkey",
) -> DataFrame:
    """salt by store _ store _ time counted down _ last 8: newest first within a store"""
    salt = keys.store_salt(F.col("store_id"), salts)
    # Salts of up to two digits are padded without a test, which would compute the hash once more.
    salt = F.lpad(salt.cast("string"), 2, "0") if salts <= 100 else keys.padded(salt, 2)
    return df.withColumn(
        name,
        keys.joined(
            salt,
            F.col("store_id"),
            keys.newest_first(clock.epoch_millis(df, time)),
            keys.last_chars(F.col("transaction_id"), 8),
        ),
    )


def with_key_store_date(
    df: DataFrame, time: str = "timestamp", name: str = "rowkey"
) -> DataFrame:
    """store _ yyyyMMdd _ last 4"""
    return df.withColumn(
        name,
        keys.joined(
            F.col("store_id"),
            clock.compact_date(F.col(time)),
            keys.last_chars(F.col("transaction_id"), 4),
        ),
    )


def with_key_batch(df: DataFrame, time: str = "timestamp", name: str = "rowkey") -> DataFrame:
    """store _ time _ last 8"""
    return df.withColumn(
        name,
        keys.joined(
            F.col("store_id"),
            clock.plain_text(F.col(time)),
            keys.last_chars(F.col("transaction_id"), 8),
        ),
    )
