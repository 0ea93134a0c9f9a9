"""First rows per key, safe for keys that hold a large share of all rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
_RANK = "__rank"
_SLICE = "__slice"
#: Slices of a key that one task merges.
FAN_IN = 32


def orderable(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def total_order(df: DataFrame, leading: Sequence[Column], named: Sequence[str]) -> list[Column]:
    """`leading`, then every column not in `named`, so that ties are only exact copies."""
    rest = [
        F.col(f"`{field.name}`").asc_nulls_first()
        for field in orderable(df)
        if field.name not in named
    ]
    return [*leading, *rest]


def _keep(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows of every key.

    Up to the session's group-limit threshold, Spark cuts each key to `n` rows inside every
    map task, so a hot key never travels whole. Beyond it the key is cut in slices first, and
    these are merged in a tree: no task gets more than `n` rows from each of `FAN_IN` slices of a
    key, however many shuffle partitions there are.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    spark = df.sparkSession
    columns = [F.col(key) for key in keys]
    if n <= int(spark.conf.get(_LIMIT_CONF)):
        return _keep(df, columns, order, n)
    # By input partition, not by content: copies of one row spread like any other rows.
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.withColumn(_SLICE, F.spark_partition_id() % slices)
    while slices > 1:
        cut = _keep(cut, [*columns, F.col(_SLICE)], order, n)
        slices = -(-slices // FAN_IN)
        cut = cut.withColumn(_SLICE, F.floor(F.col(_SLICE) / FAN_IN).cast("int"))
    return _keep(cut, columns, order, n).drop(_SLICE)


def deduplicate_latest(
    df: DataFrame,
    key: str = "transaction_id",
    order: str = "timestamp",
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """The row with the greatest `order` per `key`.

    Equal times are decided by `tie_break`, then by all remaining columns in ascending
    order: the result does not depend on how the input is partitioned.
    """
    leading = [F.col(order).desc_nulls_last(), *tie_break]
    return top_per_key(df, [key], total_order(df, leading, (key, order)), 1)
