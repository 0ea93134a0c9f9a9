"""Rows laid out for lookups by store, newest first.

<path>/rows/salt=S/   all rows, ranged and sorted by store and the recent-first key
<path>/days/salt=S/   per store and day the number of rows
<path>/columns/       no rows, the columns of the others with their types

The salt of a store picks the folder; files and row groups of a folder hold one range of stores
and times each, so statistics skip all others. The table of days tells up to which day a store's
newest rows reach, before any row is read. Days are counted in UTC, whatever the session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import fixed
from tillroll.functions import clock, keys
from tillroll.operators.row_keys import with_key_salted
from tillroll.plans.sales import recent_by_store

KEY = "recent_key"
SALT = "salt"
DAY = "utc_day"
_ADDED = (KEY, SALT, DAY)
_MILLIS_OF_DAY = 86_400_000


def save_by_store(
    df: DataFrame,
    path: str,
    time: str = "timestamp",
    salts: int = fixed.STORE_SALTS,
    parts: int | None = None,
    row_group_bytes: int = 16 << 20,
) -> None:
    """Write `df` (with transaction_id, store_id and `time`) to a new folder.

    All rows are kept: those without a time come after all others of their store, those without
    a store form one of their own. Ranges go by store, key and transaction, so a store with
    a third of all rows is divided between many tasks; `parts` is their number. Small row
    groups let a lookup read little.
    """
    taken = {name.lower() for name in df.columns} & set(_ADDED)
    if taken:
        raise ValueError(f"the layout adds columns of its own: {', '.join(sorted(taken))}")
    keyed = with_key_salted(df, time, salts, KEY).withColumns(
        {
            SALT: keys.store_salt(F.col("store_id"), salts),
            DAY: F.floor(clock.epoch_millis(df, time) / _MILLIS_OF_DAY).cast("int"),
        }
    )
    order = [F.col(SALT), F.col("store_id"), F.col(KEY).asc_nulls_last(), F.col("transaction_id")]
    ranged = keyed.repartitionByRange(*([] if parts is None else [parts]), *order)
    (
        ranged.sortWithinPartitions(*order)
        .write.option("parquet.block.size", row_group_bytes)
        .partitionBy(SALT)
        .parquet(f"{path}/rows")
    )
    spark = df.sparkSession
    spark.createDataFrame([], keyed.schema).coalesce(1).write.parquet(f"{path}/columns")
    days = _rows(spark, path).groupBy(SALT, "store_id", DAY).agg(F.count(F.lit(1)).alias("rows"))
    (
        days.hint("rebalance", SALT)
        .sortWithinPartitions(SALT, "store_id", DAY)
        .write.partitionBy(SALT)
        .parquet(f"{path}/days")
    )


def _rows(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(schema).parquet(f"{path}/rows")


def _days(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{SALT} int, store_id string, {DAY} int, rows long"
    return spark.read.schema(schema).parquet(f"{path}/days")


def _reach(days: DataFrame, n: int) -> DataFrame:
    """(store, since, undated) per store: the day that its `n` newest rows reach back to, and
    whether they reach its rows without a time."""
    before = (
        Window.partitionBy("store_id")
        .orderBy(F.col(DAY).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    newer = F.coalesce(F.sum("rows").over(before), F.lit(0))
    needed = days.withColumn("newer", newer).filter(F.col("newer") < n)
    return needed.groupBy(F.col("store_id").alias("store")).agg(
        F.min(DAY).alias("since"), F.max(F.col(DAY).isNull()).alias("undated")
    )


def rows_in_reach(
    spark: SparkSession, path: str, store: str | None, n: int, salts: int = fixed.STORE_SALTS
) -> DataFrame:
    """Rows of one store on the days that hold its `n` newest. One row of the days reaches the
    driver; folder, store and day are then filters of the scan."""
    # A null store is a store too.
    wanted = F.lit(store).cast("string")
    here = F.col(SALT).eqNullSafe(keys.store_salt(wanted, salts)) & F.col("store_id").eqNullSafe(wanted)
    reach = _reach(_days(spark, path).filter(here), n).first()
    found = _rows(spark, path).filter(here)
    if reach is None:
        return found.filter(F.lit(False))
    if reach["undated"]:
        return found
    return found.filter(F.col(DAY) >= reach["since"])


def newest_of_store(
    spark: SparkSession,
    path: str,
    store: str | None,
    n: int,
    time: str = "timestamp",
    salts: int = fixed.STORE_SALTS,
) -> DataFrame:
    """The `n` latest rows of one store, as `recent_by_store` picks them."""
    return recent_by_store(rows_in_reach(spark, path, store, n, salts).drop(*_ADDED), n, time)


def newest_by_store(spark: SparkSession, path: str, n: int, time: str = "timestamp") -> DataFrame:
    """The `n` latest rows of every store, as `recent_by_store` picks them.

    The days of each store are joined by store; the earliest of them, one row on the driver, lets
    the scan skip what is older for all stores.
    """
    reach = _reach(_days(spark, path), n)
    ends = reach.agg(F.min("since").alias("since"), F.max("undated").alias("undated")).first()
    rows = _rows(spark, path)
    if not ends["undated"] and ends["since"] is not None:
        rows = rows.filter(F.col(DAY) >= ends["since"])
    columns = [rows[name] for name in rows.columns if name not in _ADDED]
    # Rows without a time come last: a store that needs them needs all its rows.
    wanted = F.col("undated") | (F.col(DAY) >= F.col("since"))
    near = rows.join(reach, F.col("store_id").eqNullSafe(F.col("store")) & wanted).select(*columns)
    return recent_by_store(near, n, time)
