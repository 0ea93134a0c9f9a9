"""Historical batch load into a table partitioned by day or month.

A folder should hold at least a file of full size: by day for tens of terabytes, by month
for less. Inside a folder rows are sorted by day and store, so a lookup skips row groups.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.operators.row_keys import with_key_batch
from tillroll.plans.cleaning import clean_transactions
from tillroll.plans.sales import daily_groups
from tillroll.sources.csv import read_transactions_csv

DAY = "transaction_date"
MONTH = "transaction_month"
GRAINS = {"day": DAY, "month": MONTH}

# Target column -> source column of the serving table. `customer_id` is optional.
SERVING_COLUMNS = {
    "rowkey": "rowkey",
    "store_id": "store_id",
    "amount": "total_amount",
    "payment": "payment_method",
    "customer_id": "customer_id",
    "timestamp": "timestamp",
}
OPTIONAL_COLUMNS = ("customer_id",)


def serving_rows(df: DataFrame, columns: Mapping[str, str] = SERVING_COLUMNS) -> DataFrame:
    """Rename to the serving layout; a missing source column fails before any write."""
    missing = [
        source
        for source in columns.values()
        if source not in df.columns and source not in OPTIONAL_COLUMNS
    ]
    if DAY not in df.columns:
        missing.append(DAY)
    if missing:
        raise ValueError(f"no column {', '.join(missing)} to load")
    return df.select(
        *[F.col(source).alias(name) for name, source in columns.items() if source in df.columns],
        *([] if DAY in columns else [F.col(DAY)]),
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the form in which a key-value store holds its cells."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])


def _period(grain: str) -> Column:
    return F.date_format(DAY, "yyyy-MM") if grain == "month" else F.col(DAY)


def _write_by_period(
    rows: DataFrame, path: str, grain: str, mode: str, parts: int | None, **options: str
) -> int:
    """Write rows that have a day, one folder per period, and count them in the same pass.

    `rebalance` lets Spark divide a large period between tasks and merge small ones, from
    the sizes it measures; `parts` sets the shuffle partitions it starts with.
    """
    folder = GRAINS[grain]
    rows = rows.withColumn(folder, _period(grain))
    inside = [name for name in (DAY, "store_id", "rowkey") if name in rows.columns]
    counted = Observation("written")
    (
        rows.hint("rebalance", *([] if parts is None else [parts]), folder)
        .sortWithinPartitions(folder, *inside)
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .options(**options)
        .partitionBy(folder)
        .parquet(path)
    )
    return counted.get["rows"]


def load_history(
    df: DataFrame,
    path: str,
    columns: Mapping[str, str] = SERVING_COLUMNS,
    partitions: int | None = None,
    grain: str = "day",
) -> int:
    """Append to the history table and return the number of rows written."""
    return _write_by_period(serving_rows(df, columns), path, grain, "append", partitions)


def process_history(
    spark: SparkSession,
    csv_path: str,
    path: str,
    schema: T.StructType = schemas.TRANSACTION,
    tie_break: Sequence[Column] = (),
    partitions: int | None = None,
    grain: str = "day",
) -> int:
    """CSV files to cleaned, keyed rows in the history table; returns the rows written."""
    cleaned = clean_transactions(read_transactions_csv(spark, csv_path, schema), tie_break)
    return load_history(with_key_batch(cleaned), path, partitions=partitions, grain=grain)


def save_daily_sales(df: DataFrame, path: str, grain: str = "day") -> int:
    """Keep daily sales as a small table of its own; returns the rows written."""
    return _write_by_period(daily_groups(df), path, grain, "overwrite", None)


def refresh_daily_sales(df: DataFrame, changed: DataFrame, path: str, grain: str = "day") -> int:
    """Compute the daily sales of the periods that `changed` rows are in, from all their rows in
    `df`; returns the rows written. All other periods keep their files.

    The periods are collected, a value per folder; on a history table they prune its folders.
    Spark replaces the folders of the periods it writes, and each only when the job is done.
    """
    periods = [row[0] for row in changed.select(_period(grain)).distinct().collect()]
    period = F.col(MONTH) if grain == "month" and MONTH in df.columns else _period(grain)
    rows = df.filter(period.isin(periods) if periods else F.lit(False)).drop(MONTH)
    return _write_by_period(
        daily_groups(rows), path, grain, "overwrite", None, partitionOverwriteMode="dynamic"
    )
