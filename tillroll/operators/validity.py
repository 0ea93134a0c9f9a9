"""Filter for usable transactions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import fixed

REQUIRED = ("transaction_id", "store_id", "timestamp")


def remove_invalid_records(df: DataFrame) -> DataFrame:
    """Keep rows with all required fields and an amount strictly inside the limits.

    Plain comparisons on source columns, so a Parquet scan receives all of them.
    """
    amount = F.col("total_amount")
    kept = (amount > fixed.AMOUNT_ABOVE) & (amount < fixed.AMOUNT_BELOW)
    for name in REQUIRED:
        kept = kept & F.col(name).isNotNull()
    return df.filter(kept)
