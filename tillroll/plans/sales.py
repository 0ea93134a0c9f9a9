"""Sales queries."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import fixed
from tillroll.functions.amounts import EXACT, exact_amount
from tillroll.operators.ranking import top_per_key, total_order

LEADERBOARD_SQL = f"""
SELECT store_id,
       COUNT(*) AS {fixed.RANK_COUNT},
       SUM(TRY_CAST(total_amount AS {EXACT})) AS {fixed.RANK_REVENUE}
FROM {{table}}
GROUP BY store_id
ORDER BY {fixed.RANK_REVENUE} DESC, store_id
"""


def daily_groups(df: DataFrame) -> DataFrame:
    """Daily sales in no particular order.

    Grouped by payment method first. That level is plain hash aggregation with map-side
    merging, also for a store-day that holds a large share of the rows; collecting a set
    directly would switch to sorting once a task meets more than a few groups.
    """
    amount = F.col("total_amount")
    amount_type = df.schema["total_amount"].dataType
    inexact = isinstance(amount_type, (T.DoubleType, T.FloatType))
    if inexact:
        # Summed exactly, so that totals do not depend on the order of merging.
        amount = exact_amount(df, "total_amount")
    by_method = df.groupBy("store_id", "transaction_date", "payment_method").agg(
        F.count("transaction_id").alias("transactions"),
        F.sum(amount).alias("revenue"),
        F.count(amount).alias("amounts"),
    )
    revenue = F.sum("revenue")
    average = F.try_divide(revenue, F.sum("amounts"))
    if inexact:
        revenue, average = revenue.cast("double"), average.cast("double")
    if isinstance(amount_type, T.DecimalType):
        # The types Spark gives to a sum and an average of this decimal.
        precision, scale = amount_type.precision, amount_type.scale
        average = average.cast(T.DecimalType(min(precision + 4, 38), min(scale + 4, 38)))
        revenue = revenue.cast(T.DecimalType(min(precision + 10, 38), scale))
    return by_method.groupBy("store_id", "transaction_date").agg(
        F.sum("transactions").alias("transaction_count"),
        revenue.alias("total_revenue"),
        average.alias("avg_transaction_value"),
        F.sort_array(F.collect_set("payment_method")).alias("payment_methods"),
    )


def daily_sales(df: DataFrame) -> DataFrame:
    """Per store and day: transactions, revenue, average amount and payment methods."""
    return daily_groups(df).orderBy("store_id", "transaction_date")


def store_leaderboard(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Transactions and revenue per store, highest revenue first.

    Amounts may be numbers or text; they are summed as exact decimals.
    """
    ranked = (
        df.groupBy("store_id")
        .agg(
            F.count(F.lit(1)).alias(fixed.RANK_COUNT),
            F.sum(exact_amount(df, "total_amount")).alias(fixed.RANK_REVENUE),
        )
        .orderBy(F.col(fixed.RANK_REVENUE).desc(), "store_id")
    )
    return ranked if limit is None else ranked.limit(limit)


def store_leaderboard_sql(df: DataFrame, table: str = "transactions") -> DataFrame:
    """The same ranking as SQL over a temporary view, which stays registered."""
    df.createOrReplaceTempView(table)
    return df.sparkSession.sql(LEADERBOARD_SQL.format(table=table))


def recent_by_store(df: DataFrame, n: int, time: str = "timestamp") -> DataFrame:
    """The `n` latest transactions of every store; equal times follow the other columns."""
    order = total_order(df, [F.col(time).desc_nulls_last()], ("store_id", time))
    return top_per_key(df, ["store_id"], order, n)


def store_day(df: DataFrame, store: str, date: datetime.date | str) -> DataFrame:
    """One store on one day.

    On a history table the date picks the folder, and day and store skip row groups,
    because files are sorted by them.
    """
    day = F.lit(str(date)).cast("date")
    on_day = (
        F.col("transaction_date") if "transaction_date" in df.columns else F.to_date("timestamp")
    )
    found = df.filter((F.col("store_id") == store) & (on_day == day))
    if "transaction_month" in df.columns:
        found = found.filter(F.col("transaction_month") == str(date)[:7])
    return found
