"""The given tables seen as raw transactions, sales rows and wire events.

Used by the registered queries, the tests and the benchmark; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANGE_BYTES = 8 << 20  # of the stored table, in one range of sales rows
_LEAST_RANGE_BYTES = 256 << 10
SALES_ORDER = ("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")

# format_string('store_%03d', ...) as padding, which costs less a row; it prints null as a word.
_STORE = (
    "CASE WHEN l_partkey < 0 THEN format_string('store_%03d', l_partkey % 100 + 1) "
    "ELSE coalesce(concat('store_', lpad(CAST(l_partkey % 100 + 1 AS STRING), 3, '0')), 'store_null') END"
)

# Raw transactions as a CSV reader has to declare them for exact comparisons.
EXACT_TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("total_amount", T.DecimalType(20, 4)),
        T.StructField("payment_method", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as raw transactions, with real duplicates and zero amounts."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS transaction_id",
        f"{_STORE} AS store_id",
        "l_shipdate + make_dt_interval(0, CAST(l_orderkey % 14 + 8 AS INT), "
        "CAST(l_orderkey % 60 AS INT), l_orderkey % 60) AS timestamp",
        # A row of its own, so that filters on the amount do not compute it again.
        "inline(array(named_struct('total_amount', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) "
        "* CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(20,4)))))",
        "CASE WHEN l_returnflag = 'A' THEN 'cash' WHEN l_returnflag = 'R' THEN 'credit' "
        "WHEN l_linestatus = 'O' THEN 'wallet' ELSE 'Cheque' END AS payment_method",
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` with nulls in every required column and amounts outside the limits."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_quantity = 1 THEN NULL "
        "ELSE concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) END AS transaction_id",
        "CASE WHEN l_tax = 0.08 THEN NULL "
        f"ELSE {_STORE} END AS store_id",
        "CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL ELSE l_shipdate END AS timestamp",
        "CASE WHEN l_discount = 0 THEN 0D WHEN l_discount = 0.01 THEN -l_extendedprice "
        "WHEN l_discount = 0.02 THEN CAST('NaN' AS DOUBLE) WHEN l_discount = 0.03 THEN l_extendedprice * 20 "
        "ELSE l_extendedprice END AS total_amount",
    )


def colliding(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows and, again, all of them at the start of their day with ids that end alike: the
    sales of a store on one day get the same salted key and the same batch key."""
    again = cleaned.withColumn("transaction_id", F.concat("transaction_id", F.lit("_resent_")))
    day = F.date_trunc("day", "timestamp").cast(cleaned.schema["timestamp"].dataType)
    return cleaned.unionByName(again.withColumn("timestamp", day))


def quoted_sales_rows(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Sales rows whose customers have a quote, a comma and a line break in their name."""
    name = "concat(substring(customer_id, 1, 3), '\"', decode(X'0A', 'UTF-8'), ',', customer_id)"
    return sales_rows(spark, sf_dir, ordered=ordered).withColumn("customer_id", F.expr(name))


def odd_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` with unusual store codes and every payment spelling."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS transaction_id",
        "CASE l_linenumber % 3 WHEN 0 THEN concat('a-z0-9_', CAST(l_partkey % 100 AS STRING)) "
        "WHEN 1 THEN concat('store-', CAST(l_partkey % 100 AS STRING), ' !') "
        "ELSE concat('store_', CAST(l_partkey % 100 AS STRING)) END AS store_id",
        "CASE CAST(l_orderkey % 11 AS INT) WHEN 0 THEN 'CASH' WHEN 1 THEN 'cash' WHEN 2 THEN 'Cash' "
        "WHEN 3 THEN 'CARD' WHEN 4 THEN 'card' WHEN 5 THEN 'credit' WHEN 6 THEN 'CREDIT' "
        "WHEN 7 THEN 'MOBILE' WHEN 8 THEN 'mobile' WHEN 9 THEN 'wallet' ELSE NULL END AS payment_method",
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) "
        "AS DECIMAL(20,4)) AS total_amount",
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows in the order of sales, in ranges of a moderate size, a few for each core."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = rows.sparkSession.sparkContext.defaultParallelism
    ranges = max(size // _RANGE_BYTES, min(size // _LEAST_RANGE_BYTES, 3 * cores)) + 1
    return rows.repartitionByRange(ranges, *SALES_ORDER).sortWithinPartitions(*SALES_ORDER)


def sales_rows(
    spark: SparkSession, sf_dir: str, bad_prices: bool = False, ordered: bool = False
) -> DataFrame:
    """`lineitem` as sales rows, with its order columns; article numbers are not all numeric.

    `ordered` sorts the narrow rows of the table, before texts are made of them.
    """
    price = "CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.000001BD AS DECIMAL(20,8)) AS STRING)"
    if bad_prices:
        price = f"CASE WHEN l_linenumber = 6 THEN concat('EUR ', {price}) ELSE {price} END"
    rows = table(spark, sf_dir, "lineitem").select(*SALES_ORDER, "l_partkey")
    return (_in_order(rows) if ordered else rows).selectExpr(
        *SALES_ORDER,
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS t_dat",
        "md5(CAST(l_orderkey AS STRING)) AS customer_id",
        "CASE WHEN l_linenumber = 7 THEN concat('NA', CAST(l_partkey AS STRING)) "
        "ELSE CAST(l_partkey AS STRING) END AS article_id",
        f"{price} AS price",
    )


def pos_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as point-of-sale events."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws("_", "user_id", "event_id").alias("transaction_id"),
        F.format_string("STORE_%03d", F.col("user_id") % 100 + 1).alias("store_id"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("timestamp"),
        F.col("value").alias("total_amount"),
        "event_id",
        "user_id",
        "event_type",
    )


def faulty_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as JSON text; seven rows in fifty are broken, each kind in its own way."""
    events = pos_events(spark, sf_dir)
    kind = F.col("event_id") % 50
    transaction = F.format_string('"transaction_id":"%s"', "transaction_id")
    store = F.format_string('"store_id":"%s"', "store_id")
    time = F.format_string('"timestamp":"%s"', "timestamp")
    number = F.col("total_amount").cast("string")
    amount = F.concat(F.lit('"total_amount":'), number)

    def text(*fields):
        return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))

    return events.select(
        "event_id",
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, text(transaction, time, amount))
        .when(kind == 2, text(transaction, store, time, F.concat(F.lit('"total_amount":"'), number, F.lit('"'))))
        .when(kind == 3, text(transaction, store, time, F.lit('"total_amount":NaN')))
        .when(kind == 4, text(transaction, store, time, F.concat(F.lit('"total_amount":-'), number)))
        .when(kind == 5, text(transaction, store, F.lit('"timestamp":"2024-13-45 08:00:00"'), amount))
        .when(kind == 6, text(store, time, amount))
        .when(kind == 7, F.lit(None))
        .otherwise(text(transaction, store, time, amount, F.lit('"till":4')))
        .alias("value"),
    )
