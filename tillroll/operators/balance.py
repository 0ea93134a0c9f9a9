"""How evenly a salt spreads rows, and what a row key would lose under upsert."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_balance(df: DataFrame, salt: Column) -> DataFrame:
    """Rows per salt, their share of all rows and their ratio to an even spread.

    The window runs over one row per salt value.
    """
    counts = df.groupBy(salt.alias("salt")).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()
    total = F.sum("rows").over(everything)
    salts = F.count(F.lit(1)).over(everything)
    return counts.select(
        "salt",
        "rows",
        (F.col("rows") / total).alias("share"),
        (F.col("rows") * salts / total).alias("to_even_spread"),
    ).orderBy("salt")


def _rows_per_key(df: DataFrame, key: str, identity: str) -> DataFrame:
    """Rows and distinct identities per key.

    Grouped by key and identity first: a key that holds a third of the rows is spread by
    its identities, and copies of one row shrink before the shuffle.
    """
    pairs = df.groupBy(key, identity).agg(F.count(F.lit(1)).alias("rows"))
    return pairs.groupBy(key).agg(F.sum("rows").alias("rows"), F.count(identity).alias("ids"))


def key_collisions(df: DataFrame, key: str, identity: str = "transaction_id") -> DataFrame:
    """Keys shared by several identities; under upsert all but one of them are lost."""
    return (
        _rows_per_key(df, key, identity)
        .filter(F.col("ids") > 1)
        .withColumn("ids_lost", F.col("ids") - 1)
    )


def collision_summary(df: DataFrame, key: str, identity: str = "transaction_id") -> DataFrame:
    """One row: rows, keys, keys with a collision, identities lost under upsert."""
    shared = F.col("ids") > 1
    return _rows_per_key(df, key, identity).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(shared).alias("shared_keys"),
        F.coalesce(F.sum(F.when(shared, F.col("ids") - 1)), F.lit(0)).alias("ids_lost"),
    )
