"""Exact store ranking that goes on batch by batch.

<path>/ranking/epoch=E/batch_id=N/   transactions and revenue per store after that batch

A batch changes the ranking by its own last writes, less the rows they replace: a corrected amount
takes back the old one. Replaced rows are looked up where they can be: in the periods and salts of
the batch, between its first and last event time, since a row key contains the second. The ranking
of a batch is written before its journal entry, so a retry writes the same one again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import fixed, schemas
from tillroll.functions.amounts import exact_amount
from tillroll.plans.sales import store_leaderboard
from tillroll.sources.shared import matching, remove
from tillroll.streaming import journal, view

_BROADCAST_ROWS = 500_000


def _snapshot(spark: SparkSession, path: str, batch: journal.Batch) -> DataFrame:
    folder = f"{path}/ranking/{journal.folder_of(batch)}"
    if not matching(spark, f"{folder}/_SUCCESS"):
        raise ValueError(f"no ranking after batch {batch[1]} of epoch {batch[0]} in {path}")
    return spark.read.schema(schemas.RANKING).parquet(folder)


def _before(spark: SparkSession, path: str, state: journal.State) -> DataFrame:
    """The ranking that a batch goes on from. A table that was not ranked so far is ranked once."""
    if state.newest is None:
        return spark.createDataFrame([], schemas.RANKING)
    try:
        return _snapshot(spark, path, state.newest)
    except ValueError:
        return store_leaderboard(view.current_rows(spark, path, state)).select(*schemas.RANKING.names)


def changes(
    spark: SparkSession, path: str, batch: journal.Batch, state: journal.State, figures: Mapping
) -> DataFrame:
    """What a written batch adds to the ranking of the rows that were current in `state`."""
    held = view.read_parts(spark, path, state.version)
    grain = view.grain_of(held)
    alone = journal.State(state.version, state.covered, (batch,))
    new = view.last_write(view.read_tail(spark, path, alone, grain))
    touched = {(r["period"], r["salt"]) for r in new.select("period", "salt").distinct().collect()}
    between = (F.col("event_time") >= figures["first_event"]) & (F.col("event_time") <= figures["last_event"])
    base = view.read_base(spark, path, {part: v for part, v in held.items() if part in touched})
    older = base.filter(between).unionByName(view.read_tail(spark, path, state, grain).filter(between))
    keys = new.select("rowkey")
    if figures["rows"] <= _BROADCAST_ROWS:
        keys = F.broadcast(keys)
    replaced = view.last_write(older.join(keys, "rowkey", "left_semi").select(*schemas.BASE.names))

    def amounts(rows: DataFrame, name: str) -> DataFrame:
        exact = F.coalesce(exact_amount(rows, "total_amount"), F.lit(0)).cast("decimal(38,10)")
        return rows.select("rowkey", "store_id", exact.alias(name))

    both = amounts(new, "now").join(amounts(replaced, "once").drop("store_id"), "rowkey", "left")
    return both.groupBy("store_id").agg(
        F.count_if(F.col("once").isNull()).alias(fixed.RANK_COUNT),
        F.sum(F.col("now") - F.coalesce("once", F.lit(0))).cast("decimal(38,10)").alias(fixed.RANK_REVENUE),
    )


def write_next(
    spark: SparkSession, path: str, batch: journal.Batch, state: journal.State, figures: Mapping
) -> None:
    """Write the ranking after `batch`, whose rows are in the log and not in the journal yet."""
    ranking = _before(spark, path, state)
    if figures["rows"]:
        ranking = ranking.unionByName(changes(spark, path, batch, state, figures))
    ranking = ranking.groupBy("store_id").agg(
        F.sum(fixed.RANK_COUNT).alias(fixed.RANK_COUNT),
        F.sum(fixed.RANK_REVENUE).cast("decimal(38,10)").alias(fixed.RANK_REVENUE),
    )
    ranking.write.mode("overwrite").parquet(f"{path}/ranking/{journal.folder_of(batch)}")


def remove_old(spark: SparkSession, path: str, kept: set[journal.Batch | None]) -> None:
    """Remove all rankings but these."""
    folders = matching(spark, f"{path}/ranking/epoch=*/batch_id=*")
    remove(spark, [x for x in folders if journal.batch_of(x) not in kept])


def exact_ranking(spark: SparkSession, path: str) -> DataFrame:
    """The ranking of the current rows after the last finished batch, in rank order: the same as
    ranking the current view, without reading it."""
    newest = journal.read_state(spark, path).newest
    if newest is None:
        return spark.createDataFrame([], schemas.RANKING)
    ranking = _snapshot(spark, path, newest)
    return ranking.orderBy(F.col(fixed.RANK_REVENUE).desc(), "store_id")
