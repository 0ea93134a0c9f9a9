"""Stream ingest into a log of immutable micro-batches.

<path>/log/epoch=E/batch_id=N/status=ok|rejected/salt=S/   rows of one micro-batch

A batch without a journal entry is invisible to readers and is written anew by a retry; a
batch with one is never touched again. An epoch is one life of a checkpoint: whoever
starts over with a new checkpoint passes a higher epoch, since batch numbers restart. One
stream writes to a table at a time, and no stream goes back to an earlier epoch.
"""

import datetime
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import fixed, schemas
from tillroll.functions.amounts import EXACT
from tillroll.functions.keys import stream_salt
from tillroll.operators.events import REASON, annotate_events
from tillroll.operators.row_keys import with_key_stream
from tillroll.sources.shared import matching
from tillroll.streaming import journal, ranking
from tillroll.streaming.log import OK, REJECTED, read_batches, read_log  # noqa: F401


def log_rows(events: DataFrame, zone: str | None = None) -> DataFrame:
    """Wire rows as log rows: decoded, keyed, salted, with rejects marked.

    Rejects keep their text; they are salted by it, so many of them spread like good rows.
    """
    rows = with_key_stream(annotate_events(events, zone), time="event_time")
    rejected = F.col(REASON).isNotNull()
    salted_by = F.when(rejected, F.coalesce("value", F.lit(""))).otherwise(F.col("transaction_id"))
    return rows.withColumns(
        {
            "status": F.when(rejected, REJECTED).otherwise(OK),
            "salt": stream_salt(salted_by),
            "rowkey": F.when(~rejected, F.col("rowkey")),
            "value": F.when(rejected, F.col("value")),
        }
    )


def create_table(spark: SparkSession, path: str) -> None:
    """Make the empty table at `path`; leaves one that exists as it is."""
    for kind, schema, folders in (
        ("log", schemas.LOG, ["epoch", "batch_id", "status", "salt"]),
        ("journal", schemas.JOURNAL, ["epoch", "batch_id"]),
        ("manifest", schemas.MANIFEST, ["version"]),
    ):
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").partitionBy(*folders).parquet(f"{path}/{kind}")


def _write_batch(
    batch: DataFrame, path: str, epoch: int, batch_id: int, state: journal.State | None = None
) -> None:
    """Write one batch, then its entry. Figures are observed while rows are written; only the
    stores are counted after it, on that one column. With `state`, what was finished before,
    the store ranking goes on with this batch."""
    spark = batch.sparkSession
    folder = f"{path}/log/{journal.folder_of((epoch, batch_id))}"
    started = datetime.datetime.now(datetime.timezone.utc)
    counted = Observation(f"epoch {epoch} batch {batch_id}")
    kept = [name for name in schemas.LOG.names if name not in ("epoch", "batch_id")]
    good = F.col("status") == OK
    (
        batch.withColumn("ingested_at", F.lit(started))
        .select(*kept)
        .hint("rebalance", "status", "salt")
        .observe(
            counted,
            F.count_if(good).alias("rows"),
            F.count_if(F.col("status") == REJECTED).alias("rejected"),
            F.sum(F.when(good, F.col("total_amount").try_cast(EXACT))).alias("amount"),
            F.min(F.when(good, F.unix_micros("event_time"))).alias("first_event"),
            F.max(F.when(good, F.unix_micros("event_time"))).alias("last_event"),
        )
        .write.mode("overwrite")
        .partitionBy("status", "salt")
        .parquet(folder)
    )
    figures = counted.get
    for name in ("first_event", "last_event"):
        figures[name] = _moment(figures[name])
    stores = 0
    if figures["rows"]:
        stores = read_batches(spark, path, [(epoch, batch_id)]).select("store_id").distinct().count()
    if state is not None:
        ranking.write_next(spark, path, (epoch, batch_id), state, figures)
    finished = datetime.datetime.now(datetime.timezone.utc)
    entry = {**figures, "stores": stores, "started_at": started, "finished_at": finished}
    journal.write_entry(spark, path, (epoch, batch_id), entry)
    if state is not None:
        ranking.remove_old(spark, path, {(epoch, batch_id), state.newest})


def _moment(micros: int | None) -> datetime.datetime | None:
    if micros is None:
        return None
    start = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    return start + datetime.timedelta(microseconds=micros)


def batch_writer(path: str, epoch: int, ranked: bool = False) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` callback. It lets every error stop the query: a batch that was
    not written must not count as done.

    A batch that the journal already lists is left alone: it was finished just before a
    stop, and only the checkpoint did not hear of it. The journal is looked at once per
    start, since later batches cannot be in it; a ranked table asks it for every batch.
    A table that was removed since the first batch is not made again: the query stops.
    """
    finished: int | None = None

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal finished
        state = None
        if finished is not None and not matching(batch.sparkSession, f"{path}/journal"):
            raise ValueError(f"the table {path} was removed")
        if finished is None or ranked:
            state = journal.read_state(batch.sparkSession, path)
            newest = state.newest
            if newest is not None and newest[0] > epoch:
                raise ValueError(f"the table is in epoch {newest[0]} already, not in {epoch}")
            finished = newest[1] if newest is not None and newest[0] == epoch else -1
        if batch_id > finished:
            _write_batch(batch, path, epoch, batch_id, *([state] if ranked else []))

    return write


def query_name(path: str) -> str:
    """The name of the query that writes the table; Spark runs no two of one name in a session."""
    return f"ingest {path.rstrip('/')}"


def start_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    epoch: int,
    trigger: Mapping[str, object] | None = None,
    zone: str | None = None,
    ranked: bool = False,
) -> StreamingQuery:
    """Run a wire stream into the log at `path`; the caller awaits or stops the query.

    `trigger` takes the arguments of `DataStreamWriter.trigger`. Rows are written by the
    executors; large batches are divided between tasks, small salts share one. `ranked` keeps the
    exact store ranking of the current rows, see `ranking`.
    """
    create_table(stream.sparkSession, path)
    return (
        log_rows(stream, zone)
        .writeStream.queryName(query_name(path))
        .foreachBatch(batch_writer(path, epoch, ranked))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": fixed.TRIGGER_INTERVAL}))
        .start()
    )
