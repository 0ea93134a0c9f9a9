"""Store ranking that refreshes while events arrive."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import fixed
from tillroll.operators.events import decode_events
from tillroll.operators.row_keys import with_key_stream
from tillroll.plans.sales import store_leaderboard
from tillroll.sources.shared import matching

_STORE = "spark.sql.streaming.stateStore"
#: Every key stands in the state for the watermark's delay, and once more for its slice: as many as
#: arrive in that time, which no executor's memory is sure to hold. RocksDB keeps them on disk, with
#: one bounded cache for all partitions of an executor.
_STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "400",
    # A batch sends its changes, not whole files that are soon merged into others.
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.compression": "zstd",
    # Costs a lookup for each write, for a figure that nothing here reads.
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def live_leaderboard(
    stream: DataFrame, watermark: str = "1 hour", spread: int = 8, zone: str | None = None
) -> DataFrame:
    """Streaming store ranking over wire events, for output mode "complete".

    Repeats of a row key count once while they arrive within `watermark` of the first; later ones
    count again, which keeps the state bounded. The watermark follows the time of arrival, which
    Spark fixes for each batch, so an event counts however old it is. The first write of a
    key counts, so a corrected amount does not show here: `ranking` keeps the exact ranking of an
    ingested table. A key is first reduced within `spread` groups of source tasks, so a key that
    fills a large part of a batch does not go to one task whole.
    """
    good, _ = decode_events(stream, zone)
    keyed = (
        with_key_stream(good, time="event_time")
        .select("store_id", "total_amount", "rowkey")
        .withColumn("arrived", F.current_timestamp())
        .withWatermark("arrived", watermark)
    )
    if spread > 1:
        keyed = (
            keyed.withColumn("slice", F.spark_partition_id() % spread)
            .dropDuplicatesWithinWatermark(["rowkey", "slice"])
            .drop("slice")
        )
    return store_leaderboard(keyed.dropDuplicatesWithinWatermark(["rowkey"]))


def start_live_leaderboard(
    ranking: DataFrame,
    path: str,
    checkpoint: str,
    epoch: int,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write every refresh of the ranking to its own folder `<path>/epoch=E/refresh=N`.

    Refreshes are numbered from 0 by each checkpoint: a new one needs a new, higher `epoch`.
    State is kept on the executors' disks, unless the session names another store; a checkpoint
    that was begun with another one goes on with it.
    """

    def write(refresh: DataFrame, number: int) -> None:
        target = f"{path}/epoch={epoch}/refresh={number}"
        refresh.coalesce(1).write.mode("overwrite").parquet(target)

    writer = (
        ranking.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": fixed.TRIGGER_INTERVAL}))
    )
    # A query keeps the settings that its session has when it starts.
    conf = ranking.sparkSession.conf
    added = [name for name in _STATE if conf.get(name, None) is None]
    for name in added:
        conf.set(name, _STATE[name])
    try:
        return writer.start()
    finally:
        for name in added:
            conf.unset(name)


def _newest_first(folders: list[str]) -> list[str]:
    return sorted(folders, key=lambda x: int(x.rpartition("=")[2]), reverse=True)


def newest_ranking(spark: SparkSession, path: str) -> DataFrame:
    """The latest finished refresh of the highest epoch that has one, in rank order. Folders
    are listed by name; only that of the refresh is opened."""
    for epoch in _newest_first(matching(spark, f"{path}/epoch=*")):
        for refresh in _newest_first(matching(spark, f"{epoch}/refresh=*")):
            if matching(spark, f"{refresh}/*.parquet"):
                ranking = spark.read.parquet(refresh)
                return ranking.orderBy(F.col(fixed.RANK_REVENUE).desc(), "store_id")
    raise ValueError(f"no finished refresh in {path}")
