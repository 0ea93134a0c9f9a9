"""The journal of finished batches, and what compactions have folded away.

<path>/journal/epoch=E/batch_id=N/   one row, written when the batch is whole
<path>/folded/version=V/             the entries that version V is the first to cover, one file
<path>/manifest/version=V/           per epoch the last batch in V, written last of all

Batches of an epoch finish in order, so one number per epoch says what is covered. The tail, all
entries after it, is found by folder names and read by name: reading costs what came since
the last compaction, whatever the age of the table. A compaction removes the entries that
it folded, after its manifest; whoever was reading the state just then reads it again.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillroll import schemas
from tillroll.sources.shared import matching, remove

Batch = tuple[int, int]

_BATCH = re.compile(r"epoch=(\d+)/batch_id=(\d+)$")


@dataclass(frozen=True)
class State:
    """The newest base version, the last batch in it per epoch, and the finished batches after it."""

    version: int | None
    covered: Mapping[int, int]
    tail: tuple[Batch, ...]

    @property
    def newest(self) -> Batch | None:
        """The last finished batch of the highest epoch."""
        return max([*self.covered.items(), *self.tail], default=None)

    def covers(self, batch: Batch) -> bool:
        return batch[1] <= self.covered.get(batch[0], -1)


def folder_of(batch: Batch) -> str:
    return f"epoch={batch[0]}/batch_id={batch[1]}"


def batch_of(folder: str) -> Batch:
    epoch, batch_id = _BATCH.search(folder).groups()
    return int(epoch), int(batch_id)


def _entries(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schemas.JOURNAL)
    reader = spark.read.schema(schemas.JOURNAL).option("basePath", f"{path}/journal")
    return reader.parquet(*folders)


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The highest version whose manifest is whole."""
    numbers = [int(x.rpartition("=")[2]) for x in matching(spark, f"{path}/manifest/version=*")]
    for number in sorted(numbers, reverse=True):
        if matching(spark, f"{path}/manifest/version={number}/*.parquet"):
            return number
    return None


def read_state(spark: SparkSession, path: str) -> State:
    """What is finished now. The driver gets a row per epoch and per batch of the tail."""
    while True:
        version = newest_version(spark, path)
        try:
            state, failure = _state_of(spark, path, version), None
        except AnalysisException as error:
            state, failure = None, error
        # Entries go only after a new manifest: with the same one, none was missed.
        if newest_version(spark, path) == version:
            if failure is not None:
                raise failure
            return state


def _state_of(spark: SparkSession, path: str, version: int | None) -> State:
    covered = {}
    if version is not None:
        manifest = spark.read.parquet(f"{path}/manifest/version={version}")
        covered = {row["epoch"]: row["batch_id"] for row in manifest.collect()}
    known = State(version, covered, ())
    folders = [x for x in matching(spark, f"{path}/journal/epoch=*/batch_id=*") if not known.covers(batch_of(x))]
    # A folder may be there without its row: then the batch is not finished.
    rows = _entries(spark, path, folders).select("epoch", "batch_id").collect()
    return State(version, covered, tuple(sorted((row["epoch"], row["batch_id"]) for row in rows)))


def read_journal(spark: SparkSession, path: str, state: State | None = None) -> DataFrame:
    """One row per finished batch of the table's whole life."""
    state = state or read_state(spark, path)
    tail = _entries(spark, path, [f"{path}/journal/{folder_of(x)}" for x in state.tail])
    if state.version is None:
        return tail
    # Later versions may be there unfinished. `version` is read from the folder names.
    folded = spark.read.schema(schemas.JOURNAL).parquet(f"{path}/folded")
    folded = folded.filter(F.col("version") <= state.version).select(*schemas.JOURNAL.names)
    return folded.unionByName(tail)


def write_entry(spark: SparkSession, path: str, batch: Batch, entry: Mapping[str, object]) -> None:
    """Make a batch count as finished."""
    fields = [schemas.JOURNAL[name] for name in entry]
    row = spark.range(1, numPartitions=1).select(
        *(F.lit(entry[f.name]).cast(f.dataType).alias(f.name) for f in fields)
    )
    row.write.mode("overwrite").parquet(f"{path}/journal/{folder_of(batch)}")


def fold(spark: SparkSession, path: str, state: State, version: int) -> None:
    """Let `version` cover the tail: its entries go to one file, the manifest is written, and then
    they go from the journal."""
    tail = _entries(spark, path, [f"{path}/journal/{folder_of(x)}" for x in state.tail])
    tail.coalesce(1).write.mode("overwrite").parquet(f"{path}/folded/version={version}")
    covered = dict(state.covered)
    for epoch, batch_id in state.tail:
        covered[epoch] = max(batch_id, covered.get(epoch, -1))
    manifest = spark.createDataFrame(list(covered.items()), "epoch long, batch_id long")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    old = matching(spark, f"{path}/journal/epoch=*/batch_id=*")
    now = State(version, covered, ())
    remove(spark, [x for x in old if now.covers(batch_of(x))])
