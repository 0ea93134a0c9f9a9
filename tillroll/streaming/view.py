"""Current rows of the log: the last write per row key, with compaction by partition.

<path>/base/version=V/period=P/salt=S/   current rows of a period and salt, as of version V
<path>/parts/version=V/                  the version that holds each period and salt, in V

A row key tells its salt and, by its second, its period, so whatever replaces a row is in the same
period and salt. A compaction writes those that have new rows; all others stay in the
folders of older versions. Files are sorted by event time, so a time range skips row groups.
One compaction at a time. Covered batches of the log, and folders that no parts table of
a version in use names, may be removed.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import fixed, schemas
from tillroll.operators.ranking import top_per_key
from tillroll.plans.history import as_text
from tillroll.sources.shared import discard, staged
from tillroll.streaming import journal
from tillroll.streaming.log import read_batches

Part = tuple[str, int]

#: Characters of a date that make the period of a base row.
GRAINS = {"day": 10, "month": 7}

_WRITE_ORDER = ("epoch", "batch_id", "seq", "event_time")
_CONTENT = fixed.EVENT_FIELDS
#: Bytes of new row keys that one join may broadcast, and how many such joins a view may have.
_BROADCAST_BYTES = 64 << 20
_BROADCASTS = 8
_KEY_BYTES = 64  # pointers and table of one key, without its text


def last_write(rows: DataFrame) -> DataFrame:
    """The last write per row key: by epoch, batch and place in the source.

    Sources without places fall back to event time and then the content, so the choice
    within one batch is at least always the same.
    """
    order = [F.col(name).desc_nulls_last() for name in (*_WRITE_ORDER, *_CONTENT)]
    return top_per_key(rows, ["rowkey"], order, 1)


def period_of(event_time: Column, grain: str) -> Column:
    """The day or month of a moment in UTC, whatever the session zone."""
    days = F.floor(F.unix_seconds(event_time) / 86_400).cast("int")
    return F.substring(F.date_from_unix_date(days).cast("string"), 1, GRAINS[grain])


def read_parts(spark: SparkSession, path: str, version: int | None) -> dict[Part, int]:
    """The version that holds each period and salt: a row per folder, nothing of the data."""
    if version is None:
        return {}
    rows = spark.read.schema(schemas.PARTS).parquet(f"{path}/parts/version={version}").collect()
    return {(row["period"], row["salt"]): row["held_by"] for row in rows}


def grain_of(parts: Iterable[Part], default: str = "day") -> str:
    """A table keeps the grain of its first compaction."""
    sizes = {size: name for name, size in GRAINS.items()}
    return next((sizes[len(period)] for period, _ in parts), default)


def read_base(spark: SparkSession, path: str, held: dict[Part, int]) -> DataFrame:
    """Base rows of these periods and salts, read by folder name."""
    if not held:
        return spark.createDataFrame([], schemas.BASE)
    folders = [f"{path}/base/version={v}/period={p}/salt={s}" for (p, s), v in held.items()]
    reader = spark.read.schema(schemas.BASE).option("basePath", f"{path}/base")
    return reader.parquet(*folders).select(*schemas.BASE.names)


def read_tail(spark: SparkSession, path: str, state: journal.State, grain: str) -> DataFrame:
    """Log rows after the base, in the columns of base rows."""
    rows = read_batches(spark, path, state.tail)
    return rows.withColumn("period", period_of(F.col("event_time"), grain)).select(*schemas.BASE.names)


def _inside(parts: Iterable[Part]) -> Column:
    names = [f"{period}/{salt}" for period, salt in parts]
    return F.concat_ws("/", "period", F.col("salt").cast("string")).isin(names)


@dataclass(frozen=True)
class _Group:
    """Periods and salts with new rows that are merged by one join."""

    parts: tuple[Part, ...]
    broadcast: bool


def _groups(tail: DataFrame) -> list[_Group]:
    """What the tail touches, in groups whose keys may be broadcast together. A period and salt with
    more new keys than that is a group of its own, which is joined by a shuffle."""
    size = F.sum(F.octet_length("rowkey") + _KEY_BYTES).alias("bytes")
    touched = tail.groupBy("period", "salt").agg(size).orderBy("period", "salt").collect()
    groups, open_parts, held = [], [], 0
    for row in touched:
        part = row["period"], row["salt"]
        if row["bytes"] > _BROADCAST_BYTES:
            groups.append(_Group((part,), broadcast=False))
            continue
        if held + row["bytes"] > _BROADCAST_BYTES:
            groups.append(_Group(tuple(open_parts), broadcast=True))
            open_parts, held = [], 0
        open_parts.append(part)
        held += row["bytes"]
    if open_parts:
        groups.append(_Group(tuple(open_parts), broadcast=True))
    return groups


def _unreplaced(spark, path: str, held: dict[Part, int], group: _Group, tail: DataFrame) -> DataFrame:
    """Base rows of a group that the tail does not replace. The base is scanned and not moved,
    as long as the group's new keys may be broadcast."""
    base = read_base(spark, path, {part: held[part] for part in group.parts if part in held})
    replaced = tail.filter(_inside(group.parts)).select("rowkey").distinct()
    if group.broadcast:
        replaced = F.broadcast(replaced)
    return base.join(replaced, "rowkey", "left_anti").select(*schemas.BASE.names)


def _held_together(groups: list[_Group]) -> list[_Group]:
    """The groups of one plan. Executors hold all its broadcasts at once, so beyond some number of
    groups the periods and salts of the others are joined by a shuffle, and nothing else is."""
    few = [group for group in groups if group.broadcast][:_BROADCASTS]
    rest = [part for group in groups if group not in few for part in group.parts]
    return [*few, *([_Group(tuple(rest), broadcast=False)] if rest else [])]


def current_rows(spark: SparkSession, path: str, state: journal.State | None = None) -> DataFrame:
    """The last write per row key of all finished batches, in the columns of base rows.

    Every batch after the base is later than all of it, so a key in the tail replaces the
    base row. Periods and salts without new rows are scanned as they are.
    """
    state = state or journal.read_state(spark, path)
    held = read_parts(spark, path, state.version)
    tail = read_tail(spark, path, state, grain_of(held))
    rows = last_write(tail)
    if not held:
        return rows
    groups = _groups(tail) if state.tail else []
    touched = {part for group in groups for part in group.parts}
    untouched = {part: version for part, version in held.items() if part not in touched}
    rows = rows.unionByName(read_base(spark, path, untouched))
    for group in _held_together(groups):
        if any(part in held for part in group.parts):
            rows = rows.unionByName(_unreplaced(spark, path, held, group, tail))
    return rows


def current_view(spark: SparkSession, path: str) -> DataFrame:
    """Row key, event fields and event time of the last write per row key."""
    rows = current_rows(spark, path)
    return rows.select("rowkey", *fixed.EVENT_FIELDS, "event_time", "salt")


def serving_text(view: DataFrame) -> DataFrame:
    """The view in the text layout of the serving table."""
    return as_text(view.select("rowkey", "store_id", "timestamp", "total_amount"))


def compact(spark: SparkSession, path: str, grain: str = "day") -> int | None:
    """Merge the tail into the base and return the number of the newest version.

    Only periods and salts with new rows are written, a group of them at a time, so that no more
    than one group's keys are broadcast at once. Without new batches nothing is done. `grain`
    counts for the first compaction of a table.
    """
    state = journal.read_state(spark, path)
    if not state.tail:
        return state.version
    held = read_parts(spark, path, state.version)
    target = 0 if state.version is None else state.version + 1
    tail = read_tail(spark, path, state, grain_of(held, grain))
    new = staged(last_write(tail), "last-writes")
    groups = _groups(new)
    # An attempt that broke off left folders of this version behind; the first write removes them.
    mode = "overwrite"
    for group in groups:
        rows = new.filter(_inside(group.parts))
        if any(part in held for part in group.parts):
            rows = rows.unionByName(_unreplaced(spark, path, held, group, new))
        (
            rows.hint("rebalance", "period", "salt")
            .sortWithinPartitions("period", "salt", "event_time", "rowkey")
            .write.mode(mode)
            .partitionBy("period", "salt")
            .parquet(f"{path}/base/version={target}")
        )
        mode = "append"
    now = {**held, **{part: target for group in groups for part in group.parts}}
    parts = spark.createDataFrame([(*part, version) for part, version in now.items()], schemas.PARTS)
    parts.coalesce(1).write.mode("overwrite").parquet(f"{path}/parts/version={target}")
    journal.fold(spark, path, state, target)
    discard(new)
    return target
