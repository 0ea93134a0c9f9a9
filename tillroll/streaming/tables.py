"""An ingested table and a history table in the session's catalog, for SQL by name.

<name>_log    rows of finished batches, rejects among them
<name>_base   current rows as of the newest compaction

Tables are external. Their partitions are those folders that count, so a batch that is not
finished and a base folder that was replaced are never read; `refresh_tables` brings them up
to date. Rows that came after the newest compaction are in the log alone: `view.current_view` has both.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.plans import history
from tillroll.sources.shared import matching, remove
from tillroll.streaming import ingest, journal, view

_LOG_FOLDERS = ("epoch", "batch_id", "status", "salt")
_BASE_FOLDERS = ("version", "period", "salt")
#: Folders of an ingested table.
_FOLDERS = ("log", "journal", "folded", "manifest", "base", "parts", "ranking")
#: Partitions that one statement adds or drops.
_STATEMENT = 1_000


class InUse(ValueError):
    """A table that a query writes."""


def _declare(
    spark: SparkSession, table: str, schema: T.StructType, folders: Iterable[str], location: str
) -> None:
    columns = [f for f in schema if f.name not in folders] + [schema[name] for name in folders]
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    place = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({declared}) USING parquet"
        f" PARTITIONED BY ({', '.join(folders)}) LOCATION '{place}'"
    )


def _spec(folder: str) -> str:
    """PARTITION (...) of a folder such as version=0/period=2020-01-30/salt=3."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return f"PARTITION ({', '.join(f'{k}={v}' if v.isdigit() else f"{k}='{v}'" for k, v in pairs)})"


def _point(spark: SparkSession, table: str, wanted: set[str]) -> None:
    """Let the table have these partitions. The driver handles a name per folder."""
    there = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for verb, gap, folders in (
        ("DROP IF EXISTS", ", ", there - wanted),
        ("ADD IF NOT EXISTS", " ", wanted - there),
    ):
        specs = [_spec(folder) for folder in sorted(folders)]
        for at in range(0, len(specs), _STATEMENT):
            spark.sql(f"ALTER TABLE {table} {verb} {gap.join(specs[at : at + _STATEMENT])}")


def refresh_tables(spark: SparkSession, path: str, name: str) -> None:
    """Bring the partitions of both tables up to date with the finished batches and the newest base.

    Folders of replaced versions leave before those of the newest come, so a query that
    starts in between sees fewer rows and none twice.
    """
    state = journal.read_state(spark, path)
    tail = set(state.tail)
    finished = set()
    for folder in matching(spark, f"{path}/log/epoch=*/batch_id=*/status=*/salt=*"):
        parts = folder.rsplit("/", 4)[1:]
        batch = journal.batch_of("/".join(parts[:2]))
        if batch in tail or state.covers(batch):
            finished.add("/".join(parts))
    held = view.read_parts(spark, path, state.version)
    _point(spark, f"{name}_log", finished)
    _point(spark, f"{name}_base", {f"version={v}/period={p}/salt={s}" for (p, s), v in held.items()})


def create_tables(spark: SparkSession, path: str, name: str) -> None:
    """Make the table at `path`, unless it is there, and enter <name>_log and <name>_base in the
    catalog. `name` may begin with a database."""
    ingest.create_table(spark, path)
    base = T.StructType([*schemas.BASE.fields, T.StructField("version", T.LongType())])
    _declare(spark, f"{name}_log", schemas.LOG, _LOG_FOLDERS, f"{path}/log")
    _declare(spark, f"{name}_base", base, _BASE_FOLDERS, f"{path}/base")
    refresh_tables(spark, path, name)


def create_history(spark: SparkSession, path: str, name: str, grain: str = "day") -> None:
    """Enter a history table in the catalog, with all folders that are there; a second call adds
    those that came since. `grain` is that of its loads. A table that nothing was loaded into has
    no rows."""
    _declare(spark, name, schemas.history(grain), [history.GRAINS[grain]], path)
    if matching(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def writers(spark: SparkSession, path: str) -> list[str]:
    """What seems to write the table: queries of this session, and batches that are not finished,
    as a query of any application leaves them while it runs or if it broke off."""
    found = [q.name for q in spark.streams.active if q.name == ingest.query_name(path)]
    state = journal.read_state(spark, path)
    tail = set(state.tail)
    for folder in matching(spark, f"{path}/log/epoch=*/batch_id=*"):
        batch = journal.batch_of(folder)
        if batch not in tail and not state.covers(batch):
            found.append(f"batch {batch[1]} of epoch {batch[0]}")
    return found


def drop_tables(
    spark: SparkSession, path: str, name: str, purge: bool = False, force: bool = False
) -> None:
    """Take the table out of the catalog; `purge` removes its rows as well, and no other files.

    Refused with InUse while something writes the table, see `writers`; `force` is for what a
    broken-off query left. A query of another application that is between two batches goes unseen
    here, and fails at its next batch if the rows are gone.
    """
    busy = writers(spark, path)
    if busy and not force:
        raise InUse(f"{path} is written by {', '.join(busy)}")
    for kind in ("log", "base"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{kind}")
    if purge:
        remove(spark, [folder for kind in _FOLDERS for folder in matching(spark, f"{path}/{kind}")])
