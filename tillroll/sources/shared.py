"""The folder where jobs keep intermediate tables."""

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named in `spark.checkpoint.dir`.

    Only a local session may do without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder that all executors share")
    # The setting is fixed once a session runs, so the folder is remembered here.
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="tillroll-")
    return _LOCAL[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run within leave no shuffle files. Else these stay until the driver
    happens to collect its garbage, and add up over the queries of a job."""
    if spark.conf.get(_CLEANUP, None) is not None:
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP)


def staged(df: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """Write `df` once and read it back, so that no retry can compute it differently."""
    spark = df.sparkSession
    path = folder or new_folder(spark, purpose)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    with shuffles_removed(df.sparkSession):
        # Spark's own `isEmpty` leaves its shuffle files all the same.
        return df.limit(1).count() == 0


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern; none where its folder does not exist."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    path = hadoop.Path(pattern)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    found = system.globStatus(path)
    if not found:
        return []
    # As one text "{a,b}": a call for each of thousands of paths would take seconds.
    text = context._jvm.org.apache.commons.lang3.ArrayUtils.toString(hadoop.FileUtil.stat2Paths(found))
    root = system.makeQualified(hadoop.Path(pattern.partition("*")[0].rpartition("/")[0])).toString()
    return re.split(f",(?={re.escape(root)})", text[1:-1])


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    """Remove folders with all that is in them."""
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Remove tables that `staged` wrote, once no result reads them any more."""
    for table in tables:
        remove(table.sparkSession, {name.rpartition("/")[0] for name in table.inputFiles()})
