"""Gapless row numbers over a whole table without a single-task window.

Both variants write the rows, tagged with a position that rises inside each written chunk.
A count per chunk gives the chunk's start, in two levels: the chunks are dealt out in ranges, every
range sums its own chunks, and only the sums of the ranges are added up by the driver.
"""

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.ranking import orderable, total_order
from tillroll.sources.shared import discard, staged

INDEX = "row_index"
_POSITION = "__position"
_CHUNK_BITS = 33  # monotonically_increasing_id keeps the task number above these bits
# One start row per file block or range. A hundred terabytes in blocks of 128 MB make
# 800,000 rows, about 150 MB with their paths. Beyond the bound Spark chooses the join.
_BROADCAST_BYTES = 256 * 1024 * 1024
_ROW_BYTES = 64  # numbers, pointers and hash table of one row, without texts
# Chunks of one range of the first level, and bytes of one range of rows.
_RANGE_CHUNKS = 4_096
_RANGE_BYTES = 256 * 1024 * 1024
_MOST_RANGES = 100_000


def _starts(rows: DataFrame, chunk: Sequence[str]) -> DataFrame:
    """Rows before each chunk, less the position of its first row."""
    counts = rows.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(_POSITION).alias("__first")
    )
    counts = staged(counts, "chunk-counts")
    ranges = counts.count() // _RANGE_CHUNKS + 1
    dealt = counts.repartitionByRange(ranges, *chunk) if ranges > 1 else counts.coalesce(1)
    # Written, because a range is sampled and could end elsewhere when it is computed again.
    dealt = staged(dealt.withColumn("__range", F.spark_partition_id()), "chunk-ranges")
    sums = dealt.groupBy("__range").agg(F.sum("__rows").alias("rows")).orderBy("__range").collect()
    totals = accumulate((row["rows"] for row in sums), initial=0)
    before = [(row["__range"], total) for row, total in zip(sums, totals, strict=False)]
    earlier = Window.partitionBy("__range").orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    offsets = dealt.sparkSession.createDataFrame(before, "__range int, __before long")
    starts = dealt.withColumn("__inside", inside).join(F.broadcast(offsets), "__range")
    shift = F.col("__before") + F.col("__inside") - F.col("__first")
    starts = staged(starts.select(*chunk, shift.alias("__shift")), "chunk-starts")
    discard(counts, dealt)
    return starts


def _numbered(rows: DataFrame, chunk: Sequence[str], name: str) -> DataFrame:
    """Add the start of each row's chunk to the row's place inside the chunk."""
    starts = _starts(rows, chunk)
    texts = sum((F.octet_length(F.col(name).cast("string")) for name in chunk), F.lit(_ROW_BYTES))
    size = starts.agg(F.sum(texts)).first()[0] or 0
    if size <= _BROADCAST_BYTES:
        starts = F.broadcast(starts)
    return (
        rows.join(starts, list(chunk))
        .withColumn(name, F.col(_POSITION) + F.col("__shift"))
        .drop(*chunk, _POSITION, "__shift")
    )


def _range_count(df: DataFrame) -> int:
    """Ranges of a moderate size, from Spark's estimate of the input; at least the session's."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, min(size // _RANGE_BYTES + 1, _MOST_RANGES))


def dense_index(
    df: DataFrame, order_cols: Sequence[str | Column], name: str = INDEX, folder: str | None = None
) -> DataFrame:
    """Number rows 0, 1, 2, ... along `order_cols`; ties follow the remaining columns.

    One range shuffle. Arrival position is the last sort key, so even a large set of exact
    copies is divided between tasks. It is taken from partitions sorted by a content hash,
    one radix sort: a task that runs again, also one that reads a shuffle, gives every row
    the same position. Spark computes `df` twice, first to sample the ranges; write a costly
    `df` to a table before. The numbered rows live in `folder`, by default under the shared
    folder, which has to outlive the result.
    """
    leading = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]
    named = [c for c in order_cols if isinstance(c, str)]
    order = total_order(df, leading, named)
    content = F.xxhash64(*[F.col(f"`{field.name}`") for field in orderable(df)])
    arrived = (
        df.withColumn("__content", content)
        .sortWithinPartitions("__content")
        .withColumn("__arrival", F.monotonically_increasing_id())
        .drop("__content")
    )
    order = [*order, F.col("__arrival").asc()]
    rows = (
        arrived.repartitionByRange(_range_count(df), *order)
        .sortWithinPartitions(*order)
        .drop("__arrival")
        .withColumn(_POSITION, F.monotonically_increasing_id())
        .withColumn("__chunk", F.shiftright(_POSITION, _CHUNK_BITS))
    )
    return _numbered(staged(rows, "dense-index", folder), ["__chunk"], name)


def file_order_index(scan: DataFrame, name: str = INDEX, folder: str | None = None) -> DataFrame:
    """Number the rows of a fresh file scan in file order (path, then place in the file).

    No shuffle: a scan task reads each file block front to back, so positions rise inside a
    block. `scan` must come straight from the reader, without a shuffle in between.
    """
    rows = scan.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
    ).withColumn(_POSITION, F.monotonically_increasing_id())
    return _numbered(staged(rows, "file-order", folder), ["__file", "__block"], name)
