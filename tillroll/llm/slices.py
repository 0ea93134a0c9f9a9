"""Bounded work units inside Arrow tasks.

Spark hands Python record batches of up to ten thousand rows. The operators cut them into
slices of a megabyte of text, so that what a task holds does not depend on how long the
documents are; a single document is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of `batch` that hold about `limit` bytes of `column` each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def map_text(
    df: DataFrame,
    schema: str,
    prepare: Callable[[], Callable[[pa.RecordBatch], list[pa.RecordBatch] | pa.RecordBatch]],
    column: str = "text",
) -> DataFrame:
    """`mapInArrow` by slices. `prepare` runs once in each task and returns the function."""

    def run(batches):
        work = prepare()
        for batch in batches:
            for part in slices(batch, column):
                made = work(part)
                yield from made if isinstance(made, list) else [made]
            # Workers live on between tasks; what they no longer use goes back.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that text operators read; a null text is an empty one."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def list_array(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """Lists whose ends in `values` are `ends`."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
