"""Packing documents into sequences with a fixed number of open windows per partition."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import staged

from .byte_bpe import byte_bpe
from .slices import keyed_text, list_array, slices

SEQUENCE_TOKENS = 1024
OPEN_WINDOWS = 32
#: Partitions whose leftovers meet in one task of the next merge.
MERGE_WIDTH = 32

_PLACES = "doc_tokens long, sequence_id long, offset long, part long, open boolean"
#: Rows of pieces that a task hands on at once.
_ROWS = 2_000


#: A piece to be packed: its document, ids before it, its ids, ids of the whole document.
Piece = tuple[object, int, np.ndarray, int]


def text_pieces(path: str, end_id: int = 0) -> Callable[[], Callable]:
    """Whole documents (doc_id, text) as pieces: the library's ids of the text and `end_id`."""

    def prepare():
        bpe = byte_bpe(path)

        def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
            for part in slices(batch, "text"):
                found = bpe.encode(part.column("text").to_pylist())
                for document, ids in zip(part.column("doc_id").to_pylist(), found, strict=True):
                    ids.append(end_id)
                    yield document, 0, np.array(ids, np.int32), len(ids)

        return pieces

    return prepare


def id_pieces() -> Callable:
    """Pieces that have been cut before (doc_id, start, ids, doc_tokens)."""

    def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
        starts, totals = batch.column("start").to_pylist(), batch.column("doc_tokens").to_pylist()
        for i, document in enumerate(batch.column("doc_id").to_pylist()):
            # A copy, so that an open window doesn't hold the whole batch.
            ids = batch.column("ids")[i].values
            if ids is not None and len(ids):
                yield document, starts[i], ids.to_numpy().copy(), totals[i]

    return pieces


class Windows:
    """At most `limit` open windows, in order of the room they have left."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.room: list[tuple[int, int]] = []
        self.held: dict[int, list] = {}
        self.made = 0

    def place(self, piece: tuple) -> Iterator[list]:
        """Put a piece (document, start, ids, document's tokens) where the least room is left.

        When no open window has room and no further one may be opened, the fullest is filled
        with the front of the piece and emitted, and the rest is placed. So an emitted window
        has no padding.
        """
        document, start, ids, total = piece
        while len(ids):
            spot = bisect_left(self.room, (len(ids), -1))
            if spot < len(self.room):
                room, window = self.room.pop(spot)
            elif len(self.room) < self.limit:
                room, window = self.size, self.made
                self.held[window] = []
                self.made += 1
            else:
                room, window = self.room.pop(0)
            front, ids = ids[:room], ids[room:]
            self.held[window].append((document, start, front, total))
            start += len(front)
            if len(front) == room:
                yield self.held.pop(window)
            else:
                insort(self.room, (room - len(front), window))

    def leftovers(self) -> Iterator[list]:
        """Windows that are still open, the fullest first."""
        for _, window in self.room:
            yield self.held.pop(window)
        self.room.clear()


def _pack_partition(
    rows_in: DataFrame, prepare: Callable[[], Callable], level: int, size: int, limit: int
) -> DataFrame:
    """Every partition packs the pieces of its rows; windows still open at its end are marked.
    Sequence ids are (level, partition, running number)."""

    def run(batches):
        part = TaskContext.get().partitionId()
        first, made = (level << 58) + (part << 32), 0
        windows, rows, pieces = Windows(size, limit), [], prepare()

        def table() -> pa.RecordBatch:
            documents, starts, ids, totals, sequences, offsets, opened = zip(*rows, strict=True)
            ends = np.cumsum([len(x) for x in ids])
            columns = [
                pa.array(documents, kind),
                pa.array(starts, pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                list_array(np.concatenate(ids).astype(np.int32), ends),
                pa.array(totals, pa.int64()),
                pa.array(sequences, pa.int64()),
                pa.array(offsets, pa.int64()),
                pa.array([part] * len(rows), pa.int64()),
                pa.array(opened, pa.bool_()),
            ]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        def add(window: list, still_open: bool) -> None:
            nonlocal made
            offset = 0
            for document, start, ids, total in window:
                rows.append((document, start, ids, total, first + made, offset, still_open))
                offset += len(ids)
            made += 1

        names = [
            "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "part",
            "open",
        ]
        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            for piece in pieces(batch):
                for window in windows.place(piece):
                    add(window, False)
                if len(rows) >= _ROWS:
                    yield table()
        for window in windows.leftovers():
            add(window, True)
        if rows:
            yield table()

    kind = rows_in.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids array<int>, {_PLACES}"
    return rows_in.mapInArrow(run, schema)


def pack(
    rows: DataFrame,
    prepare: Callable[[], Callable],
    size: int = SEQUENCE_TOKENS,
    open_windows: int = OPEN_WINDOWS,
    merge_width: int = MERGE_WIDTH,
) -> DataFrame:
    """One row per piece of the documents in `rows`: doc_id, start, length, ids, doc_tokens,
    sequence_id, offset. `prepare` gives, in each task, the function that makes pieces of rows.

    Each partition packs what it reads, with at most `open_windows` unfinished windows of
    `size` tokens. Its leftovers, at most that many, meet those of `merge_width` other
    partitions, and so on until one task has them all; there one window at a time is
    filled, so that the whole corpus has at most one sequence that is not full. Every id lies
    in exactly one piece. Rows without ids have no piece; repeated rows are packed each; no
    shuffle moves more than leftovers. No rows in, no rows out.
    """
    packed = staged(_pack_partition(rows, prepare, 0, size, open_windows), "packed")
    done, level = [packed.filter(~F.col("open"))], 0
    parts = packed.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    while True:
        level += 1
        last = parts <= merge_width
        parts = -(-parts // merge_width)
        left = packed.filter("open").repartition(parts, F.floor(F.col("part") / merge_width))
        left = left.sortWithinPartitions("part", "sequence_id", "offset")
        left = left.select("doc_id", "start", "ids", "doc_tokens")
        merged = _pack_partition(left, id_pieces, level, size, 1 if last else open_windows)
        packed = staged(merged, "leftovers")
        if last:
            done.append(packed)
            break
        done.append(packed.filter(~F.col("open")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("part", "open")


def ids_crc32(ids: pd.Series) -> pd.Series:
    """CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    import zlib

    return ids.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))


def pack_text(
    docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`pack` for documents; a null or empty text has `end_id` only. Other columns are not
    read."""
    return pack(keyed_text(docs, id_col, text_col), text_pieces(path, end_id))


def packed_documents(docs: DataFrame, path: str) -> DataFrame:
    """The registered query: every piece with a checksum in place of its ids."""
    pieces, checksum = pack_text(docs, path), F.pandas_udf(ids_crc32, "long")
    return pieces.select(
        "doc_id", "start", "length", checksum("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )
