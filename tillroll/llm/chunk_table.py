"""Distinct chunks, each segmented once, and their ids joined back by position."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np

#: Chunks kept from slice to slice; beyond it a task starts its table anew.
TABLE_ROWS = 400_000
TABLE_CHARS = 12_000_000


class ChunkTable:
    """A table chunk -> ids that grows with the distinct chunks of a task, up to a bound.

    A table of the whole corpus would have to be shuffled to every place where a chunk
    stands: one row per word. Segmenting a chunk again in another task costs less than
    moving it there, and the table never needs to be broadcast.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], rows: int = TABLE_ROWS):
        self.encode, self.limit = encode, rows
        self._reset()

    def _reset(self) -> None:
        self.row: dict[str, int] = {}
        self.chars = 0
        self.flat, self.start = array("i"), array("q", [0])

    def ids(self, chunks: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in order, and where the ids of each document end.

        `ends`: where the chunks of each document end.
        """
        if len(self.row) > self.limit or self.chars > TABLE_CHARS:
            self._reset()
        new = list(set(chunks) - self.row.keys())
        for chunk, ids in zip(new, self.encode(new) if new else [], strict=True):
            self.row[chunk] = len(self.start) - 1
            self.chars += len(chunk)
            self.flat.extend(ids)
            self.start.append(len(self.flat))
        rows = np.fromiter(map(self.row.__getitem__, chunks), np.int64, len(chunks))
        start, flat = np.array(self.start), np.array(self.flat)
        first, length = start[rows], start[rows + 1] - start[rows]
        total = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(first - total[:-1], length) + np.arange(total[-1])
        return flat[place].astype(np.int32), total[ends]
