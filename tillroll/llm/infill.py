"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of about `FRAME_BYTES`, each with the units,
characters and bytes before it, and cut only where a unit ends. Two cuts are found by their unit
number: only the frames that hold them are decompressed. All other frames go into the output as
they are, so an output is again a chain of frames, which any zstandard reader takes as one
stream. Digests and restored texts read the frames in order, one at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import staged

from .slices import map_text

FRAME_BYTES = 1 << 16
LEVEL = 3
SEED = 42
#: Per cent of documents that are rearranged, and of these, those with the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The parts of an output in their order, by form.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_FRAME = pa.struct(
    [("unit", pa.int64()), ("char", pa.int64()), ("byte", pa.int64()), ("data", pa.binary())]
)
_STORED = (
    "n_units long, n_chars long, n_bytes long, marked boolean,"
    " frames array<struct<unit:long,char:long,byte:long,data:binary>>"
)


def _marks(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of texts that end at `ends`: does a unit end here, does a character start.

    A unit is a word with the blanks before it; blanks at the end of a text are one more.
    """
    blank = _BLANK[data]
    last = np.zeros(len(data), bool)
    last[:-1] = ~blank[:-1] & blank[1:]
    last[ends[ends > 0] - 1] = True
    # A word that ends with the text ends there, and blanks do not end inside it.
    return last, (data & 0xC0) != 0x80


def _frame_starts(size: int, unit_ends: np.ndarray) -> list[int]:
    """Starts of frames: at least `FRAME_BYTES` each but for the last, cut at unit ends."""
    starts = [0]
    while size - starts[-1] > FRAME_BYTES:
        cut = int(unit_ends[np.searchsorted(unit_ends, starts[-1] + FRAME_BYTES)])
        if cut >= size:
            break
        starts.append(cut)
    return starts


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_units, n_chars, n_bytes, marked, frames) of every row; a null text is empty and
    has no frames. `marked`: the text holds one of the three marks. No other column is read."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark.decode()))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    texts = texts.withColumn("marked", marked)

    def prepare():
        compress = zstandard.ZstdCompressor(level=LEVEL).compress

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            column = part.column("text")
            texts = [x.as_buffer() or pa.py_buffer(b"") for x in column]
            ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            unit_end, char = _marks(data, np.unique(ends))
            units = np.concatenate([[0], np.cumsum(unit_end)])
            chars = np.concatenate([[0], np.cumsum(char)])
            frames: list[tuple[int, int, int, bytes]] = []
            upto = []
            for text, high in zip(texts, ends.tolist(), strict=True):
                low = high - len(text)
                edges = [0, len(text)]
                if len(text) > FRAME_BYTES:
                    unit_ends = np.flatnonzero(unit_end[low:high]) + 1
                    edges = [*_frame_starts(len(text), unit_ends), len(text)]
                # An empty text has no frame.
                for at, end in pairwise(edges if len(text) else ()):
                    before = int(units[low + at] - units[low]), int(chars[low + at] - chars[low])
                    frames.append((*before, at, compress(text[at:end])))
                upto.append(len(frames))
            lows = ends - [len(x) for x in texts]
            fields = list(zip(*frames, strict=True)) if frames else [()] * 4
            held = pa.StructArray.from_arrays(
                [pa.array(x, f.type) for x, f in zip(fields, _FRAME, strict=True)], fields=list(_FRAME)
            )
            offsets = pa.array([0, *upto], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(units[ends] - units[lows]),
                    pa.array(chars[ends] - chars[lows]),
                    pa.array(ends - lows),
                    part.column("marked"),
                    pa.ListArray.from_arrays(offsets, held),
                ],
                ["doc_id", "n_units", "n_chars", "n_bytes", "marked", "frames"],
            )

        return work

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_text(texts, f"doc_id {kind}, {_STORED}", prepare)


class StoredText:
    """One stored text. At most two frames are held decompressed."""

    def __init__(self, frames: list[dict], n_bytes: int):
        self.frames, self.size = frames, n_bytes
        self._open: dict[int, bytes] = {}
        self._decompress = zstandard.ZstdDecompressor().decompress

    def frame(self, number: int) -> bytes:
        if number not in self._open:
            if len(self._open) > 1:
                self._open.pop(next(iter(self._open)))
            self._open[number] = self._decompress(self.frames[number]["data"])
        return self._open[number]

    def place(self, unit: int) -> tuple[int, int]:
        """Bytes and characters before the unit of this number, or of the whole text."""
        if unit <= 0:
            return 0, 0
        number = bisect_right(self.frames, unit - 1, key=lambda x: x["unit"]) - 1
        start, data = self.frames[number], np.frombuffer(self.frame(number), np.uint8)
        unit_end, char = _marks(data, np.array([len(data)]))
        size = int(np.flatnonzero(unit_end)[unit - start["unit"] - 1]) + 1
        return start["byte"] + size, start["char"] + int(char[:size].sum())

    def cut(self, low: int, high: int, compress) -> Iterator[bytes]:
        """Frames that hold the bytes from `low` to `high`; whole ones are not touched."""
        number = max(0, bisect_right(self.frames, low, key=lambda x: x["byte"]) - 1)
        while low < high:
            start = self.frames[number]["byte"]
            more = number + 1 < len(self.frames)
            end = self.frames[number + 1]["byte"] if more else self.size
            if low == start and end <= high:
                yield self.frames[number]["data"]
            else:
                yield compress(self.frame(number)[low - start : min(end, high) - start])
            low, number = end, number + 1


def draws(doc_id: object, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that a document's id decides; without an id, the empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def rearrange(doc_id: object, text: StoredText, n_units: int, marked: bool, seed: int, compress):
    """(form, characters of the prefix, of the middle, frames of the output) of one text."""
    first, second, chosen, way = draws(doc_id, seed)
    if not text.size or marked or chosen % 100 >= FIM_PERCENT:
        return PLAIN, None, None, [x["data"] for x in text.frames]
    low, high = sorted((first % (n_units + 1), second % (n_units + 1)))
    (a, chars), (b, upto) = text.place(low), text.place(high)
    ranges = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, text.size)}
    form = SPM if way % 100 < SPM_PERCENT else PSM
    output = []
    for mark in ORDER[form]:
        output += [compress(mark), *text.cut(*ranges[mark], compress)]
    return form, chars, upto - chars, output


def fill_in_middle(stored: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): each stored text rearranged, its
    output as a list of frames whose concatenation is one zstandard stream."""

    def prepare():
        compress = zstandard.ZstdCompressor(level=LEVEL).compress

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            made, upto, frames = [], [], []
            names = ("doc_id", "n_units", "n_bytes", "marked", "frames")
            columns = [part.column(x) for x in names]
            for row in range(part.num_rows):
                doc_id, n_units, n_bytes, marked, held = (x[row].as_py() for x in columns)
                text = StoredText(held, n_bytes)
                *facts, output = rearrange(doc_id, text, n_units, marked, seed, compress)
                made.append(facts)
                frames += output
                upto.append(len(frames))
            form, prefix, middle = zip(*made, strict=True) if made else ((), (), ())
            offsets = pa.array([0, *upto], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("n_units"),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(frames, pa.binary())),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

        return work

    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long"
    return _by_rows(stored, f"{schema}, output array<binary>", prepare)


def _by_rows(df: DataFrame, schema: str, prepare) -> DataFrame:
    """`mapInArrow` over few rows at a time, as one may hold a long text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield work(batch.slice(at, 256))

    return df.mapInArrow(run, schema)


def _plain(frames: Iterable[bytes]) -> Iterator[bytes]:
    decompress = zstandard.ZstdDecompressor().decompress
    for frame in frames:
        yield decompress(frame)


def _mark_places(frames: list[bytes], marks: tuple[bytes, ...]) -> list[int]:
    """Where each mark stands first in the output. Pieces between marks hold none."""
    places: list[int] = []
    tail, at = b"", 0
    for data in _plain(frames):
        data = tail + data
        found = 0
        while len(places) < len(marks) and (x := data.find(marks[len(places)], found)) >= 0:
            places.append(at + x)
            found = x + len(marks[len(places) - 1])
        keep = max(len(data) - 2, found)
        tail, at = data[keep:], at + keep
        if len(places) == len(marks):
            break
    return places


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text that an output was made from, piece by piece, from the output and its form."""
    if form == PLAIN:
        yield from _plain(frames)
        return
    marks = ORDER[form]
    places = _mark_places(frames, marks)
    ranges = {
        mark: (low + len(mark), high)
        for mark, low, high in zip(marks, places, [*places[1:], None], strict=True)
    }
    for mark in (PREFIX, MIDDLE, SUFFIX):
        low, high = ranges[mark]
        at = 0
        for data in _plain(frames):
            end = at + len(data)
            if end > low and (high is None or at < high):
                yield data[max(0, low - at) : len(data) if high is None else min(len(data), high - at)]
            at = end
            if high is not None and at >= high:
                break


def _sha256(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def restore(outputs: DataFrame) -> DataFrame:
    """(doc_id, text) from (doc_id, form, output)."""

    def prepare():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(part.column("output").to_pylist(), part.column("form").to_pylist(), strict=True)
            texts = [b"".join(restored(*row)).decode() for row in rows]
            columns = [part.column("doc_id"), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "text"])

        return work

    kind = outputs.schema["doc_id"].dataType.simpleString()
    return _by_rows(outputs.select("doc_id", "form", "output"), f"doc_id {kind}, text string", prepare)


def infill_digest(docs: DataFrame) -> DataFrame:
    """The registered query: one row per row of `docs`, with digests of the output and of the text
    restored from it. Null and empty texts are plain with n = 0. No rows in, no rows out."""
    outputs = fill_in_middle(staged(store(docs), "frames"))

    def prepare():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            frames, forms = part.column("output").to_pylist(), part.column("form").to_pylist()
            output = [_sha256(_plain(x)) for x in frames]
            again = [_sha256(restored(x, form)) for x, form in zip(frames, forms, strict=True)]
            kept = [part.column(x) for x in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
            names += ["output_sha256", "restored_sha256"]
            return pa.RecordBatch.from_arrays([*kept, pa.array(output), pa.array(again)], names)

        return work

    kind = outputs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long"
    return _by_rows(outputs, f"{schema}, output_sha256 string, restored_sha256 string", prepare)


#: The same in DuckDB SQL.
INFILL_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n,
         ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM base
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), pieces AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(units[1:lo], ''), '') AS pre,
         coalesce(array_to_string(units[lo + 1:hi], ''), '') AS mid,
         coalesce(array_to_string(units[hi + 1:n], ''), '') AS suf
  FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
