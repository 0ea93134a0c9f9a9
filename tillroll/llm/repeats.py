"""Removal of long passages that stand elsewhere, by a logarithmic family of suffix arrays.

A suffix is indexed where a passage of `length` bytes can be recognised: at its anchor, the gram
of `gram_of` bytes with the smallest hash in it, the last of equals. Equal passages have the
anchor at the same offset, so every window of `length` bytes belongs to one suffix and
only windows at suffixes with equal grams can be equal. That keeps one suffix in about 140 for
400 bytes, and one in 36 for 101.

New batches get a suffix array, in the order of the grams' hashes, which is scanned against all
levels for grams that occur again; equal-sized levels merge. What is found are
candidates. The exact check follows: stretches of windows are compared whole by a hash of
their text, and window by window where the stretches of one gram differ.

Units are bytes, or words: then a text is the sequence of its words' hashes, passages are equal
whatever blanks stand between their words, and all lengths and places count words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.shared import discard, is_empty, new_folder, staged

from .slices import list_array, map_text, slices

LENGTH = 400
BYTES, WORDS = "bytes", "words"
#: Batches that a table is taken in by; batch sizes double as levels merge.
BATCHES = 4
#: Rows of one gram that a task compares; those of more frequent grams are dealt out by window.
GROUP_ROWS = 2_000
_OFFSETS = 64
_PLACE_BITS = 20
_BLOCK = 1 << 19
_SEED = 3
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gram_of(length: int) -> int:
    """Units of the grams for passages of `length` units: 128 for 400, 16 for 51."""
    return length * 8 // 25


def _coded(text: bytes, unit: str) -> tuple[bytes, int]:
    """What windows are cut from and hashed, and its bytes per unit."""
    if unit == BYTES:
        return text, 1
    # `split` of bytes cuts at the six blanks of ASCII.
    hashes = [xxhash.xxh3_64_intdigest(word) for word in text.split()]
    return np.array(hashes, np.uint64).tobytes(), 8


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers for bytes, and powers of an odd number with their inverses."""
    random = np.random.default_rng(_SEED)
    values = random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    size = _BLOCK + 2 * LENGTH
    powers, inverses = np.ones(size, np.uint64), np.ones(size, np.uint64)
    powers[1:], inverses[1:] = np.uint64(base), np.uint64(pow(base, -1, 2**64))
    return values, np.cumprod(powers, dtype=np.uint64), np.cumprod(inverses, dtype=np.uint64)


def _anchored(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Stretches of windows with one anchor: its hash, its place, the first window, how many.
    `data` has a 64-bit number for each unit."""
    _, powers, inverses = _tables()
    gram = gram_of(length)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[: len(data)], dtype=np.uint64, out=total[1:])
    h = (total[gram:] - total[:-gram]) * inverses[: len(data) - gram + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = (h & ~mask) | (mask - np.arange(len(h), dtype=np.uint64))
    grams, windows, size = length - gram + 1, len(data) - length + 1, 1
    while size * 2 <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:windows], least[grams - size : grams - size + windows])
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    count = np.diff(np.append(first, windows))
    found = least[first]
    place = (mask - (found & mask)).astype(np.int64)
    return (found >> np.uint64(_PLACE_BITS)).astype(np.int64), place, first, count


def suffixes(
    text: bytes, length: int = LENGTH, unit: str = BYTES
) -> Iterator[tuple[int, int, int, int, int]]:
    """(gram, content, anchor, first, count) of all stretches of windows; `content` is a
    hash of the text that they cover. Texts of any length, in blocks."""
    data, step = _coded(text, unit)
    for start in range(0, max(0, len(data) // step - length + 1), _BLOCK):
        block = data[start * step : (start + _BLOCK + length - 1) * step]
        numbers = np.frombuffer(block, np.uint64) if step == 8 else _tables()[0][np.frombuffer(block, np.uint8)]
        columns = _anchored(numbers, length)
        for gram, anchor, first, count in zip(*(x.tolist() for x in columns), strict=True):
            content = xxhash.xxh3_64_intdigest(block[first * step : (first + count - 1 + length) * step])
            yield gram, content - (1 << 63), start + anchor, start + first, count


_ENTRY = "gram long, content long, doc long, size int, anchor int, first int, count int, copies int"
_NAMES = ["gram", "content", "doc", "size", "anchor", "first", "count", "copies"]


def _suffix_rows(texts: DataFrame, length: int, unit: str) -> DataFrame:
    """Suffixes of all texts. Stretches with equal content within one text are one row with
    `copies`, and the other places are rows of no gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []
                ids = zip(part.column("doc").to_pylist(), part.column("size").to_pylist(), strict=True)
                for (doc, size), text in zip(ids, part.column("text"), strict=True):
                    if size < length:
                        continue
                    seen: dict[tuple, int] = {}
                    found = list(suffixes(text.as_buffer().to_pybytes(), length, unit))
                    for item in found:
                        seen[item[:2]] = seen.get(item[:2], 0) + 1
                    for gram, content, anchor, first, count in found:
                        copies = seen[gram, content]
                        if copies:
                            seen[gram, content] = 0
                            rows.append((gram, content, doc, size, anchor, first, count, min(copies, 2)))
                        else:
                            rows.append((None, None, doc, size, anchor, first, count, 2))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 8
                kinds = [pa.int64()] * 3 + [pa.int32()] * 5
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, _NAMES)

    return texts.select("doc", "size", "text").mapInArrow(run, _ENTRY)


def _sorted_level(rows: DataFrame) -> DataFrame:
    return staged(rows.repartitionByRange("gram").sortWithinPartitions("gram", "content"), "level")


class IndexFamily:
    """Levels of suffix arrays, none two of the same size."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def insert(self, batch: DataFrame) -> DataFrame:
        """Take in a batch; the suffixes, new or indexed, whose gram this shows to be repeated."""
        new = _sorted_level(batch)
        grams = new.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
        repeated = grams.filter(F.col("times") > 1).select("gram")
        found = []
        if self.levels:
            old = self.levels[0][1]
            for _, level in self.levels[1:]:
                old = old.unionByName(level)
            found.append(old.join(grams.select("gram"), "gram", "left_semi"))
            repeated = repeated.union(old.select("gram"))
        found.append(new.join(repeated, "gram", "left_semi"))
        # A suffix that its own text repeats is shown by its copies.
        found.append(new.filter(F.col("copies") > 1))
        size = 1
        shown = found[0]
        for more in found[1:]:
            shown = shown.unionByName(more)
        shown = staged(shown.distinct(), "found")
        while self.levels and self.levels[-1][0] == size:
            same, small = self.levels.pop()[1], new
            new, size = _sorted_level(same.unionByName(small)), 2 * size
            discard(same, small)
        self.levels.append((size, new))
        return shown


def _windows(rows: DataFrame, length: int, unit: str = BYTES) -> DataFrame:
    """Hashes of the windows of each stretch, by their offset to the anchor, in parts."""

    schema = (
        "gram long, part int, doc long, size int, anchor int, low int, hashes array<long>,"
        " open boolean, kinds long"
    )

    def prepare():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            made: list[tuple] = []
            hashes: list[int] = []
            ends: list[int] = []
            keys = [part.column(c).to_pylist() for c in ("doc", "size", "stretches")]
            for doc, size, stretches, text in zip(*keys, part.column("text"), strict=True):
                data, step = _coded(text.as_buffer().to_pybytes(), unit)
                for x in stretches:
                    top = x["anchor"] - x["first"]
                    low = top - x["count"] + 1
                    for piece in range(low // _OFFSETS, top // _OFFSETS + 1):
                        lo = max(low, piece * _OFFSETS)
                        hi = min(top, piece * _OFFSETS + _OFFSETS - 1)
                        for offset in range(lo, hi + 1):
                            at = x["anchor"] - offset
                            window = data[at * step : (at + length) * step]
                            hashes.append(xxhash.xxh3_64_intdigest(window))
                        ends.append(len(hashes))
                        made.append(
                            (x["gram"], piece, doc, size, x["anchor"], lo, x["open"], x["kinds"])
                        )
            columns = list(zip(*made, strict=True)) if made else [()] * 8
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 3, pa.bool_(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            lists = list_array(np.array(hashes, np.uint64).view(np.int64), np.array(ends, np.int64))
            arrays.insert(6, lists)
            names = ["gram", "part", "doc", "size", "anchor", "low", "hashes", "open", "kinds"]
            return pa.RecordBatch.from_arrays(arrays, names)

        return work

    return map_text(rows, schema, prepare)


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Intervals that windows with these starts cover."""
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    parts = np.split(starts, cut)
    return [(int(x[0]), int(x[-1]) + length) for x in parts if len(x)]


_INTERVAL = "doc long, size int, low int, high int"


def _repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """Intervals of open stretches whose windows stand elsewhere too; rows of one gram and part
    follow each other."""

    def group(held: list[tuple]) -> Iterator[tuple]:
        count = np.array([len(x[4]) for x in held])
        row = np.repeat(np.arange(len(held)), count)
        offset = np.concatenate([x[3] + np.arange(len(x[4])) for x in held])
        hashes = np.concatenate([x[4] for x in held])
        places: dict[tuple, int] = {}
        place = np.array([places.setdefault((x[0], x[1], x[2]), len(places)) for x in held])[row]
        order = np.lexsort((hashes, offset))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (hashes[order][1:] == hashes[order][:-1]) & (
            offset[order][1:] == offset[order][:-1]
        )
        first = np.flatnonzero(~same[:-1])
        low = np.minimum.reduceat(place[order], first)
        high = np.maximum.reduceat(place[order], first)
        twice = np.zeros(len(order), bool)
        twice[order] = np.repeat(low != high, np.diff(np.append(first, len(order))))
        for i in np.unique(row[twice]).tolist():
            doc, size, anchor, _, _, still_open = held[i]
            if still_open:
                for lo, hi in _runs(anchor - offset[twice & (row == i)], length):
                    yield doc, size, lo, hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            out.clear()
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["doc", "size", "low", "high"])

        key = None
        names = ("gram", "part", "doc", "size", "anchor", "low", "open")
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in names]
            for i, (gram, piece, doc, size, anchor, low, still_open) in enumerate(
                zip(*columns, strict=True)
            ):
                if (gram, piece) != key:
                    if len(held) > 1:
                        out.extend(group(held))
                    held.clear()
                    key = gram, piece
                hashes = batch.column("hashes")[i].values.to_numpy()
                held.append((doc, size, anchor, low, hashes, still_open))
            if len(out) > 10_000:
                yield emit()
        if len(held) > 1:
            out.extend(group(held))
        yield emit()

    return rows.mapInArrow(run, _INTERVAL)


def _frequent_windows(rows: DataFrame, length: int) -> DataFrame:
    """The same for frequent grams, one row per window, so that no task has a gram's rows."""
    each = rows.select(
        "gram", "doc", "size", "anchor", "open", "low", F.posexplode("hashes").alias("i", "hash")
    )
    offset = (F.col("low") + F.col("i")).cast("int")
    each = each.withColumn("offset", offset).withColumn("place", F.struct("doc", "size", "anchor"))
    key = ["gram", "offset", "hash"]
    twice = each.groupBy(*key).agg(F.min("place").alias("p"), F.max("place").alias("q"))
    twice = twice.filter(F.col("p") != F.col("q")).select(*key)
    first = (F.col("anchor") - F.col("offset")).cast("int")
    found = each.filter("open").join(twice, key)
    return found.select("doc", "size", first.alias("low"), (first + length).cast("int").alias("high"))


def _spans(
    texts: DataFrame, length: int, batches: int, unit: str
) -> tuple[DataFrame, list[DataFrame]]:
    """(doc, size, low, high): intervals that hold all units to be removed. And the written
    tables that they are read from."""
    path = new_folder(texts.sparkSession, "suffixes")
    batch = F.pmod(F.xxhash64("doc"), F.lit(batches))
    _suffix_rows(texts, length, unit).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    kept = texts.sparkSession.read.schema(_ENTRY + ", batch int").parquet(path)
    index, parts = IndexFamily(), []
    for number in range(batches):
        rows = kept.filter((F.col("batch") == number) & F.col("gram").isNotNull()).drop("batch")
        parts.append(index.insert(rows))
    shown = parts[0]
    for more in parts[1:]:
        shown = shown.unionByName(more)
    found = staged(shown.distinct(), "candidates")
    discard(*parts, *(level for _, level in index.levels))

    # Stretches whose whole text stands twice need no more; one of each is left to compare.
    classes = found.groupBy("gram", "content").agg(
        F.sum("copies").alias("places"),
        F.min(F.struct("doc", "size", "anchor", "first", "count")).alias("x"),
    )
    classes = staged(classes, "classes")
    whole = found.join(classes.filter(F.col("places") > 1).select("gram", "content"), ["gram", "content"])
    inside = kept.filter(F.col("gram").isNull()).select("doc", "size", "first", "count")
    covered = whole.select("doc", "size", "first", "count").union(inside)
    high = F.col("first") + F.col("count") - 1 + length
    spans = [covered.select("doc", "size", F.col("first").alias("low"), high.cast("int").alias("high"))]

    grams = classes.groupBy("gram").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("places").alias("fewest")
    )
    grams = grams.filter((F.col("kinds") > 1) & (F.col("fewest") < 2))
    unlike = classes.join(grams, "gram").select(
        "gram", "kinds", "x.*", (F.col("places") < 2).alias("open")
    )
    holders = unlike.groupBy("doc", "size").agg(
        F.collect_list(F.struct("gram", "anchor", "first", "count", "open", "kinds")).alias("stretches")
    )
    # Copies of a text give the same rows and places, so one of them stands for all; map tasks
    # drop theirs before texts are moved.
    once = texts.filter(F.col("size") >= length).select("doc", "size", "text")
    holding = once.dropDuplicates(["doc", "size"]).join(holders, ["doc", "size"])
    rows = _windows(holding, length, unit)
    crowded = not is_empty(grams.filter(F.col("kinds") > GROUP_ROWS))
    # Windows are the widest table; only if they are read twice are they written.
    rows = staged(rows, "windows") if crowded else rows
    few = rows.filter(F.col("kinds") <= GROUP_ROWS).repartition("gram", "part")
    spans.append(_repeated_windows(few.sortWithinPartitions("gram", "part"), length))
    if crowded:
        spans.append(_frequent_windows(rows.filter(F.col("kinds") > GROUP_ROWS), length))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out, [kept, found, classes, *([rows] if crowded else [])]


def _byte_runs(data: bytes, runs: list[list[int]], unit: str) -> list[list[int]]:
    """Runs of units as runs of bytes, from the first byte of the first to the last of the last."""
    if unit == BYTES or not runs:
        return runs
    words = [x.span() for x in _WORD.finditer(data)]
    return [[words[low][0], words[high - 1][1]] for low, high in runs]


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    batches: int = BATCHES,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = BYTES,
) -> DataFrame:
    """(doc_id, spans, kept): the maximal runs of bytes, as (low, high), that windows of
    `length` units cover which start anywhere else too, and the other bytes.

    Judged on the input: all places of a passage go, also within one document, also in exact
    copies. One row per row of `docs`, repeated rows included, which are copies of each other;
    other columns are not read. Null texts are empty; texts shorter than `length` stay whole.
    No rows in, no rows out. `length` is 4 to 800.

    In words, blanks within a run go with it, those around it stay.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).alias("row"), text.alias("text"))
    return _removed(texts, length, batches, unit).drop("row")


def _removed(texts: DataFrame, length: int, batches: int, unit: str) -> DataFrame:
    """(doc_id, row, spans, kept) of (doc_id, row, text), where no text is null."""
    texts = texts.withColumns({"doc": F.xxhash64("text"), "size": F.octet_length("text")})
    spans, read = _spans(texts, length, batches, unit)
    spans = staged(spans, "spans")
    discard(*read)
    spans = spans.groupBy("doc", "size").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    copies = texts.filter(F.col("size") >= length).groupBy("doc", "size").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.filter(F.col("n") > 1).drop("n").withColumn("copied", F.lit(True))
    known = spans.join(copies, ["doc", "size"], "full")
    joined = texts.join(known, ["doc", "size"], "left").select(
        "doc_id", "row", "text", F.coalesce("copied", F.lit(False)).alias("copied"), "found"
    )

    def prepare():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            runs, rest = [], []
            columns = (part.column("text"), part.column("copied"), part.column("found"))
            for text, copied, found in zip(*columns, strict=True):
                data = text.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                parts = [(x["low"], x["high"]) for x in found.as_py() or ()]
                if copied.as_py():
                    units = len(data) if unit == BYTES else len(data.split())
                    parts = [(0, units)] if units >= length else []
                for low, high in sorted(parts):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                merged = _byte_runs(data, merged, unit)
                runs.append([{"low": low, "high": high} for low, high in merged])
                edges = [0, *(x for run in merged for x in run), len(data)]
                rest.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans_type = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            arrays = [part.column("doc_id"), part.column("row"), pa.array(runs, spans_type)]
            arrays.append(pa.array(rest, pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "row", "spans", "kept"])

        return work

    span = T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])
    schema = T.StructType(
        [
            *(T.StructField(name, texts.schema[name].dataType) for name in ("doc_id", "row")),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    return map_text(joined, schema, prepare)


@F.pandas_udf(T.StringType())
def _readable(kept: pd.Series) -> pd.Series:
    return kept.map(lambda data: data.decode("utf-8", "ignore"), na_action="ignore")


def without_repeats(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, unit: str = BYTES
) -> DataFrame:
    """`docs` with the kept bytes as text; what a cut leaves of a character goes with it. Null
    texts stay null, all other columns stay as they are, whatever their names. `length` and
    `unit` as above."""
    others = [c for c in docs.columns if c != text_col]
    # Inside a struct no name of the user's meets one of ours.
    row = F.struct(F.col(text_col).isNull().alias("null"), F.struct(*map(_quoted, others)).alias("of"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.lit(0).alias("doc_id"), row.alias("row"), text.alias("text"))
    found = _removed(texts, length, BATCHES, unit)
    text = F.when(~F.col("row.null"), _readable("kept"))
    columns = {c: F.col("row.of")[c] for c in others} | {text_col: text}
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def repeats_digest(docs: DataFrame) -> DataFrame:
    """The registered query: sizes, a digest of what is kept, and that as text, without what a
    cut leaves of a character."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    return remove_repeats(docs).select(
        "doc_id",
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        _readable("kept").alias("kept_text"),
    )
