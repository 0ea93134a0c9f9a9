"""SentencePiece encoding and decoding with a table of distinct marked words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk_table import ChunkTable
from .slices import keyed_text, list_array, map_text

MARK = "▁"
#: A marked word begins at a space that follows something else.
_WORD = re.compile("(?<=[^ ]) ")


def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def cannot_cross(processor) -> bool:
    """Whether words can be segmented alone: no piece has a marker behind another character,
    white space is kept as it is, and the text gets a marker in front."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    inner = any(MARK in piece.lstrip(MARK) for piece in pieces)
    kept = processor.decode(processor.encode("  a \n b  ")) == "  a \n b  "
    prefixed = processor.encode("a", out_type=str)[0].startswith(MARK)
    return kept and prefixed and not inner


def marked_words(text: str) -> list[str]:
    """Words without the marker that stands in front of each; further spaces stay."""
    return _WORD.split(text.replace(MARK, " ")) if text else []


def _word_encoder(processor):
    """Ids of words, each taken with one marker in front."""
    bare = processor.piece_to_id(MARK)

    def encode(words: list[str]) -> list[list[int]]:
        found = processor.encode(words, num_threads=1)
        # The library gives an empty text no marker; a lone one stands at the end of a text.
        return [ids if word else [bare] for word, ids in zip(words, found, strict=True)]

    return encode


def encode(
    docs: DataFrame, model: str, end_id: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids): the ids the library gives for the whole text, and the end id.

    One row per row of `docs`, repeated rows included; other columns are not read. A null or
    empty text has the end id only. Texts may have any length; a task holds one slice.
    Models whose pieces can cross a marker are encoded text by text.
    """

    def prepare():
        processor = _processor(model)
        end = [processor.eos_id()] if end_id else []
        if cannot_cross(processor):
            split, table = marked_words, ChunkTable(_word_encoder(processor))
        else:
            whole = lambda texts: processor.encode(texts, num_threads=1)
            split, table = lambda text: [text], ChunkTable(whole, 0)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            words: list[str] = []
            ends = np.empty(part.num_rows, np.int64)
            for i, text in enumerate(part.column("text").to_pylist()):
                words += split(text)
                ends[i] = len(words)
            ids, stops = table.ids(words, ends)
            if end:
                ids = np.insert(ids, stops, end[0])
                stops = stops + np.arange(1, len(stops) + 1)
            columns = [part.column("doc_id"), list_array(ids, stops)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

        return work

    rows = keyed_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_text(rows, f"doc_id {kind}, ids array<int>", prepare)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the text of its ids, as the library decodes them, in column `into`.

    Null ids have a null text. `into` replaces a column of that name.
    """

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        processor = _processor(model)
        for ids in parts:
            yield pd.Series(
                [None if x is None else processor.decode(x.tolist()) for x in ids], dtype=object
            )

    return encoded.withColumn(into, text_of(F.col(ids_col)))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """The registered query: digests of the ids and of the decoded text."""
    found = decode(encode(docs, model), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
