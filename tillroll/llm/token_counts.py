"""Token counts: pre-tokens that are one token are counted, only the rest is merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import PRE_TOKEN, byte_bpe, whole_tokens
from .chunk_table import TABLE_CHARS, TABLE_ROWS
from .slices import keyed_text, map_text

TOKEN_LIMIT = 1024


class WordCounts(dict):
    """Tokens of distinct words. A word counts its pre-tokens that are whole tokens directly;
    pre-tokens that are not are merged by the library, each once."""

    def __init__(self, path: str, rows: int = TABLE_ROWS):
        super().__init__()
        self.bpe, self.whole, self.limit = byte_bpe(path), whole_tokens(path), rows
        self.merged: dict[str, int] = {}
        self.chars = 0

    def learn(self, words: list[str]) -> None:
        if len(self) + len(self.merged) > self.limit or self.chars > TABLE_CHARS:
            self.clear()
            self.merged.clear()
            self.chars = 0
        new = set(words) - self.keys()
        self.chars += sum(map(len, new))
        parts, rest = {}, set()
        for word in new:
            if word in self.whole:
                self[word] = 1
                continue
            parts[word] = pieces = PRE_TOKEN.findall(word) if self.bpe.can_cut(word) else [word]
            rest.update(p for p in pieces if p not in self.whole and p not in self.merged)
        todo = list(rest)
        for piece, ids in zip(todo, self.bpe.encode(todo) if todo else [], strict=True):
            self.merged[piece] = len(ids)
        for word, pieces in parts.items():
            self[word] = sum(1 if p in self.whole else self.merged[p] for p in pieces)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens): tokens of the whole text, without special ones added.

    One row per row of `docs`, repeated rows included; other columns are not read. A null or
    empty text has none. Strings of added tokens inside a text are one token each, as the
    library reads them. Texts may have any length.
    """

    def prepare():
        counts = WordCounts(path)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = part.column("text").to_pylist()
            words = [counts.bpe.words(text) for text in texts]
            counts.learn([word for document in words for word in document])
            tokens = np.array([sum(map(counts.__getitem__, x)) for x in words], np.int64)
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(tokens)],
                ["doc_id", "n_bytes", "n_tokens"],
            )

        return work

    rows = keyed_text(docs, id_col, text_col)
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_text(rows, f"doc_id {kind}, n_bytes long, n_tokens long", prepare)


def over_limit(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """The registered query: counts, and whether they exceed `limit`."""
    return count_tokens(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
