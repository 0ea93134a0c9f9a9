"""Pieces, token counts and packing against the libraries."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from tests.conftest import SMALL
from tillroll.llm import packing, sentence_pieces, token_counts
from tillroll.llm.queries import BYTE_MODEL, PIECE_MODEL, vocabulary


@pytest.fixture(scope="module")
def docs(llm, odd):
    given = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    shifted = odd.selectExpr("doc_id + 1000000 AS doc_id", "text")
    return given.unionByName(shifted)


@pytest.fixture(scope="module")
def texts(docs):
    return [(row["doc_id"], row["text"] or "") for row in docs.collect()]


def test_pieces_as_the_library_gives_them(docs, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    want = []
    for doc, text in texts:
        ids = library.encode(text, add_eos=True)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        want.append((doc, len(ids), digest, back))
    got = map(tuple, sentence_pieces.round_trip(docs, vocabulary(PIECE_MODEL)).collect())
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(BYTE_MODEL))
    return [(doc, t, library.encode(t, add_special_tokens=False).ids) for doc, t in texts]


def test_counts_as_the_library_gives_them(docs, ids):
    want = [(doc, len(t.encode()), len(x), len(x) > 1024) for doc, t, x in ids]
    got = map(tuple, token_counts.over_limit(docs, vocabulary(BYTE_MODEL)).collect())
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pieces_fill_sequences(docs, ids):
    rows = packing.packed_documents(docs.repartition(40), vocabulary(BYTE_MODEL)).collect()
    whole = {}
    for doc, _, x in ids:
        whole.setdefault(doc, [*x, 0])
    sequences: dict = {}
    for row in rows:
        if row["doc_id"] is not None and row["doc_id"] != 1000014:
            part = whole[row["doc_id"]][row["start"] : row["start"] + row["length"]]
            assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert row["doc_tokens"] == len(whole[row["doc_id"]])
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    assert sum(row["length"] for row in rows) == sum(len(x) + 1 for _, _, x in ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert max(sizes) == 1024 and sum(size < 1024 for size in sizes) <= 1


def test_no_rows(docs):
    none = docs.limit(0)
    assert sentence_pieces.encode(none, vocabulary(PIECE_MODEL)).count() == 0
    assert token_counts.count_tokens(none, vocabulary(BYTE_MODEL)).count() == 0
    assert packing.pack_text(none, vocabulary(BYTE_MODEL)).count() == 0
