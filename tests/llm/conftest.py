"""The package in the workers, and odd inputs for every operator."""

from __future__ import annotations

import pytest

from tillroll.llm.shipping import ship_package

ODD_TEXTS = [
    None, "", " ", "  a  b \n c", "▁▁ x▁", "<|endoftext|> x<|endoftext|>", "日本語 テスト",
    "don't 's 12th ½x  y  ", "\x00\x1c a\x85b", "é" * 300, "a" * 5000, "ab" * 700, "🙂🙂 x\ty",
    "to be or not to be " * 40, "to be or not to be " * 40,
]


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm):
    """Odd texts, a repeated row, a null id, and columns named like results."""
    rows = [(i, t, "en" if i % 2 else None, None, i, 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "no id here", "de", "s", 1, 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens int"
    return llm.createDataFrame(rows, schema).repartition(3)
