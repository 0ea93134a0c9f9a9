"""Languages by cross parsing: phrases that a language's suffix automaton knows."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import keyed_text, map_text

#: The fit reads at most this: labelled rows per language, and characters of them.
SAMPLE_ROWS = 200
SAMPLE_CHARS = 60_000
#: Characters of all languages together; many languages get less each.
TOTAL_CHARS = 2_000_000
#: Distinct words a task remembers, and their costs in all languages together.
TABLE_ROWS, TABLE_CELLS = 500_000, 8_000_000
#: Bits for the length of a phrase.
LENGTH_BITS = 4

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Words in lower case, letters only."""
    return _LETTERS.findall(text.lower())


class SuffixAutomaton:
    """All substrings of the marked words of a sample; a phrase never leaves its word."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        for word in dict.fromkeys(words):
            last = 0
            for char in " " + word:
                last = self._extend(last, char, link, length)
        self.states = len(self.next)

    def _extend(self, last: int, char: str, link: list[int], length: list[int]) -> int:
        known = self.next[last].get(char)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is not None:
            return self._split(last, known, char, link, length)
        state = len(self.next)
        self.next.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and char not in self.next[at]:
            self.next[at][char] = state
            at = link[at]
        if at >= 0:
            target = self.next[at][char]
            exact = length[target] == length[at] + 1
            link[state] = target if exact else self._split(at, target, char, link, length)
        return state

    def _split(self, at: int, target: int, char: str, link: list[int], length: list[int]) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[target]))
        length.append(length[at] + 1)
        link.append(link[target])
        link[target] = copy
        while at >= 0 and self.next[at].get(char) == target:
            self.next[at][char] = copy
            at = link[at]
        return copy

    def parse(self, word: str) -> tuple[int, int]:
        """Longest matches, one behind the other, that make up the marked word, and characters
        between them that the sample doesn't have."""
        step, matches, foreign, state = self.next, 0, 0, 0
        for char in " " + word:
            onward = step[state].get(char)
            if onward is None or not state:
                onward = step[0].get(char)
                if onward is None:
                    foreign += 1
                    state = 0
                    continue
                matches += 1
            state = onward
        return matches, foreign

    def phrases(self, word: str) -> int:
        """Phrases of the marked word: its matches and its foreign characters."""
        return sum(self.parse(word))


def training_sample(
    labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> dict[str, str]:
    """Text per language: up to `rows` rows in order of a hash of their content, cut at `chars`
    characters. The limit is applied in every map task before rows are shuffled, so a language
    with a third of all rows sends no more than the others. All languages together send
    TOTAL_CHARS at most: the more there are, the less of each."""
    languages = labelled.select("lang").distinct().count()
    chars = min(chars, TOTAL_CHARS // max(1, languages))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text")
    ranked = labelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rows)
    before = F.sum(F.char_length("text") + 1).over(order) - F.char_length("text") - 1
    sample = (
        ranked.withColumn("before", before)
        .filter(F.col("before") < chars)
        .select("lang", "before", F.expr(f"substring(text, 1, {chars} - before)").alias("text"))
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():
        texts.setdefault(row["lang"], []).append((row["before"], row["text"]))
    return {
        lang: "\n".join(text for _, text in sorted(parts))[:chars]
        for lang, parts in sorted(texts.items())
    }


class PhraseTable:
    """Normalised phrases of distinct words in every language whose sample has a letter.

    A phrase costs what it takes to point at it: the log of its sample's size, and its length. So
    a large sample doesn't gain by longer phrases alone, nor lose by having more places. A character
    that a sample doesn't have costs as much as a phrase of the largest one, in all
    languages: a small sample doesn't gain by knowing nothing."""

    def __init__(self, sample: dict[str, str], limit: int = TABLE_ROWS):
        words = {lang: found for lang, text in sample.items() if (found := words_of(text))}
        self.languages = list(words)
        self.limit = min(limit, TABLE_CELLS // max(1, len(words)))
        self.automata = [SuffixAutomaton(found) for found in words.values()]
        self.weights = [math.log2(x.states) + LENGTH_BITS for x in self.automata]
        self.foreign = max(self.weights, default=0.0)
        self._reset()

    def _reset(self) -> None:
        self.row: dict[str, int] = {}
        self.known = np.zeros((1024, len(self.automata)), np.float32)

    def cost(self, word: str) -> list[float]:
        """The word in each language, in bits."""
        parsed = (x.parse(word) for x in self.automata)
        return [
            matches * weight + foreign * self.foreign
            for (matches, foreign), weight in zip(parsed, self.weights, strict=True)
        ]

    def costs(self, documents: list[list[str]]) -> np.ndarray:
        """Each document in each language, in bits."""
        if len(self.row) > self.limit:
            self._reset()
        flat = [word for words in documents for word in words]
        new = list(set(flat) - self.row.keys())
        first, last = len(self.row), len(self.row) + len(new)
        if last > len(self.known):
            grown = np.zeros((max(last, 2 * len(self.known)), len(self.automata)), np.float32)
            grown[:first] = self.known[:first]
            self.known = grown
        self.row.update(zip(new, range(first, last), strict=True))
        if new:
            self.known[first:last] = [self.cost(word) for word in new]
        rows = np.fromiter(map(self.row.__getitem__, flat), np.int64, len(flat))
        total = np.zeros((len(flat) + 1, len(self.automata)))
        np.cumsum(self.known[rows], axis=0, dtype=np.float64, out=total[1:])
        ends = np.cumsum([len(words) for words in documents], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return total[ends] - total[starts]


def predict_language(
    docs: DataFrame, sample: dict[str, str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score): the language whose sample needs the fewest phrases for the
    whole text, normalised as in `PhraseTable`; ties go to the first name. Phrases end with
    their word. Languages whose sample has no letter are left out.

    `score`: by what share it needs less than the next language, 1 if there is no other.
    A null text, one without a letter, and every text if no sample has a letter: `und`, 0. One
    row per row of `docs`, repeated rows included; other columns are not read.
    """

    def prepare():
        table = PhraseTable(sample)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            documents = [words_of(text) for text in part.column("text").to_pylist()]
            names, scores = ["und"] * len(documents), np.zeros(len(documents))
            if table.languages:
                costs = table.costs(documents)
                for i in np.flatnonzero([bool(words) for words in documents]):
                    best = int(np.argmin(costs[i]))
                    others = np.delete(costs[i], best)
                    names[i] = table.languages[best]
                    scores[i] = 1 - costs[i][best] / others.min() if len(others) else 1.0
            columns = [part.column("doc_id"), pa.array(names), pa.array(scores)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

        return work

    rows = keyed_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_text(rows, f"doc_id {kind}, lang_pred string, score double", prepare)


def held_out(doc_id):
    """Whether a row is kept from the fit; rows without an id are neither."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify_languages(docs: DataFrame) -> DataFrame:
    """The registered query: fit on the other two folds, predict every row."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    sample = training_sample(labelled.filter(F.col("text").isNotNull()))
    found = predict_language(docs, sample)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
