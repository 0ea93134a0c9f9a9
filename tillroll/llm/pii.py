"""Personal data: plain patterns, and the same patterns on a text whose disguises are undone.

Offsets are code points, ends exclusive. Every scan is linear in the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slices import keyed_text, map_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*+")
_DIAL = re.compile(r"[ ().0-9-]++")
_ANY = re.compile("[@0-9]")


def emails(text: str) -> Iterator[Span]:
    """`[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield "email", start, free
        at = text.find("@", max(free, at + 1))


def ips(text: str) -> Iterator[Span]:
    """Each four parts of a dotted number, if none exceeds 255."""
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield "ip", at, end
            at = end + 1


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() < 14:
            continue
        digits = run.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", run.start(), run.end()


def phones(text: str) -> Iterator[Span]:
    """`\\+[0-9][\\x20().0-9-]+[0-9]` with 10 to 15 digits."""
    plus = text.find("+")
    while plus >= 0:
        after = plus + 1
        if text[plus + 1 : plus + 2] in tuple("0123456789"):
            run = _DIAL.match(text, plus + 2)
            body = run.group().rstrip(" ().-") if run else ""
            if len(body) >= 2:
                after = plus + 2 + len(body)
                if 10 <= 1 + sum(map(str.isdigit, body)) <= 15:
                    yield "phone", plus, after
        plus = text.find("+", after)


def plain_spans(text: str) -> list[Span]:
    """Matches of the four patterns: leftmost, not overlapping within a kind; those that fail
    their check are dropped without a retry."""
    if not _ANY.search(text):
        return []
    return [*emails(text), *ips(text), *cards(text), *phones(text)]


# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(
    zip(
        "АВСЕНІЈКМОРЅТХУаеорсухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνυι․∙﹒。‐‑‒–−﹣＋﹢",
        "ABCEHIJKMOPSTXYaeopcyxijshdqwABEZHIKMNOPTYXaopvui....------++",
        strict=True,
    )
)
# How numbers and addresses are spelled, by language.
_SPELLED = {
    "en": {"digits": "zero one two three four five six seven eight nine", "more": {"oh": "0", "hundred": "00", "thousand": "000"},
           "twice": "double", "at": "at", "dot": "dot", "plus": "plus"},
    "de": {"digits": "null eins zwei drei vier fünf sechs sieben acht neun", "more": {"zwo": "2", "fuenf": "5"},
           "twice": "doppel", "at": "at ät", "dot": "punkt", "plus": "plus"},
    "fr": {"digits": "zéro un deux trois quatre cinq six sept huit neuf", "more": {},
           "twice": "double", "at": "arobase arrobase", "dot": "point", "plus": "plus"},
    "es": {"digits": "cero uno dos tres cuatro cinco seis siete ocho nueve", "more": {},
           "twice": "doble", "at": "arroba", "dot": "punto", "plus": "más mas"},
}
_DIGIT_WORDS = {
    word: figures
    for said in _SPELLED.values()
    for word, figures in [*zip(said["digits"].split(), "0123456789", strict=True), *said["more"].items()]
}


def _any_of(words: Iterable[str]) -> str:
    """A pattern of these words, longer ones first."""
    return "|".join(sorted(set(words), key=lambda x: (-len(x), x)))


_INVISIBLE = "\u00ad\u200b-\u200f\u2060\ufeff"


class _Fold(dict):
    """Code point -> the ASCII character that it imitates, or itself. Filled as it is used."""

    def __missing__(self, point: int) -> int:
        char = chr(point)
        like = _LOOKALIKES.get(char)
        if like is None and point > 127:
            like = unicodedata.normalize("NFKC", char)
            if unicodedata.category(char) == "Nd":
                like = str(unicodedata.decimal(char))
        self[point] = ord(like) if like and len(like) == 1 and like.isascii() else point
        return self[point]


_FOLD = _Fold()
_WORDS = _any_of(_DIGIT_WORDS)
_AT, _DOT, _PLUS, _TWICE = (
    _any_of(word for said in _SPELLED.values() for word in said[part].split())
    for part in ("at", "dot", "plus", "twice")
)
_CHANGED = "".join(c for c in map(chr, range(0x250)) if _FOLD[ord(c)] != ord(c))
_FOREIGN = re.compile(f"[^\x00-ɏ]|[{_INVISIBLE}{_CHANGED}]")
_GAP = r"[\s,-]{1,3}"
_SAID = rf"(?:(?:{_TWICE})[\s-]{{1,3}})?(?:{_WORDS})"
_REWRITE = re.compile(
    rf"(?P<hidden>[{_INVISIBLE}])"
    rf"|(?P<at>\s{{0,3}}[\[({{<]\s{{0,3}}(?:{_AT}|@)\s{{0,3}}[\])}}>]\s{{0,3}})"
    rf"|(?P<dot>\s{{0,3}}[\[({{<]\s{{0,3}}(?:{_DOT}|\.)\s{{0,3}}[\])}}>]\s{{0,3}})"
    rf"|(?P<bare_at>(?<=[a-z0-9])\s{{1,3}}(?:{_AT})\s{{1,3}}"
    rf"(?=[a-z0-9-]{{1,63}}(?:\s{{1,3}}(?:{_DOT})\s|\s{{0,3}}[\[({{<]\s{{0,3}}(?:{_DOT}|\.))))"
    rf"|(?P<bare_dot>(?<=[a-z0-9])\s{{1,3}}(?:{_DOT})\s{{1,3}}(?=[a-z0-9]))"
    rf"|(?P<spelled>\b(?:{_SAID}|(?:{_PLUS}){_GAP}(?:{_SAID}|[0-9]{{1,4}}(?![0-9])))"
    rf"(?:{_GAP}(?:{_SAID}|{_DOT}|[0-9]{{1,4}}(?![0-9]))){{2,}}\b)"
    r"|(?P<letter>(?<=[0-9])[OolI](?=[0-9]))",
    re.I,
)
#: What each alternative of _REWRITE begins with or holds, in lower case, which is searched much
#: faster: an opened bracket (at, dot, bare_at), a dot between spaces (bare_at, bare_dot), two parts
#: of a spelled number, a letter in a number. Invisible characters are foreign.
_GATE = re.compile(
    rf"[\[({{<]\s{{0,3}}(?:{_AT}|@|{_DOT}|\.)|\s(?:{_DOT})\s"
    rf"|\b(?:{_WORDS}|(?:{_PLUS}){_GAP}[0-9]{{1,4}}){_GAP}(?:{_WORDS}|{_TWICE}|{_DOT}|[0-9])"
    r"|[0-9][oli][0-9]"
)
_TURKISH = str.maketrans("ıİ", "ii")
_SPOKEN = re.compile(rf"(?i)(?P<twice>{_TWICE})|(?P<dot>{_DOT})|(?P<plus>{_PLUS})|{_WORDS}|[0-9]")


def disguised(text: str) -> bool:
    """Whether anything in the text could be a disguise; cheap, and true too often only."""
    if _FOREIGN.search(text):
        return True
    # Where case is ignored, the Turkish letters count as i too.
    return bool(_GATE.search(text.translate(_TURKISH).lower() if not text.isascii() else text.lower()))


def normalised(text: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The text without disguises, and for each of its characters where the source
    characters that made it begin and end."""
    folded = text.translate(_FOLD)
    out, starts, ends, at = [], [], [], 0

    def keep(lo: int, hi: int) -> None:
        out.append(folded[lo:hi])
        starts.append(np.arange(lo, hi))
        ends.append(np.arange(lo + 1, hi + 1))

    def put(chars: str, lo: int, hi: int) -> None:
        out.append(chars)
        starts.append(np.full(len(chars), lo))
        ends.append(np.full(len(chars), hi))

    for token in _REWRITE.finditer(folded):
        keep(at, token.start())
        at = token.end()
        kind = token.lastgroup
        if kind in ("at", "bare_at"):
            put("@", token.start(), at)
        elif kind in ("dot", "bare_dot"):
            put(".", token.start(), at)
        elif kind == "letter":
            put("0" if token.group() in "Oo" else "1", token.start(), at)
        elif kind == "spelled":
            begin, times = None, 1
            for word in _SPOKEN.finditer(folded, token.start(), at):
                begin = word.start() if begin is None else begin
                if word["twice"]:
                    times = 2
                    continue
                said = word.group().lower()
                chars = "." if word["dot"] else "+" if word["plus"] else _DIGIT_WORDS.get(said, said)
                put(chars * times, begin, word.end())
                begin, times = None, 1
    keep(at, len(folded))
    return "".join(out), np.concatenate(starts), np.concatenate(ends)


def added_spans(text: str, plain: list[Span]) -> list[Span]:
    """Spans found once disguises are undone, without those inside a plain span of their kind."""
    if not disguised(text):
        return []
    clear, starts, ends = normalised(text)
    found = []
    for kind, lo, hi in plain_spans(clear):
        start, end = int(starts[lo]), int(ends[hi - 1])
        if not any(k == kind and s <= start and end <= e for k, s, e in plain):
            found.append((kind, start, end))
    return found


def all_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, plain) by start, then kind as listed, then end."""
    plain = plain_spans(text)
    marked = [(*span, True) for span in plain]
    marked += [(*span, False) for span in added_spans(text, plain)]
    return sorted(marked, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPANS = "array<struct<kind:string,start:long,end:long,plain:boolean>>"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): all spans of the whole text; `plain` says which need no deobfuscation.

    One row per row of `docs`, repeated rows included; other columns are not read. A null or
    empty text has an empty list. Texts may have any length.
    """

    def prepare():
        spans_type = pa.list_(
            pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                 ("plain", pa.bool_())]
            )
        )
        names = ("kind", "start", "end", "plain")

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [
                [dict(zip(names, span, strict=True)) for span in all_spans(text)]
                for text in part.column("text").to_pylist()
            ]
            columns = [part.column("doc_id"), pa.array(rows, spans_type)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "spans"])

        return work

    rows = keyed_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_text(rows, f"doc_id {kind}, spans {_SPANS}", prepare)


def redacted(text: str) -> str:
    """The text with each stretch of personal data replaced by its kind in brackets.
    Overlapping spans are one stretch, named after the first."""
    out, at, free = [], 0, 0
    for kind, start, end, _ in all_spans(text):
        if start >= free:
            out += [text[at:start], f"[{kind.upper()}]"]
        free = at = max(free, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with personal data in `text_col` replaced; null texts stay null, all other
    columns stay as they are."""

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.map(redacted, na_action="ignore")

    return docs.withColumn(text_col, clean(F.col(text_col)))


def _joined(spans: Column) -> Column:
    said = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.array_join(said, ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """The registered query: counts and a digest of the plain spans, and all spans as text.
    `n_added` counts those that only the deobfuscated text shows."""
    plain = F.filter("spans", lambda x: x["plain"])
    count = lambda kind: F.size(F.filter(plain, lambda x: x["kind"] == kind)).cast("long")
    return find_pii(docs).select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_joined(plain).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: ~x["plain"])).cast("long").alias("n_added"),
    )
