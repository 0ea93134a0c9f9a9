"""Lines that stand in many documents, dropped from all of them.

Texts are exploded into lines, each with its place and a 128-bit hash of its normalised form.
Documents are counted by hash, and lines whose hash is frequent are dropped. What is moved are
hashes and places; texts go once, to the list of their dropped places.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.shared import discard, staged

from .slices import map_text

#: Documents a line has to stand in, and characters its normalised form has to have.
DOCUMENTS, CHARS = 10, 1
#: A line that takes more than one in so many places is hot: there are fewer such lines than this,
#: and their hashes are broadcast, 100 KB at most. All others are joined.
HOT_SHARE = 4_096

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["k1", "k2"]


def normalised(line: Column) -> Column:
    """Blanks at both ends removed, A-Z in lower case, all else as it is."""
    line = F.btrim(line, F.lit(_BLANKS))
    # Beyond ASCII the general rules would change more than A-Z, and are the faster ones within.
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))


def _hashes(text: Column, names: list[str]) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(12), text).alias(names[1])]


def lines_of(texts: DataFrame, chars: int = CHARS) -> DataFrame:
    """(doc_id, d, t1, t2, place, k1, k2): the lines of (doc_id, text) whose normalised form has
    `chars` characters, with hashes of the id, the text and the line."""
    row = [F.xxhash64("doc_id").alias("d"), *_hashes(F.col("text"), ["t1", "t2"])]
    split = F.posexplode(F.split("text", "\n", -1)).alias("place", "line")
    lines = texts.select("doc_id", *row, split).withColumn("line", normalised(F.col("line")))
    lines = lines.filter(F.char_length("line") >= chars)
    return lines.select("doc_id", "d", "t1", "t2", "place", *_hashes(F.col("line"), _HASH))


def frequent_lines(lines: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(k1, k2, documents) of lines that stand in so many documents.

    Rows with one id are one document; a row without an id is told by its text. Distinct
    documents are found first, so a line of a third of all rows is spread by them, and counts
    are merged in the map tasks.
    """
    unnamed = F.when(F.col("doc_id").isNull(), F.struct("t1", "t2"))
    holders = lines.select(*_HASH, "doc_id", unnamed.alias("unnamed")).distinct()
    counts = holders.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("documents"))
    return counts.filter(F.col("documents") >= documents)


def dropped_places(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(d, t1, t2, places): what every document loses. `frequent` is a written table."""
    total = frequent.agg(F.sum("documents")).first()[0] or 0
    is_hot = F.col("documents") * HOT_SHARE > total
    hot = F.broadcast(frequent.filter(is_hot).select(*_HASH))
    rest = frequent.filter(~is_hot).select(*_HASH)
    found = lines.join(hot, _HASH, "left_semi").unionByName(
        lines.join(hot, _HASH, "left_anti").join(rest, _HASH, "left_semi")
    )
    return found.groupBy("d", "t1", "t2").agg(F.collect_set("place").alias("places"))


def drop_lines(
    docs: DataFrame,
    documents: int = DOCUMENTS,
    chars: int = CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for each row of `docs`, with `carry` as struct `row`.

    A null or empty text is one empty line, and a line without characters stays unless `chars` is
    0. Repeated rows are one document and each keeps the same lines. Columns other than the two
    and `carry` are not read. No rows in, no rows out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(0)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), row.alias("row"))
    lines = staged(lines_of(rows.select("doc_id", "text"), chars), "lines")
    frequent = staged(frequent_lines(lines, documents), "frequent-lines")
    places = staged(dropped_places(lines, frequent), "dropped-lines")
    discard(lines, frequent)
    keyed = rows.select(
        "*", F.xxhash64("doc_id").alias("d"), *_hashes(F.col("text"), ["t1", "t2"])
    )
    joined = keyed.join(places, ["d", "t1", "t2"], "left").select("doc_id", "row", "text", "places")

    def prepare():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            sizes, dropped, kept = [], [], []
            texts, places = part.column("text").to_pylist(), part.column("places").to_pylist()
            for text, gone in zip(texts, places, strict=True):
                lines = text.split("\n")
                gone = set(gone or ())
                sizes.append(len(lines))
                dropped.append(len(gone))
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
            counts = [pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64())]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), *counts, pa.array(kept, pa.string())],
                ["doc_id", "row", "n_lines", "n_dropped", "kept"],
            )

        return work

    schema = T.StructType(
        [
            *(T.StructField(name, rows.schema[name].dataType) for name in ("doc_id", "row")),
            *(T.StructField(name, T.LongType()) for name in ("n_lines", "n_dropped")),
            T.StructField("kept", T.StringType()),
        ]
    )
    found = map_text(joined, schema, prepare)
    return found if carry else found.drop("row")


def without_lines(
    docs: DataFrame, documents: int = DOCUMENTS, chars: int = CHARS, text_col: str = "text"
) -> DataFrame:
    """`docs` without their frequent lines; null texts stay null, other columns as they are."""
    found = drop_lines(docs, documents, chars, text_col=text_col, carry=tuple(docs.columns))
    row = F.col("row")
    text = F.when(row[text_col].isNotNull(), F.col("kept"))
    return found.select(*((text if c == text_col else row[c]).alias(c) for c in docs.columns))


def lines_digest(docs: DataFrame) -> DataFrame:
    """The registered query: counts, and a digest of what is kept."""
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return drop_lines(docs).select("doc_id", "n_lines", "n_dropped", digest)


#: The same in DuckDB SQL.
LINES_SQL = """
WITH base AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM base
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT k.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(f.key) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY k.doc_id
"""
