"""Frequent lines, fill-in-middle outputs and whitened vectors against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillroll.llm import infill, lines, queries, whitening

BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def small_sql():
    found = duckdb.connect()
    found.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    return found


@pytest.mark.parametrize("name", ["op12_lines", "op13_infill"])
def test_equals_sql(llm, small_sql, name):
    found = queries.queries()[name](llm, SMALL)
    told = small_sql.execute(queries.oracle_sql()[name])
    names = [x[0] for x in told.description]
    order = [names.index(c) for c in found.columns]
    expected = sorted(tuple(row[i] for i in order) for row in told.fetchall())
    assert sorted(tuple(row) for row in found.collect()) == expected


# --- lines ----------------------------------------------------------------------------


def key_of(line):
    return re.sub("[A-Z]", lambda x: x.group().lower(), line.strip(BLANKS))


def plain_lines(rows, documents, chars=1):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(doc_id if doc_id is not None else (text,))
    gone = {k for k, held in holders.items() if len(k) >= chars and len(held) >= documents}
    out = []
    for doc_id, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if key_of(x) not in gone]
        out.append((doc_id, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows():
    draw = random.Random(4)
    pool = ["Header", " header\t", "HEADER\r", "ÄÖ", "äö", "", "  ", "\x0b", "x" * 9000, "e\x1c", "e", "日本"]
    rows = [
        (i, "\n".join(draw.choice([*pool, f"own {i}", f"pair {i // 2}"]) for _ in range(draw.randrange(9))))
        for i in range(60)
    ]
    # Copies within a document, repeated rows, rows without id or text, a text of many lines.
    rows += [(100, "once\nonce\nonce"), *[(101, "again\nrow")] * 4, (None, "lost\nrow"), (None, "lost\nrow")]
    return rows + [(102, None), (103, ""), (104, "\n\n"), (105, "\n".join(map(str, range(3000))) + "\nheader")]


@pytest.mark.parametrize("documents,chars,share", [(2, 1, 4096), (4, 1, 4096), (2, 3, 4), (3, 0, 50)])
def test_lines_equal_a_plain_version(llm, monkeypatch, documents, chars, share):
    monkeypatch.setattr(lines, "HOT_SHARE", share)
    rows = line_rows()
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = lines.drop_lines(df, documents, chars)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_lines(rows, documents, chars)


def test_lines_touch_no_other_column(llm):
    names = ["d", "t1", "T2", "k1", "K2", "place", "places", "row", "kept", "line", "_", "a.b", "documents", "n lines"]
    rows = [(i, "same\nown %d" % i if i else None, *[f"{n} {i}" for n in names]) for i in range(12)]
    df = llm.createDataFrame(rows, ["doc_id", "text", *names])
    found = lines.without_lines(df)
    assert found.columns == df.columns and found.dtypes == df.dtypes
    expected = [(r[0], r[1] and r[1].removeprefix("same\n"), *r[2:]) for r in rows]
    assert sorted(map(tuple, found.collect())) == expected


def test_lines_of_no_rows(llm):
    empty = llm.createDataFrame([], "doc_id long, text string")
    assert lines.lines_digest(empty).collect() == []


def test_hot_lines_are_not_joined_by_key(llm):
    rows = [(i, f"hot\nown {i}\npair {i // 2}") for i in range(50)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    told = lines.lines_of(df)
    frequent = lines.staged(lines.frequent_lines(told, 2), "frequent")
    assert frequent.count() == 26
    counted = {r["documents"] for r in frequent.collect()}
    assert counted == {2, 50}
    assert lines.dropped_places(told, frequent).count() == 50


# --- fill in the middle ---------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def infill_rows():
    draw = random.Random(7)
    chars = ["a", "é", "日", "🙂", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "<", ">", "P>", "S", "<M"]
    texts = ["".join(draw.choice(chars) for _ in range(draw.randrange(300))) for _ in range(250)]
    texts += [None, "", " ", "a", " a ", "a <P> b", "<M>", "é" * 500, "no blank" * 300, " \n" * 400]
    rows = list(enumerate(texts)) + [(None, "no id here at all"), (5, texts[5]), (-3, "minus three words")]
    return rows


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 16])
def test_infill_equals_a_plain_version(size, monkeypatch, llm):
    """The functions that tasks run, with frames of any size."""
    monkeypatch.setattr(infill, "FRAME_BYTES", size)
    compress = zstandard.ZstdCompressor().compress
    for doc_id, text in infill_rows():
        data = (text or "").encode()
        unit_end, char = infill._marks(np.frombuffer(data, np.uint8), np.array([len(data)]))
        starts = infill._frame_starts(len(data), np.flatnonzero(unit_end) + 1)
        frames = [
            {"unit": int(unit_end[:a].sum()), "char": int(char[:a].sum()), "byte": a, "data": compress(data[a:b])}
            for a, b in zip(starts, [*starts[1:], len(data)], strict=True)
            if b
        ]
        marked = any(x in data for x in (b"<P>", b"<S>", b"<M>"))
        form, prefix, middle, output = infill.rearrange(
            doc_id, infill.StoredText(frames, len(data)), int(unit_end.sum()), marked, 42, compress
        )
        made = b"".join(infill._plain(output)).decode()
        assert (doc_id, int(unit_end.sum()), form, prefix, middle, made) == plain_infill(doc_id, text)
        assert b"".join(infill.restored(output, form)) == data


def test_infill_round_trip(llm):
    rows = infill_rows() + [(1000 + i, "wörter und " * 30_000 + str(i)) for i in range(4)]
    df = llm.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n string, form long")
    stored = infill.store(df.repartition(3))
    outputs = infill.fill_in_middle(stored)
    assert any(len(r["output"]) > 6 for r in outputs.collect())
    read = zstandard.ZstdDecompressor()
    found = []
    for r in outputs.collect():
        # One stream to any reader, read across its frames.
        whole = read.stream_reader(b"".join(r["output"]), read_across_frames=True).read().decode()
        found.append((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], whole))
    assert sorted(found, key=repr) == sorted((plain_infill(*r) for r in rows), key=repr)
    texts = [tuple(r) for r in infill.restore(outputs).collect()]
    assert sorted(texts, key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_infill_decompresses_only_the_frames_of_the_cuts(monkeypatch, llm):
    monkeypatch.setattr(infill, "FRAME_BYTES", 100)
    data = b"word " * 400
    compress = zstandard.ZstdCompressor().compress
    frames = [{"unit": i * 20, "char": i * 100, "byte": i * 100, "data": compress(data[i * 100 : i * 100 + 100])} for i in range(20)]
    text = infill.StoredText(frames, len(data))
    opened = []
    frame = text.frame
    monkeypatch.setattr(text, "frame", lambda number: opened.append(number) or frame(number))
    infill.rearrange(3, text, 400, False, 1, compress)
    assert len(set(opened)) <= 2


def test_infill_of_no_rows(llm):
    empty = llm.createDataFrame([], "doc_id long, text string")
    assert infill.infill_digest(empty).collect() == []


# --- whitening ------------------------------------------------------------------------


def plain_whitening(rows, by_copies=False):
    """(key, component) -> (n, deviation, whitened, explained), in exact numbers where possible."""
    def whole(vector):
        if vector is None or any(c is None or not np.isfinite(c) for c in vector) or not len(vector):
            return None
        return tuple(int(np.floor(256 * float(c))) for c in vector)

    x = [(key, whole(v)) for key, v in rows]
    out = []
    for size in {len(v) for _, v in x if v}:
        held = [v for _, v in x if v and len(v) == size]
        fit = held if by_copies else list(dict.fromkeys(held))
        n, sums = len(fit), [sum(v[i] for v in fit) for i in range(size)]
        moved = np.array([[(n * v[i] - sums[i]) / n for i in range(size)] for v in fit])
        values, vectors = np.linalg.eigh(moved.T @ moved / n)
        for key, v in x:
            if v and len(v) == size:
                exact = [n * c - s for c, s in zip(v, sums)]
                for k in range(min(4, size)):
                    e = values[-1 - k]
                    if e > values.sum() * size * 3e-16:
                        white = np.dot([c / n for c in exact], vectors[:, -1 - k]) / np.sqrt(e)
                        out.append((key, k + 1, n, sum(c * c for c in exact), abs(white), e / values.sum()))
                    else:
                        out.append((key, k + 1, n, sum(c * c for c in exact), None, None))
    return sorted(out, key=repr)


def vector_rows():
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 6)) @ np.diag([5, 4, 3, 2, 1, 0.5]) + 1000
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(None, rows[4][1]), (7, rows[7][1])]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 6)]
    rows += [(204, [float("inf")] + [0.0] * 5), (205, [0.5, 0.25]), (206, [1.5, -0.25]), (207, [-0.0, 0.001])]
    return rows + [(208, [1.0, 2.0, 3.0])]


@pytest.mark.parametrize("by_copies,share", [(False, 1024), (True, 1024), (False, 4)])
def test_whitening_equals_a_plain_version(llm, monkeypatch, by_copies, share):
    monkeypatch.setattr(whitening, "HOT_SHARE", share)
    rows = vector_rows()
    df = llm.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, x string")
    found = whitening.whiten_vectors(df.repartition(4), by_copies=by_copies).collect()
    assert len(found) == 4 * 72 + 3 * 2 + 3
    told = sorted(
        ((r.vec_id, r.component, r.n, r.deviation, r.whitened and abs(r.whitened), r.explained) for r in found),
        key=lambda r: repr(r[:4]),
    )
    expected = sorted(plain_whitening(rows, by_copies), key=lambda r: repr(r[:4]))
    assert [r[:4] for r in told] == [r[:4] for r in expected]
    for mine, theirs in zip(told, expected, strict=True):
        for a, b in zip(mine[4:], theirs[4:], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-8), (mine, theirs)
    assert max(r.identity_error for r in found if r.identity_error is not None) < 1e-9
    signs = {}
    for r in found:
        signs.setdefault((r.vec_id, r.component), set()).add(r.whitened)
    assert all(len(s) == 1 for key, s in signs.items() if key[0] is not None)


def test_whitening_of_given_vectors(llm):
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = queries.op11_whitening(llm, SMALL).collect()
    told = sorted(((r.vec_id, r.component, r.n, r.deviation) for r in found))
    expected = plain_whitening(rows)
    assert told == sorted(r[:4] for r in expected)
    known = {r[:2]: r[4:] for r in expected}
    for r in found:
        white, share = known[r.vec_id, r.component]
        assert abs(abs(r.whitened) - white) < 1e-6 and abs(r.explained - share) < 1e-9


def test_whitening_of_huge_numbers_and_no_rows(llm):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3e15, 2.0]), (4, [0.0, 0.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten_vectors(df).collect()
    assert len(found) == 8 and {r.n for r in found} == {4}
    assert all(r.deviation is None for r in found)
    assert whitening.whiten_vectors(df.filter("vec_id = 9")).collect() == []


def test_equal_vectors_are_computed_once(llm):
    rows = [(i, [float(i % 3), 1.0]) for i in range(90)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = df.select(whitening.quantised(F.col("embedding")).alias("x"))
    assert x.distinct().count() == 3
    assert {r.n for r in whitening.whiten_vectors(df).collect()} == {3}
    assert {r.n for r in whitening.whiten_vectors(df, by_copies=True).collect()} == {90}
