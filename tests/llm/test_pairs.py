"""Joins, repeated passages, vectors and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tillroll.llm import repeats, shingle_join, vectors
from tillroll.llm.components import _with_root, components
from tillroll.sources.shared import is_empty, shared_folder, staged


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def named_components(ids, linked):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


@pytest.fixture(scope="module")
def copies(llm):
    """Near copies with few and many changes, and texts that share a passage only."""
    dice = random.Random(4)
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(4))
    base, passage, rows = [word() for _ in range(120)], [word() for _ in range(60)], []
    for i in range(90):
        text = list(base)
        for _ in range(dice.randint(0, 8)):
            text[dice.randrange(120)] = word()
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join([word() for _ in range(30)] + passage)) for i in range(30)]
    rows += [(200, None), (201, ""), (202, "a"), (203, "A"), (204, "a b"), (205, rows[0][1])]
    return llm.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("words, num, region", [(3, 90, 2_000), (3, 90, 6), (5, 80, 6)])
def test_shingle_join(copies, words, num, region):
    sets = {row["doc_id"]: shingles(row["text"], words) for row in copies.collect()}
    near = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    want = named_components(list(sets), near)
    got = shingle_join.link_shingles(copies, words, num, 100, region_rows=region).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {
        i: (len(sets[i]), want[i]) for i in sets
    }


def test_regions_are_counted_in_map_tasks(copies, monkeypatch):
    """No stage brings all members of a region to one task to count them."""
    plans, staged = {}, shingle_join.staged

    def recorded(df, purpose, *more):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, purpose, *more)

    monkeypatch.setattr(shingle_join, "staged", recorded)
    shingle_join.link_shingles(copies, 3, 90, 100).count()
    assert "places" in plans and not [name for name, plan in plans.items() if "Window" in plan]
    assert "partial_count" in plans["shared"]


def shuffle_files(spark):
    """Spark's, not those of a test."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for top in manager.localDirsString() for x in Path(top).rglob("shuffle_*") if x.is_file()}


def test_written_tables_leave_no_shuffle_files(llm):
    rows = lambda: llm.range(9_000).groupBy((F.col("id") % 70).alias("k")).count().repartition(3, "k")
    before = shuffle_files(llm)
    table = staged(rows(), "counts")
    assert not is_empty(rows()) and is_empty(rows().filter("k < 0"))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert llm.conf.get(name, None) is None
    for _ in range(50):  # they go in the background
        left = shuffle_files(llm) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert table.count() == 70
    # A setting of the caller's stays.
    llm.conf.set(name, "false")
    try:
        staged(rows(), "counts")
        assert llm.conf.get(name) == "false"
    finally:
        llm.conf.unset(name)


def test_unlike_texts_are_not_taken_apart(llm, monkeypatch):
    """Long texts that share a passage where no shingle is known to be rare: 64 parts leave them
    together, 256 do not."""
    dice, made, whole = random.Random(5), [], shingle_join._whole_sets
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(5))
    passages = [[word() for _ in range(400)] for _ in range(2)]
    long = [[word() for _ in range(2_600)] + x for x in passages for _ in range(3)]
    near = [*long[0][:-40], "x", *long[0][-39:]]
    rows = [(i, " ".join(x)) for i, x in enumerate([*long, near])]

    def recorded(docs, words):
        made.append(sorted(r["doc_id"] for r in docs.select("doc_id").collect()))
        return whole(docs, words)

    monkeypatch.setattr(shingle_join, "_whole_sets", recorded)
    alike = np.zeros(1 << shingle_join.SKETCH_BITS, np.uint32)
    monkeypatch.setattr(shingle_join, "shingle_sketch", lambda docs, words: alike)
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in shingle_join.link_shingles(docs, 5, 80, 100).collect()}
    assert found == {**{i: i for i in range(6)}, 6: 0}
    assert made == [[0, 6]]


def test_groups_of_many_are_not_divided(llm):
    """Groups beyond the bound stay as they are, however far apart their members."""
    fine = [bytes([9 * (i == j) for j in range(256)]) for i in range(6)]
    rows = llm.createDataFrame([(i, 9, x) for i, x in enumerate(fine)], "num long, size int, fine binary")
    pairs = llm.createDataFrame([(1, 0), (2, 0), (3, 0), (5, 4)], "num long, pivot long")
    pairs_of = lambda most: sorted(map(tuple, shingle_join._divided(pairs, rows, 80, 100, most).collect()))
    assert pairs_of(3) == [(1, 0), (2, 0), (3, 0)]
    assert pairs_of(4) == []


def test_tables_of_a_stage_go(llm):
    folder = shared_folder(llm).removeprefix("file:")
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(i, f"{text} {i % 3}") for i in range(12)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    before = set(os.listdir(folder))
    assert shingle_join.first_of_each(docs).count() == 1
    left = {x.rpartition("-")[0] for x in set(os.listdir(folder)) - before if any(Path(folder, x).glob("*.parquet"))}
    assert "shingles" not in left and "pairs" not in left


def test_the_pipeline_keeps_one_table(llm):
    """Documents of a stage go once the next has written its own; the given ones stay."""
    folder = shared_folder(llm).removeprefix("file:")
    given, before = llm.read.parquet(f"{SMALL}/documents.parquet").count(), set(os.listdir(folder))
    assert corpus_pipeline.run(llm, SMALL).count()
    left = {x for x in set(os.listdir(folder)) - before if any(Path(folder, x).glob("*.parquet"))}
    names = {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES}
    assert {x.rpartition("-")[0] for x in left} & names == {"personal-data"}
    assert llm.read.parquet(f"{SMALL}/documents.parquet").count() == given


def test_odd_texts_join(odd):
    rows = shingle_join.link_shingles(odd).collect()
    assert len(rows) == odd.count()
    assert shingle_join.link_shingles(odd.limit(0)).count() == 0
    assert shingle_join.first_of_each(odd).columns == odd.columns


def test_one_of_each(llm):
    dice = random.Random(7)
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(4))
    a, b, c, d = ([word() for _ in range(80)] for _ in range(4))
    near = " ".join([*a[:-1], "zzz"])
    a, b, c, d = map(" ".join, (a, b, c, d))
    rows = [
        (5, a, 1), (None, a, 2), (3, near, 3), (9, a, 4), (3, near, 3),
        (None, b, 5), (None, b, 5), (None, c, 6), (8, c, 7), (8, c, 7), (8, d, 8),
        (1, "", 9), (1, "", 9), (None, None, 10), (2, " ", 11),
    ]
    docs = llm.createDataFrame(rows, "doc_id long, text string, n_chars int").repartition(4)
    found = shingle_join.link_shingles(docs, 5, 80, 100).collect()
    want = [3] * 5 + [None] * 2 + [8] * 4 + [1, 1, None, 2]
    key = lambda x: (x is None, x or 0)
    assert sorted((r["component_id"] for r in found), key=key) == sorted(want, key=key)
    left = sorted(tuple(r) for r in shingle_join.first_of_each(docs).collect() if r["doc_id"])
    assert left == sorted([(1, "", 9), (1, "", 9), (2, " ", 11), (3, near, 3), (8, c, 7), (8, d, 8)])
    nameless = shingle_join.first_of_each(docs).filter("doc_id IS NULL").collect()
    assert sorted(r["n_chars"] for r in nameless) == [5, 10]


def test_components(llm):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = components(llm.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["root"] for r in found} == {i: 0 for i in range(1, 41)} | {95: 90, 100: 90}


def without(texts, size):
    starts = {}
    for n, text in enumerate(texts):
        for at in range(len(text) - size + 1):
            starts.setdefault(text[at : at + size], []).append((n, at))
    gone = [bytearray(len(text)) for text in texts]
    for places in starts.values():
        if len(places) > 1:
            for n, at in places:
                gone[n][at : at + size] = b"\1" * size
    return [bytes(c for c, g in zip(t, x, strict=True) if not g) for t, x in zip(texts, gone, strict=True)]


def test_components_of_hot_centres(llm):
    """Centres with most of the edges, beside chains and pairs; ids may be numbers or bytes."""
    edges = [(5_000, i) for i in range(0, 3_000, 2)] + [(7, i) for i in range(1, 2_000, 2)]
    edges += [(9_000 + i, 9_001 + i) for i in range(60)] + [(20_000 + i, 30_000 + i) for i in range(200)]
    edges += [(7, 7), (40_000, 40_000), (7, 1)]
    table = llm.createDataFrame(edges, "a long, b long")
    root = {}
    for group in (range(0, 3_000, 2), [5_000], range(1, 2_000, 2)):
        root |= {i: group[0] if group[0] in (0, 1) else 0 for i in group}
    root |= {9_000 + i: 9_000 for i in range(61)}
    root |= {30_000 + i: 20_000 + i for i in range(200)} | {20_000 + i: 20_000 + i for i in range(200)}
    want = {i: r for i, r in root.items() if i != r}
    assert {row["id"]: row["root"] for row in components(table).collect()} == want
    text = _with_root(table, len(edges))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"place#\d+L = place#\d+L", text)
    raw = table.select(F.encode(F.lpad("a", 9, "0"), "UTF-8").alias("a"), F.encode(F.lpad("b", 9, "0"), "UTF-8").alias("b"))
    got = {int(bytes(row["id"])): int(bytes(row["root"])) for row in components(raw).collect()}
    assert got == want


@pytest.mark.parametrize("rows", [2_000, 3])
def test_repeats(llm, monkeypatch, rows):
    monkeypatch.setattr(repeats, "GROUP_ROWS", rows)
    dice = random.Random(5)
    p = "".join(dice.choice("abcdé ") for _ in range(900))
    texts = [
        "ab" * 500, "abc" * 300 + "x" + "abc" * 250, "x" * 399, "y" * 400, "z" * 401, p,
        "q" + p[:420] + "r", p[100:499] + "w", p[100:500] + "v", p[300:800] + p[200:700], None, "",
        p[:420][::-1], "é" * 250, "é" * 250 + "f", "same" * 120, "same" * 120,
        *(f"{i}" * (i % 7) + p[i : i + 430] + f"{i}" * 9 for i in range(40)),
    ]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = without([(t or "").encode() for t in texts], 400)
    got = {r["doc_id"]: r for r in repeats.repeats_digest(docs).collect()}
    for i, (text, kept) in enumerate(zip(texts, want, strict=True)):
        assert got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest(), i
        assert got[i]["n_bytes"] == len((text or "").encode())
        assert got[i]["n_removed"] == got[i]["n_bytes"] - len(kept)


def test_copies_are_compared_once(llm, monkeypatch):
    seen, windows = [], repeats._windows
    monkeypatch.setattr(repeats, "_windows", lambda rows, *n: seen.append(rows.count()) or windows(rows, *n))
    dice = random.Random(9)
    p = "".join(dice.choice("abcdé ") for _ in range(900))
    texts = [p] * 60 + [p[:500] + "w" + p[501:]]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = without([t.encode() for t in texts], 400)
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(docs).collect()}
    assert got == dict(enumerate(want)) and seen == [2]


def test_passages_of_51_words(llm):
    dice = random.Random(8)
    word = lambda n: "".join(dice.choice("abcdefghijkl") for _ in range(n))
    short, wide, few = ([word(n) for _ in range(k)] for n, k in ((1, 51), (4, 51), (9, 30)))
    solid = word(450)
    texts = [
        " ".join([word(7) for _ in range(20)] + passage + [word(7) for _ in range(20)])
        for passage in (short, wide, few, [solid])
        for _ in range(2)
    ]
    docs = llm.createDataFrame(list(enumerate(texts)), "n_chars int, text string").repartition(3)
    left = {r["n_chars"]: r["text"] for r in corpus_pipeline.repeats.without_repeats(
        docs, length=corpus_pipeline.PASSAGE_WORDS, unit="words").collect()}
    staged = corpus_pipeline.repeated_passages(llm, docs, SMALL)
    assert sorted(r["text"] for r in staged.collect()) == sorted(left.values())
    for i, passage in enumerate((short, wide, few, [solid])):
        for n in (2 * i, 2 * i + 1):
            gone = len(texts[n].split()) - len(left[n].split())
            assert gone == (51 if len(passage) == 51 else 0), (i, n)
            assert all(x in left[n].split() for x in [*texts[n].split()[:20], *texts[n].split()[-20:]])


def test_chained_passages_stay(llm):
    """Two of 30 words, each of another document, are no passage of 51."""
    dice = random.Random(2)
    word = lambda: "".join(dice.choice("abcdefghijkl") for _ in range(6))
    first, second = ([word() for _ in range(60)] for _ in range(2))
    both = [*(word() for _ in range(40)), *first[10:40], *second[10:40], *(word() for _ in range(40))]
    texts = [" ".join(first), "\n".join(second), " ".join(both)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in repeats.without_repeats(docs, length=51, unit="words").collect()}
    assert left == dict(enumerate(texts))


def marked_words(texts, size):
    """For each text which words a window of `size` words covers that starts elsewhere too."""
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in texts]
    starts = {}
    for n, held in enumerate(words):
        for at in range(len(held) - size + 1):
            starts.setdefault(tuple(held[at : at + size]), []).append((n, at))
    marks = [bytearray(len(held)) for held in words]
    for places in starts.values():
        for n, at in places if len(places) > 1 else ():
            marks[n][at : at + size] = b"\1" * size
    return marks


def without_words(text, marks):
    """`text` without the runs of marked words and the blanks within them."""
    out, at = b"", 0
    spans = [x.span() for x in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    for gone, run in itertools.groupby(range(len(spans)), key=lambda i: marks[i]):
        run = list(run)
        if gone:
            out += text[at : spans[run[0]][0]]
            at = spans[run[-1]][1]
    return out + text[at:]


@pytest.mark.parametrize("rows,size", [(2_000, 4), (3, 9), (2_000, 51)])
def test_repeated_words(llm, monkeypatch, rows, size):
    monkeypatch.setattr(repeats, "GROUP_ROWS", rows)
    dice = random.Random(3)
    blanks = [" ", "  ", "\n", "\t ", "\x0b"]
    text = lambda words: "".join(w + dice.choice(blanks) for w in words)
    pool = [dice.choice(["a", "bé", "日本", "x\x1cy", "w\xa0"]) + str(dice.randrange(900)) for _ in range(300)]
    texts = [text(pool[a : a + dice.randrange(160)]) for a in (dice.randrange(250) for _ in range(60))]
    texts += [text(["to"] * 130), text(["to", "be"] * 100 + ["x"]), "", None, "  ", text(pool), text(pool[:50])]
    texts += [texts[0], texts[0], text(["k"] * 50), text(pool[::-1] + pool[7:80]), "one", "one"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    data = [(t or "").encode() for t in texts]
    want = {i: without_words(t, m) for i, (t, m) in enumerate(zip(data, marked_words(data, size), strict=True))}
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(docs, size, unit="words").collect()}
    assert got == want


CLASHING = ["text_hash", "_Unnamed", "_id", "_hash", "doc", "SIZE", "row", "kept", "_null", "_name", "_salt", "_group", "_d",
            "_x0", "_m0", "_l00", "_quality_kept", "n_words", "base_failed", "num", "node", "root", "unnamed", "a.b", "hash"]


def test_stages_touch_no_other_column(llm):
    given = llm.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    named = given.select("*", *(F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASHING))
    for name in ("quality rules", "near duplicates", "repeated passages"):
        stage = dict(corpus_pipeline.STAGES)[name]
        found = stage(llm, named, SMALL)
        assert found.columns == named.columns, name
        rows = found.collect()
        plain = {r["doc_id"]: r["text"] for r in stage(llm, given, SMALL).collect()}
        assert {r["doc_id"]: r["text"] for r in rows} == plain and plain, name
        assert all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASHING), name


def test_odd_repeats(odd):
    assert repeats.remove_repeats(odd).count() == odd.count()
    left = repeats.without_repeats(odd)
    assert left.columns == odd.columns and left.filter("text IS NULL").count() == 1
    assert repeats.remove_repeats(odd.limit(0)).count() == 0


def test_vectors(llm):
    dice = np.random.default_rng(6)
    centres = dice.standard_normal((40, 16))
    near = centres[dice.integers(0, 40, 600)] + dice.normal(0, 0.12, (600, 16))
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(near)]
    rows += [(700, rows[0][1], 0), (701, [2 * x for x in rows[0][1]], 0)]
    odd = [(800, [0.0] * 16, 0), (801, None, 0), (802, rows[0][1], None), (803, [float("nan")], 0)]
    odd += [(804, [None, 1.0], 0), (None, [1.0], 1), (805, [], 0)]
    schema = "vec_id long, embedding array<double>, label int"
    found = vectors.link_vectors(llm.createDataFrame(rows + odd, schema).repartition(4)).collect()
    got = {r["vec_id"]: r for r in found}
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([k for _, _, k in rows])
    close = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    want = close.sum(axis=1) - 1
    links = np.array([got[i]["n_links"] for i, _, _ in rows])
    assert (links <= want).all() and links.sum() >= 0.95 * want.sum()
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _, _ in odd)
    assert vectors.link_vectors(llm.createDataFrame([], schema)).count() == 0


def test_vector_components(llm):
    """Links, components and the kept row against all pairs, with clusters, copies and chains."""
    dice = np.random.default_rng(8)
    rows = []
    for _ in range(6):
        at, step = dice.normal(size=24), dice.normal(size=24) * 0.02
        near = [at + dice.normal(size=24) * 0.01 for _ in range(25)]
        rows += near + near[:3] + [at + 40 + step * i for i in range(12)]
    rows += list(dice.normal(size=(60, 24)))
    order = dice.permutation(len(rows))
    given = [(int(i), [float(x) for x in rows[at]], int(at) % 2) for i, at in enumerate(order)]
    found = vectors.link_vectors(llm.createDataFrame(given, "vec_id long, embedding array<double>, label int").repartition(4))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in given}
    label = {i: kind for i, _, kind in given}

    def linked(a, b):
        return label[a] == label[b] and float(unit[a] @ unit[b]) >= vectors.COSINE

    links = {a: sum(linked(a, b) for b in unit if b != a) for a in unit}
    root = named_components(list(unit), linked)
    got = {row["vec_id"]: row for row in found.collect()}
    assert sum(links.values()) > 2_000
    # Searched by buckets: nothing false, and all but a few of the links.
    assert all(got[i]["n_links"] <= links[i] for i in links)
    assert sum(row["n_links"] for row in got.values()) >= 0.95 * sum(links.values())
    for i, row in got.items():
        assert root[row["component_id"]] == root[i] and row["kept"] == (row["component_id"] == i)
    agree = sum(row["component_id"] == root[i] for i, row in got.items())
    assert agree >= 0.95 * len(got)


def test_pipeline(llm, odd):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(llm, docs, SMALL), "stage")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= rows
        rows = docs.count()
    assert corpus_pipeline.STAGES[-1][1](llm, docs, SMALL).select("doc_id").distinct().count() == rows
    for name, stage in corpus_pipeline.STAGES:
        assert stage(llm, odd.limit(0), SMALL).count() == 0, name
        assert stage(llm, odd, SMALL).count() <= 1_000, name


def one_of_each(rows):
    """Rows in groups, one of which stays with the smallest id: ([rows], ids that may)."""
    sets = [shingles(r["text"], 5) for r in rows]
    near = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    groups = {}
    for i, top in named_components(range(len(rows)), near).items():
        groups.setdefault(top, []).append(rows[i])
    return list(groups.values())


def test_stages_against_plain_versions(llm, tmp_path):
    given = llm.read.parquet(f"{SMALL}/documents.parquet")
    rows = [r.asDict() for r in given.filter("n_chars > 900").orderBy("doc_id").limit(60).collect()]
    passage = " ".join(rows[0]["text"].split()[10:61])
    tenth = " ".join(rows[1]["text"].split()[5:15])
    for i, more in ((2, passage), (3, passage), (4, tenth), (5, tenth)):
        rows[i]["text"] += f" then{i} {more} {i}later"
    rows += [rows[6], rows[6], rows[7] | {"doc_id": None}, rows[8] | {"doc_id": None}]
    rows[8] = rows[8] | {"doc_id": None}
    rows.append(rows[9] | {"doc_id": None, "text": rows[9]["text"] + " one two more"})
    docs = llm.createDataFrame(rows, given.schema).repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs, stages = llm.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES)
    key = lambda r: (str(r["doc_id"]), r["text"] or "")

    def after(name, docs):
        docs = corpus_pipeline.staged(stages[name](llm, docs, str(tmp_path)), "stage")
        return docs, sorted((r.asDict() for r in docs.collect()), key=key)

    judged = corpus_pipeline.quality.assess_quality(docs).filter("kept").collect()
    docs, good = after("quality rules", docs)
    assert [str(r["doc_id"]) for r in good] == sorted(str(r["doc_id"]) for r in judged)
    assert sum(r["doc_id"] is None for r in good) > 1

    docs, left = after("near duplicates", docs)
    groups = one_of_each(good)
    assert len(left) == len(groups) < len(good)
    for group in groups:
        ids = [r["doc_id"] for r in group if r["doc_id"] is not None]
        stays = [r for r in group if r in left]
        assert {r["doc_id"] for r in stays} == {min(ids) if ids else None}

    texts = [(r["text"] or "").encode() for r in left]
    marks = marked_words(texts, 51)
    want = {key(r)[0]: without_words(x, m).decode() for r, x, m in zip(left, texts, marks, strict=True)}
    docs, cut = after("repeated passages", docs)
    assert sorted((str(r["doc_id"]), r["text"]) for r in cut if r["doc_id"] is not None) == sorted(
        (i, x) for i, x in want.items() if i != "None"
    )
    assert any(passage in r["text"] for r in left) and not any(passage in r["text"] for r in cut)
    assert sum(tenth in r["text"] for r in cut) == sum(tenth in r["text"] for r in left)

    docs, clean = after("personal data", docs)
    redacted = sorted((str(r["doc_id"]), corpus_pipeline.pii.redacted(r["text"])) for r in cut)
    assert sorted(map(key, clean)) == redacted
    assert all(r["n_chars"] == len(r["text"]) for r in clean)

    pieces = stages["packing"](llm, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in clean}
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = lambda rows: sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0)
    ran = corpus_pipeline.run(llm, str(tmp_path))
    assert set(columns) <= set(ran.columns) and whole(ran.collect()) == whole(pieces)
