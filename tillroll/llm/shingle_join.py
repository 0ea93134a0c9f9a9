"""Exact Jaccard join of shingle sets by recursive pivot regions.

Jaccard distance grows with the size of the symmetric difference, which is a metric. Relative to
a pivot p a set x is its difference dx = x ^ p, and |x ^ y| = |dx ^ dy|. For two linked sets
either dx and dy share an element, and then x and y meet in the region of that element;
or |dx| + |dy| = |x ^ y|, and then the triangle inequality makes both of them linked to p. So
a region is divided by testing its members against one pivot and replicating each to the
regions of its difference: by the same inequality at most |x| (1 - t) / t elements of dx can be
missing from dy, so that one more, in an order that all share, always has one in common.

The first pivot is the empty set, whose differences are the sets themselves: ordinary pivots
have distance one from nearly all documents of a corpus and would divide nothing. The common order
there takes rare shingles first, by a counting sketch of all documents. Its regions are cut into
rings of size, with documents at a border in both, and into groups that the triangle inequality
leaves together: the universe has 64 parts, and sets are at least as far apart as their counts
in the parts differ. Those groups are divided once more by 256 parts, as 64 tell sets of over
1,600 shingles no longer apart; whole sets are made only of what is left together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import discard, is_empty, shuffles_removed, staged

from .components import components
from .slices import list_array, map_text, slices

WORDS, NUMERATOR, DENOMINATOR = 3, 90, 100
#: Counters of the sketch: four bytes each, all that is ever broadcast.
SKETCH_BITS = 22
_SKETCH_BLOCK = 1 << 16
_SLOTS = 32
#: Members of a region that one task compares with each other; larger ones get a pivot.
REGION_ROWS = 2_000
#: Elements of their differences that such a task may hold.
REGION_ITEMS = 1_000_000
#: Parts of the universe whose counts bound how far two sets are apart.
PARTS = 64
#: The same for the groups that those leave, a byte each.
FINE_PARTS = 256
#: Width of the rings around the empty set, as a logarithm of the size.
RING = 0.7
_TABLE_ROWS = 150_000
_COLUMNS = 1024

_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hashes of distinct words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str], words: int, table: WordHashes) -> list[np.ndarray]:
    """The set of each text as ascending numbers: shingles of `words` words, A-Z in lower case;
    of a text with fewer words its whole sequence, of one without words nothing."""
    if len(table) > _TABLE_ROWS:
        table.clear()
    split = [text.encode().lower().split() for text in texts]
    counts = np.array([len(x) for x in split], np.int64)
    flat = np.fromiter(
        (h for x in split for h in map(table.__getitem__, x)), np.uint64, int(counts.sum())
    )
    ends = np.cumsum(counts)
    h = np.zeros(max(0, len(flat) - words + 1), np.uint64)
    for i in range(words):
        h = _mixed(h * np.uint64(_MIX[0]) + flat[i : i + len(h)])
    found = []
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if n >= words:
            found.append(np.unique(h[end - n : end - words + 1].view(np.int64)))
        elif n:
            whole = b" ".join(flat[end - n : end].tobytes()[i : i + 8] for i in range(0, 8 * n, 8))
            found.append(np.array([xxhash.xxh3_64_intdigest(whole)], np.uint64).view(np.int64))
        else:
            found.append(np.zeros(0, np.int64))
    return found


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def _added_up(rows: DataFrame, kind: str) -> DataFrame:
    """Sums of the counters of rows that follow each other and have the same block and slot.
    `kind`: numbers as they come; sums are of four bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def emit() -> pa.RecordBatch:
            block, slot = key
            columns = [[block], [slot], [total.astype("<u4").tobytes()]]
            types = (pa.int32(), pa.int32(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["block", "slot", "counts"])

        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column("block")[row].as_py(), batch.column("slot")[row].as_py()
                counts = np.frombuffer(batch.column("counts")[row].as_py(), kind)
                if here != key:
                    if key is not None:
                        yield emit()
                    key, total = here, np.zeros(len(counts), np.uint64)
                total = np.minimum(total + counts, np.uint64(2**32 - 1))
        if key is not None:
            yield emit()

    return rows.mapInArrow(run, "block int, slot int, counts binary")


def shingle_sketch(docs: DataFrame, words: int) -> np.ndarray:
    """How many documents have a shingle, added up over all shingles of a cell, for the whole
    corpus. Every task sends one array of fixed size, a byte for each cell: beyond 255 in one
    task a cell is frequent however many there are. They are added up in two steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int32)
        slot = TaskContext.get().partitionId() % _SLOTS
        for batch in batches:
            for part in slices(batch, "text"):
                for one in shingle_sets(part.column("text").to_pylist(), words, table):
                    np.add.at(total, _cell(one), 1)
        for block in range(len(total) // _SKETCH_BLOCK):
            counts = total[block * _SKETCH_BLOCK : (block + 1) * _SKETCH_BLOCK]
            counts = np.minimum(counts, 255).astype(np.uint8)
            arrays = [
                pa.array([block], pa.int32()),
                pa.array([slot], pa.int32()),
                pa.array([counts.tobytes()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "slot", "counts"])

    made = docs.select("text").mapInArrow(run, "block int, slot int, counts binary")
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    with shuffles_removed(docs.sparkSession):
        once = made.repartition("block", "slot").sortWithinPartitions("block", "slot")
        once = _added_up(once, "u1").withColumn("slot", F.lit(0).cast("int"))
        twice = _added_up(once.repartition("block").sortWithinPartitions("block"), "<u4").collect()
    for row in twice:
        at = row["block"] * _SKETCH_BLOCK
        sketch[at : at + _SKETCH_BLOCK] = np.frombuffer(row["counts"], "<u4")
    return sketch


def _prefixes(docs: DataFrame, words: int, num: int, den: int, sketch: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, node, size, prefix, counts, fine): a digest of each set, of its elements,
    rarest first, as many as must include one that a linked set has too, and how many are
    in each part of the universe, up to 65,535, and in each of its finer parts, up to 255."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def prepare():
        table, rarity = WordHashes(), shared.value

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle_sets(part.column("text").to_pylist(), words, table)
            nodes, fronts, parts, fine = [], [], [], []
            for one in sets:
                nodes.append(xxhash.xxh3_128_digest(one.tobytes()) if len(one) else None)
                order = np.argsort(rarity[_cell(one)], kind="stable")
                fronts.append(one[order[: len(one) + (-num * len(one)) // den + 1]])
                inside = np.bincount((one >> 12) & (PARTS - 1), minlength=PARTS)
                parts.append(np.minimum(inside, 65535).astype("<u2").tobytes())
                inside = np.bincount((one >> 12) & (FINE_PARTS - 1), minlength=FINE_PARTS)
                fine.append(np.minimum(inside, 255).astype("u1").tobytes())
            fronts = [x if len(one) else one for x, one in zip(fronts, sets, strict=True)]
            ends = np.cumsum([len(x) for x in fronts])
            return pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(nodes, pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    list_array(np.concatenate(fronts).astype(np.int64), ends),
                    pa.array(parts, pa.binary()),
                    pa.array(fine, pa.binary()),
                ],
                ["doc_id", "text_hash", "node", "size", "prefix", "counts", "fine"],
            )

        return work

    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, node binary, size long, prefix array<long>"
    return map_text(rows, schema + ", counts binary, fine binary", prepare)


def _groups(rows: DataFrame, num: int, den: int, kind: str = "<u2") -> DataFrame:
    """(num, pivot) for members of a region that may have a link in it; members follow each
    other. Those whose counts are near enough, directly or through others, share a pivot.
    `kind`: of the numbers in `counts`."""

    def grouped(held: list[tuple]) -> Iterator[tuple]:
        sizes = np.array([x[1] for x in held])
        counts = np.array([np.frombuffer(x[2], kind) for x in held], np.int32)
        root = list(range(len(held)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in range(len(held) - 1):
            apart = np.abs(counts[i + 1 :] - counts[i]).sum(axis=1, dtype=np.int64)
            may = (den + num) * apart <= (den - num) * (sizes[i + 1 :] + sizes[i])
            for j in (np.flatnonzero(may) + i + 1).tolist():
                a, b = sorted((top(i), top(j)))
                root[b] = a
        for i, member in enumerate(held):
            if top(i) != i:
                yield member[0], held[top(i)][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: set[tuple] = set()

        def emit() -> pa.RecordBatch:
            ends = list(zip(*out, strict=True)) if out else [(), ()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in ends], ["num", "pivot"]
            )

        region = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("region", "num", "size", "counts")]
            for here, *member in zip(*columns, strict=True):
                if here != region:
                    if len(held) > 1:
                        out.update(grouped(held))
                    held.clear()
                    region = here
                held.append(member)
            if len(out) > 20_000:
                yield emit()
        if len(held) > 1:
            out.update(grouped(held))
        yield emit()

    return rows.mapInArrow(run, "num long, pivot long")


def _divided(
    pairs: DataFrame, rows: DataFrame, num: int, den: int, region_rows: int
) -> DataFrame:
    """`pairs` (num, pivot) where groups of up to `region_rows` are divided by their finer counts:
    those that these keep apart have no link."""
    groups = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
    small = F.col("members") < region_rows  # and the pivot
    placed = pairs.join(groups, "pivot")
    pivots = groups.filter(small).select(F.col("pivot").alias("region"), F.col("pivot").alias("num"))
    few = placed.filter(small).select(F.col("pivot").alias("region"), "num").union(pivots)
    few = few.join(rows.select("num", "size", F.col("fine").alias("counts")), "num")
    few = few.repartition("region").sortWithinPartitions("region", "num")
    return _groups(few, num, den, "u1").union(placed.filter(~small).select("num", "pivot")).distinct()


def _whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, size, items): sets of the given texts, each once."""

    def prepare():
        table = WordHashes()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle_sets(part.column("text").to_pylist(), words, table)
            ends = np.cumsum([len(x) for x in sets])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    list_array(np.concatenate(sets), ends),
                ],
                ["node", "size", "items"],
            )

        return work

    found = map_text(docs.select("text"), "node binary, size long, items array<long>", prepare)
    return found.dropDuplicates(["node"])


def _difference(a: str, b: str) -> Column:
    return F.concat(F.array_except(a, b), F.array_except(b, a))


def _near(apart: Column, both: Column, num: int, den: int) -> Column:
    """Jaccard similarity of num/den or more, from |x ^ y| and |x| + |y|."""
    return (den + num) * apart <= (den - num) * both


def _unsettled(places: DataFrame) -> DataFrame:
    """(region, members, items) of the regions that have two members or more, not all of them
    linked to the pivot; `items` are the elements of their differences, `weight` together."""
    found = places.groupBy("region").agg(
        F.count(F.lit(1)).alias("members"),
        F.sum("weight").alias("items"),
        F.bool_and("near").alias("done"),
    )
    return found.filter((F.col("members") > 1) & ~F.col("done")).drop("done")


def _subregions(tested: DataFrame, num: int, den: int) -> DataFrame:
    """Members (num, size, near, apart) of the regions of their difference to the pivot."""
    enough = F.floor(F.col("size") * (den - num) / num) + 1
    front = F.slice(F.array_sort("apart"), 1, enough.cast("int"))
    weight = F.size("apart").alias("weight")
    spread = tested.select(
        F.col("region").alias("whole"), "num", "near", weight, F.explode(front).alias("at")
    )
    spread = spread.withColumn(
        "region", F.unhex(F.md5(F.concat_ws("/", F.hex("whole"), F.hex("at"))))
    )
    left = spread.drop("near", "at", "weight").join(_unsettled(spread), "region")
    members = tested.select(F.col("region").alias("whole"), "num", "size", "near", "apart")
    return left.join(members, ["whole", "num"]).drop("whole")


def _compared(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that connect the linked members of each region; members of a region
    follow each other. Those linked to the region's pivot are connected already."""

    def edges(nodes: list, sizes: np.ndarray, near: np.ndarray, lists: list) -> Iterator[tuple]:
        length = np.array([len(x) for x in lists])
        owner = np.repeat(np.arange(len(nodes)), length)
        _, item, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        # Items of one member are in no intersection; the others go by blocks of columns.
        shared = times[item] > 1
        owner, item = owner[shared], (np.cumsum(times > 1) - 1)[item[shared]]
        both = np.zeros((len(nodes), len(nodes)), np.float32)
        for first in range(0, int((times > 1).sum()), _COLUMNS):
            here = (item >= first) & (item < first + _COLUMNS)
            table = np.zeros((len(nodes), _COLUMNS), np.float32)
            table[owner[here], item[here] - first] = 1
            both += table @ table.T
        root = list(range(len(nodes)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in range(len(nodes) - 1):
            apart = length[i] + length[i + 1 :] - 2 * both[i, i + 1 :]
            close = (den + num) * apart <= (den - num) * (sizes[i] + sizes[i + 1 :])
            close &= ~(near[i] & near[i + 1 :])
            for j in (np.flatnonzero(close) + i + 1).tolist():
                if top(i) != top(j):
                    root[top(i)] = top(j)
                    yield nodes[i], nodes[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1:
                nodes, sizes, near, lists = zip(*held, strict=True)
                out.extend(edges(list(nodes), np.array(sizes), np.array(near), list(lists)))
            held.clear()

        def emit() -> pa.RecordBatch:
            ends = list(zip(*out, strict=True)) if out else [(), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

        region = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("region", "num", "size", "near")]
            for i, (here, node, size, near) in enumerate(zip(*columns, strict=True)):
                if here != region:
                    close()
                    region = here
                held.append((node, size, near, batch.column("apart")[i].values.to_numpy()))
            if len(out) > 10_000:
                yield emit()
        close()
        yield emit()

    return rows.mapInArrow(run, "a long, b long")


def link_shingles(
    docs: DataFrame,
    words: int = WORDS,
    num: int = NUMERATOR,
    den: int = DENOMINATOR,
    id_col: str = "doc_id",
    text_col: str = "text",
    region_rows: int = REGION_ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents whose shingle sets have a Jaccard
    similarity of num/den or more are linked; a component is named after its smallest id.

    Exact: no pair is left out. Equal sets are one class from the start. One row per row of
    `docs`, repeated rows included; other columns are not read. Null texts, empty ones and those
    without words have no shingles and link with nothing. A row without an id is in the
    component of its links, named null if none of them has an id. No rows in, none out.
    """
    rows, named = _linked(_text_rows(docs, id_col, text_col), words, num, den, region_rows)
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = named.join(smallest, "root").select("node", "component_id")
    out = rows.select("doc_id", "size", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))


def _linked(
    texts: DataFrame, words: int, num: int, den: int, region_rows: int = REGION_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, size) of each row, and (num, node, unnamed, doc_id, text_hash, root) of each
    class of equal sets: its first row, and the class that names its component."""
    rows = _prefixes(texts, words, num, den, shingle_sketch(texts, words))
    # Numbers of a written table: short names for digests that stay what they are.
    rows = staged(rows.withColumn("num", F.monotonically_increasing_id()), "shingles")
    # Prefixes and counts stay where they are; the class only says which row has its own.
    classes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(
            F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "num")
        ).alias("least")
    )
    classes = staged(classes.select("node", "least.*"), "classes")
    # Joined alike at every size: a table of all classes has no bound to be broadcast by.
    chosen = classes.select("num").hint("merge")
    wide = rows.select("num", "size", "prefix").join(chosen, "num", "left_semi")

    # Level 0: the regions of rare shingles, in rings of size.
    ring = lambda size: F.floor(F.log(size) / RING).cast("int")
    rings = F.sequence(ring(F.col("size")), ring(F.col("size") * den / num * (1 + 1e-9)))
    short = F.col("size").cast("int").alias("size")
    places = wide.select("num", short, F.explode("prefix").alias("at"), rings.alias("rings"))
    places = places.select("num", "size", "at", F.explode("rings").alias("ring"))
    places = places.select("num", "size", F.xxhash64("at", "ring").alias("region"))
    # Counted in map tasks first, so that no task gets all members of a region. Nearly all
    # places are alone in theirs: the table to join back is small.
    shared = places.groupBy("region").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("num").alias("pivot"),
        F.min("size").alias("low"),
        F.max("size").alias("high"),
    )
    # Two members must have sizes that a link allows.
    fit = (F.col("members") > 2) | (F.col("low") * den >= F.col("high") * num)
    # Written, so that its size is known and large regions are split in the join.
    shared = staged(shared.filter((F.col("members") > 1) & fit).drop("low", "high"), "shared")
    places = staged(places.select("region", "num").join(shared, "region"), "places")
    discard(shared)
    few = places.filter(F.col("members") <= region_rows).select("region", "num")
    few = few.join(rows.select("num", "size", "counts"), "num")
    few = few.repartition("region").sortWithinPartitions("region", "num")
    many = places.filter(F.col("members") > region_rows).select("num", "pivot")
    pairs = _groups(few, num, den).union(many.filter(F.col("num") != F.col("pivot"))).distinct()
    coarse = staged(pairs, "pairs")
    discard(places)
    pairs = staged(_divided(coarse, rows, num, den, region_rows), "pairs")
    # Prefixes and counts have done their part, and are a large share of all that is written.
    wide, rows = rows, staged(rows.select("doc_id", "node", "size"), "sizes")
    discard(coarse, wide)
    needed = pairs.select("num").union(pairs.select("pivot")).distinct()
    needed = staged(classes.join(needed, "num", "left_semi").select("num", "node", "doc_id", "text_hash"), "needed")
    chosen = texts.withColumn("text_hash", F.xxhash64("text")).alias("t").join(
        needed.alias("n"),
        (F.col("t.text_hash") == F.col("n.text_hash")) & F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")),
        "left_semi",
    )
    sets = _whole_sets(chosen, words).join(needed.select("num", "node"), "node").drop("node")
    sets = staged(sets, "sets")
    centre = sets.select(F.col("num").alias("pivot"), F.col("size").alias("width"), F.col("items").alias("own"))
    apart = _difference("items", "own")
    tested = pairs.join(sets, "num").join(centre, "pivot")
    tested = tested.select("pivot", "num", "size", "width", apart.alias("apart"))
    near = _near(F.size("apart"), F.col("size") + F.col("width"), num, den)
    tested = tested.select("pivot", "num", "size", near.alias("near"), "apart")
    region = F.unhex(F.md5(F.hex("pivot")))
    tested = staged(tested.withColumn("region", region), "tested")
    written = [tested]
    found = [tested.filter("near").select(F.col("num").alias("a"), F.col("pivot").alias("b"))]

    def settled(members: DataFrame) -> DataFrame:
        """Compare the members of small regions; the large regions are left."""
        small = (F.col("members") <= region_rows) & (F.col("items") <= REGION_ITEMS)
        # Two can always be compared, so that division comes to an end.
        small = small | (F.col("members") == 2)
        few = members.filter(small)
        runs = few.repartition("region").sortWithinPartitions("region", "num")
        found.append(staged(_compared(runs, num, den), "edges"))
        written.append(found[-1])
        return members.filter(~small)

    weighed = tested.withColumn("weight", F.size("apart"))
    many = settled(tested.join(_unsettled(weighed), "region"))
    while not is_empty(many):
        members = staged(_subregions(many, num, den), "regions")
        many = settled(members)
        # The member nearest to the last pivot is the next one.
        picked = F.min(F.struct(F.size("apart").alias("n"), "num", "size", "apart")).alias("p")
        tested = many.join(many.groupBy("region").agg(picked), "region")
        tested = tested.filter(F.col("num") != F.col("p.num")).select(
            "region",
            "num",
            "size",
            F.col("p.num").alias("pivot"),
            F.col("p.size").alias("width"),
            "apart",
            F.col("p.apart").alias("own"),
        )
        tested = tested.withColumn("apart", _difference("apart", "own")).drop("own")
        near = _near(F.size("apart"), F.col("size") + F.col("width"), num, den)
        many = staged(tested.withColumn("near", near), "tested")
        written += [members, many]
        found.append(many.filter("near").select(F.col("num").alias("a"), F.col("pivot").alias("b")))

    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    roots = components(edges.distinct())
    discard(pairs, needed, sets, *written)
    roots = roots.select(F.col("id").alias("num"), "root")
    named = classes.select("num", "node", "unnamed", "doc_id", "text_hash").join(roots, "num", "left")
    return rows, named.withColumn("root", F.coalesce("root", "num"))


def first_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """`docs` with one row of each component, all columns as they are: of the rows with the
    smallest id one, of a component without ids one. Rows whose texts are null or have no words
    link with nothing and stay."""
    texts = _text_rows(docs, "doc_id", "text")
    _, named = _linked(texts, words, num, den)
    # Nulls last; the hash tells texts of one id apart.
    first = F.min(F.struct("unnamed", "doc_id", "text_hash")).alias("first")
    first = named.groupBy("root").agg(first).select("first.*")
    # An id and a text can stand in several rows, so they are made one before the join, in
    # map tasks first. Inside a struct no name of the user's meets one of ours.
    key = ["unnamed", "id", "hash"]
    first = first.select(*_row_key("text_hash", key))
    worded = F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    hashed = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    once = docs.filter(worded).select(row, "doc_id", hashed.alias("hashed"))
    once = once.select("row", *_row_key("hashed", key)).dropDuplicates(key)
    kept = once.join(first, key, "left_semi")
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns)).union(docs.filter(~worded))


def _row_key(hashed: str, names: list[str]) -> list[Column]:
    """The id without nulls, so that one shuffle serves both a grouping and a join."""
    columns = F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col(hashed)
    return [c.alias(name) for c, name in zip(columns, names, strict=True)]
