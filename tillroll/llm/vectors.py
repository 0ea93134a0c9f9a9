"""Near-duplicate embeddings: quantised random projections, then exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import staged

from .components import components

COSINE = 0.98
#: Vectors at the threshold are 0.2 apart. A projection puts them into one interval with
#: probability 0.84, ten of them with 0.17, and one of twenty tables finds 98 % of such pairs.
TABLES, PROJECTIONS, INTERVAL = 20, 10, 1.0
SEED = 20
#: Rows of a bucket that one task compares with each other; more are compared by blocks.
BLOCK_ROWS = 512


def _checked(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vector, node): node is a digest of label and vector, null if the
    vector cannot be compared."""

    def run(batches):
        for batch in batches:
            nodes = []
            labels = batch.column("label").to_pylist()
            lists = batch.column("vector")
            for i, label in enumerate(labels):
                values = lists[i].values if lists[i].is_valid and label is not None else None
                node = None
                if values is not None and len(values) and not values.null_count:
                    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                    # Zeros have a sign, but no meaning.
                    x = x + 0.0
                    with np.errstate(over="ignore"):
                        usable = np.isfinite(x).all() and 0 < np.abs(x).max()
                    if usable:
                        node = xxhash.xxh3_128_digest(f"{label}:".encode() + x.tobytes())
                nodes.append(node)
            columns = [*batch.columns, pa.array(nodes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "node"])

    rows = vectors.select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, label string, vector array<double>, node binary"
    return rows.mapInArrow(run, schema)


def _unit(lists: pa.ListArray) -> np.ndarray:
    x = np.stack([values.values.to_numpy() for values in lists])
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _coded(classes: DataFrame, tables: int, projections: int, interval: float) -> DataFrame:
    """`classes` with a code per table: equal codes mean equal intervals in all projections."""

    def run(batches):
        drawn: dict[int, tuple] = {}
        for batch in batches:
            size = np.array([len(x) for x in batch.column("vector")])
            codes = np.zeros((batch.num_rows, tables), np.int64)
            for dim in np.unique(size):
                if dim not in drawn:
                    random = np.random.default_rng(SEED + int(dim))
                    lines = random.standard_normal((dim, tables * projections))
                    shift = random.uniform(0, interval, tables * projections)
                    mix = random.integers(1, 2**62, projections) * 2 + 1
                    drawn[dim] = lines, shift, mix
                lines, shift, mix = drawn[dim]
                rows = np.flatnonzero(size == dim)
                for part in np.array_split(rows, len(rows) // 4096 + 1):
                    if not len(part):
                        continue
                    units = _unit(batch.column("vector").take(pa.array(part)))
                    cells = np.floor((units @ lines + shift) / interval).astype(np.int64)
                    cells = cells.reshape(len(part), tables, projections)
                    with np.errstate(over="ignore"):
                        codes[part] = (cells * mix).sum(axis=2) * 31 + int(dim)
            ends = np.arange(1, batch.num_rows + 1, dtype=np.int64) * tables
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))
            names = [*batch.schema.names, "codes"]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names)

    schema = "node binary, label string, members long, vector array<double>, codes array<long>"
    return classes.select("node", "label", "members", "vector").mapInArrow(run, schema)


def _linked(table: pa.Table, threshold: float) -> list[tuple[bytes, int, bytes]]:
    """(node, vectors it links to that no earlier table shows, a node of its group) within one
    block or between two blocks of a bucket."""
    nodes, members = table["node"].to_pylist(), table["members"].to_numpy()
    block, spot = table["block"].to_numpy(), table["spot"][0].as_py()
    pair = table["low"][0].as_py() != table["high"][0].as_py()
    units = _unit(table["vector"].combine_chunks())
    close = np.triu(units @ units.T >= threshold, 1)
    if pair:
        close &= block[:, None] != block[None, :]
    a, b = np.nonzero(close)
    if not len(a):
        return []
    codes = np.stack([x.values.to_numpy() for x in table["codes"].combine_chunks()])[:, :spot]
    fresh = ~(codes[a] == codes[b]).any(axis=1)
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, a[fresh], members[b[fresh]])
    np.add.at(links, b[fresh], members[a[fresh]])
    root = list(range(len(nodes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        root[top(i)] = top(j)
    touched = np.unique(np.concatenate([a, b])).tolist()
    return [(nodes[i], int(links[i]), nodes[top(i)]) for i in touched]


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows of one bucket and pair of blocks follow each other; each such run is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, int, bytes]] = []

        def emit() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else ((), (), ())
            types = (pa.binary(), pa.int64(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["node", "links", "root"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            keys = table["run"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist()]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi - lo > 1:
                    out += _linked(table.slice(lo, hi - lo), threshold)
            # The last run may go on in the next batch.
            held = table.slice(cuts[-1])
            if len(out) > 5_000:
                yield emit()
        if held is not None and held.num_rows > 1:
            out += _linked(held, threshold)
        yield emit()

    return rows.mapInArrow(run, "node binary, links long, root binary")


def link_vectors(
    vectors: DataFrame,
    threshold: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    interval: float = INTERVAL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): the registered query.

    Vectors of one label are linked when their cosine is `threshold` or more: of those that
    share a bucket in some table, exactly these. Equal vectors are one class before anything is
    compared, so copies cost nothing. A bucket with many classes is compared in pairs of blocks of
    bounded size, none left out; a pair that several tables show counts once, in the first.
    Vectors that are null, empty, zero, of another length, or hold nulls or non-finite
    numbers link with nothing, as do those without a label. One row per row; a row without an id
    has its component's smallest id and is kept only if there is none. No rows in, none out.
    """
    rows = staged(_checked(vectors, id_col, vector_col, label_col), "vectors")
    classes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("label").alias("label"),
        F.count(F.lit(1)).alias("members"),
        F.min("vec_id").alias("least"),
        F.first("vector").alias("vector"),
    )
    classes = staged(classes, "classes")
    coded = staged(_coded(classes, tables, projections, interval), "codes")

    places = coded.select("node", "label", F.posexplode("codes").alias("spot", "code"))
    bucket = ["label", "spot", "code"]
    crowded = places.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"))
    places = places.join(crowded.filter(F.col("size") > 1), bucket)
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    places = places.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    places = places.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    places = places.select(
        "node", "spot", "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.xxhash64(*bucket, F.least("block", "other"), F.greatest("block", "other")).alias("run"),
    )
    full = places.join(coded.select("node", "members", "vector", "codes"), "node")
    runs = full.repartition("run").sortWithinPartitions("run", "node")
    found = staged(_compare(runs, threshold), "links")

    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = roots.select(F.col("id").alias("node"), "root")
    named = classes.select("node", "members", "least").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(smallest, "root").join(degree, "node", "left").select(
        "node",
        (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id",
    )
    out = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    alone = component.isNull() & F.col("vec_id").isNull()
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, alone).alias("kept"),
    )
