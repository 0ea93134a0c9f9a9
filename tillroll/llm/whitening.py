"""Whitened embeddings from the covariance of distinct vectors.

Vectors are brought to whole numbers and equal ones are grouped, so a vector that stands a
million times is computed with once; a weight says whether it counts once or by its copies. Sums
are exact, the covariance is a product of centred matrices, each distinct vector is whitened
once, and the result is joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import discard, staged

#: Whole steps of a unit, and components that are returned.
STEPS, COMPONENTS = 256, 4
#: Lengths of vectors in one table. Each gets a fit of its own, which the driver holds.
MAX_LENGTHS = 16
#: A vector with more than one in so many rows is hot: there are fewer of them than this.
HOT_SHARE = 1_024
_ROWS = 4_096
_SAFE = 1 << 62


@dataclass(frozen=True)
class Fit:
    """Weight, exact sums, and the leading components as columns, with their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    basis: np.ndarray
    values: np.ndarray
    trace: float


def quantised(vector: Column, steps: int = STEPS) -> Column:
    """The vector in whole steps, rounded down; null where it is null, empty, or holds a null or
    a number that is not finite. Numbers beyond 64 bits become the nearest of 64 bits."""
    entries = vector.cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    # NaN is above infinity in Spark, so it is not below it.
    usable = finite & (F.size(entries) > 0)
    return F.when(usable, F.transform(entries, lambda c: F.floor(c * F.lit(float(steps)))))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Vectors of one length as a matrix, their weights, and the rows they come from."""
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            rows = batch.filter(pa.array(sizes == size)) if (sizes != size).any() else batch
            for at in range(0, rows.num_rows, _ROWS):
                part = rows.slice(at, _ROWS)
                flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
                yield flat.reshape(-1, size), part.column("weight").to_numpy(), part


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits where they suffice, else in Python's numbers."""
    most = max(abs(int(x.max())), abs(int(x.min()))) * n + max(abs(s) for s in sums)
    if most < _SAFE:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sums(distinct: DataFrame) -> dict[int, tuple[int, tuple[int, ...]]]:
    """For each length of vectors the sum of weights and the exact sums of every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for x, weight, _ in _blocks(batches):
            most = max(abs(int(x.max())), abs(int(x.min())), 1) * int(weight.sum())
            if most >= _SAFE:
                x, weight = x.astype(object), weight.astype(object)
            total = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            total[0] += int(weight.sum())
            total[1] = total[1] + (x * weight[:, None]).sum(axis=0)
        rows = [(size, at, n, int(s)) for size, (n, sums) in held.items() for at, s in enumerate(sums)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        columns[3] = [Decimal(s) for s in columns[3]]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["size", "at", "n", "sum"])

    parts = distinct.mapInArrow(run, "size int, at int, n long, sum decimal(38,0)")
    rows = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for row in rows.collect():
        found.setdefault(row["size"], (row["n"], {}))[1][row["at"]] = int(row["sum"])
    return {size: (n, tuple(s[i] for i in range(size))) for size, (n, s) in found.items()}


def _covariances(distinct: DataFrame, sums: dict[int, tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """Weighted covariances, divisor n. Tasks multiply centred blocks and give one row for each
    row of the matrix; these are added by row, and the driver gets length x length numbers."""

    schema = "size int, at int, line array<double>"

    def emit(held: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        keys = list(held)
        columns = [pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)]
        columns.append(pa.array([held[k] for k in keys], pa.list_(pa.float64())))
        return pa.RecordBatch.from_arrays(columns, ["size", "at", "line"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for x, weight, _ in _blocks(batches):
            n, s = sums[x.shape[1]]
            moved = (_centred(x, n, s) / n).astype(np.float64)
            product = (moved * weight[:, None]).T @ moved
            totals[x.shape[1]] = totals.get(x.shape[1], 0) + product
        for size, total in totals.items():
            yield emit({(size, at): total[at] for at in range(size)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(batch.column("size").to_pylist(), batch.column("at").to_pylist(), strict=True)
            for key, line in zip(keys, batch.column("line"), strict=True):
                held[key] = held.get(key, 0) + line.values.to_numpy()
        yield emit(held)

    lines = distinct.mapInArrow(multiply, schema).repartition("size", "at").mapInArrow(add, schema)
    found = {size: np.zeros((size, size)) for size in sums}
    for row in lines.collect():
        found[row["size"]][row["at"]] = row["line"]
    return {size: (m + m.T) / 2 / sums[size][0] for size, m in found.items()}


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit for each length of the vectors in (x, size, weight)."""
    sums = _sums(distinct)
    fits = {}
    for size, covariance in _covariances(distinct, sums).items():
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(values)[::-1][:components]
        trace = float(np.trace(covariance))
        # What rounding leaves of an eigenvalue of zero is no variance.
        floor = trace * size * np.finfo(float).eps
        leading = np.where(values[order] > floor, values[order], 0.0)
        fits[size] = Fit(*sums[size], vectors[:, order], leading, trace)
    return fits


_WHITE = "n long, deviation long, whitened array<double>, explained array<double>"


def whiten(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """(h, x, copies, size, weight, n, deviation, whitened, explained) of each distinct vector; null
    for components without variance, and for a deviation that has more than 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _, part in _blocks(batches):
            known = fits[x.shape[1]]
            exact = _centred(x, known.n, known.sums)
            most = max(abs(int(exact.max())), abs(int(exact.min())))
            if most * most * x.shape[1] >= _SAFE:
                exact = exact.astype(object)
            squares = (exact * exact).sum(axis=1)
            deviation = [int(s) if s < 1 << 63 else None for s in squares]
            moved = (exact / known.n).astype(np.float64)
            deep = known.values > 0
            scale = np.sqrt(np.where(deep, known.values, 1.0))
            white = (moved @ known.basis) / scale
            nothing = np.broadcast_to(~deep, white.shape).ravel()
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(deep))
            share = known.values / known.trace if known.trace else known.values
            whitened = pa.array(white.ravel(), pa.float64(), mask=nothing)
            explained = pa.array(np.tile(share, len(x)), pa.float64(), mask=nothing)
            added = [
                pa.array(np.full(len(x), known.n), pa.int64()),
                pa.array(deviation, pa.int64()),
                pa.ListArray.from_arrays(offsets, whitened),
                pa.ListArray.from_arrays(offsets, explained),
            ]
            names = [*part.schema.names, "n", "deviation", "whitened", "explained"]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names)

    kinds = "h long, x array<long>, size int, copies long, weight long"
    return distinct.mapInArrow(run, f"{kinds}, {_WHITE}")


def identity_errors(white: DataFrame, components: int = COMPONENTS) -> dict[int, float]:
    """For each length the largest absolute difference between the covariance of the whitened
    vectors, over the components with variance, and the identity; two passes, centred first."""
    at = [F.get("whitened", F.lit(i)) for i in range(components)]
    weight = F.col("weight")
    means = white.groupBy("size").agg(
        F.sum(weight).alias("n"), *(F.sum(w * weight).alias(f"m{i}") for i, w in enumerate(at))
    )
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    known = {r["size"]: r for r in means.collect()}
    errors = {}
    for size, row in known.items():
        moved = [
            w - F.lit(row[f"m{i}"] / row["n"]) if row[f"m{i}"] is not None else F.lit(None)
            for i, w in enumerate(at)
        ]
        sums = [F.sum(moved[i] * moved[j] * weight).alias(f"c{i}_{j}") for i, j in pairs]
        found = white.filter(F.col("size") == size).agg(*sums).first()
        gaps = [
            abs(found[f"c{i}_{j}"] / row["n"] - (i == j))
            for i, j in pairs
            if found[f"c{i}_{j}"] is not None
        ]
        errors[size] = max(gaps, default=None)
    return errors


def whiten_vectors(
    vectors: DataFrame,
    components: int = COMPONENTS,
    steps: int = STEPS,
    by_copies: bool = False,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): the registered query.

    One row for each usable vector and component up to `components` or its length. A vector that
    is null, empty, or holds a null or a number that is not finite has no rows. Distinct vectors
    count once in the fit, or with `by_copies` as often as they stand. Vectors of another
    length have a fit of their own, up to `MAX_LENGTHS` lengths; a table with more is refused.
    Components without variance, as all are of a single distinct vector, have null in
    `whitened` and `explained`. Repeated rows and rows without an id each give their rows. Columns
    other than the two are not read. No rows in, no rows out.
    """
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), quantised(F.col(vector_col), steps).alias("x")
    ).filter(F.col("x").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("x"))
    copies = F.count(F.lit(1))
    distinct = rows.groupBy("h", "x").agg(copies.alias("copies")).select(
        "h", "x", F.size("x").alias("size"), "copies",
        (F.col("copies") if by_copies else F.lit(1)).cast("long").alias("weight"),
    )
    distinct = staged(distinct, "distinct-vectors")
    lengths = distinct.select("size").distinct().limit(MAX_LENGTHS + 1).count()
    if lengths > MAX_LENGTHS:
        raise ValueError(f"vectors have more than {MAX_LENGTHS} lengths")
    white = staged(whiten(distinct, fit(distinct, components)), "whitened-vectors")
    discard(distinct)
    errors = identity_errors(white, components)
    error = F.lit(None).cast("double")
    for size, value in errors.items():
        error = F.when(F.col("size") == size, F.lit(value)).otherwise(error)

    # Vectors with many copies are told to all tasks; the rows of the others are joined.
    total = white.agg(F.sum("copies")).first()[0] or 0
    is_hot = F.col("copies") * HOT_SHARE > total
    result = white.withColumn("hot", is_hot).withColumn("error", error)
    result = result.drop("copies", "weight", "size")
    hot = F.broadcast(result.filter("hot"))
    cold = rows.join(hot.select("h", "x"), ["h", "x"], "left_anti")
    found = rows.join(hot, ["h", "x"]).unionByName(cold.join(result.filter(~F.col("hot")), ["h", "x"]))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return found.select("vec_id", "n", "deviation", "error", each).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        F.col("error").alias("identity_error"),
    )
