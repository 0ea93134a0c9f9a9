"""Quality rules: plain statistics of whole texts, and robust multivariate outliers.

DataFrame functions only. Statistics are array expressions inside one row, so no word is
shuffled; the estimates work on the small table of statistics.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import staged

SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

#: Share of a group that the estimates rest on, and rejection beyond this squared distance: for
#: five normal statistics one row in ten million is farther out.
SUPPORT = 0.75
CUTOFF = 42.0
#: Concentration steps from every start; the best goes on until its log determinant falls by less.
TRIAL_STEPS = 2
TOLERANCE = 0.01
#: Standard deviations that every estimate has at least: statistics that are zero in most
#: texts of a group would reject the others.
FLOOR = (0.5, 0.12, 0.5, 1.0, 1.0)
#: Groups with fewer rows than this share one estimate.
MIN_GROUP = 50
SALTS = 16
#: The central 75 % of five normal statistics vary that much less than all rows do.
CONSISTENCY = 1.41

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _window_keys(words: Column) -> Column:
    """A hash for each window of eight words, from hashes of two, four and eight."""

    def wider(step: int) -> Callable[[Column], Column]:
        def join(h: Column) -> Column:
            size = F.size(h) - step
            ahead = F.slice(h, F.lit(step + 1), size)
            return F.zip_with(F.slice(h, F.lit(1), size), ahead, lambda a, b: F.xxhash64(a, b))

        return join

    hashed = F.transform(words, lambda word: F.xxhash64(word))
    return let(let(let(hashed, wider(1)), wider(2)), wider(4))


def _covered(keys: Column) -> Column:
    """Words in windows whose key occurs twice or more: windows sorted by key, those with an
    equal neighbour, then the stretch each adds in order of position."""

    def repeated(ordered: Column) -> Column:
        def equal(item: Column, place: Column) -> Column:
            before, after = F.get(ordered, place - 1), F.get(ordered, place + 1)
            same = lambda other: F.coalesce(other["key"] == item["key"], F.lit(False))
            return same(before) | same(after)

        return F.array_sort(F.transform(F.filter(ordered, equal), lambda item: item["at"]))

    def length(at: Column) -> Column:
        def stretch(place: Column, i: Column) -> Column:
            gap = F.coalesce(F.get(at, i + 1) - place, F.lit(WINDOW_WORDS))
            return F.least(gap, F.lit(WINDOW_WORDS))

        return F.aggregate(F.transform(at, stretch), F.lit(0), lambda total, x: total + x)

    marked = F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at")))
    return let(let(F.array_sort(marked), repeated), length)


def repeated_words(words: Column) -> Column:
    def count(keys: Column) -> Column:
        some = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(some, _covered(keys)).otherwise(0)

    return F.when(F.size(words) > WINDOW_WORDS, let(_window_keys(words), count)).otherwise(0)


def statistics(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """`docs` with the five counts of the whole text and `n_lines`, lines that have a word.
    A null text has none of anything. `prefix` keeps clear of columns of these names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    def line_counts(x: Column) -> Column:
        repeats = F.size(x) - F.size(F.array_distinct(x))
        return F.struct(F.size(x).alias("n_lines"), repeats.alias("n_dup_lines"))

    found = {
        "word_chars": F.char_length(F.translate(text, SPACES, "")),
        "n_symbols": F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, "")),
    }
    by_word, by_line = f"{prefix}by_word", f"{prefix}by_line"
    out = docs.withColumns(
        {f"{prefix}{name}": column.cast("long") for name, column in found.items()}
        | {by_word: let(words, counts), by_line: let(lines, line_counts)}
    )
    nested = {
        f"{prefix}{name}": F.col(holder)[name].cast("long")
        for holder, names in ((by_word, ("n_words", "n_repeat_words")), (by_line, ("n_lines", "n_dup_lines")))
        for name in names
    }
    return out.withColumns(nested).drop(by_word, by_line)


def _vector(prefix: str) -> list[Column]:
    """The statistics, transformed so that those of ordinary texts are about normal."""
    n, chars, symbols, repeated_lines, repeated = (F.col(prefix + name) for name in BASE)
    some = F.greatest(n, F.lit(1))
    share = lambda part, whole: F.log1p(100.0 * part / whole)
    return [
        F.log1p(n),
        F.log(F.greatest(chars, F.lit(1)) / some),
        share(symbols, some),
        share(repeated_lines, F.greatest(F.col(prefix + "n_lines"), F.lit(1))),
        share(repeated, some),
    ]


_SIZE = len(FLOOR)
_X = [f"_x{i}" for i in range(_SIZE)]
_PAIRS = [(j, i) for i, j in combinations_with_replacement(range(_SIZE), 2)]


_SHAPE = [f"_m{i}" for i in range(_SIZE)] + [f"_l{i}{j}" for i in range(_SIZE) for j in range(i + 1)]


def _beside(rows: DataFrame, small: DataFrame, key: str = "_group", how: str = "left") -> DataFrame:
    """`rows` with what `small` has for their group, null if nothing. Large groups are dealt
    out by a salt, so that a join by shuffling doesn't bring one to a single task."""
    salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = small.withColumn("_salt", F.explode(salt))
    return rows.join(copies, [key, "_salt"], how)


def _distances(rows: DataFrame, estimates: DataFrame, how: str = "left") -> DataFrame:
    """`rows` with the squared Mahalanobis distance `_d` to their group's estimate."""
    out, z = _beside(rows, estimates.select("_group", *_SHAPE), how=how), []
    for i, x in enumerate(_X):
        rest = F.col(x) - F.col(f"_m{i}")
        for k in range(i):
            rest = rest - F.col(f"_l{i}{k}") * F.col(z[k])
        z.append(f"_z{i}")
        out = out.withColumn(z[i], rest / F.col(f"_l{i}{i}"))
    squared = sum((F.col(name) * F.col(name) for name in z[1:]), F.col(z[0]) * F.col(z[0]))
    return out.withColumn("_d", squared).drop(*z, *_SHAPE)


def _central(rows: DataFrame) -> DataFrame:
    """The rows of each group with the smallest `_d`, a share of SUPPORT or more by ties."""
    bound = rows.groupBy("_group").agg(F.percentile_approx("_d", SUPPORT, 10_000).alias("_bound"))
    return _beside(rows, bound).filter(F.col("_d") <= F.col("_bound"))


def _triangles(found: DataFrame) -> DataFrame:
    """Covariances `_c..` of each group as their Cholesky triangle `_l..`, the floor added, with the
    logarithm of the determinant as `_det`."""

    def cov(i: int, j: int) -> Column:
        floor = FLOOR[i] ** 2 if i == j else 0.0
        return CONSISTENCY * F.coalesce(F.col(f"_c{i}{j}"), F.lit(0.0)) + floor

    def appended(done: Column, x: Column) -> Column:
        row, column = (F.slice(done, x[name], x["before"]) for name in ("row", "column"))
        products = F.zip_with(row, column, lambda a, b: a * b)
        rest = F.aggregate(products, x["covariance"], lambda total, product: total - product)
        diagonal = F.get(done, x["column"] + x["before"] - 1)
        return F.array_append(done, F.when(x["row"] == x["column"], F.sqrt(rest)).otherwise(rest / diagonal))

    # Row by row in one array. As columns, the entries would be generated code of many thousand
    # lines, beyond what a method may have, and all of that in the driver's memory.
    places = [(i, j) for i in range(_SIZE) for j in range(i + 1)]
    start = lambda i: F.lit(i * (i + 1) // 2 + 1)
    entries = F.array(
        *(
            F.struct(
                cov(i, j).alias("covariance"),
                start(i).alias("row"),
                start(j).alias("column"),
                F.lit(j).alias("before"),
            )
            for i, j in places
        )
    )
    found = found.withColumn("_l", F.aggregate(entries, F.array().cast("array<double>"), appended))
    triangle = {f"_l{i}{j}": F.get("_l", F.lit(n)) for n, (i, j) in enumerate(places)}
    logs = sum((F.log(triangle[f"_l{i}{i}"]) for i in range(1, _SIZE)), F.log(triangle["_l00"]))
    means = [f"_m{i}" for i in range(_SIZE)]
    shape = [column.alias(name) for name, column in triangle.items()]
    return found.select("_group", *means, *shape, (2 * logs).alias("_det"))


def _estimates(subset: DataFrame) -> DataFrame:
    """Mean and covariance of each group."""
    moments = [F.avg(x).alias(f"_m{i}") for i, x in enumerate(_X)]
    moments += [F.covar_pop(_X[i], _X[j]).alias(f"_c{i}{j}") for i, j in _PAIRS]
    return _triangles(subset.groupBy("_group").agg(*moments))


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: the estimates from the rows nearest to `estimates`, for the groups in
    there. It does not raise the determinant, but for the approximate percentile and the floor."""
    return _estimates(_central(_distances(rows, estimates, "inner")))


def _lowest(estimates: DataFrame) -> DataFrame:
    """Of the estimates of a group that of the least determinant."""
    shape = F.struct("_det", *_SHAPE)
    return estimates.groupBy("_group").agg(F.min(shape).alias("_best")).select("_group", "_best.*")


def _starts(rows: DataFrame) -> list[DataFrame]:
    """Three robust estimates of each group: its medians with absolute deviations and correlations of
    nothing, of hyperbolic tangents, and of spatial signs."""
    middle = rows.groupBy("_group").agg(
        *(F.percentile_approx(x, 0.5, 1_000).alias(f"_m{i}") for i, x in enumerate(_X))
    )
    deviations = [F.abs(F.col(x) - F.col(f"_m{i}")) for i, x in enumerate(_X)]
    spread = _beside(rows, middle).groupBy("_group").agg(
        *(F.first(f"_m{i}").alias(f"_m{i}") for i in range(_SIZE)),
        *(
            F.greatest(1.4826 * F.percentile_approx(x, 0.5, 1_000), F.lit(FLOOR[i])).alias(f"_s{i}")
            for i, x in enumerate(deviations)
        ),
    )
    spread = staged(spread, "medians")
    scaled = _beside(rows, spread).withColumns(
        {f"_z{i}": (F.col(x) - F.col(f"_m{i}")) / F.col(f"_s{i}") for i, x in enumerate(_X)}
    )
    z = [F.col(f"_z{i}") for i in range(_SIZE)]
    length = F.sqrt(sum((x * x for x in z[1:]), z[0] * z[0]))
    signs = [F.coalesce(F.try_divide(x, length), F.lit(0.0)) for x in z]
    kinds = {"t": [F.tanh(x) for x in z], "k": signs}
    scaled = scaled.select(
        "_group", *(x.alias(f"_{kind}{i}") for kind, values in kinds.items() for i, x in enumerate(values))
    )
    products = [
        F.covar_pop(f"_{kind}{i}", f"_{kind}{j}").alias(f"_{kind}{i}{j}") for kind in kinds for i, j in _PAIRS
    ]
    # Written, for three starts read it.
    moments = staged(spread.join(scaled.groupBy("_group").agg(*products), "_group"), "moments")

    def start(correlation: Callable[[int, int], Column]) -> DataFrame:
        covariances = {
            f"_c{i}{j}": F.col(f"_s{i}") * F.col(f"_s{j}") * (F.lit(1.0) if i == j else correlation(i, j))
            for i, j in _PAIRS
        }
        return _triangles(moments.withColumns(covariances))

    def correlated(kind: str) -> Callable[[int, int], Column]:
        def of(i: int, j: int) -> Column:
            size = F.sqrt(F.col(f"_{kind}{i}{i}") * F.col(f"_{kind}{j}{j}"))
            return F.coalesce(F.try_divide(F.col(f"_{kind}{i}{j}"), size), F.lit(0.0))

        return of

    return [start(lambda i, j: F.lit(0.0)), start(correlated("t")), start(correlated("k"))]


def _named(measured: DataFrame, lang_col: str, source_col: str, prefix: str) -> DataFrame:
    """`measured` with the base verdict, the name of its group, and the transformed statistics."""
    failed = (F.col(f"{prefix}n_words") < MIN_WORDS) | (
        100 * F.col(f"{prefix}n_repeat_words") > MAX_REPEATED_PERCENT * F.col(f"{prefix}n_words")
    )
    name = F.to_json(F.struct(F.col(lang_col).alias("l"), F.col(source_col).alias("s")))
    named = measured.withColumn(f"{prefix}base_failed", failed).withColumn("_name", name)
    named = named.withColumns(dict(zip(_X, _vector(prefix), strict=True)))
    return named.withColumn("_salt", F.pmod(F.xxhash64(*_X), F.lit(SALTS)).cast("int"))


def fit_outliers(
    measured: DataFrame, lang_col: str = "lang", source_col: str = "source", prefix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """The group of each language and source, and the estimate of each group, as small tables.

    `measured` (see `statistics`) is a table, for it is read several times. Minimum covariance
    determinant: concentration steps take the mean and covariance of the central rows and then the
    rows nearest to that estimate. Each of three robust starts gets TRIAL_STEPS of them, and each
    group goes on from its best until the determinant falls no more; the least one is its estimate.
    The floor bounds determinants from below, so this ends. Groups are any values, null included;
    groups under MIN_GROUP rows share an estimate. Rows that fail the base rules are not
    estimated from. All steps are grouped sums with partial aggregation, so that a group with a
    third of all rows is no heavier than others; estimates are one row per group, of which the
    driver learns only whether one fell. Repeated rows count each.
    """
    named = _named(measured, lang_col, source_col, prefix)
    passing = named.filter(~F.col(f"{prefix}base_failed"))
    groups = passing.groupBy("_name").agg(F.count(F.lit(1)).alias("_rows"))
    large = F.when(F.col("_rows") >= MIN_GROUP, F.col("_name")).otherwise("small")
    groups = staged(groups.select("_name", large.alias("_group")), "groups")

    # Written, for every step reads it twice, and plans stay small.
    rows = _beside(passing.select("_name", "_salt", *_X), groups, "_name").drop("_name")
    rows = staged(rows, "vectors")
    starts = _starts(rows)
    numbered = [
        x.withColumn("_group", F.concat(F.lit(f"{n}:"), F.col("_group"))) for n, x in enumerate(starts)
    ]
    number = F.explode(F.array(*(F.lit(f"{n}:") for n in range(len(starts)))))
    tried = rows.withColumn("_start", number).withColumn("_group", F.concat("_start", "_group")).drop("_start")
    trial = staged(reduce(DataFrame.union, numbered), "estimates")
    for _ in range(TRIAL_STEPS):
        trial = staged(_concentrated(tried, trial), "estimates")
    best = _lowest(trial.withColumn("_group", F.expr("substring(_group, 3)")))
    falling = staged(best, "estimates")
    found = [falling]
    while True:
        before = falling.select("_group", F.col("_det").alias("_before"))
        lower = _concentrated(rows, falling).join(before, "_group")
        lower = lower.filter(F.col("_det") < F.col("_before") - TOLERANCE).drop("_before")
        falling = staged(lower, "estimates")
        if falling.isEmpty():
            return groups, staged(_lowest(reduce(DataFrame.unionByName, found)), "estimates")
        found.append(falling)


def judge_outliers(
    measured: DataFrame,
    groups: DataFrame,
    estimates: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    prefix: str = "",
) -> DataFrame:
    """`measured` with `base_failed` and `kept`, both under `prefix`: rows that fail the base
    rules or lie beyond CUTOFF are rejected. Rows of a group without estimate stay."""
    named = _named(measured, lang_col, source_col, prefix)
    judged = _distances(_beside(named, groups, "_name"), estimates)
    near = F.coalesce(F.col("_d") <= CUTOFF, F.lit(True))
    judged = judged.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & near)
    return judged.drop("_name", "_group", "_salt", "_d", *_X)


def assess_quality(docs: DataFrame) -> DataFrame:
    """The registered query: counts of every whole text and the verdict on it."""
    measured = statistics(docs.select("doc_id", "lang", "source", "text")).drop("text")
    measured = staged(measured, "statistics")
    judged = judge_outliers(measured, *fit_outliers(measured))
    return judged.select("doc_id", *BASE, "base_failed", "kept")


_MARK = "_quality_"


def keep_good(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that the rules reject, all columns as they are. The statistics
    are computed again for the verdict, which costs less than writing all texts beside them."""
    read = ["lang", "source", "text"]
    brief = statistics(docs.select(*read), prefix=_MARK).drop("text")
    fitted = fit_outliers(staged(brief, "statistics"), prefix=_MARK)
    # Inside a struct no name of the user's meets one of ours.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(*read, row)
    judged = judge_outliers(statistics(rows, prefix=_MARK), *fitted, prefix=_MARK)
    kept = judged.filter(F.col(f"{_MARK}kept"))
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
