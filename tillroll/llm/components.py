"""Connected components by alternating stars, as grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shared import discard, staged


#: A centre with over this share of the edges is joined by broadcast: at most 1,024 of them, as
#: a round has two rows an edge.
_HOT_SHARE = 512
_PLACES = 1 << 20


def _with_root(ties: DataFrame, total: int) -> DataFrame:
    """(a, b, root) for each tie (a, b): the smallest of a and all its b.

    Hot centres get their root from a broadcast; their ties then pass the join of the others on
    places of their own, spread over all tasks.
    """
    least = ties.groupBy("a").agg(
        F.least(F.col("a"), F.min("b")).alias("root"), F.count(F.lit(1)).alias("n")
    )
    hot = least.filter(F.col("n") * _HOT_SHARE > total).select("a", F.col("root").alias("hot_root"))
    spread = 1 + F.pmod(F.xxhash64("b"), F.lit(_PLACES))
    marked = ties.join(F.broadcast(hot), "a", "left").withColumn(
        "place", F.when(F.col("hot_root").isNotNull(), spread).otherwise(F.lit(0).cast("long"))
    )
    # Always 0, but no literal: Spark would take one out of the keys of the join.
    nowhere = F.least(F.col("n"), F.lit(0).cast("long"))
    others = least.select("a", nowhere.alias("place"), "root")
    joined = marked.join(others, ["a", "place"], "left")
    return joined.select("a", "b", F.coalesce("hot_root", "root").alias("root"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    rooted = _with_root(both, total).filter(F.col("b") > F.col("a"))
    return rooted.select("b", "root").toDF("a", "b")


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rooted = _with_root(down, total)
    # The tie of a centre to its root is the one that holds the root.
    ties = rooted.select(
        F.when(F.col("b") > F.col("root"), F.col("b")).otherwise(F.col("a")).alias("a"),
        F.col("root").alias("b"),
    )
    return ties.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of `edges` (a, b) that is not the smallest of its component.

    Each round is written to the shared folder, which also cuts the lineage. Rounds grow with
    the logarithm of the components' size; nothing but two sums of a round reaches the
    driver. Loops (a = a) and repeated edges change nothing; no edges, no rows.
    """
    known = edges.filter(F.col("a") != F.col("b")).select("a", "b")
    state, before = staged(known, "edges"), None
    while True:
        mark = state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark[0] == 0 or mark == before:
            return state.select(F.col("a").alias("id"), F.col("b").alias("root"))
        before, old = mark, state
        state = staged(_small_star(_large_star(old, mark[0]), mark[0]), "edges")
        discard(old)
