"""Rows laid out by store: the same results as from the plain rows, and little is read."""

import pytest
from pyspark.sql import functions as F

import fixtures
from tests.conftest import SMALL
from tillroll.operators import ranking
from tillroll.plans import by_store, sales
from tillroll.plans.cleaning import clean_transactions


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    got = got.select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def scanned(df):
    """Rows that the scan of a plan without shuffles hands on."""
    executed = df._jdf.queryExecution().executedPlan()
    rows = df._jdf.queryExecution().toRdd().count()
    leaf = executed.collectLeaves().head()
    return rows, leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def clean(spark):
    cached = clean_transactions(fixtures.raw_transactions(spark, SMALL)).cache()
    yield cached
    cached.unpersist()  # else plans of later tests read it


@pytest.fixture(scope="module")
def laid(clean, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("by-store") / "table")
    by_store.save_by_store(clean, path, salts=3, parts=4, row_group_bytes=4_096)
    return path


def test_newest_rows(spark, clean, laid):
    for n in (1, 7, 100_000):
        same(by_store.newest_by_store(spark, laid, n), sales.recent_by_store(clean, n))
    for store in ("STORE_001", "STORE_039", "no such store", None):
        want = sales.recent_by_store(clean.filter(F.col("store_id").eqNullSafe(F.lit(store))), 7)
        same(by_store.newest_of_store(spark, laid, store, 7, salts=3), want)


def test_a_lookup_reads_little(spark, clean, laid):
    found = by_store.rows_in_reach(spark, laid, "STORE_039", 2, salts=3)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "(salt#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert f"GreaterThanOrEqual({by_store.DAY}" in text
    rows, read = scanned(found)
    assert rows >= 2 and read <= clean.count() / 20


def test_odd_rows(spark, tmp_path):
    rows = spark.sql(
        """SELECT CASE WHEN id % 11 = 0 THEN NULL ELSE concat('t', id % 50) END AS transaction_id,
                  CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS store_id,
                  CASE WHEN id % 4 = 0 THEN NULL ELSE timestamp'1969-12-30 23:00:00' + make_dt_interval(0, CAST(id % 60 AS INT)) END AS timestamp,
                  CAST(id % 3 AS INT) AS rowkey, 'x' AS `a b` FROM range(400)"""
    )
    path = str(tmp_path / "odd")
    by_store.save_by_store(rows, path, parts=5, row_group_bytes=4_096)
    for n in (1, 20, 60, 300):
        same(by_store.newest_by_store(spark, path, n), sales.recent_by_store(rows, n))
        for store in ("hot", "s1", None):
            want = sales.recent_by_store(rows.filter(F.col("store_id").eqNullSafe(F.lit(store))), n)
            same(by_store.newest_of_store(spark, path, store, n), want)
    empty = str(tmp_path / "empty")
    by_store.save_by_store(rows.limit(0), empty)
    assert by_store.newest_by_store(spark, empty, 3).count() == 0
    assert by_store.newest_of_store(spark, empty, "hot", 3).count() == 0
    with pytest.raises(ValueError, match="salt"):
        by_store.save_by_store(rows.withColumn("Salt", F.lit(1)), str(tmp_path / "clash"))


def test_days_do_not_follow_the_session_zone(spark, tmp_path):
    """A clock that is put back over midnight gives a later moment an earlier date."""
    rows = spark.range(48).selectExpr(
        "concat('t', id) transaction_id", "'s' store_id", "timestamp_seconds(1572750000 + id * 1800) timestamp"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    path = str(tmp_path / "zone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Havana")
        by_store.save_by_store(rows, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for n in (1, 5, 17, 30):
        same(by_store.newest_of_store(spark, path, "s", n), sales.recent_by_store(rows, n))


def test_long_cuts_are_merged_in_a_tree(spark, monkeypatch):
    """Beyond the group limit a hot key's tasks get at most n rows from each merged slice."""
    monkeypatch.setattr(ranking, "FAN_IN", 3)
    rows = spark.range(4_000, numPartitions=8).selectExpr("CAST(id % 50 = 0 AS INT) AS k", "id", "id % 97 AS v")
    limit, parts = spark.conf.get(ranking._LIMIT_CONF), spark.conf.get("spark.sql.shuffle.partitions")
    n, widest = 20, []
    keep = ranking._keep

    def watched(df, keys, order, count):
        widest.append(df.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return keep(df, keys, order, count)

    try:
        spark.conf.set(ranking._LIMIT_CONF, 5)
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        with monkeypatch.context() as patched:
            patched.setattr(ranking, "_keep", watched)
            order = [F.col("v").desc(), F.col("id")]
            got = ranking.top_per_key(rows, ["k"], order, n)
        # Eight slices, then three, then one.
        assert len(widest) == 3 and max(widest[1:]) <= 3 * n
        text = got._jdf.queryExecution().executedPlan().toString()
        assert text.count("hashpartitioning(k") == 3
        result = sorted(tuple(row) for row in got.collect())
    finally:
        spark.conf.set(ranking._LIMIT_CONF, limit)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    everything = sorted((tuple(row) for row in rows.collect()), key=lambda r: (r[0], -r[2], r[1]))
    want = [r for k in (0, 1) for r in [x for x in everything if x[0] == k][:n]]
    assert result == sorted(want)
