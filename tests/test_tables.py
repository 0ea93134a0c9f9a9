"""Ingested and history tables in the catalog."""

import pytest

from tests.test_history import cleaned
from tests.test_stream import current, put, some_events, take_in, wire
from tillroll.__main__ import main
from tillroll.plans import history
from tillroll.sources.events import read_event_stream
from tillroll.streaming import ingest, tables, view


def rows(spark, text):
    return sorted(tuple(row) for row in spark.sql(text).collect())


BY_NAME = "SELECT transaction_id, store_id, `timestamp`, total_amount FROM "


@pytest.fixture
def catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    yield "shop.pos"
    spark.sql("DROP DATABASE shop CASCADE")


def test_partitions_follow_the_finished_batches_and_the_base(spark, tmp_path, catalog):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", [*some_events(30), "{"])
    tables.create_tables(spark, str(table), catalog)
    assert rows(spark, f"SELECT * FROM {catalog}_log") == rows(spark, f"SELECT * FROM {catalog}_base") == []
    take_in(spark, source, table)
    tables.refresh_tables(spark, str(table), catalog)
    assert rows(spark, f"{BY_NAME} {catalog}_log WHERE status = 'ok'") == current(spark, table)
    assert rows(spark, f"SELECT value FROM {catalog}_log WHERE status = 'rejected'") == [("{",)]
    assert rows(spark, f"SELECT rowkey FROM {catalog}_base") == []

    view.compact(spark, str(table))
    put(source, "b.txt", [wire(500, store=9, amount=3.0, time="2023-05-05 10:00:00"), *some_events(3)])
    take_in(spark, source, table)
    tables.create_tables(spark, str(table), catalog)  # once more, as the job does
    assert len(rows(spark, f"{BY_NAME} {catalog}_base")) == 30
    view.compact(spark, str(table))
    tables.refresh_tables(spark, str(table), catalog)
    assert rows(spark, f"{BY_NAME} {catalog}_base") == current(spark, table)
    # Replaced folders are no partitions any more, untouched ones still are.
    held = view.read_parts(spark, str(table), 1)
    assert len(spark.sql(f"SHOW PARTITIONS {catalog}_base").collect()) == len(held)
    assert set(held.values()) == {0, 1}


def test_folders_prune_by_name(spark, tmp_path, catalog):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(30))
    take_in(spark, source, table)
    tables.create_tables(spark, str(table), catalog)
    all_files = spark.table(f"{catalog}_log").inputFiles()
    some = spark.sql(f"SELECT * FROM {catalog}_log WHERE salt = 3")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(salt" in plan
    assert len(all_files) > 1


def test_an_unfinished_batch_is_not_seen_and_refuses_the_drop(spark, tmp_path, catalog):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(10))
    take_in(spark, source, table)
    done = table / "log" / "epoch=1" / "batch_id=0"
    half = table / "log" / "epoch=1" / "batch_id=1"
    for file in done.rglob("*.parquet"):
        target = half / file.relative_to(done)
        target.parent.mkdir(parents=True)
        target.write_bytes(file.read_bytes())
    tables.create_tables(spark, str(table), catalog)
    assert spark.table(f"{catalog}_log").count() == 10
    with pytest.raises(tables.InUse, match="batch 1 of epoch 1"):
        tables.drop_tables(spark, str(table), catalog, purge=True)
    assert spark.table(f"{catalog}_log").count() == 10
    tables.drop_tables(spark, str(table), catalog, force=True)
    assert not spark.catalog.tableExists(f"{catalog}_log") and done.exists()


def test_a_running_query_refuses_the_drop(spark, tmp_path, catalog):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(10))
    stream = read_event_stream(spark, "files", path=str(source))
    query = ingest.start_ingest(stream, str(table), str(tmp_path / "ck"), 1, {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        tables.create_tables(spark, str(table), catalog)
        with pytest.raises(tables.InUse, match="ingest"):
            tables.drop_tables(spark, str(table), catalog, purge=True)
        # Forced, the query finds its table gone and stops.
        tables.drop_tables(spark, str(table), catalog, purge=True, force=True)
        put(source, "b.txt", some_events(5))
        with pytest.raises(Exception, match="was removed"):
            query.processAllAvailable()
    finally:
        query.stop()
    assert not (table / "log").exists() and not (table / "journal").exists()


def test_purge_leaves_other_files(spark, tmp_path, catalog):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(10))
    take_in(spark, source, table)
    view.compact(spark, str(table))
    (table / "notes.txt").write_text("mine")
    tables.create_tables(spark, str(table), catalog)
    tables.drop_tables(spark, str(table), catalog, purge=True)
    assert [x.name for x in table.iterdir()] == ["notes.txt"]
    tables.drop_tables(spark, str(table), catalog, purge=True)  # nothing left to drop
    put(source, "b.txt", some_events(4))
    tables.create_tables(spark, str(table), catalog)
    assert spark.table(f"{catalog}_log").count() == 0


@pytest.mark.parametrize("grain", ["day", "month"])
def test_history_in_the_catalog(spark, tmp_path, grain, catalog):
    path = str(tmp_path / "history")
    tables.create_history(spark, path, catalog, grain)
    assert spark.table(catalog).count() == 0
    history.load_history(cleaned(spark), path, grain=grain)
    tables.create_history(spark, path, catalog, grain)
    found = spark.table(catalog)
    assert found.count() == 240
    want = spark.read.parquet(path)
    columns = [c for c in found.columns if c != "customer_id"]
    assert found.select(columns).exceptAll(want.select(columns)).count() == 0
    assert found.filter("customer_id IS NOT NULL").count() == 0
    day = spark.sql(f"SELECT * FROM {catalog} WHERE transaction_date = DATE '2020-01-31'")
    assert day.count() == 48


def test_jobs(spark, tmp_path, catalog):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(10))
    take_in(spark, source, table)
    main(["create", str(table), catalog])
    assert spark.table(f"{catalog}_log").count() == 10
    main(["drop", str(table), catalog, "--purge"])
    assert not spark.catalog.tableExists(f"{catalog}_log") and not (table / "log").exists()
    history.load_history(cleaned(spark, 10), str(tmp_path / "history"))
    main(["create", str(tmp_path / "history"), catalog, "--history"])
    assert spark.table(catalog).count() == 10
