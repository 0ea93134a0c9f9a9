"""What the plans must look like for large inputs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import fixtures
import oracles
from tillroll.operators import events
from tillroll.operators.pos_mapping import map_sales_to_pos
from tillroll.operators.row_keys import (
    with_key_batch,
    with_key_salted,
    with_key_store_date,
    with_key_stream,
)
from tillroll.plans import sales
from tillroll.plans.cleaning import clean_transactions
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "raw")
    fixtures.raw_transactions(spark, SMALL).withColumn("unused", F.lit("x")).write.parquet(path)
    return spark.read.parquet(path)


def test_cleaning_shuffles_once_and_cuts_before_it(stored):
    text = plan(clean_transactions(stored))
    assert text.count("Exchange") == 1
    assert "hashpartitioning(transaction_id" in text
    assert text.count("WindowGroupLimit") == 2  # in the map tasks and after the shuffle


def test_filters_reach_the_scan(stored):
    text = plan(clean_transactions(stored))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    for part in ("IsNotNull(transaction_id)", "IsNotNull(store_id)", "IsNotNull(timestamp)", "GreaterThan(total_amount"):
        assert part.split("(")[0] in pushed


def test_daily_sales_read_only_their_columns(spark, stored):
    days = stored.withColumn("transaction_date", F.to_date("timestamp"))
    text = plan(sales.daily_sales(days))
    assert "unused" not in text.split("ReadSchema: ")[1]
    assert text.count("HashAggregate(keys=[store_id") >= 4
    assert "SortAggregate" not in text


def test_recent_rows_are_cut_in_the_map_tasks(stored):
    assert plan(sales.recent_by_store(stored, 5)).count("WindowGroupLimit") == 2


def test_top_stores_are_not_sorted_whole(stored):
    assert "TakeOrderedAndProject" in plan(sales.store_leaderboard(stored, limit=3))


def test_keys_do_not_shuffle(stored):
    keyed = stored
    for at, add in enumerate((with_key_stream, with_key_salted, with_key_store_date, with_key_batch)):
        keyed = add(keyed, name=f"key_{at}")
    assert "Exchange" not in plan(keyed)


def test_json_is_parsed_once(spark):
    good, rejects = events.decode_events(spark.createDataFrame([("{}",)], "value string"))
    for df in (good, rejects):
        assert plan(df).count("from_json") == 1


BATCH = [name for name in oracles.sql() if "stream" not in name and "live" not in name and "ingest" not in name]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registered.queries()[name](spark, SMALL))
    for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_row_numbers_have_no_window_over_all_blocks(spark, tmp_path, monkeypatch):
    """Also with many ranges of chunks: windows are per range, and numbers stay gapless."""
    from pyspark.sql import DataFrame

    from tillroll.operators import dense_index
    from tillroll.sources.csv import read_sales_csv

    monkeypatch.setattr(dense_index, "_RANGE_CHUNKS", 3)
    rows = spark.range(1_000).selectExpr(
        "'d' AS t_dat", "CAST(id AS STRING) AS customer_id", "'1' AS article_id", "'2' AS price"
    )
    rows.repartitionByRange(20, F.col("customer_id").cast("int")).sortWithinPartitions(
        F.col("customer_id").cast("int")
    ).write.option("header", True).csv(str(tmp_path / "csv"))
    written = []
    stage = dense_index.staged

    def watched(df: DataFrame, *names):
        written.append(plan(df))
        return stage(df, *names)

    monkeypatch.setattr(dense_index, "staged", watched)
    found = read_sales_csv(spark, str(tmp_path / "csv"), indexed=True)
    assert found.filter("customer_id <> row_index").count() == 0 and found.count() == 1_000
    windows = [text for text in written if "Window" in text]
    assert windows and all("windowspecdefinition(__range" in text for text in windows)
    assert not any("SinglePartition" in text for text in windows)


def test_ranges_follow_the_size_of_the_input(spark, stored, monkeypatch):
    from tillroll.operators import dense_index

    least = dense_index._range_count(stored)
    monkeypatch.setattr(dense_index, "_RANGE_BYTES", 1_000)
    assert dense_index._range_count(stored) > 10 * least
    assert dense_index._range_count(stored.crossJoin(stored).crossJoin(stored)) == dense_index._MOST_RANGES


def test_a_capped_send_reads_the_first_files(spark, tmp_path):
    from tillroll.plans import feed
    from tillroll.sources.csv import first_sales_files, read_sales_csv

    folder = tmp_path / "sales csv"
    folder.mkdir()
    for number in range(40):
        lines = [f"2020-01-01,c{number}_{i},{i},0.5" for i in range(100)]
        (folder / f"part-{number:02d}.csv").write_text("t_dat,customer_id,article_id,price\n" + "\n".join(lines) + "\n")
    for limit, files in ((1, 1), (100, 1), (101, 2), (390, 4), (401, 8), (4_000, 40), (9_000, 40)):
        taken = first_sales_files(spark, str(folder), limit)
        assert len(taken) == files and taken[0].endswith("part-00.csv")
    sent = feed.send_sales(spark, str(folder), limit=250, kind="files", path=str(tmp_path / "wire"))
    assert sent.rows == 250
    good, _ = events.decode_events(spark.read.text(str(tmp_path / "wire")))
    told = {r["transaction_id"] for r in good.collect()}
    assert told == {f"c{i // 100}_{i % 100}_{i}" for i in range(250)}
    assert len(read_sales_csv(spark, first_sales_files(spark, str(folder), 250)).inputFiles()) == 4


def test_sales_are_sorted_before_texts_are_made(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_LEAST_RANGE_BYTES", 10_000)
    rows = fixtures.sales_rows(spark, SMALL, ordered=True)
    assert "md5(" not in plan(rows).split("rangepartitioning")[1]
    want = fixtures.sales_rows(spark, SMALL).orderBy(*fixtures.SALES_ORDER)
    order = list(fixtures.SALES_ORDER)
    assert rows.select(order).collect() == want.select(order).collect()
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()


def test_large_tables_are_sorted_in_more_ranges(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_RANGE_BYTES", 1_000)
    text = plan(fixtures.sales_rows(spark, SMALL, ordered=True))
    ranges = int(text.split(", REPARTITION_BY_NUM")[0].rpartition(" ")[2].strip(")"))
    assert ranges > 3 * spark.sparkContext.defaultParallelism


def test_amounts_of_sales_are_computed_once(spark):
    good, rejects = map_sales_to_pos(fixtures.sales_rows(spark, SMALL).withColumn("row_index", F.lit(1)))
    for rows in (good, rejects):
        assert plan(rows).count("decimal(38,20)") == 1


def test_refreshed_daily_sales_clean_the_rows_once(spark, monkeypatch):
    read, raw = spark.sparkContext.accumulator(0), fixtures.raw_transactions

    def counted(session, sf_dir):
        def work(parts):
            for part in parts:
                read.add(part.num_rows)
                yield part

        rows = raw(session, sf_dir)
        return rows.mapInArrow(work, rows.schema)

    monkeypatch.setattr(fixtures, "raw_transactions", counted)
    assert registered.daily_sales_refreshed(spark, SMALL).count() > 0
    assert read.value == raw(spark, SMALL).count()


def test_amounts_are_computed_once_before_cleaning(spark):
    text = plan(clean_transactions(fixtures.raw_transactions(spark, SMALL)))
    assert text.count("cast(l_discount") == 1
