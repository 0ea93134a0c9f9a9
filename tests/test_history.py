"""History table, daily sales and lookups."""

import datetime

import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from tillroll.operators.row_keys import with_key_batch
from tillroll.plans import history, sales
from tillroll.plans.cleaning import clean_transactions

DAY = datetime.datetime(2020, 1, 30)


def cleaned(spark, rows=240, extra=""):
    raw = spark.range(rows).selectExpr(
        "concat('t', id) transaction_id",
        "concat('store_', id % 4) store_id",
        "timestamp'2020-01-30 08:00:00' + make_dt_interval(CAST(id % 5 AS INT), 0, CAST(id % 60 AS INT)) timestamp",
        "CAST(id % 9 + 1 AS DOUBLE) total_amount",
        "CASE id % 3 WHEN 0 THEN 'cash' WHEN 1 THEN 'card' ELSE NULL END payment_method",
        *([extra] if extra else []),
    )
    return with_key_batch(clean_transactions(raw))


@pytest.mark.parametrize("grain", ["day", "month"])
@pytest.mark.parametrize("partitions", [None, 16])
def test_load_and_read_back(spark, tmp_path, grain, partitions):
    path = str(tmp_path / "history")
    rows = cleaned(spark)
    assert history.load_history(rows, path, grain=grain, partitions=partitions) == 240
    table = spark.read.parquet(path)
    want = rows.select("rowkey", "store_id", F.col("total_amount").alias("amount"), F.col("payment_method").alias("payment"), "timestamp", "transaction_date")
    got = table.select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    folders = {p.name for p in (tmp_path / "history").iterdir() if p.is_dir()}
    if grain == "day":
        assert folders == {f"transaction_date={DAY.date() + datetime.timedelta(days=d)}" for d in range(5)}
    else:
        assert folders == {"transaction_month=2020-01", "transaction_month=2020-02"}


def test_loads_append(spark, tmp_path):
    path = str(tmp_path / "history")
    assert history.load_history(cleaned(spark, 10), path) == 10
    assert history.load_history(cleaned(spark, 7), path) == 7
    assert spark.read.parquet(path).count() == 17


def test_files_are_sorted_by_day_and_store(spark, tmp_path):
    path = tmp_path / "history"
    history.load_history(cleaned(spark, 2_000), str(path), grain="month")
    for file in path.rglob("*.parquet"):
        rows = pyarrow.parquet.ParquetFile(file).read(["transaction_date", "store_id", "rowkey"])
        keys = [tuple(row.values()) for row in rows.to_pylist()]
        assert keys == sorted(keys)


def test_an_empty_load_counts_zero(spark, tmp_path):
    assert history.load_history(cleaned(spark, 0), str(tmp_path / "history")) == 0


def test_customer_is_kept_where_there_is_one(spark):
    assert "customer_id" not in history.serving_rows(cleaned(spark)).columns
    with_customer = history.serving_rows(cleaned(spark, extra="'c' AS customer_id"))
    assert with_customer.columns == ["rowkey", "store_id", "amount", "payment", "customer_id", "timestamp", "transaction_date"]


def test_missing_columns_fail_before_the_write(spark, tmp_path):
    path = tmp_path / "history"
    with pytest.raises(ValueError, match="payment_method"):
        history.load_history(cleaned(spark).drop("payment_method"), str(path))
    with pytest.raises(ValueError, match="nothing_like_it"):
        history.load_history(cleaned(spark), str(path), {"amount": "nothing_like_it"})
    assert not path.exists()


def test_own_column_map(spark, tmp_path):
    path = str(tmp_path / "history")
    history.load_history(cleaned(spark), path, {"key": "rowkey", "value": "total_amount"})
    assert spark.read.parquet(path).columns == ["key", "value", "transaction_date"]


def test_store_day_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "history")
    history.load_history(cleaned(spark), path)
    found = sales.store_day(spark.read.parquet(path), "STORE_1", "2020-02-01")
    want = cleaned(spark).filter("store_id = 'STORE_1' AND transaction_date = DATE'2020-02-01'")
    assert sorted(r["rowkey"] for r in found.collect()) == sorted(r["rowkey"] for r in want.collect())
    assert found.count() > 0
    plan = explained(found)
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    assert "EqualTo(store_id,STORE_1)" in plan
    assert len(found.inputFiles()) < len(spark.read.parquet(path).inputFiles()) or "2020-02-01" in plan


def test_store_day_by_month(spark, tmp_path):
    path = str(tmp_path / "history")
    history.load_history(cleaned(spark), path, grain="month")
    found = sales.store_day(spark.read.parquet(path), "STORE_1", datetime.date(2020, 2, 1))
    assert found.count() == sales.store_day(cleaned(spark), "STORE_1", "2020-02-01").count() > 0
    assert "transaction_month#" in explained(found).split("PartitionFilters: ")[1].split("]")[0]


def explained(df):
    return df._jdf.queryExecution().toString()


def test_text_layout(spark):
    texts = history.as_text(history.serving_rows(cleaned(spark, 3)))
    assert {f.dataType.simpleString() for f in texts.schema} == {"string"}


def test_daily_sales(spark):
    rows = spark.createDataFrame(
        [
            ("a", "s", "2020-01-01", 10.0, "CASH"),
            ("b", "s", "2020-01-01", 20.0, "CARD"),
            (None, "s", "2020-01-01", 30.0, "CASH"),
            ("d", "s", "2020-01-01", None, None),
            ("e", "r", "2020-01-02", None, None),
        ],
        "transaction_id string, store_id string, transaction_date string, total_amount double, payment_method string",
    )
    assert [tuple(r) for r in sales.daily_sales(rows).collect()] == [
        ("r", "2020-01-02", 1, None, None, []),
        ("s", "2020-01-01", 3, 60.0, 20.0, ["CARD", "CASH"]),
    ]


@pytest.mark.parametrize("kind", ["double", "decimal(20,2)", "decimal(38,10)"])
def test_daily_sales_agree_with_plain_aggregates(spark, kind):
    rows = cleaned(spark).withColumn("total_amount", F.col("total_amount").cast(kind))
    plain = rows.groupBy("store_id", "transaction_date").agg(
        F.count("transaction_id").alias("transaction_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_transaction_value"),
        F.sort_array(F.collect_set("payment_method")).alias("payment_methods"),
    )
    got = sales.daily_sales(rows)
    assert [f.dataType for f in got.schema] == [f.dataType for f in plain.schema]
    assert got.collect() == plain.orderBy("store_id", "transaction_date").collect()


def test_leaderboard_forms_agree(spark):
    rows = cleaned(spark)
    texts = history.as_text(rows)
    want = [tuple(r) for r in sales.store_leaderboard(rows).collect()]
    assert [tuple(r) for r in sales.store_leaderboard(texts).collect()] == want
    assert [tuple(r) for r in sales.store_leaderboard_sql(texts, "told").collect()] == want
    assert [tuple(r) for r in sales.store_leaderboard(rows, limit=2).collect()] == want[:2]
    assert want == sorted(want, key=lambda r: (-r[2], r[0]))


def test_amounts_that_are_no_numbers_count_but_do_not_add(spark):
    rows = spark.createDataFrame([("s", "1.5"), ("s", "None"), ("s", "1E-5"), ("s", "1.2E7")], "store_id string, total_amount string")
    row = sales.store_leaderboard(rows).first()
    assert (row[1], float(row[2])) == (4, 12_000_001.50001)


def test_recent_by_store(spark):
    rows = cleaned(spark)
    got = {}
    for row in sales.recent_by_store(rows, 3).collect():
        got.setdefault(row["store_id"], []).append((row["timestamp"], row["transaction_id"]))
    everything = {}
    for row in rows.collect():
        everything.setdefault(row["store_id"], []).append((row["timestamp"], row["transaction_id"]))
    for store, times in everything.items():
        want = sorted(times, key=lambda r: (-r[0].timestamp(), r[1]))[:3]
        assert sorted(got[store]) == sorted(want)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_saved_daily_sales(spark, tmp_path, grain):
    path = str(tmp_path / "daily")
    rows = cleaned(spark)
    want = sales.daily_sales(rows)
    assert history.save_daily_sales(rows, path, grain) == want.count()
    assert history.save_daily_sales(rows, path, grain) == want.count()
    got = spark.read.parquet(path).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_process_history(spark, tmp_path):
    csv, path = str(tmp_path / "csv"), str(tmp_path / "history")
    spark.range(60).selectExpr(
        "concat('t', id % 50) transaction_id",
        "'store_1' store_id",
        "concat('2020-01-30 08:00:', lpad(id, 2, '0')) timestamp",
        "id total_amount",
        "'cash' payment_method",
        "concat('c', id) customer_id",
    ).write.option("header", True).csv(csv)
    assert history.process_history(spark, csv, path) == 50
    table = spark.read.parquet(path)
    assert table.filter("rowkey = 'STORE_1_2020-01-30 08:00:50_t0'").first()["customer_id"] == "c50"
