"""Sales rows to events: dense numbers, file order, odd article numbers and prices."""

import decimal
import json

import pytest
from pyspark.sql import functions as F

from tillroll.operators.dense_index import dense_index
from tillroll.operators.pos_mapping import map_sales_to_pos
from tillroll.plans.feed import send_sales
from tillroll.sources.csv import read_sales_csv, read_transactions_csv

COLUMNS = "t_dat string, customer_id string, article_id string, price string, row_index long"


def mapped(spark, **changes):
    row = {"t_dat": "2020-09-20", "customer_id": "0123456789abc", "article_id": "108775015", "price": "0.05", "row_index": 61}
    row.update(changes)
    frame = spark.createDataFrame([tuple(row.values())], COLUMNS)
    events, rejects = map_sales_to_pos(frame)
    return events.first(), rejects.first()


def test_plain_row(spark):
    event, reject = mapped(spark)
    assert tuple(event) == ("0123456789_61", "STORE_016", "2020-09-20 13:01:01", decimal.Decimal("500.00"))
    assert reject is None


@pytest.mark.parametrize(
    ("article", "store"),
    [
        ("99", "STORE_100"),
        ("100", "STORE_001"),
        (" 42 ", "STORE_043"),
        ("-1", "STORE_100"),
        ("-250", "STORE_051"),
        ("1_234", "STORE_035"),
        ("123456789012345678901234567", "STORE_068"),
        ("12.7", "STORE_062"),
        ("NA7", "STORE_062"),
        ("1__2", "STORE_062"),
        ("", "STORE_062"),
        (None, "STORE_062"),
    ],
)
def test_article_numbers(spark, article, store):
    assert mapped(spark, article_id=article)[0]["store_id"] == store


@pytest.mark.parametrize(
    ("price", "amount"),
    [
        ("0.050830508474576264", "508.31"),
        ("0.0000005", "0.01"),
        ("0.00000049999", "0.00"),
        ("1e-3", "10.00"),
        (" 2 ", "20000.00"),
        ("-0.01", "-100.00"),
        ("0.0508304999999", "508.30"),
    ],
)
def test_prices(spark, price, amount):
    assert mapped(spark, price=price)[0]["total_amount"] == decimal.Decimal(amount)


@pytest.mark.parametrize("price", [None, "", "free", "NaN", "1,5"])
def test_bad_prices_are_rejected(spark, price):
    event, reject = mapped(spark, price=price)
    assert event is None
    assert (reject["row_index"], reject["price"], reject["reject_reason"]) == (61, price, "price_not_a_number")


def test_missing_texts_stay_empty(spark):
    event, _ = mapped(spark, customer_id=None, t_dat=None)
    assert (event["transaction_id"], event["timestamp"]) == ("_61", " 13:01:01")


def test_limit(spark):
    rows = spark.range(50).selectExpr(
        "'2020-01-01' t_dat", "'c' customer_id", "'1' article_id", "'1' price", "id AS line"
    )
    events, _ = map_sales_to_pos(rows, ["line"], limit=7)
    assert sorted(r["transaction_id"] for r in events.collect()) == [f"c_{i}" for i in range(7)]
    with pytest.raises(ValueError):
        map_sales_to_pos(rows, ["line"], limit=0)


def test_dense_index_follows_order_and_remaining_columns(spark):
    rows = spark.range(3_000).select(
        (F.col("id") * 31 % 50).alias("a"), (F.col("id") * 17 % 101).cast("string").alias("b")
    )
    got = dense_index(rows.repartition(9), [F.col("a").desc(), "b"]).collect()
    want = sorted(((r["a"], r["b"]) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["row_index"])] == want
    assert sorted(r["row_index"] for r in got) == list(range(3_000))


def test_exact_copies_are_numbered_and_divided(spark, tmp_path):
    rows = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("a")
    )
    stage = str(tmp_path / "stage")
    got = dense_index(rows.repartition(6), ["a"], folder=stage)
    numbers = [r["row_index"] for r in got.collect()]
    assert sorted(numbers) == list(range(6_000))
    chunks = spark.read.parquet(stage).groupBy("__chunk").count()
    assert chunks.agg(F.max("count")).first()[0] < 2_000


def test_empty_input(spark):
    assert dense_index(spark.range(0), ["id"]).count() == 0


def write_sales(folder, files, rows_per_file):
    number = 0
    for name in range(files):
        with open(f"{folder}/part-{name:03d}.csv", "w", encoding="utf-8") as out:
            out.write("t_dat,customer_id,article_id,price\n")
            for _ in range(rows_per_file):
                out.write(f"2020-09-20,c{number:06d},{number},0.01\n")
                number += 1
    return number


def test_file_order_over_many_blocks(spark, folder):
    total = write_sales(folder, files=3, rows_per_file=4_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 9_000)
    try:
        rows = read_sales_csv(spark, folder, indexed=True)
        got = {r["row_index"]: r["article_id"] for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: str(i) for i in range(total)}


def test_send_sales(spark, tmp_path):
    sales, wire = tmp_path / "sales", tmp_path / "wire"
    sales.mkdir()
    write_sales(sales, files=1, rows_per_file=40)
    sent = send_sales(spark, str(sales), limit=30, kind="files", path=str(wire))
    events = [json.loads(r["value"]) for r in spark.read.text(str(wire)).collect()]
    assert sent.rows == 30 and sent.rejects.count() == 0 and sent.rows_per_second > 0
    assert sorted(e["transaction_id"] for e in events) == sorted(f"c{i:06d}_{i}" for i in range(30))
    first = next(e for e in events if e["transaction_id"] == "c000000_0")
    assert first == {
        "transaction_id": "c000000_0",
        "store_id": "STORE_001",
        "timestamp": "2020-09-20 08:00:00",
        "total_amount": 100.0,
    }


def test_csv_columns_are_found_by_name(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        "note,total_amount,store_id,timestamp,transaction_id,payment_method\n"
        "n,1.5,s,2020-09-20 08:00:00,00012345678,cash\n"
        "n,many,s,yesterday,2,\n"
    )
    rows = read_transactions_csv(spark, str(file)).orderBy("transaction_id").collect()
    assert rows[0]["transaction_id"] == "00012345678" and rows[0]["total_amount"] == 1.5
    assert rows[0]["note"] == "n"
    assert (rows[1]["total_amount"], rows[1]["timestamp"], rows[1]["payment_method"]) == (None, None, None)


def test_csv_without_a_required_column(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("transaction_id,store_id\n1,s\n")
    with pytest.raises(ValueError, match="timestamp, total_amount, payment_method"):
        read_transactions_csv(spark, str(file))


def test_quoted_sales_cells(spark, folder):
    with open(f"{folder}/sales.csv", "w", newline="") as file:
        file.write('t_dat,customer_id,article_id,price\n2020-01-01,"ab ""q"" cd","x\ny",1.5\n')
    rows = read_sales_csv(spark, folder, multiLine=True).collect()
    assert [(r["customer_id"], r["article_id"]) for r in rows] == [('ab "q" cd', "x\ny")]
