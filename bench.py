"""Times of the main jobs, one JSON line.

Tables come from $BENCH_SF_DIR, the session has $BENCH_CPUS cores. Every job runs once to
warm up, then $BENCH_RUNS times; the median counts. Inputs (Parquet, CSV, wire events) are
written before the clock starts, in as many files as there are cores: the given lineitem
is one row group, which one task would have to read alone.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import fixtures  # noqa: E402
from tillroll.functions import keys  # noqa: E402
from tillroll.operators import balance, events, row_keys  # noqa: E402
from tillroll.operators.pos_mapping import map_sales_to_pos  # noqa: E402
from tillroll.plans import history, sales  # noqa: E402
from tillroll.plans.cleaning import clean_transactions  # noqa: E402
from tillroll.sources.csv import read_sales_csv, read_transactions_csv  # noqa: E402
from tillroll.sources.events import read_event_stream  # noqa: E402
from tillroll.sources.shared import new_folder, staged  # noqa: E402
from tillroll.streaming import ingest, live, view  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MEMORY = os.environ.get("BENCH_MEMORY", "12g")
ALL_AT_ONCE = {"availableNow": True}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", MEMORY)
        .config("spark.sql.shuffle.partitions", CPUS)
        # Files of a few megabytes: the default of 64 would leave most cores without work.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Compute every column of every row and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def jobs(spark: SparkSession) -> dict[str, Callable[[], None]]:
    raw = staged(fixtures.raw_transactions(spark, SF_DIR).repartition(int(CPUS)), "raw")
    clean = clean_transactions(raw)
    csv, sales_csv = new_folder(spark, "csv"), new_folder(spark, "sales-csv")
    raw.write.option("header", True).csv(csv)
    sold = staged(fixtures.sales_rows(spark, SF_DIR).repartition(int(CPUS)), "sales")
    sold.drop(*fixtures.SALES_ORDER).write.option("header", True).csv(sales_csv)
    cleaned = new_folder(spark, "clean")
    row_keys.with_key_batch(clean).write.parquet(cleaned)
    cleaned = spark.read.parquet(cleaned)
    wire, ingested = new_folder(spark, "wire"), new_folder(spark, "ingested")
    to_send, _ = map_sales_to_pos(read_sales_csv(spark, sales_csv, indexed=True))
    events.encode_events(to_send).write.text(wire)
    loaded = new_folder(spark, "history")
    history.load_history(cleaned, loaded, grain="month")

    def ingest_into(path: str) -> None:
        stream = read_event_stream(spark, "files", path=wire)
        checkpoint = new_folder(spark, "checkpoint")
        ingest.start_ingest(stream, path, checkpoint, 1, ALL_AT_ONCE).awaitTermination()

    def rank_live() -> None:
        ranking = live.live_leaderboard(read_event_stream(spark, "files", path=wire))
        live.start_live_leaderboard(
            ranking, new_folder(spark, "ranking"), new_folder(spark, "checkpoint"), 1, ALL_AT_ONCE
        ).awaitTermination()

    def all_keys() -> DataFrame:
        rows = row_keys.with_key_stream(cleaned, name="stream_key")
        rows = row_keys.with_key_salted(rows, name="salted_key")
        rows = row_keys.with_key_store_date(rows, name="store_date_key")
        return row_keys.with_key_batch(rows, name="batch_key")

    ingest_into(ingested)
    texts = history.as_text(cleaned.select("store_id", "total_amount"))
    return {
        "csv_scan": lambda: run(read_transactions_csv(spark, csv, fixtures.EXACT_TRANSACTION)),
        "clean_transactions": lambda: run(clean),
        "daily_sales": lambda: run(sales.daily_sales(clean)),
        "daily_sales_of_cleaned": lambda: run(sales.daily_sales(cleaned)),
        "leaderboard_of_cleaned": lambda: run(sales.store_leaderboard(cleaned)),
        "leaderboard_of_text": lambda: run(sales.store_leaderboard_sql(texts)),
        "recent_by_store": lambda: run(sales.recent_by_store(cleaned, 5)),
        "store_day": lambda: run(
            sales.store_day(spark.read.parquet(loaded), "STORE_013", "1999-03-11")
        ),
        "row_keys": lambda: run(all_keys()),
        "key_balance": lambda: run(
            balance.key_balance(cleaned, keys.stream_salt(F.col("transaction_id")))
        ),
        "key_collisions": lambda: run(
            balance.collision_summary(row_keys.with_key_store_date(cleaned), "rowkey")
        ),
        "sales_to_pos": lambda: run(
            map_sales_to_pos(sold, fixtures.SALES_ORDER)[0]
        ),
        "sales_csv_to_pos": lambda: run(
            map_sales_to_pos(read_sales_csv(spark, sales_csv, indexed=True))[0]
        ),
        "event_decode": lambda: run(events.decode_events(spark.read.text(wire))[0]),
        "history_load": lambda: history.load_history(
            cleaned, new_folder(spark, "history"), grain="month"
        ),
        "stream_ingest": lambda: ingest_into(new_folder(spark, "ingested")),
        "current_view": lambda: run(view.current_view(spark, ingested)),
        "live_leaderboard": rank_live,
    }


def main() -> None:
    spark = session()
    rows = fixtures.table(spark, SF_DIR, "lineitem").count()
    seconds = {}
    for name, job in jobs(spark).items():
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            job()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "sum of median job times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows": rows,
        "ingest_rows_per_second": round(rows / seconds["stream_ingest"]),
        "cpus": int(CPUS),
        "memory": MEMORY,
        "runs": RUNS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
