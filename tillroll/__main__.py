"""Jobs to submit. The only place that makes a session; settings come from spark-submit.

    spark-submit ... tillroll/__main__.py send sales.csv --option kafka.bootstrap.servers=host:9092
    spark-submit ... tillroll/__main__.py ingest /tables/pos --epoch 1 --checkpoint /checkpoints/pos \\
        --option kafka.bootstrap.servers=host:9092
    spark-submit ... tillroll/__main__.py leaderboard /tables/pos
    spark-submit ... tillroll/__main__.py sql /tables/pos "SELECT * FROM transactions"
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.streaming import StreamingQuery  # noqa: E402

from tillroll import fixed  # noqa: E402
from tillroll.plans import feed, history, sales  # noqa: E402
from tillroll.plans.cleaning import clean_transactions  # noqa: E402
from tillroll.sources.csv import read_transactions_csv  # noqa: E402
from tillroll.sources.events import read_event_stream  # noqa: E402
from tillroll.streaming import enriched, ingest, live, metrics, progress, ranking, tables, view  # noqa: E402


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _trigger(args: argparse.Namespace) -> dict[str, object]:
    return {"availableNow": True} if args.once else {"processingTime": args.interval}


def _stream(spark: SparkSession, args: argparse.Namespace):
    return read_event_stream(
        spark, args.kind, args.starting, not args.allow_data_loss, **_options(args.option)
    )


def send(spark: SparkSession, args: argparse.Namespace) -> None:
    with progress.watching(spark, "send"):
        sent = feed.send_sales(
            spark, args.csv, args.limit, args.kind, _options(args.reading), **_options(args.option)
        )
    print(f"sent {sent.rows:,} rows in {sent.seconds} s, {sent.rows_per_second} rows/s")
    print(f"not mapped: {sent.rejects.count():,} rows")


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    with progress.watching(spark, "load"):
        rows = history.process_history(
            spark, args.csv, args.table, partitions=args.partitions, grain=args.grain
        )
    print(f"loaded {rows:,} rows")


def _run(spark: SparkSession, query: StreamingQuery) -> None:
    listener = progress.BatchProgress()
    with progress.listening(spark, listener):
        query.awaitTermination()
        listener.ended.wait(10)


def start(spark: SparkSession, args: argparse.Namespace) -> None:
    query = ingest.start_ingest(
        _stream(spark, args), args.table, args.checkpoint, args.epoch, _trigger(args), args.zone, args.ranked
    )
    _run(spark, query)


def follow(spark: SparkSession, args: argparse.Namespace) -> None:
    board = live.live_leaderboard(_stream(spark, args), args.watermark, zone=args.zone)
    _run(
        spark,
        live.start_live_leaderboard(board, args.table, args.checkpoint, args.epoch, _trigger(args)),
    )


def enrich(spark: SparkSession, args: argparse.Namespace) -> None:
    query = enriched.start_enriched(
        _stream(spark, args), args.table, args.checkpoint, _trigger(args), args.zone
    )
    _run(spark, query)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    """From the cleaned transactions of a CSV folder; with --changed only the periods in there."""
    cleaned = clean_transactions(read_transactions_csv(spark, args.csv))
    if args.changed:
        changed = clean_transactions(read_transactions_csv(spark, args.changed))
        rows = history.refresh_daily_sales(cleaned, changed, args.table, args.grain)
    else:
        rows = history.save_daily_sales(cleaned, args.table, args.grain)
    print(f"{rows:,} store-days written")


def recent(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = view.current_view(spark, args.table)
    _print(sales.recent_by_store(rows, args.latest, "event_time"), args.rows)


def _print(rows: DataFrame, limit: int) -> None:
    """The first lines, and whether rows are left out: one row more is asked for, not all."""
    first = rows.limit(limit + 1).collect()
    shown = rows.sparkSession.createDataFrame(first[:limit], rows.schema)
    shown.show(limit, truncate=False)
    if len(first) > limit:
        print(f"only the first {limit:,} rows, see --rows")


def leaderboard(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.exact:
        _print(ranking.exact_ranking(spark, args.table), args.rows)
        return
    rows = view.serving_text(view.current_view(spark, args.table))
    _print(sales.store_leaderboard_sql(rows), args.rows)


def query(spark: SparkSession, args: argparse.Namespace) -> None:
    view.current_view(spark, args.table).createOrReplaceTempView("transactions")
    rows = spark.sql(args.text)
    if args.out:
        rows.write.parquet(args.out)
    else:
        _print(rows, args.rows)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    metrics.ingest_totals(spark, args.table).show(args.rows, truncate=False)
    batches = metrics.ingest_metrics(spark, args.table)
    _print(batches.orderBy(F.desc("epoch"), F.desc("batch_id")), args.rows)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"version {view.compact(spark, args.table, args.grain)}")


def create(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.history:
        tables.create_history(spark, args.table, args.name, args.grain)
    else:
        tables.create_tables(spark, args.table, args.name)


def drop(spark: SparkSession, args: argparse.Namespace) -> None:
    tables.drop_tables(spark, args.table, args.name, args.purge, args.force)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillroll")
    jobs = top.add_subparsers(required=True)

    def job(name, run, help):
        sub = jobs.add_parser(name, help=help)
        sub.set_defaults(run=run)
        return sub

    def stream_arguments(sub):
        sub.add_argument("table")
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--kind", default="kafka", choices=["kafka", "files"])
        sub.add_argument("--starting", default="earliest")
        sub.add_argument("--allow-data-loss", action="store_true")
        sub.add_argument("--zone", help="of the event times; the session's zone by default")
        sub.add_argument("--interval", default=fixed.TRIGGER_INTERVAL)
        sub.add_argument("--once", action="store_true", help="take what is there and stop")
        sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    sub = job("send", send, "sales files to the event stream")
    sub.add_argument("csv")
    sub.add_argument("--limit", type=int, help="rows of the input to send; all by default")
    sub.add_argument("--kind", default="kafka", choices=["kafka", "files"])
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    sub.add_argument("--reading", action="append", default=[], metavar="NAME=VALUE", help="CSV options")

    sub = job("load", load, "transaction files to the history table")
    sub.add_argument("csv")
    sub.add_argument("table")
    sub.add_argument("--partitions", type=int)
    sub.add_argument("--grain", default="day", choices=list(history.GRAINS))

    sub = job("ingest", start, "event stream to the log")
    stream_arguments(sub)
    sub.add_argument("--epoch", type=int, required=True)

    sub.add_argument("--ranked", action="store_true", help="keep the exact store ranking")

    sub = job("enrich", enrich, "event stream to cleaned rows by day")
    stream_arguments(sub)

    sub = job("daily", daily, "transaction files to the daily sales table")
    sub.add_argument("csv")
    sub.add_argument("table")
    sub.add_argument("--changed", help="only the periods of these files, which are among the others")
    sub.add_argument("--grain", default="day", choices=list(history.GRAINS))

    sub = job("recent", recent, "latest rows of every store")
    sub.add_argument("table")
    sub.add_argument("--latest", type=int, default=5, help="rows of a store")
    sub.add_argument("--rows", type=int, default=100, help="lines to print")

    sub = job("follow", follow, "store ranking that refreshes with the stream")
    stream_arguments(sub)
    sub.add_argument("--epoch", type=int, required=True)
    sub.add_argument("--watermark", default="1 hour")

    for name, run, help in (
        ("leaderboard", leaderboard, "store ranking of the current rows"),
        ("report", report, "what the ingest did"),
    ):
        sub = job(name, run, help)
        sub.add_argument("table")
        sub.add_argument("--rows", type=int, default=100, help="lines to print")
        if run is leaderboard:
            sub.add_argument("--exact", action="store_true", help="as kept by ingest --ranked")

    sub = job("sql", query, "any SQL on the current rows, the view `transactions`")
    sub.add_argument("table")
    sub.add_argument("text")
    sub.add_argument("--rows", type=int, default=100, help="lines to print")
    sub.add_argument("--out", help="folder for all rows, as Parquet, instead of printing")

    sub = job("compact", compact, "merge the log into the base")
    sub.add_argument("table")
    sub.add_argument("--grain", default="day", choices=list(view.GRAINS))

    sub = job("create", create, "enter a table in the catalog, or bring its partitions up to date")
    sub.add_argument("table")
    sub.add_argument("name", help="in the catalog; log and base follow it as _log and _base")
    sub.add_argument("--history", action="store_true", help="the folder is a history table")
    sub.add_argument("--grain", default="day", choices=list(history.GRAINS), help="of a history table")

    sub = job("drop", drop, "take an ingested table out of the catalog")
    sub.add_argument("table")
    sub.add_argument("name")
    sub.add_argument("--purge", action="store_true", help="remove its rows as well")
    sub.add_argument("--force", action="store_true", help="though a batch was left unfinished")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("tillroll").getOrCreate(), args)


if __name__ == "__main__":
    main()
