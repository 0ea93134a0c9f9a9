"""Registered queries and, for each, the SQL that must give the same rows.

Results are brought to types that every engine has: decimals as DOUBLE after exact
summing, whole numbers as BIGINT, dates and times as text, arrays as joined text.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import fixtures  # noqa: E402
import oracles  # noqa: E402
from tillroll import fixed  # noqa: E402
from tillroll.functions import keys  # noqa: E402
from tillroll.operators import balance, events, row_keys, standardize, validity  # noqa: E402
from tillroll.operators.pos_mapping import map_sales_to_pos  # noqa: E402
from tillroll.operators.ranking import deduplicate_latest  # noqa: E402
from tillroll.plans import by_store, feed, history, sales  # noqa: E402
from tillroll.plans.cleaning import clean_transactions  # noqa: E402
from tillroll.sources.csv import read_sales_csv, read_transactions_csv  # noqa: E402
from tillroll.sources.events import read_event_stream, send_events  # noqa: E402
from tillroll.sources.shared import new_folder, staged  # noqa: E402
from tillroll.streaming import enriched, ingest, live, metrics, ranking, tables, view  # noqa: E402

DAILY_COLUMNS = (
    "transaction_id",
    "store_id",
    "transaction_date",
    "transaction_hour",
    "payment_method",
    "total_amount",
)
ALL_AT_ONCE = {"availableNow": True}


def highest_first() -> tuple[Column, ...]:
    """Of rows with the same id and time, the highest amount counts."""
    return (F.col("total_amount").desc(),)


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = column.cast("string")
            whole = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".")))
            column = F.rpad(whole, 26, "0")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(fixtures.raw_transactions(spark, sf_dir), tie_break=highest_first())


# --- sources and events ---------------------------------------------------------------


def csv_scan(spark, sf_dir):
    path = new_folder(spark, "transactions-csv")
    fixtures.raw_transactions(spark, sf_dir).write.option("header", True).csv(path)
    return read_transactions_csv(spark, path, fixtures.EXACT_TRANSACTION)


def sales_to_pos(spark, sf_dir):
    good, _ = map_sales_to_pos(fixtures.sales_rows(spark, sf_dir), fixtures.SALES_ORDER)
    return good


def sales_to_pos_file_order(spark, sf_dir):
    path = new_folder(spark, "sales-csv")
    rows = fixtures.sales_rows(spark, sf_dir, ordered=True)
    rows.drop(*fixtures.SALES_ORDER).write.option("header", True).csv(path)
    good, _ = map_sales_to_pos(read_sales_csv(spark, path, indexed=True))
    return good


def send_sales(spark, sf_dir):
    csv, wire = new_folder(spark, "sales-csv"), new_folder(spark, "wire")
    rows = fixtures.sales_rows(spark, sf_dir, ordered=True)
    rows.drop(*fixtures.SALES_ORDER).write.option("header", True).csv(csv)
    sent = feed.send_sales(spark, csv, limit=None, kind="files", path=wire)
    arrived, _ = events.decode_events(spark.read.text(wire))
    arrived = arrived.select(*fixed.EVENT_FIELDS)
    return arrived.withColumn("rows_sent", F.lit(sent.rows).cast("bigint"))


def sales_csv_quoted(spark, sf_dir):
    csv, wire = new_folder(spark, "quoted-csv"), new_folder(spark, "wire")
    rows = fixtures.quoted_sales_rows(spark, sf_dir, ordered=True)
    rows.drop(*fixtures.SALES_ORDER).write.options(header=True, escape='"').csv(csv)
    feed.send_sales(spark, csv, kind="files", path=wire, reading={"multiLine": True})
    arrived, _ = events.decode_events(spark.read.text(wire))
    return arrived.select(*fixed.EVENT_FIELDS)


def send_sales_capped(spark, sf_dir):
    """The first 5,000 rows of a folder of files."""
    csv, wire = new_folder(spark, "sales-csv"), new_folder(spark, "wire")
    rows = fixtures.sales_rows(spark, sf_dir).repartitionByRange(16, *fixtures.SALES_ORDER)
    rows = rows.sortWithinPartitions(*fixtures.SALES_ORDER).drop(*fixtures.SALES_ORDER)
    rows.write.option("header", True).csv(csv)
    sent = feed.send_sales(spark, csv, limit=5_000, kind="files", path=wire)
    arrived, _ = events.decode_events(spark.read.text(wire))
    arrived = arrived.select(*fixed.EVENT_FIELDS)
    return arrived.withColumn("rows_sent", F.lit(sent.rows).cast("bigint"))


def sales_to_pos_capped(spark, sf_dir):
    good, _ = map_sales_to_pos(
        fixtures.sales_rows(spark, sf_dir), fixtures.SALES_ORDER, limit=5_000
    )
    return good


def sales_to_pos_with_bad_prices(spark, sf_dir):
    rows = fixtures.sales_rows(spark, sf_dir, bad_prices=True)
    good, _ = map_sales_to_pos(rows, fixtures.SALES_ORDER)
    return good


def sales_rejects(spark, sf_dir):
    rows = fixtures.sales_rows(spark, sf_dir, bad_prices=True)
    _, rejects = map_sales_to_pos(rows, fixtures.SALES_ORDER)
    return rejects.select(
        "row_index", "t_dat", "customer_id", "article_id", "price", "reject_reason"
    )


def event_encode(spark, sf_dir):
    return events.encode_events(
        fixtures.pos_events(spark, sf_dir).withColumn(
            "total_amount", F.col("total_amount").cast("decimal(20,2)")
        )
    )


def event_roundtrip(spark, sf_dir):
    good, _ = events.decode_events(events.encode_events(fixtures.pos_events(spark, sf_dir)))
    return good.select(*fixed.EVENT_FIELDS)


def event_decode(spark, sf_dir):
    good, _ = events.decode_events(fixtures.faulty_wire(spark, sf_dir))
    return good.select("event_id", *fixed.EVENT_FIELDS)


def event_rejects(spark, sf_dir):
    _, rejects = events.decode_events(fixtures.faulty_wire(spark, sf_dir))
    return rejects.select("event_id", "reject_reason")


# --- cleaning -------------------------------------------------------------------------


def valid_records(spark, sf_dir):
    return validity.remove_invalid_records(fixtures.dirty_transactions(spark, sf_dir))


def dedupe_latest(spark, sf_dir):
    raw = fixtures.raw_transactions(spark, sf_dir)
    return deduplicate_latest(raw, tie_break=highest_first())


def standard_formats(spark, sf_dir):
    return standardize.standardize_formats(fixtures.odd_formats(spark, sf_dir))


def standard_formats_class(spark, sf_dir):
    return standardize.standardize_formats(
        fixtures.odd_formats(spark, sf_dir), fixed.STORE_PATTERN_CLASS
    )


def review_flags(spark, sf_dir):
    rows = standardize.standardize_formats(fixtures.odd_formats(spark, sf_dir))
    return standardize.validate_business_rules(rows)


def enrichment(spark, sf_dir):
    return standardize.enrich(fixtures.raw_transactions(spark, sf_dir))


# --- keys -----------------------------------------------------------------------------


def _keyed(add_key):
    def run(spark, sf_dir):
        return add_key(_clean(spark, sf_dir)).select("transaction_id", "rowkey")

    return run


def key_stream(spark, sf_dir):
    keyed = row_keys.with_key_stream(fixtures.pos_events(spark, sf_dir), zone="UTC")
    return keyed.select("transaction_id", "rowkey")


def key_balance_stream(spark, sf_dir):
    rows = fixtures.pos_events(spark, sf_dir)
    return balance.key_balance(rows, keys.stream_salt(F.col("transaction_id")))


def key_balance_store(spark, sf_dir):
    return balance.key_balance(_clean(spark, sf_dir), keys.store_salt(F.col("store_id")))


def _collisions(add_key):
    def run(spark, sf_dir):
        return balance.key_collisions(add_key(_clean(spark, sf_dir)), "rowkey")

    return run


def _shared_keys(add_key):
    def run(spark, sf_dir):
        rows = fixtures.colliding(_clean(spark, sf_dir))
        return balance.key_collisions(add_key(rows), "rowkey")

    return run


def collision_summary(spark, sf_dir):
    rows = row_keys.with_key_store_date(_clean(spark, sf_dir))
    return balance.collision_summary(rows, "rowkey")


# --- history --------------------------------------------------------------------------


def history_load(spark, sf_dir):
    path = new_folder(spark, "history")
    keyed = row_keys.with_key_batch(_clean(spark, sf_dir))
    # Day folders would hold a dozen rows each at this size.
    loaded = history.load_history(keyed, path, grain="month")
    rows = spark.read.parquet(path).drop(history.MONTH)
    return rows.withColumn("rows_loaded", F.lit(loaded).cast("bigint"))


def history_from_csv(spark, sf_dir):
    csv, path = new_folder(spark, "history-csv"), new_folder(spark, "history")
    fixtures.raw_transactions(spark, sf_dir).write.option("header", True).csv(csv)
    loaded = history.process_history(
        spark,
        csv,
        path,
        schema=fixtures.EXACT_TRANSACTION,
        tie_break=highest_first(),
        partitions=16,
        grain="month",
    )
    rows = spark.read.parquet(path).drop(history.MONTH)
    return rows.withColumn("rows_loaded", F.lit(loaded).cast("bigint"))


def store_day(spark, sf_dir):
    path = new_folder(spark, "history")
    keyed = row_keys.with_key_batch(_clean(spark, sf_dir))
    history.load_history(keyed, path, grain="month")
    found = sales.store_day(spark.read.parquet(path), oracles.STORE, oracles.DAY)
    return found.drop(history.MONTH)


# --- sales ----------------------------------------------------------------------------


def daily_sales(spark, sf_dir):
    return sales.daily_sales(_clean(spark, sf_dir))


def daily_sales_double(spark, sf_dir):
    """On the default type of a CSV file's amounts, dealt out at random."""
    rows = _clean(spark, sf_dir).withColumn("total_amount", F.col("total_amount").cast("double"))
    return sales.daily_sales(rows.repartition(7))


def daily_sales_saved(spark, sf_dir):
    path = new_folder(spark, "daily-sales")
    history.save_daily_sales(_clean(spark, sf_dir), path, grain="month")
    return spark.read.parquet(path).drop(history.MONTH)


def daily_sales_refreshed(spark, sf_dir):
    """Sales until three in the afternoon are saved; then the rest of some months arrives."""
    path, rows = new_folder(spark, "daily-sales"), _clean(spark, sf_dir)
    # Read three times: by the save, for the months that changed, and by the refresh.
    rows = staged(rows.select(*DAILY_COLUMNS), "cleaned")
    late = F.col("transaction_hour") >= 15
    arrived = late & (F.month("transaction_date") % 3 == 0)
    history.save_daily_sales(rows.filter(~late), path, grain="month")
    history.refresh_daily_sales(rows.filter(~late | arrived), rows.filter(arrived), path, "month")
    return spark.read.parquet(path).drop(history.MONTH)


def leaderboard(spark, sf_dir):
    return sales.store_leaderboard(_clean(spark, sf_dir))


def leaderboard_text(spark, sf_dir):
    return sales.store_leaderboard(history.as_text(_clean(spark, sf_dir)))


def leaderboard_sql(spark, sf_dir):
    return sales.store_leaderboard_sql(history.as_text(_clean(spark, sf_dir)))


def leaderboard_top(spark, sf_dir):
    return sales.store_leaderboard(_clean(spark, sf_dir), limit=10)


def recent_by_store(spark, sf_dir):
    return sales.recent_by_store(_clean(spark, sf_dir), 5)


def recent_by_store_layout(spark, sf_dir):
    """From rows laid out by store and time, of which only the days in reach are read."""
    path = new_folder(spark, "by-store")
    by_store.save_by_store(_clean(spark, sf_dir), path)
    return by_store.newest_by_store(spark, path, 5)


def recent_of_store(spark, sf_dir):
    path = new_folder(spark, "by-store")
    by_store.save_by_store(_clean(spark, sf_dir), path)
    return by_store.newest_of_store(spark, path, oracles.STORE, 20)


# --- streams --------------------------------------------------------------------------


def _ingested(
    spark: SparkSession, sf_dir: str, compacting: str | None = None, ranked: list | None = None
) -> str:
    """Two epochs of events: everything, then corrections, then a new start with others. The exact
    ranking after each of the three batches is added to `ranked`."""
    path = new_folder(spark, "ingest")
    rows = fixtures.pos_events(spark, sf_dir)
    amount = F.col("total_amount")
    first = rows.unionByName(
        rows.filter(F.col("event_type") == "click").withColumn("total_amount", amount / 2)
    )
    corrected = rows.filter(F.col("user_id") % 3 == 0).withColumn("total_amount", amount * 2)
    second = rows.filter(F.col("event_type") == "view").withColumn("total_amount", amount + 1000)
    for epoch, sent in ((1, [first, corrected]), (2, [second])):
        wire = f"{path}/wire-{epoch}"
        for part in sent:
            send_events(part, "files", path=wire)
            stream = read_event_stream(spark, "files", path=wire)
            query = ingest.start_ingest(
                stream, path, f"{path}/checkpoint-{epoch}", epoch, ALL_AT_ONCE, zone="UTC",
                ranked=ranked is not None,
            )
            query.awaitTermination()
            if ranked is not None:
                now = ranking.exact_ranking(spark, path).withColumn("step", F.lit(len(ranked)))
                ranked.append(staged(now, "ranking"))
        if compacting:
            view.compact(spark, path, compacting)
    return path


def stream_view(spark, sf_dir):
    path = _ingested(spark, sf_dir)
    return view.current_view(spark, path).select("rowkey", *fixed.EVENT_FIELDS)


def stream_view_compacted(spark, sf_dir):
    path = _ingested(spark, sf_dir, "day")
    return view.current_view(spark, path).select("rowkey", *fixed.EVENT_FIELDS)


def stream_view_named(spark, sf_dir):
    """The base by its name in the catalog, after the last compaction."""
    path = _ingested(spark, sf_dir, "month")
    name = f"pos_{uuid.uuid4().hex}"
    tables.create_tables(spark, path, name)
    columns = ", ".join(f"`{c}`" for c in ("rowkey", *fixed.EVENT_FIELDS))
    return spark.sql(f"SELECT {columns} FROM {name}_base")


def stream_leaderboard(spark, sf_dir):
    path = _ingested(spark, sf_dir)
    return sales.store_leaderboard(view.serving_text(view.current_view(spark, path)))


def ranking_exact(spark, sf_dir):
    """The ranking after every batch of corrections, of which each goes on from the one before."""
    ranked: list[DataFrame] = []
    _ingested(spark, sf_dir, "month", ranked)
    return ranked[0].unionByName(ranked[1]).unionByName(ranked[2])


def _enriched(spark: SparkSession, sf_dir: str) -> str:
    """Events and, in a second batch, corrections of some of them."""
    path = new_folder(spark, "enriched")
    rows = fixtures.pos_events(spark, sf_dir)
    higher = rows.filter(F.col("user_id") % 3 == 0).withColumn("total_amount", F.col("total_amount") * 64)
    for part in (rows, higher):
        send_events(part, "files", path=f"{path}/wire")
        stream = read_event_stream(spark, "files", path=f"{path}/wire")
        enriched.start_enriched(
            stream, f"{path}/rows", f"{path}/checkpoint", ALL_AT_ONCE, zone="UTC"
        ).awaitTermination()
    return f"{path}/rows"


def stream_enriched(spark, sf_dir):
    return spark.read.parquet(_enriched(spark, sf_dir)).drop("event_time", "seq")


def stream_enriched_latest(spark, sf_dir):
    return enriched.latest_enriched(spark, _enriched(spark, sf_dir)).drop("event_time", "seq")


def stream_rejects(spark, sf_dir):
    path = new_folder(spark, "ingest")
    wire = fixtures.faulty_wire(spark, sf_dir).select("value")
    wire.write.text(f"{path}/wire")
    stream = read_event_stream(spark, "files", path=f"{path}/wire")
    ingest.start_ingest(
        stream, path, f"{path}/checkpoint", 1, ALL_AT_ONCE, zone="UTC"
    ).awaitTermination()
    rejects = ingest.read_log(spark, path, ingest.REJECTED)
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def ingest_metrics(spark, sf_dir):
    """Figures of every batch, one of them with rejects, from the journal alone: the rows are folded
    into the base before it is read."""
    path = _ingested(spark, sf_dir, "month")
    fixtures.faulty_wire(spark, sf_dir).select("value").write.text(f"{path}/wire-3")
    stream = read_event_stream(spark, "files", path=f"{path}/wire-3")
    ingest.start_ingest(
        stream, path, f"{path}/checkpoint-3", 3, ALL_AT_ONCE, zone="UTC"
    ).awaitTermination()
    return metrics.ingest_metrics(spark, path).drop("seconds", "rows_per_second")


def ingest_totals(spark, sf_dir):
    timed = metrics.ingest_totals(spark, _ingested(spark, sf_dir))
    return timed.drop("seconds", "rows_per_second")


def live_leaderboard(spark, sf_dir):
    path = new_folder(spark, "live")
    rows = fixtures.pos_events(spark, sf_dir)
    repeated = rows.unionByName(rows.filter(F.col("event_type") == "click"))
    # Eight files, one in a batch, so that late events come after the watermark has moved.
    send_events(repeated.repartition(8), "files", path=f"{path}/wire")
    stream = read_event_stream(spark, "files", path=f"{path}/wire", maxFilesPerTrigger="1")
    live.start_live_leaderboard(
        live.live_leaderboard(stream, zone="UTC"),
        f"{path}/ranking",
        f"{path}/checkpoint",
        1,
        ALL_AT_ONCE,
    ).awaitTermination()
    return live.newest_ranking(spark, f"{path}/ranking")


# --- contract -------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Daily sales over cleaned transactions."""
    return daily_sales(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = {
        "csv_scan": csv_scan,
        "sales_to_pos": sales_to_pos,
        "sales_to_pos_file_order": sales_to_pos_file_order,
        "send_sales": send_sales,
        "sales_to_pos_capped": sales_to_pos_capped,
        "send_sales_capped": send_sales_capped,
        "sales_csv_quoted": sales_csv_quoted,
        "sales_to_pos_with_bad_prices": sales_to_pos_with_bad_prices,
        "sales_rejects": sales_rejects,
        "event_encode": event_encode,
        "event_roundtrip": event_roundtrip,
        "event_decode": event_decode,
        "event_rejects": event_rejects,
        "valid_records": valid_records,
        "dedupe_latest": dedupe_latest,
        "standard_formats": standard_formats,
        "standard_formats_class": standard_formats_class,
        "review_flags": review_flags,
        "enrichment": enrichment,
        "clean_transactions": _clean,
        "key_stream": key_stream,
        "key_salted": _keyed(row_keys.with_key_salted),
        "key_store_date": _keyed(row_keys.with_key_store_date),
        "key_batch": _keyed(row_keys.with_key_batch),
        "key_balance_stream": key_balance_stream,
        "key_balance_store": key_balance_store,
        "key_collisions_salted": _shared_keys(row_keys.with_key_salted),
        "key_collisions_store_date": _collisions(row_keys.with_key_store_date),
        "key_collisions_batch": _shared_keys(row_keys.with_key_batch),
        "key_collision_summary": collision_summary,
        "history_load": history_load,
        "history_from_csv": history_from_csv,
        "store_day": store_day,
        "daily_sales": daily_sales,
        "daily_sales_double": daily_sales_double,
        "daily_sales_saved": daily_sales_saved,
        "daily_sales_refreshed": daily_sales_refreshed,
        "leaderboard": leaderboard,
        "leaderboard_text": leaderboard_text,
        "leaderboard_sql": leaderboard_sql,
        "leaderboard_top": leaderboard_top,
        "recent_by_store": recent_by_store,
        "recent_by_store_layout": recent_by_store_layout,
        "recent_of_store": recent_of_store,
        "stream_view": stream_view,
        "stream_view_compacted": stream_view_compacted,
        "stream_view_named": stream_view_named,
        "stream_leaderboard": stream_leaderboard,
        "stream_enriched": stream_enriched,
        "stream_enriched_latest": stream_enriched_latest,
        "stream_rejects": stream_rejects,
        "ingest_metrics": ingest_metrics,
        "ingest_totals": ingest_totals,
        "live_leaderboard": live_leaderboard,
        "live_ranking_exact": ranking_exact,
    }

    def compared(run):
        return lambda spark, sf_dir: comparable(run(spark, sf_dir))

    return {name: compared(run) for name, run in plain.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return oracles.sql() | _training_data()[1]


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, none where these are not installed."""
    try:
        import corpus_pipeline
        from tillroll.llm import queries as training
    except ImportError as missing:
        warnings.warn(f"no queries of training data: {missing}", stacklevel=2)
        return {}, {}
    found, sql = training.queries(), training.oracle_sql()
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql
