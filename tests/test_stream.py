"""Decode, ingest, current view, compaction, metrics and the live ranking."""

import json
import shutil
import statistics
import time

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators import events
from tillroll.plans import sales
from tillroll.sources.events import read_event_stream, send_events
from tillroll.streaming import enriched, ingest, journal, live, metrics, progress, ranking, view

ALL_AT_ONCE = {"availableNow": True}


def wire(number, store=1, time="2024-01-01 08:00:00", amount=1.0, **more):
    event = {"transaction_id": f"t{number}", "store_id": f"S{store}", "timestamp": time, "total_amount": amount, **more}
    return json.dumps({k: v for k, v in event.items() if v is not ...})


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")


def take_in(spark, source, table, checkpoint="ck", epoch=1, **options):
    stream = read_event_stream(spark, "files", path=str(source), **options)
    query = ingest.start_ingest(stream, str(table), str(table) + f"-{checkpoint}", epoch, ALL_AT_ONCE)
    query.awaitTermination()
    return query


def current(spark, table):
    rows = view.current_view(spark, str(table)).collect()
    return sorted((r["transaction_id"], r["store_id"], r["timestamp"], r["total_amount"]) for r in rows)


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (None, "malformed"),
        ("", "malformed"),
        ("{", "malformed"),
        ("{}", "malformed"),
        ("null", "malformed"),
        (wire(1, amount=...), "no_amount"),
        (wire(1, amount="1.0"), "no_amount"),
        (wire(1, amount=0), "amount_not_positive"),
        (wire(1, amount=-2.5), "amount_not_positive"),
        (wire(1, amount=float("nan")), "amount_not_positive"),
        (wire(1, amount=float("inf")), "amount_not_positive"),
        (wire(1, time=...), "bad_timestamp"),
        (wire(1, time="2024-01-01"), "bad_timestamp"),
        (wire(1, time="2024-02-30 08:00:00"), "bad_timestamp"),
        (wire(1, store_id=...), "no_store_id"),
        (wire(1, transaction_id=None), "no_transaction_id"),
        (wire(1), None),
        (wire(1, till=4), None),
        (wire(1, transaction_id=123), None),
    ],
)
@pytest.mark.parametrize("zone", [None, "Asia/Ho_Chi_Minh"])
def test_reject_reasons(spark, text, reason, zone):
    good, rejects = events.decode_events(spark.createDataFrame([(text,)], "value string"), zone)
    assert (good.count(), [tuple(r) for r in rejects.collect()]) == (
        (1, []) if reason is None else (0, [(text, reason)])
    )


def test_numbers_become_text_ids(spark):
    good, _ = events.decode_events(spark.createDataFrame([(wire(1, transaction_id=123),)], "value string"))
    assert good.first()["transaction_id"] == "123"


def test_bytes_decode_like_text(spark):
    rows = spark.createDataFrame([(wire(1).encode(),)], "value binary")
    assert events.decode_events(rows)[0].count() == 1


def test_nulls_are_written_to_the_wire(spark):
    row = spark.createDataFrame([(None, "s", None, None)], schemas.EVENT)
    assert json.loads(events.encode_events(row).first()["value"]) == {
        "transaction_id": None, "store_id": "s", "timestamp": None, "total_amount": None,
    }


def some_events(count=300):
    return [wire(i, store=i % 7, time=f"2024-01-01 08:00:{i % 60:02d}", amount=i % 11 + 0.5) for i in range(count)]


def test_one_file_and_many_files_agree_with_the_batch(spark, tmp_path):
    lines = some_events()
    put(tmp_path / "one", "a.txt", lines)
    for at in range(10):
        put(tmp_path / "many", f"{at}.txt", lines[at::10])
    take_in(spark, tmp_path / "one", tmp_path / "table-one")
    take_in(spark, tmp_path / "many", tmp_path / "table-many", maxFilesPerTrigger="1")
    parsed = [json.loads(line) for line in lines]
    want = sorted((e["transaction_id"], e["store_id"], e["timestamp"], e["total_amount"]) for e in parsed)
    assert current(spark, tmp_path / "table-one") == want
    assert current(spark, tmp_path / "table-many") == want
    assert journal.read_journal(spark, str(tmp_path / "table-many")).count() == 10


def test_last_write_wins_across_batches_and_epochs(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", [wire(1, amount=1.0), wire(2, amount=1.0), wire(3, amount=9.0), wire(3, amount=4.0)])
    take_in(spark, source, table)
    put(source, "b.txt", [wire(1, amount=0.5)])
    take_in(spark, source, table)
    time = "2024-01-01 08:00:00"
    # 3 was sent twice in one batch of a source without places: the greater content stays.
    assert current(spark, table) == [("t1", "S1", time, 0.5), ("t2", "S1", time, 1.0), ("t3", "S1", time, 9.0)]
    put(tmp_path / "again", "a.txt", [wire(2, amount=0.25)])
    take_in(spark, tmp_path / "again", table, checkpoint="ck2", epoch=2)
    assert current(spark, table)[1] == ("t2", "S1", time, 0.25)


def test_places_in_the_source_order_writes_of_one_batch(spark):
    def row(partition, offset, amount):
        return ("t", "s", "x", amount, None, "k", (partition, offset), 1, 0, "2024-01-01", 0)

    writes = spark.createDataFrame([row(0, 7, 1.0), row(0, 12, 2.0), row(0, 9, 3.0)], schemas.BASE)
    assert [r["total_amount"] for r in view.last_write(writes).collect()] == [2.0]


def test_a_new_time_makes_a_new_row(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [wire(1), wire(1, time="2024-01-01 08:00:01")])
    take_in(spark, tmp_path / "in", tmp_path / "table")
    assert len(current(spark, tmp_path / "table")) == 2


def test_rejects_do_not_cost_good_rows(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [wire(1), "broken", wire(2, amount=0), wire(3, time="soon"), wire(4)])
    take_in(spark, tmp_path / "in", tmp_path / "table")
    assert [r[0] for r in current(spark, tmp_path / "table")] == ["t1", "t4"]
    rejects = ingest.read_log(spark, str(tmp_path / "table"), ingest.REJECTED).collect()
    assert sorted((r["value"], r["reject_reason"]) for r in rejects) == sorted(
        [("broken", "malformed"), (wire(2, amount=0), "amount_not_positive"), (wire(3, time="soon"), "bad_timestamp")]
    )


def test_a_failing_sink_stops_the_query_and_loses_nothing(spark, tmp_path, monkeypatch):
    source, table = tmp_path / "in", tmp_path / "table"
    lines = some_events(40)
    put(source, "a.txt", lines[:20])
    take_in(spark, source, table)
    put(source, "b.txt", lines[20:])
    real = ingest._write_batch

    def fail(*args):
        raise RuntimeError("disk is full")

    monkeypatch.setattr(ingest, "_write_batch", fail)
    with pytest.raises(Exception, match="disk is full"):
        take_in(spark, source, table)
    assert len(current(spark, table)) == 20

    def fail_after_the_rows(batch, path, epoch, batch_id):
        batch.limit(3).write.mode("overwrite").partitionBy("status", "salt").parquet(
            f"{path}/log/epoch={epoch}/batch_id={batch_id}"
        )
        raise RuntimeError("lost the journal")

    monkeypatch.setattr(ingest, "_write_batch", fail_after_the_rows)
    with pytest.raises(Exception, match="lost the journal"):
        take_in(spark, source, table)
    # Rows of an unfinished batch stay out of sight.
    assert len(current(spark, table)) == 20
    monkeypatch.setattr(ingest, "_write_batch", real)
    take_in(spark, source, table)
    assert len(current(spark, table)) == 40
    assert ingest.read_log(spark, str(table)).count() == 40


def test_a_finished_batch_is_not_written_again(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(30))
    take_in(spark, source, table)
    before = current(spark, table)
    rows = ingest.log_rows(
        spark.read.text(str(source)).withColumn("seq", F.lit(None).cast(schemas.SEQ))
    )
    # What Spark does after a stop between the callback and its own commit.
    ingest.batch_writer(str(table), 1)(rows.limit(5), 0)
    assert current(spark, table) == before
    ingest.batch_writer(str(table), 1)(rows.limit(5), 1)
    assert current(spark, table) == before
    assert ingest.read_log(spark, str(table)).count() == 35


def test_an_empty_batch(spark, tmp_path):
    table = tmp_path / "table"
    ingest.create_table(spark, str(table))
    empty = ingest.log_rows(spark.createDataFrame([], "value string").withColumn("seq", F.lit(None).cast(schemas.SEQ)))
    ingest.batch_writer(str(table), 1)(empty, 0)
    assert current(spark, table) == []
    assert [tuple(r)[:2] for r in journal.read_journal(spark, str(table)).collect()] == [(0, 0)]
    assert metrics.ingest_metrics(spark, str(table)).first()["rows"] == 0


def test_a_new_table_is_empty(spark, tmp_path):
    ingest.create_table(spark, str(tmp_path / "table"))
    ingest.create_table(spark, str(tmp_path / "table"))
    assert current(spark, tmp_path / "table") == []
    assert metrics.ingest_metrics(spark, str(tmp_path / "table")).count() == 0


def test_compaction_keeps_the_view(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(50))
    take_in(spark, source, table)
    before = current(spark, table)
    assert view.compact(spark, str(table)) == 0
    assert current(spark, table) == before
    put(source, "b.txt", [wire(7, store=0, time="2024-01-01 08:00:07", amount=99.0), wire(500)])
    take_in(spark, source, table)
    after = current(spark, table)
    assert len(after) == 51 and ("t7", "S0", "2024-01-01 08:00:07", 99.0) in after
    assert view.compact(spark, str(table)) == 1
    assert view.compact(spark, str(table)) == 1  # nothing new
    assert current(spark, table) == after
    assert view.read_base(spark, str(table), view.read_parts(spark, str(table), 1)).count() == 51


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(number):
    return f"2024-01-{number % 28 + 1:02d} 08:00:00"


# All new keys in one broadcast, in one for each day and salt or two, and in none.
@pytest.mark.parametrize(("most", "joins"), [(64 << 20, 1), (1_500, 2), (0, 0)])
def test_the_view_does_not_depend_on_the_join(spark, tmp_path, monkeypatch, most, joins):
    monkeypatch.setattr(view, "_BROADCAST_BYTES", most)
    monkeypatch.setattr(view, "_BROADCASTS", 200)
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", [wire(i, store=i % 7, time=day(i % 2)) for i in range(200)])
    take_in(spark, source, table)
    assert view.compact(spark, str(table)) == 0
    put(source, "b.txt", [wire(i, store=i % 7, time=day(i % 2), amount=77.0) for i in range(150, 250)])
    take_in(spark, source, table)
    # Without the hint Spark would broadcast so few keys on its own.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = current(spark, table)
        text = plan_of(view.current_view(spark, str(table)))
        version = view.compact(spark, str(table))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 250 and sum(r[3] == 77.0 for r in rows) == 100
    assert current(spark, table) == rows and version == 1
    found = text.count("BroadcastHashJoin")
    assert found == joins if joins < 2 else found > 1
    for base_side in text.split("LeftAnti")[1:] if joins else []:
        assert "Exchange" not in base_side.split("BroadcastExchange")[0]


def test_beyond_some_groups_a_view_moves_the_rest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(view, "_BROADCAST_BYTES", 200)
    monkeypatch.setattr(view, "_BROADCASTS", 1)
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", [wire(i, time=day(i)) for i in range(60)])
    take_in(spark, source, table)
    view.compact(spark, str(table))
    put(source, "b.txt", [wire(i, time=day(i), amount=5.0) for i in range(30, 70)])
    take_in(spark, source, table)
    rows = current(spark, table)
    assert len(rows) == 70 and sum(r[3] == 5.0 for r in rows) == 40


def test_a_million_new_keys_do_not_move_the_base(spark, tmp_path):
    table = str(tmp_path / "table")
    ingest.create_table(spark, table)

    def batch(rows, amount):
        number = F.col("id").cast("string")
        at = F.date_format(F.timestamp_seconds(F.lit(1_704_100_000) + F.col("id") * 37 % 500_000), "yyyy-MM-dd HH:mm:ss")
        event = F.struct(
            F.concat(F.lit("t"), number).alias("transaction_id"),
            F.concat(F.lit("STORE_"), number % 100).alias("store_id"),
            at.alias("timestamp"),
            F.lit(amount).alias("total_amount"),
        )
        text = spark.range(rows, numPartitions=8).select(F.to_json(event).alias("value"))
        return ingest.log_rows(text.withColumn("seq", F.lit(None).cast(schemas.SEQ)))

    write = ingest.batch_writer(table, 1)
    write(batch(20_000, 1.0), 0)
    assert view.compact(spark, table) == 0
    write(batch(1_050_000, 2.0), 1)
    rows = view.current_view(spark, table)
    text = plan_of(rows)
    assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text
    for base_side in text.split("LeftAnti")[1:]:
        assert "Exchange" not in base_side.split("BroadcastExchange")[0]
    assert [tuple(r) for r in rows.groupBy("total_amount").count().collect()] == [(2.0, 1_050_000)]


def files_of(table):
    return {str(x.relative_to(table)) for x in (table / "base").rglob("*.parquet")}


@pytest.mark.parametrize("grain", ["day", "month"])
def test_compaction_leaves_untouched_files_alone(spark, tmp_path, grain):
    source, table = tmp_path / "in", tmp_path / "table"
    times = [f"2024-0{month}-0{d} 23:59:59" for month in (1, 2) for d in (1, 2)]
    put(source, "a.txt", [wire(i, time=times[i % 4]) for i in range(200)])
    take_in(spark, source, table)
    view.compact(spark, str(table), grain)
    first = files_of(table)
    put(source, "b.txt", [wire(2, time=times[2], amount=8.0), wire(900, time="2024-03-01 00:00:00")])
    take_in(spark, source, table)
    rows = current(spark, table)
    assert view.compact(spark, str(table), "day") == 1  # the grain stays as it is
    second = files_of(table)
    assert first < second
    periods = {"day": {"2024-02-01", "2024-03-01"}, "month": {"2024-02", "2024-03"}}[grain]
    assert {x.split("period=")[1].split("/")[0] for x in second - first} == periods
    assert len(second - first) == 2
    used = view.current_view(spark, str(table)).inputFiles()
    assert len(used) == len(first) + 1  # the one file that was replaced is out of use
    assert current(spark, table) == rows and len(rows) == 201


def test_a_key_stays_in_its_period_in_every_zone(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", [wire(1, time="2024-01-01 23:30:00")])
    take_in(spark, source, table)
    view.compact(spark, str(table))
    zone = spark.conf.get("spark.sql.session.timeZone")
    put(source, "b.txt", [wire(1, time="2024-01-02 06:30:00", amount=3.0)])
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        take_in(spark, source, table)
        assert [r["total_amount"] for r in view.current_view(spark, str(table)).collect()] == [3.0]
        view.compact(spark, str(table))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r["total_amount"] for r in view.current_view(spark, str(table)).collect()] == [3.0]


def test_a_compaction_that_broke_off_is_done_anew(spark, tmp_path, monkeypatch):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(40))
    take_in(spark, source, table)
    view.compact(spark, str(table))
    put(source, "b.txt", [wire(i, store=9) for i in range(20)])
    take_in(spark, source, table)
    before = current(spark, table)

    def fail(*args):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(journal, "fold", fail)
        with pytest.raises(RuntimeError):
            view.compact(spark, str(table))
    assert current(spark, table) == before
    assert view.compact(spark, str(table)) == 1
    assert current(spark, table) == before


def test_an_earlier_epoch_is_refused(spark, tmp_path):
    put(tmp_path / "in", "a.txt", some_events(5))
    take_in(spark, tmp_path / "in", tmp_path / "table", epoch=2)
    with pytest.raises(Exception, match="in epoch 2 already"):
        take_in(spark, tmp_path / "in", tmp_path / "table", checkpoint="ck2", epoch=1)


def test_a_base_without_a_manifest_is_ignored(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(20))
    take_in(spark, source, table)
    before = current(spark, table)
    junk = spark.createDataFrame([("x", "s", "t", 1.0, None, "k", None, 9, 9, "2024-01-01", 0)], schemas.BASE)
    junk.write.partitionBy("period", "salt").parquet(str(table / "base" / "version=0"))
    assert current(spark, table) == before
    assert view.compact(spark, str(table)) == 0
    assert current(spark, table) == before


def test_serving_text_feeds_the_ranking(spark, tmp_path):
    put(tmp_path / "in", "a.txt", some_events(100))
    take_in(spark, tmp_path / "in", tmp_path / "table")
    rows = view.current_view(spark, str(tmp_path / "table"))
    texts = view.serving_text(rows)
    assert texts.columns == ["rowkey", "store_id", "timestamp", "total_amount"]
    assert {f.dataType.simpleString() for f in texts.schema} == {"string"}
    by_text = sales.store_leaderboard_sql(texts).collect()
    assert by_text == sales.store_leaderboard(rows).collect()


def test_salt_folders(spark, tmp_path):
    put(tmp_path / "in", "a.txt", some_events(200))
    take_in(spark, tmp_path / "in", tmp_path / "table")
    log = ingest.read_log(spark, str(tmp_path / "table"))
    assert {r[0] for r in log.select("salt").distinct().collect()} <= set(range(12))
    split = log.select(F.substring_index("rowkey", "_", 1).cast("int").alias("in_key"), "salt")
    assert split.filter("in_key <> salt").count() == 0
    plan = log.filter("salt = 3")._jdf.queryExecution().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "salt#" in filters and "status#" in filters


def test_only_finished_batches_are_read(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    for at in range(4):
        put(source, f"{at}.txt", [*some_events(60)[at::4], "broken"])
    take_in(spark, source, table, maxFilesPerTrigger="1")
    # A batch that was begun and never finished, with and without a folder in the journal.
    for number in (8, 9):
        ingest.read_log(spark, str(table)).limit(5).drop("epoch", "batch_id").write.partitionBy(
            "status", "salt"
        ).parquet(str(table / "log" / "epoch=1" / f"batch_id={number}"))
    (table / "journal" / "epoch=1" / "batch_id=9" / "_temporary").mkdir(parents=True)

    def counts(state=None):
        kinds = (ingest.OK, ingest.REJECTED)
        return [ingest.read_log(spark, str(table), kind, state).count() for kind in kinds]

    assert counts() == [60, 4]
    view.compact(spark, str(table))
    state = journal.read_state(spark, str(table))
    assert (state.version, dict(state.covered), state.tail) == (0, {1: 3}, ())
    put(tmp_path / "more", "a.txt", some_events(80)[60:])
    take_in(spark, tmp_path / "more", table, checkpoint="ck2", epoch=2)
    assert journal.read_state(spark, str(table)).tail == ((2, 0),)
    assert counts() == [80, 4]
    # Covered batches may go; what is left is read.
    for number in (0, 1, 2, 3):
        shutil.rmtree(table / "log" / "epoch=1" / f"batch_id={number}")
    assert counts() == [20, 0] and len(current(spark, table)) == 80


def test_figures_outlive_the_rows(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    wanted = None
    for number in range(5):
        put(source, f"{number}.txt", [*some_events(50)[number::5], "broken"])
        take_in(spark, source, table)
        if number in (1, 3):
            view.compact(spark, str(table))
        wanted = metrics.ingest_metrics(spark, str(table)).collect()
        assert [r["batch_id"] for r in wanted] == list(range(number + 1))
    there = {x.name for x in (table / "journal" / "epoch=1").iterdir()}
    assert there == {"batch_id=4"}
    for number in range(4):
        shutil.rmtree(table / "log" / "epoch=1" / f"batch_id={number}")
    assert metrics.ingest_metrics(spark, str(table)).collect() == wanted
    total = metrics.ingest_totals(spark, str(table)).first()
    assert (total["batches"], total["rows"], total["rejected"]) == (5, 50, 5)


def test_the_age_of_a_table_does_not_slow_its_view(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.txt", some_events(50))

    def seconds(table):
        started = time.perf_counter()
        assert len(current(spark, table)) == 51
        return time.perf_counter() - started

    for covered in (1, 6_000):
        table = tmp_path / f"table-{covered}"
        take_in(spark, source, table)
        entry, rows = (table / kind / "epoch=1" / "batch_id=0" for kind in ("journal", "log"))
        for number in range(1, covered):
            shutil.copytree(entry, entry.parent / f"batch_id={number}")
            (rows.parent / f"batch_id={number}").mkdir()
        state = journal.State(None, {}, tuple((1, n) for n in range(covered)))
        if covered > 1:
            monkey = pytest.MonkeyPatch()
            monkey.setattr(journal, "read_state", lambda *_: state)
            monkey.setattr(view, "read_batches", lambda s, p, b, *_: ingest.read_batches(s, p, list(b)[:1]))
        assert view.compact(spark, str(table)) == 0
        if covered > 1:
            monkey.undo()
        put(tmp_path / "more", "a.txt", [wire(700)])
        take_in(spark, tmp_path / "more", table, checkpoint=f"more-{covered}", epoch=2)
        assert journal.read_state(spark, str(table)).covered == {1: covered - 1}
    took = {covered: [] for covered in (1, 6_000)}
    for _ in range(6):
        for covered, times in took.items():
            times.append(seconds(tmp_path / f"table-{covered}"))
    young, old = (statistics.median(times[1:]) for times in took.values())
    assert old < 1.5 * young, took


def test_a_compaction_while_the_state_is_read(spark, tmp_path, monkeypatch):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(20))
    take_in(spark, source, table)
    real, done = journal._entries, []

    def late(spark_, path, folders):
        if folders and not done:
            done.append(1)
            view.compact(spark, str(table))
        return real(spark_, path, folders)

    monkeypatch.setattr(journal, "_entries", late)
    state = journal.read_state(spark, str(table))
    assert (state.version, state.tail) == (0, ()) and len(current(spark, table)) == 20


def test_figures_of_a_batch(spark, tmp_path):
    put(tmp_path / "in", "a.txt", ["broken"])
    take_in(spark, tmp_path / "in", tmp_path / "table")
    row = metrics.ingest_metrics(spark, str(tmp_path / "table")).first()
    assert (row["rows"], row["rejected"], row["stores"]) == (0, 1, 0)
    assert (row["amount"], row["first_event"], row["last_event"]) == (None, None, None)


def ranked_in(spark, source, table, checkpoint="ck", epoch=1, **options):
    stream = read_event_stream(spark, "files", path=str(source), **options)
    ingest.start_ingest(
        stream, str(table), str(table) + f"-{checkpoint}", epoch, ALL_AT_ONCE, ranked=True
    ).awaitTermination()


def test_the_exact_ranking_follows_corrections(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"

    def check():
        want = sales.store_leaderboard(view.current_view(spark, str(table))).collect()
        assert [tuple(r) for r in ranking.exact_ranking(spark, str(table)).collect()] == [tuple(r) for r in want]
        assert len(list((table / "ranking").rglob("batch_id=*"))) <= 2
        return want

    put(source, "a.txt", [wire(i, store=i % 5, time=day(i), amount=i + 1) for i in range(100)])
    take_in(spark, source, table)  # not ranked: the ranking starts with the next batch
    with pytest.raises(ValueError):
        ranking.exact_ranking(spark, str(table))
    # Lower and higher amounts, twice in one batch, repeats, new rows, rejects.
    put(source, "b.txt", [wire(i, store=i % 5, time=day(i), amount=a) for i in range(40) for a in (0.5, 2.0)] + ["broken"])
    ranked_in(spark, source, table)
    check()
    view.compact(spark, str(table))
    check()
    put(source, "c.txt", [wire(i, store=i % 5, time=day(i), amount=9.25) for i in range(30, 120)])
    put(source, "d.txt", [wire(31, store=1, time=day(31), amount=1.0), wire(500, store=77)])
    ranked_in(spark, source, table, maxFilesPerTrigger="1")
    assert check()[-1]["store_id"] == "S77"
    put(source, "e.txt", ["broken only"])
    ranked_in(spark, source, table)
    check()
    put(tmp_path / "again", "a.txt", [wire(31, store=1, time=day(31), amount=4.0)])
    ranked_in(spark, tmp_path / "again", table, checkpoint="ck2", epoch=2)
    assert sum(r["so_giao_dich"] for r in check()) == 121
    # An amount can be moved back and forth; the ranking is not summed up from rounded parts.
    for number in range(3):
        put(tmp_path / "again", f"b{number}.txt", [wire(31, store=1, time=day(31), amount=0.1 * (number + 1))])
        ranked_in(spark, tmp_path / "again", table, checkpoint="ck2", epoch=2)
        check()


def test_a_retried_batch_is_ranked_once(spark, tmp_path, monkeypatch):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", some_events(30))
    ranked_in(spark, source, table)
    put(source, "b.txt", [wire(i, store=i % 7, time=f"2024-01-01 08:00:{i:02d}", amount=50.0) for i in range(20)])

    def fail(*args):
        raise RuntimeError("lost the journal")

    with monkeypatch.context() as broken:
        broken.setattr(journal, "write_entry", fail)
        with pytest.raises(Exception, match="lost the journal"):
            ranked_in(spark, source, table)
    before = ranking.exact_ranking(spark, str(table)).collect()
    assert before == sales.store_leaderboard(view.current_view(spark, str(table))).collect()
    ranked_in(spark, source, table)
    after = ranking.exact_ranking(spark, str(table)).collect()
    assert [tuple(r) for r in after] == [tuple(r) for r in sales.store_leaderboard(view.current_view(spark, str(table))).collect()]
    assert after != before


def test_an_empty_table_has_an_empty_ranking(spark, tmp_path):
    ingest.create_table(spark, str(tmp_path / "table"))
    assert ranking.exact_ranking(spark, str(tmp_path / "table")).collect() == []


def test_metrics(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    put(source, "a.txt", [wire(1, store=1, amount=1.25), wire(2, store=2, amount=2.5, time="2024-01-02 08:00:00"), "broken"])
    take_in(spark, source, table)
    put(source, "b.txt", [wire(3, amount=4.0)])
    take_in(spark, source, table)
    rows = metrics.ingest_metrics(spark, str(table)).collect()
    assert [(r["epoch"], r["batch_id"], r["rows"], r["rejected"], r["stores"], float(r["amount"])) for r in rows] == [
        (1, 0, 2, 1, 2, 3.75),
        (1, 1, 1, 0, 1, 4.0),
    ]
    assert [str(rows[0]["first_event"]), str(rows[0]["last_event"])] == ["2024-01-01 08:00:00", "2024-01-02 08:00:00"]
    assert all(r["seconds"] > 0 and r["rows_per_second"] > 0 for r in rows)
    total = metrics.ingest_totals(spark, str(table)).first()
    assert (total["batches"], total["rows"], total["rejected"]) == (2, 3, 1)


def test_trigger_and_await(spark, tmp_path):
    put(tmp_path / "in", "a.txt", some_events(5))
    stream = read_event_stream(spark, "files", path=str(tmp_path / "in"))
    query = ingest.start_ingest(
        stream, str(tmp_path / "table"), str(tmp_path / "ck"), 1, {"processingTime": "1 second"}
    )
    try:
        query.processAllAvailable()
        assert query.awaitTermination(0.1) is False
    finally:
        query.stop()
    assert len(current(spark, tmp_path / "table")) == 5


@pytest.mark.parametrize("spread", [1, 8])
def test_live_ranking_counts_repeats_once(spark, tmp_path, spread):
    source = tmp_path / "in"
    lines = some_events(120)
    put(source, "a.txt", lines[:80])
    put(source, "b.txt", lines[40:])
    put(source, "c.txt", [lines[5]] * 50 + ["broken"])
    ranking = live.live_leaderboard(
        read_event_stream(spark, "files", path=str(source), maxFilesPerTrigger="1"), spread=spread
    )
    live.start_live_leaderboard(
        ranking, str(tmp_path / "ranking"), str(tmp_path / "ck"), 1, ALL_AT_ONCE
    ).awaitTermination()
    take_in(spark, source, tmp_path / "table")
    want = sales.store_leaderboard(view.current_view(spark, str(tmp_path / "table"))).collect()
    assert live.newest_ranking(spark, str(tmp_path / "ranking")).collect() == want
    refreshes = spark.read.parquet(str(tmp_path / "ranking")).select("refresh").distinct().count()
    assert refreshes >= 3


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def state_settings(checkpoint):
    newest = max((checkpoint / "offsets").glob("[0-9]*"), key=lambda x: int(x.name))
    return json.loads(newest.read_text().splitlines()[1])["conf"]


def test_live_state_is_on_disk(spark, tmp_path):
    """State of another store, named by the session or by its checkpoint, goes on where it is."""
    lines, before = some_events(60), spark.conf.get(PROVIDER)
    given = {k: v for k, v in spark.conf.getAll.items() if "stateStore" in k}

    def life(name, number, part):
        put(tmp_path / f"in-{name}", f"{number}.txt", part)
        stream = read_event_stream(spark, "files", path=str(tmp_path / f"in-{name}"))
        live.start_live_leaderboard(
            live.live_leaderboard(stream), str(tmp_path / name), str(tmp_path / f"ck-{name}"), 1, ALL_AT_ONCE
        ).awaitTermination()
        rows = live.newest_ranking(spark, str(tmp_path / name)).collect()
        return rows, state_settings(tmp_path / f"ck-{name}")[PROVIDER]

    first, disk = life("disk", 0, lines[:40])
    assert disk.endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(PROVIDER) == before
    assert {k: v for k, v in spark.conf.getAll.items() if "stateStore" in k} == given
    spark.conf.set(PROVIDER, ON_HEAP)
    try:
        assert life("heap", 0, lines[:40]) == (first, ON_HEAP)
    finally:
        spark.conf.unset(PROVIDER)
    assert life("heap", 1, lines[20:])[1] == ON_HEAP
    assert life("disk", 1, lines[20:])[1] == disk
    take_in(spark, tmp_path / "in-disk", tmp_path / "table")
    want = sales.store_leaderboard(view.current_view(spark, str(tmp_path / "table"))).collect()
    for name in ("disk", "heap"):
        assert live.newest_ranking(spark, str(tmp_path / name)).collect() == want


def test_a_new_checkpoint_gives_the_new_ranking(spark, tmp_path):
    path, lines = str(tmp_path / "ranking"), some_events(60)
    # The first life has more refreshes, so its highest number is the higher one.
    for epoch, files in ((1, [lines[:20], lines[20:40], lines[40:]]), (2, [lines[:10]])):
        source = tmp_path / f"in{epoch}"
        for number, part in enumerate(files):
            put(source, f"{number}.txt", part)
        stream = read_event_stream(spark, "files", path=str(source), maxFilesPerTrigger="1")
        live.start_live_leaderboard(
            live.live_leaderboard(stream), path, str(tmp_path / f"ck{epoch}"), epoch, ALL_AT_ONCE
        ).awaitTermination()
    take_in(spark, tmp_path / "in2", tmp_path / "table")
    want = sales.store_leaderboard(view.current_view(spark, str(tmp_path / "table"))).collect()
    newest = live.newest_ranking(spark, path)
    assert newest.collect() == want
    assert {x.rpartition("/")[0].split("/")[-2] for x in newest.inputFiles()} == {"epoch=2"}
    # A refresh that was begun only does not hide the last finished one.
    (tmp_path / "ranking" / "epoch=3" / "refresh=0" / "_temporary").mkdir(parents=True)
    assert live.newest_ranking(spark, path).collect() == want
    with pytest.raises(ValueError):
        live.newest_ranking(spark, str(tmp_path / "none"))


def test_sources_that_do_not_exist(spark, tmp_path):
    with pytest.raises(ValueError):
        read_event_stream(spark, "pigeons")
    with pytest.raises(ValueError):
        read_event_stream(spark, "files", starting="latest", path=str(tmp_path))
    with pytest.raises(ValueError):
        send_events(spark.createDataFrame([], schemas.EVENT), "pigeons")


def test_cleaning_on_the_stream_equals_that_of_a_batch(spark, tmp_path):
    source = tmp_path / "in"
    lines = [
        wire(1, amount=49.995), wire(2, amount=5000.01), wire(3, amount=999999.99), wire(4, amount=1_000_000),
        wire(5, time="2024-01-06 23:59:59"), wire(6, store_id="store-1 !"), "broken", wire(1, amount=2.0),
    ]
    put(source, "a.txt", lines)
    table = str(tmp_path / "rows")
    zone = spark.conf.get("spark.sql.session.timeZone")

    def run():
        stream = read_event_stream(spark, "files", path=str(source))
        enriched.start_enriched(stream, table, str(tmp_path / "ck"), ALL_AT_ONCE, zone="UTC").awaitTermination()
        return {r["transaction_id"]: r for r in spark.read.parquet(table).collect()}

    rows = run()
    assert set(rows) == {"t1", "t2", "t3", "t5", "t6"} and spark.read.parquet(table).count() == 6
    assert "payment_method" not in spark.read.parquet(table).columns
    assert [rows[x]["validation_status"] for x in ("t2", "t3", "t5")] == ["REVIEW", "REVIEW", "VALID"]
    assert (rows["t5"]["transaction_hour"], rows["t5"]["is_weekend"], rows["t6"]["store_id"]) == (23, True, "STORE-1 !")
    assert rows["t1"]["amount_category"] in ("SMALL", "MEDIUM")
    put(source, "b.txt", [wire(1, time="2024-01-01 08:00:01", amount=300.0), wire(7, time="2024-01-01 23:30:00")])
    try:
        # Event text counts as it is written, whatever the zone of the session.
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        rows = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (rows["t7"]["transaction_hour"], str(rows["t7"]["transaction_date"])) == (23, "2024-01-01")
    latest = {r["transaction_id"]: r for r in enriched.latest_enriched(spark, table).collect()}
    assert len(latest) == 6 and latest["t1"]["total_amount"] == 300.0 and latest["t1"]["amount_category"] == "LARGE"
    batch, _ = events.decode_events(spark.createDataFrame([(x,) for x in lines], "value string"), "UTC")
    wanted = enriched.clean_events(spark.createDataFrame([(x,) for x in lines], "value string"), "UTC")
    assert wanted.count() == batch.count() - 1
    text = plan_of(wanted)
    assert "Exchange" not in text and "Python" not in text


def test_progress_of_a_stream(spark, tmp_path):
    lines, told = some_events(300), []
    for at in range(3):
        put(tmp_path / "in", f"{at}.txt", lines[at::3])
    listener = progress.BatchProgress(told.append, every=150)
    with progress.listening(spark, listener):
        take_in(spark, tmp_path / "in", tmp_path / "table", maxFilesPerTrigger="1")
        assert listener.ended.wait(10)
    assert [x.split(":")[0] for x in told if x.startswith("batch")] == ["batch 0", "batch 1", "batch 2"]
    assert [x for x in told if "taken in" in x] == ["150 rows taken in", "300 rows taken in"]
    assert "stopped after 300 rows" in told


def test_progress_of_a_batch_job(spark):
    told = []
    with progress.watching(spark, "load", told.append, seconds=0.05):
        slow = F.sha2(F.repeat(F.col("id").cast("string"), 20_000), 512)
        spark.range(40_000, numPartitions=40).select(slow.alias("x")).write.format("noop").mode("overwrite").save()
    assert told and all(x.startswith("load: ") and " of " in x for x in told)
