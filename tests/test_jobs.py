"""The submitted jobs, end to end over files."""

from tillroll.__main__ import main
from tests.test_mapping import write_sales


def test_send_ingest_rank_report_compact(spark, tmp_path, capsys):
    sales, wire, table = tmp_path / "sales", tmp_path / "wire", tmp_path / "table"
    sales.mkdir()
    write_sales(sales, files=2, rows_per_file=150)
    main(["send", str(sales), "--limit", "250", "--kind", "files", "--option", f"path={wire}"])
    assert "sent 250 rows" in capsys.readouterr().out
    stream = ["--kind", "files", "--option", f"path={wire}", "--once"]
    main(["ingest", str(table), "--epoch", "1", "--checkpoint", str(tmp_path / "ck"), "--ranked", *stream])
    printed = capsys.readouterr().out
    assert "batch 0: 250 rows" in printed
    main(["leaderboard", str(table), "--rows", "3", "--exact"])
    exact = capsys.readouterr().out
    main(["leaderboard", str(table), "--rows", "3"])
    whole = capsys.readouterr().out
    assert [x.replace(" ", "").split(".")[0] for x in exact.splitlines()[3:6]] == [
        x.replace(" ", "").split(".")[0] for x in whole.splitlines()[3:6]
    ]
    first = [line for line in whole.splitlines() if "STORE_" in line][0]
    # 250 articles over 100 stores: the first fifty stores have three each.
    assert first.split("|")[1:3] == ["STORE_001", "3           "]
    main(["compact", str(table)])
    assert "version 0" in capsys.readouterr().out
    main(["report", str(table)])
    assert "250" in capsys.readouterr().out
    text = "SELECT store_id, count(*) AS sales FROM transactions GROUP BY store_id ORDER BY store_id"
    main(["sql", str(table), text, "--rows", "3"])
    printed = capsys.readouterr().out
    assert "STORE_001" in printed and "only the first 3 rows" in printed
    main(["sql", str(table), text, "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
    live = ["follow", str(tmp_path / "live"), "--epoch", "1", "--checkpoint", str(tmp_path / "ck2")]
    main([*live, *stream])
    assert any((tmp_path / "live").iterdir())
    main(["enrich", str(tmp_path / "rows"), "--checkpoint", str(tmp_path / "ck3"), "--zone", "UTC", *stream])
    assert spark.read.parquet(str(tmp_path / "rows")).filter("validation_status = 'VALID'").count() > 0
    main(["recent", str(table), "--latest", "1", "--rows", "200"])
    assert capsys.readouterr().out.count("|STORE_") == 100


def test_daily(spark, tmp_path, capsys):
    def put(name, *rows):
        (tmp_path / "csv").mkdir(exist_ok=True)
        (tmp_path / "csv" / name).write_text(
            "transaction_id,store_id,timestamp,total_amount,payment_method\n" + "".join(r + "\n" for r in rows)
        )

    put("a.csv", "a,s1,2020-09-19 08:00:00,1,cash", "b,s1,2020-10-19 08:00:00,2,cash")
    table = tmp_path / "daily"
    main(["daily", str(tmp_path / "csv"), str(table), "--grain", "month"])
    files = {x.name for x in table.rglob("*.parquet")}
    put("b.csv", "c,s1,2020-10-19 09:00:00,4,card")
    changed = str(tmp_path / "csv" / "b.csv")
    main(["daily", str(tmp_path / "csv"), str(table), "--grain", "month", "--changed", changed])
    assert "1 store-days written" in capsys.readouterr().out
    assert len({x.name for x in table.rglob("*.parquet")} & files) == 1  # September is as it was
    rows = spark.read.parquet(str(table)).orderBy("transaction_date").collect()
    assert [(r["transaction_count"], r["total_revenue"]) for r in rows] == [(1, 1.0), (2, 6.0)]


def test_load(spark, tmp_path, capsys):
    csv = tmp_path / "t.csv"
    csv.write_text(
        "transaction_id,store_id,timestamp,total_amount,payment_method,customer_id\n"
        "a,s1,2020-09-19 08:00:00,10.005,cash,c\n"
        "a,s1,2020-09-20 08:00:00,20,wallet,c\n"
        "b,s2,2020-09-20 09:00:00,-1,cash,c\n"
    )
    main(["load", str(csv), str(tmp_path / "history")])
    assert "loaded 1 rows" in capsys.readouterr().out
    row = spark.read.parquet(str(tmp_path / "history")).first()
    assert (row["rowkey"], row["payment"]) == ("S1_2020-09-20 08:00:00_a", "MOBILE")
