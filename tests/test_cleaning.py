"""Cleaning stages on small tables, one row per branch."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tillroll import fixed
from tillroll.operators.ranking import deduplicate_latest, top_per_key
from tillroll.operators.standardize import enrich, standardize_formats, validate_business_rules
from tillroll.operators.validity import remove_invalid_records
from tillroll.plans.cleaning import clean_transactions

RAW = "transaction_id string, store_id string, timestamp timestamp, total_amount double, payment_method string"
NOON = datetime.datetime(2020, 9, 19, 12)


def table(spark, rows, schema=RAW):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    ("amount", "kept"),
    [
        (None, False),
        (-1.0, False),
        (0.0, False),
        (0.01, True),
        (999_999.99, True),
        (1_000_000.0, False),
        (float("nan"), False),
        (float("inf"), False),
    ],
)
def test_amount_limits(spark, amount, kept):
    rows = table(spark, [("t", "s", NOON, amount, "cash")])
    assert remove_invalid_records(rows).count() == kept


def test_required_fields(spark):
    rows = table(
        spark,
        [
            (None, "s", NOON, 1.0, "cash"),
            ("t", None, NOON, 1.0, "cash"),
            ("t", "s", None, 1.0, "cash"),
            ("t", "s", NOON, 1.0, None),
        ],
    )
    assert remove_invalid_records(rows).count() == 1


@pytest.mark.parametrize(
    ("spelling", "expected"),
    [(s, name) for name, spellings in fixed.PAYMENT_SPELLINGS.items() for s in spellings]
    + [(s, "OTHER") for s in ("Cash", "CREDIT", "", " cash", None)],
)
def test_payment_spellings(spark, spelling, expected):
    rows = standardize_formats(table(spark, [("t", "s", NOON, 1.0, spelling)]))
    assert rows.first()["payment_method"] == expected


@pytest.mark.parametrize(
    ("code", "literal", "stripped"),
    [
        ("store-001 !", "STORE-001 !", "STORE001"),
        ("a-z0-9_12", "12", "AZ09_12"),
        ("x^a-z0-9_", "X^A-Z0-9_", "XAZ09_"),
        (None, None, None),
    ],
)
def test_store_patterns(spark, code, literal, stripped):
    rows = table(spark, [("t", code, NOON, 1.0, "cash")])
    assert standardize_formats(rows).first()["store_id"] == literal
    by_class = standardize_formats(rows, fixed.STORE_PATTERN_CLASS)
    assert by_class.first()["store_id"] == stripped


def test_amounts_round_half_up(spark):
    rows = table(spark, [("t", "s", NOON, a, "cash") for a in (2.675, 2.665, 0.004)])
    got = [r["total_amount"] for r in standardize_formats(rows).collect()]
    assert got == [2.68, 2.67, 0.0]


@pytest.mark.parametrize(
    ("amount", "payment", "store", "suspicious"),
    [
        (5000.0, "CASH", "S", False),
        (5000.01, "CASH", "S", True),
        (1.0, "OTHER", "S", True),
        (1.0, "CASH", None, True),
        (None, "CASH", "S", None),
    ],
)
def test_review_flags(spark, amount, payment, store, suspicious):
    row = validate_business_rules(table(spark, [("t", store, NOON, amount, payment)])).first()
    assert row["is_suspicious"] is suspicious
    assert row["validation_status"] == ("REVIEW" if suspicious else "VALID")


@pytest.mark.parametrize(
    ("amount", "expected"),
    [
        (49.99, "SMALL"),
        (50.0, "MEDIUM"),
        (199.99, "MEDIUM"),
        (200.0, "LARGE"),
        (999.99, "LARGE"),
        (1000.0, "XLARGE"),
        (None, "XLARGE"),
    ],
)
def test_amount_classes(spark, amount, expected):
    assert enrich(table(spark, [("t", "s", NOON, amount, "x")])).first()["amount_category"] == expected


def test_amount_class_sees_the_rounded_amount(spark):
    rows = table(spark, [("a", "s", NOON, 49.995, "cash"), ("b", "s", NOON, 199.995, "cash")])
    got = {r["transaction_id"]: r["amount_category"] for r in clean_transactions(rows).collect()}
    assert got == {"a": "MEDIUM", "b": "LARGE"}


def test_calendar(spark):
    rows = enrich(
        table(
            spark,
            [
                ("sat", "s", datetime.datetime(2020, 9, 19, 23, 59, 59), 1.0, "x"),
                ("sun", "s", datetime.datetime(2020, 9, 20), 1.0, "x"),
                ("mon", "s", datetime.datetime(2020, 9, 21, 8), 1.0, "x"),
                ("none", "s", None, 1.0, "x"),
            ],
        )
    )
    got = {
        r["transaction_id"]: (r["transaction_hour"], r["transaction_day"], r["is_weekend"])
        for r in rows.collect()
    }
    assert got == {
        "sat": (23, 7, True),
        "sun": (0, 1, True),
        "mon": (8, 2, False),
        "none": (None, None, False),
    }


def test_an_invalid_newest_row_does_not_hide_an_older_valid_one(spark):
    later = NOON + datetime.timedelta(hours=1)
    rows = table(spark, [("t", "s", NOON, 5.0, "cash"), ("t", "s", later, 0.0, "cash")])
    assert [r["total_amount"] for r in clean_transactions(rows).collect()] == [5.0]


def test_the_upper_limit_applies_before_rounding(spark):
    rows = table(spark, [("t", "s", NOON, 999_999.999, "cash")])
    assert [r["total_amount"] for r in clean_transactions(rows).collect()] == [1_000_000.0]


def test_latest_wins_and_ties_do_not_depend_on_partitions(spark):
    rng = random.Random(7)
    rows = [
        (f"t{rng.randrange(40)}", f"s{rng.randrange(3)}", NOON + datetime.timedelta(hours=rng.randrange(3)), float(rng.randrange(4)), "p")
        for _ in range(600)
    ]
    want = {}
    for row in rows:
        best = want.get(row[0])
        # latest time; then, ascending, store and amount
        rank = (-row[2].timestamp(), row[1], row[3])
        if best is None or rank < best[0]:
            want[row[0]] = (rank, row)
    expected = sorted(row for _, row in want.values())
    for parts in (1, 5, 13):
        kept = deduplicate_latest(table(spark, rows).repartition(parts))
        assert sorted(map(tuple, kept.collect())) == expected
        assert sorted(map(tuple, deduplicate_latest(kept).collect())) == expected


def test_null_times_lose(spark):
    rows = table(spark, [("t", "s", None, 9.0, "p"), ("t", "s", NOON, 1.0, "p")])
    assert [r["total_amount"] for r in deduplicate_latest(rows).collect()] == [1.0]


def test_caller_tie_break_comes_first(spark):
    rows = table(spark, [("t", "a", NOON, 1.0, "p"), ("t", "b", NOON, 9.0, "p")])
    kept = deduplicate_latest(rows, tie_break=[F.col("total_amount").desc()])
    assert [r["store_id"] for r in kept.collect()] == ["b"]


def test_top_beyond_the_group_limit_is_exact(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        (F.col("id") * 7919 % 20_011).alias("value"),
    )
    wide = top_per_key(rows, ["key"], [F.col("value").desc()], 1_500)
    data = {}
    for row in rows.collect():
        data.setdefault(row["key"], []).append(row["value"])
    want = sorted((k, v) for k, vs in data.items() for v in sorted(vs, reverse=True)[:1_500])
    assert sorted((r["key"], r["value"]) for r in wide.collect()) == want
    # Copies of one row are cut down as well, and exactly n remain.
    copies = spark.range(5_000).select(F.lit("k").alias("key"), F.lit(1).alias("value"))
    assert top_per_key(copies, ["key"], [F.col("value")], 1_200).count() == 1_200


def test_top_needs_a_positive_count(spark):
    with pytest.raises(ValueError):
        top_per_key(spark.range(1), ["id"], [F.col("id")], 0)


def test_decimal_amounts_stay_exact(spark):
    schema = RAW.replace("double", "decimal(20,4)")
    rows = table(spark, [("t", "s", NOON, decimal.Decimal("2.6750"), "cash")], schema)
    assert clean_transactions(rows).first()["total_amount"] == decimal.Decimal("2.68")
