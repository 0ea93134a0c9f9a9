"""Sales rows to point-of-sale events."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import fixed
from tillroll.functions.keys import joined, padded
from tillroll.operators.dense_index import INDEX, dense_index

REASON = "reject_reason"
_PRICE = "decimal(38,20)"
_AMOUNT = "decimal(20,2)"
_MAPPED = "__amount"
# Whole numbers as Python's int() reads them: blanks around, a sign, single underscores.
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def _store_number(article: Column, index: Column) -> Column:
    """0-based store of an article number, or of the row index where it is no number.

    Numbers that do not fit a BIGINT still count: two last digits decide.
    """
    digits = F.regexp_replace(article, r"[^0-9]", "")
    tail = F.right(digits, F.lit(2)).try_cast("bigint")
    signed = F.when(F.contains(article, F.lit("-")), -tail).otherwise(tail)
    whole = article.try_cast("bigint")
    number = F.coalesce(whole, F.when(article.rlike(_WHOLE_NUMBER), signed), index)
    return F.pmod(number, F.lit(fixed.STORES))


def _event_text(day: Column, index: Column) -> Column:
    hour = padded(index % fixed.OPEN_HOURS + fixed.OPENING_HOUR, 2)
    sixtieth = padded(index % 60, 2)
    colon = F.lit(":")
    return F.concat(F.coalesce(day, F.lit("")), F.lit(" "), hour, colon, sixtieth, colon, sixtieth)


def _amount(price: Column) -> Column:
    """Price times the factor, rounded to cents, in exact arithmetic.

    The price is rounded first, at the decimals that become cents: one rounding in all.
    """
    exact = F.round(F.trim(price).try_cast(_PRICE), 6)
    return (exact * F.lit(fixed.PRICE_FACTOR)).try_cast(_AMOUNT)


def map_sales_to_pos(
    df: DataFrame, order_cols: Sequence[str] | None = None, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Map sales rows to `(events, rejects)`.

    `order_cols` decide the row index; leave them out for rows that have a `row_index`
    already. `limit` keeps the rows before that index. A price that is no number goes to
    the rejects together with the source columns, and keeps its index.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    rows = df if order_cols is None else dense_index(df, order_cols)
    index = F.col(INDEX)
    if limit is not None:
        rows = rows.filter(index < limit)
    # `inline` makes the amount a column of a row: the filters use it and do not compute it again.
    amount = F.struct(_amount(F.col("price")).alias(_MAPPED))
    rows = rows.select("*", F.inline(F.array(amount)))
    amount = F.col(_MAPPED)
    customer = F.coalesce(F.substring("customer_id", 1, fixed.CUSTOMER_CHARS), F.lit(""))
    store = _store_number(F.col("article_id"), index)
    events = rows.filter(amount.isNotNull()).select(
        joined(customer, index.cast("string")).alias("transaction_id"),
        F.concat(F.lit(fixed.STORE_PREFIX), padded(store + 1, fixed.STORE_DIGITS)).alias("store_id"),
        _event_text(F.col("t_dat"), index).alias("timestamp"),
        amount.alias("total_amount"),
    )
    rejects = rows.filter(amount.isNull()).drop(_MAPPED).withColumn(REASON, F.lit("price_not_a_number"))
    return events, rejects
