"""Row-wise cleaning stages: formats, review flags, calendar and size columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import fixed
from tillroll.functions.amounts import amount_class, to_cents
from tillroll.functions.clock import is_text
from tillroll.functions.labels import payment_class, store_code


def standardize_formats(df: DataFrame, pattern: str = fixed.STORE_PATTERN_LITERAL) -> DataFrame:
    """Upper-case store codes, payment classes, amounts with two decimals.

    Pass `fixed.STORE_PATTERN_CLASS` to strip every other character from store codes. Rows
    without a payment column, as events on the wire, get none.
    """
    columns = {
        "store_id": store_code(F.col("store_id"), pattern),
        "total_amount": to_cents(F.col("total_amount")),
    }
    if _has_payment(df):
        columns["payment_method"] = payment_class(F.col("payment_method"))
    return df.withColumns(columns)


def _has_payment(df: DataFrame) -> bool:
    return "payment_method" in df.columns


def validate_business_rules(df: DataFrame) -> DataFrame:
    """Flag rows that need a look: a high amount, an unlisted payment or no store. Rows without a
    payment column are judged by the other two."""
    suspicious = F.col("store_id").isNull() | (F.col("total_amount") > fixed.REVIEW_ABOVE)
    if _has_payment(df):
        suspicious = suspicious | (F.col("payment_method") == fixed.PAYMENT_OTHER)
    status = F.when(suspicious, fixed.STATUS_REVIEW).otherwise(fixed.STATUS_VALID)
    return df.withColumns({"is_suspicious": suspicious, "validation_status": status})


def enrich(df: DataFrame) -> DataFrame:
    """Date, hour, weekday (1 = Sunday), weekend flag and amount class.

    A time that is event text counts as it is written, in every session zone.
    """
    moment = F.col("timestamp")
    if is_text(df, "timestamp"):
        moment = moment.try_cast("timestamp_ntz")
    weekday = F.dayofweek(moment)
    return df.withColumns(
        {
            "transaction_date": F.to_date(moment),
            "transaction_hour": F.hour(moment),
            "transaction_day": weekday,
            "is_weekend": F.coalesce(weekday.isin(*fixed.WEEKEND_DAYS), F.lit(False)),
            "amount_category": amount_class(F.col("total_amount")),
        }
    )
