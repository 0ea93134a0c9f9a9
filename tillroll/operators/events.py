"""Events on the wire: JSON text in a `value` column."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import fixed, schemas
from tillroll.functions import amounts, clock

REASON = "reject_reason"


def encode_events(df: DataFrame) -> DataFrame:
    """The four event fields as one JSON text per row; nulls are written out."""
    event = F.struct(*fixed.EVENT_FIELDS)
    return df.select(F.to_json(event, {"ignoreNullFields": "false"}).alias("value"))


def annotate_events(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Decode `value`, keep all other columns, and name what is wrong with a row.

    `inline` makes the decoded fields a row of their own: later filters use the result
    and do not parse the text a second time.
    """
    text = F.col("value").cast("string")
    others = [F.col(name) for name in df.columns if name != "value"]
    decoded = df.select(
        *others, text.alias("value"), F.inline(F.array(F.from_json(text, schemas.EVENT)))
    )
    amount = F.col("total_amount")
    event_time = clock.event_time(decoded, "timestamp", zone)
    nothing = F.coalesce(*[F.col(name).cast("string") for name in fixed.EVENT_FIELDS]).isNull()
    reason = (
        F.when(nothing, "malformed")
        .when(F.col("transaction_id").isNull(), "no_transaction_id")
        .when(F.col("store_id").isNull(), "no_store_id")
        .when(amount.isNull(), "no_amount")
        .when(~amounts.is_positive_number(amount), "amount_not_positive")
        .when(F.col("event_time").isNull(), "bad_timestamp")
    )
    return decoded.withColumn("event_time", event_time).withColumn(REASON, reason)


def decode_events(df: DataFrame, zone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split wire rows into `(good, rejects)`. Works on batches and on streams.

    Good rows carry the event fields and `event_time`; rejects carry the text and a reason.
    Event times are read in `zone`, by default in the session zone.
    """
    rows = annotate_events(df, zone)
    reason = F.col(REASON)
    kept = [name for name in df.columns if name != "value"]
    good = rows.filter(reason.isNull()).drop("value", REASON)
    rejects = rows.filter(reason.isNotNull()).select(*kept, "value", REASON)
    return good, rejects
