"""Time expressions that hold for text, TIMESTAMP and TIMESTAMP_NTZ columns.

TIMESTAMP_NTZ values are wall-clock readings and count as UTC, whatever the session zone.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import fixed

def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def is_wall_clock(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def parse_event_time(text: Column) -> Column:
    """Event text in the session zone; null where it does not have the event format."""
    return F.try_to_timestamp(text, F.lit(fixed.EVENT_TIME_FORMAT))


def epoch_seconds(df: DataFrame, name: str, zone: str | None = None) -> Column:
    """Seconds since 1970 UTC; null for text that is no event time.

    Text is read in `zone`, or in the session zone where none is given.
    """
    column = F.col(name)
    if not is_text(df, name):
        return F.unix_timestamp(column)
    if zone is None:
        return F.unix_timestamp(parse_event_time(column))
    # Checked as a time first: a cast of other text would fail the job.
    reading = column.try_cast("timestamp_ntz")
    shaped = column.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    in_utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), reading)
    return F.when(shaped, F.unix_timestamp(in_utc))


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 UTC, rounded down."""
    moment = F.col(name)
    if not is_wall_clock(df, name):
        return F.unix_millis(moment.cast("timestamp"))
    # Other functions that count milliseconds would first put the reading into the session
    # zone, and move the hour that daylight saving skips.
    hours = F.unix_date(F.to_date(moment)).cast("bigint") * 24 + F.hour(moment)
    seconds = (hours * 60 + F.minute(moment)) * 60
    return seconds * 1000 + (F.extract(F.lit("SECOND"), moment) * 1000).cast("bigint")


def event_time(df: DataFrame, name: str, zone: str | None = None) -> Column:
    """Event text as a point in time, read in `zone` or else in the session zone."""
    if zone is None:
        return parse_event_time(F.col(name))
    return F.timestamp_seconds(epoch_seconds(df, name, zone))


def plain_text(moment: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`, with six decimals where the second is not whole."""
    text = moment.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def compact_date(moment: Column) -> Column:
    """`yyyyMMdd`"""
    return F.replace(F.to_date(moment).cast("string"), F.lit("-"), F.lit(""))
