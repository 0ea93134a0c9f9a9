"""Row-key expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import fixed


def joined(*parts: Column) -> Column:
    """Parts with underscores between them; null as soon as one part is null."""
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit("_"), part]
    return F.concat(*spaced)


def padded(number: Column, digits: int) -> Column:
    """A whole number with zeros in front, as `format_string("%0<digits>d")` gives it.

    That function sets up a formatter for every row, at several times the cost of padding; it is left
    to what padding does not cover: signs, longer numbers, and null, which it prints as a word.
    """
    plain = number.between(0, 10**digits - 1)
    text = F.lpad(number.cast("string"), digits, "0")
    return F.when(plain, text).otherwise(F.format_string(f"%0{digits}d", number))


def last_chars(text: Column, count: int) -> Column:
    return F.substring(text, -count, count)


def stream_salt(transaction: Column, salts: int = fixed.STREAM_SALTS) -> Column:
    """Salt by transaction: spreads one store over all salts.

    Widened before `abs`, because the smallest 32-bit hash has no positive twin.
    """
    return (F.abs(F.hash(transaction).cast("bigint")) % salts).cast("int")


def store_salt(store: Column, salts: int = fixed.STORE_SALTS) -> Column:
    """Salt by store: keeps one store together."""
    digest = F.substring(F.md5(store), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % salts).cast("int")


def newest_first(millis: Column) -> Column:
    """Thirteen digits that sort later moments first, for 0 <= millis <= 9999999999999."""
    # Without the test a missing time would be printed as the word "null".
    down = F.lit(fixed.REVERSE_MILLIS_FROM) - millis
    return F.when(millis.isNotNull(), padded(down, 13))
