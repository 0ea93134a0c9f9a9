"""Store-code and payment expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import fixed


def store_code(store: Column, pattern: str = fixed.STORE_PATTERN_LITERAL) -> Column:
    """Upper-case store code without whatever `pattern` matches."""
    return F.regexp_replace(F.upper(store), pattern, "")


def payment_class(payment: Column) -> Column:
    """The class a spelling is listed under, else (null included) the rest class."""
    classes = [
        F.when(payment.isin(*spellings), F.lit(name))
        for name, spellings in fixed.PAYMENT_SPELLINGS.items()
    ]
    return F.coalesce(*classes, F.lit(fixed.PAYMENT_OTHER))
