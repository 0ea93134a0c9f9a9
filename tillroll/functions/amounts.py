"""Money expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import fixed

# Wide enough for any sum of text or double amounts with ten decimals.
EXACT = "decimal(38,10)"


def exact_amount(df: DataFrame, name: str) -> Column:
    """A number or its text as an exact decimal; null where it is no such number.

    Decimals stay as they are. Doubles go through their shortest text, so the sum of a
    column does not depend on the order in which partitions are merged.
    """
    amount = F.col(name)
    return amount if isinstance(df.schema[name].dataType, T.DecimalType) else amount.try_cast(EXACT)


def to_cents(amount: Column) -> Column:
    """Two decimals, halves away from zero."""
    return F.round(amount, 2)


def amount_class(amount: Column) -> Column:
    (first, limit), *others = fixed.AMOUNT_CLASSES
    chosen = F.when(amount < limit, first)
    for name, limit in others:
        chosen = chosen.when(amount < limit, name)
    return chosen.otherwise(fixed.AMOUNT_LARGEST)


def is_positive_number(amount: Column) -> Column:
    """True for a finite amount above zero; NaN sorts above all numbers in Spark."""
    return (amount > fixed.AMOUNT_ABOVE) & (amount < float("inf"))
