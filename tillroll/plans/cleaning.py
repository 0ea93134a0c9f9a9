"""The cleaning pipeline."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tillroll import fixed
from tillroll.operators.ranking import deduplicate_latest
from tillroll.operators.standardize import enrich, standardize_formats, validate_business_rules
from tillroll.operators.validity import remove_invalid_records


def clean_rows(df: DataFrame, pattern: str = fixed.STORE_PATTERN_LITERAL) -> DataFrame:
    """The stages that look at one row: standard formats, review flags, enrichment. For batches and
    streams; without a payment column its part is left out."""
    return (
        df.transform(standardize_formats, pattern)
        .transform(validate_business_rules)
        .transform(enrich)
    )


def clean_transactions(
    df: DataFrame,
    tie_break: Sequence[Column] = (),
    pattern: str = fixed.STORE_PATTERN_LITERAL,
) -> DataFrame:
    """Valid rows, latest per transaction, standard formats, review flags, enrichment.

    The order is part of the result: an invalid newest row is gone before the latest row
    is chosen, and the amount limits apply to the unrounded amount. One shuffle, on the
    transaction; everything after it is row-wise.
    """
    return (
        df.transform(remove_invalid_records)
        .transform(deduplicate_latest, tie_break=tie_break)
        .transform(clean_rows, pattern)
    )
