"""Row-local cleaning steps: no shuffle, no second pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.functions import code_to_label


def canonical_value(column: str, fixes: Mapping[str, str] | None = None) -> Column:
    """A category in lower case, with known misspellings replaced; ``fixes`` match whole values."""
    lowered = F.lower(column)
    return code_to_label(lowered, fixes, default=lowered) if fixes else lowered


def not_sentinel(column: str, values: Sequence[object]) -> Column:
    """Whether a value is known and no sentinel."""
    return ~F.col(column).isin(*values)


def canonicalise(
    df: DataFrame,
    column: str,
    fixes: Mapping[str, str] | None = None,
    allowed: Sequence[str] | None = None,
) -> DataFrame:
    """Lower-case a category, replace known misspellings, keep only the allowed values.

    ``fixes`` match whole lower-cased values. Null is never an allowed value, so with
    ``allowed`` the null rows go too.
    """
    cleaned = df.withColumn(column, canonical_value(column, fixes))
    return cleaned if allowed is None else cleaned.where(F.col(column).isin(*allowed))


def drop_sentinel(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Remove rows marked by a sentinel value. Null is unknown and goes as well."""
    return df.where(not_sentinel(column, values))
