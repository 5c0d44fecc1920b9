"""Null and duplicate checks on the key columns of the regional tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comarca.operators import find_dupes, null_counts
from comarca.plans import fixed

# Columns that should hold no null, per stored table.
REQUIRED = {
    "garitos": ["name", "county", "city", "garito_kind", "postal_code"],
    "social": ["name", "county", "city", "social_kind"],
    "cultural": ["name", "county", "city", "cultural_kind"],
    "population": ["county", "city", *fixed.AGE_BUCKETS, fixed.TOTAL_POPULATION],
}

# Columns that should not repeat together. Venues have no such key: chains repeat.
UNIQUE = {
    "social": ["name", "county", "city", "social_kind"],
    "cultural": ["name", "county", "city", "cultural_kind"],
    "population": ["city"],
}


def key_nulls(df: DataFrame, name: str) -> DataFrame:
    """(column, null_count) for the required columns of a table."""
    return null_counts(df, REQUIRED[name])


def key_dupes(df: DataFrame, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Repeated keys of a table, largest group first; ``extra`` columns extend the key."""
    return find_dupes(df, [*UNIQUE[name], *extra])
