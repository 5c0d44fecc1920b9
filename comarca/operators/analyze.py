"""Counting and ranking. Every count is partially aggregated before its shuffle, so a key
that holds a third of all rows still reaches the final task as one row per map task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.functions import indicator
from comarca.operators.enrich import free_name, join_spread


def count_by(
    df: DataFrame, keys: Sequence[str], counted: str | None = None, name: str = "total"
) -> DataFrame:
    """Rows per key. With ``counted`` only rows where that column is not null are counted;
    a key whose rows are all null there stays, with 0."""
    return df.groupBy(*keys).agg(F.count(counted if counted else F.lit(1)).alias(name))


def count_matrix(
    df: DataFrame,
    keys: Sequence[str],
    kind_column: str,
    kinds: Mapping[str, object],
    total_of: str | None = None,
    total: str = "total",
) -> DataFrame:
    """One count per kind side by side, plus a total.

    ``kinds`` maps output column to kind value. ``total_of`` counts the rows where that
    column is not null; without it the total is the row count.
    """
    counts = [F.count(indicator(kind_column, kind)).alias(out) for out, kind in kinds.items()]
    rows = F.count(total_of if total_of else F.lit(1)).alias(total)
    return df.groupBy(*keys).agg(*counts, rows)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_pairs(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The distinct non-null values per key, one row each: the exact form for any number of values.

    Shuffled by key and value together, so that no key is gathered anywhere.
    """
    return df.where(F.col(column).isNotNull()).select(*keys, column).distinct()


def value_sets(df: DataFrame, keys: Sequence[str], column: str, name: str = "values") -> DataFrame:
    """The sorted set of distinct non-null values per key.

    Meant for columns with a small domain (kinds, states): the set of one key is one array. Where
    some key may have many values see ``value_sets_up_to`` and ``value_pairs``.
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias(name))


def value_sets_up_to(
    df: DataFrame, keys: Sequence[str], column: str, limit: int, name: str = "values", size: str = "size"
) -> DataFrame:
    """The same with the exact number of distinct values, and the set only of keys with at most ``limit``.

    Sets of other keys are null; ``value_pairs`` has their values. Values are made distinct
    first, by key and value, and counted in parts. Then pairs meet the keys with small sets; a key
    with many pairs is found by a sketch (one job) and spread over tasks, where its pairs are
    dropped. So no task holds more than ``limit`` values of a key. Null keys are keys.
    """
    key, value = free_name("_key", df.columns), F.col(column)
    # One text per key, never null: null keys meet each other, and keys of any type can be sketched.
    known = F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})
    pairs = df.select(known.alias(key), *keys, column).distinct()
    sizes = pairs.groupBy(key, *keys).agg(F.count(column).alias(size))
    small = sizes.where(F.col(size) <= limit).select(key)
    listed = join_spread(pairs.where(value.isNotNull()).select(key, column), small, [key], "inner")
    sets = listed.groupBy(key).agg(F.array_sort(F.collect_list(column)).alias(name))
    found = sizes.join(sets, key, "left")
    nothing = F.when(F.col(size) == 0, F.array().cast(sets.schema[name].dataType))
    return found.select(*keys, size, F.coalesce(F.col(name), nothing).alias(name))


def top_k(
    df: DataFrame, by: str, k: int, ties: Sequence[str] = (), descending: bool = True
) -> DataFrame:
    """The first ``k`` rows by one column, ties settled by further ascending columns.

    Spark plans this as TakeOrderedAndProject: each task keeps ``k`` rows, nothing is sorted
    globally. Nulls come last in descending order and first in ascending order.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(order, *[F.col(tie).asc() for tie in ties]).limit(k)
