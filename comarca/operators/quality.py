"""Checks and repairs of keys: nulls, duplicates, row counts, column statistics, profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.operators.bloom import bloom_filter, may_have

def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_count) for all columns from one scan."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.count_if(F.col(name).isNull()).alias("null_count"),
            )
            for name in columns
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def has_no_nulls(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether none of the columns holds a null. Runs one job that stops at the first null row."""
    any_null = reduce(Column.__or__, [F.col(name).isNull() for name in columns])
    return not df.where(any_null).select(F.lit(1)).head(1)


def find_dupes(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Key groups with more than one row, largest first, then by key.

    Sorting by the key too spreads the many groups of the same size over the range
    partitions of the sort. For a long text see ``find_long_dupes``.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
    return groups.orderBy(F.col(name).desc(), *keys)


def find_long_dupes(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Values of a long text column found in more than one row, most frequent first.

    Values are counted by SHA-256 digest and length, so the counting shuffle holds no text. A
    Bloom filter of the digests that repeat, of bounded size, goes to the tasks that read the
    table again; only rows that pass leave them, as one text per digest and task, however
    often it comes. They are counted once more, which drops the few that passed by chance. Nulls
    count as one value. The table is read twice, so it should be a stored one.
    """
    text = F.col(key).cast("string")
    hashed = df.select(
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest"),
        F.coalesce(F.length(text), F.lit(-1)).alias("length"),
        F.col(key),
    )
    keys = ["digest", "length"]
    groups = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    repeated = bloom_filter(groups.where(F.col("rows") > 1), keys)
    fetched = may_have(hashed, repeated, keys).groupBy(*keys).agg(
        F.min(key).alias(key), F.count(F.lit(1)).alias("rows")
    )
    found = fetched.where(F.col("rows") > 1)
    return found.orderBy(F.col("rows").desc(), *keys).select(key, F.col("rows").alias(name))


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the remaining columns.

    Nulls are equal in keys and sort first in the order, so the survivor does not depend on
    how the rows are laid out. The survivor is a minimum, so each task sends on one row per
    key and a hot key is never gathered in one place.
    """
    first = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in first]
    payload = [c for c in first if c not in keys] + rest
    if not payload:
        return df.select(*keys).distinct()
    survivor = F.min(F.struct(*payload)).alias("_survivor")
    kept = df.groupBy(*keys).agg(survivor)
    return kept.select(*keys, "_survivor.*").select(*df.columns)


def audit(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(step, rows) for the stages of a cleanup, in one job.

    Each step is counted by a query of its own that reads the columns it needs: meant for tables
    that are stored. ``Traced`` counts all steps of a cleanup in the pass that makes it.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")
        for step, df in steps
    ]
    return reduce(DataFrame.unionByName, counts)


def audit_filters(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """(step, rows) for a chain of row filters, all counted in one scan.

    Each step counts the rows that pass its own condition and all earlier ones.
    """
    passed = F.lit(True)
    rows = []
    for step, condition in steps:
        passed = passed & condition
        rows.append(F.struct(F.lit(step).alias("step"), F.count_if(passed).alias("rows")))
    return df.agg(F.array(*rows).alias("audit")).select(F.inline("audit"))


def stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max) from one scan; min and max as text.

    Mean and deviation of a text column cover the values that read as numbers.
    """
    types = {field.name: field.dataType for field in df.schema.fields}

    def row(name: str) -> Column:
        text = isinstance(types[name], T.StringType)
        number = F.col(name).try_cast("double") if text else F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("count"),
            F.avg(number).alias("mean"),
            F.stddev(number).alias("stddev"),
            F.min(name).cast("string").alias("min"),
            F.max(name).cast("string").alias("max"),
        )

    return df.agg(F.array(*[row(name) for name in columns]).alias("rows")).select(F.inline("rows"))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, unique, top, freq) per column, exact, in one job.

    Each column's values are counted on their own, with partial counts before the shuffle
    and one row per task after it. On a stored table every scan reads a single column, and
    a column of unique values does not crowd out the others' partial counts; a table that
    is expensive to compute should be stored first. Ties for ``top`` go to the smallest
    value.
    """
    known = F.col("value").isNotNull()
    best = F.min(F.when(known, F.struct((-F.col("n")).alias("rank"), "value")))

    def summary(name: str) -> DataFrame:
        values = df.select(F.col(name).cast("string").alias("value"))
        counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        found = counted.agg(
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"),
            F.count("value").alias("unique"),
            best.alias("best"),
        )
        return found.select(
            F.lit(name).alias("column"),
            "count",
            "unique",
            F.col("best.value").alias("top"),
            (-F.col("best.rank")).alias("freq"),
        )

    return reduce(DataFrame.unionByName, [summary(name) for name in columns or df.columns])


# Deviations that the error of a distinct count stands for, and a sketch's places for frequent values.
DEVIATIONS = 4
PROFILE_PLACES = 1 << 12
# Equally frequent values that are looked at to name the smallest.
TIED = 1000


def profile_sketch(
    df: DataFrame, columns: Sequence[str] | None = None, deviation: float = 0.01, places: int = PROFILE_PLACES
) -> DataFrame:
    """(column, count, unique, top, freq, unique_error, freq_error), in one scan and one small shuffle.

    For tables too wide or too large for ``profile``. Each task keeps two sketches per column, of
    bounded size, which are merged: registers for the distinct values and ``places`` counters for
    the frequent ones. ``count`` is exact. ``unique`` is off by a share of ``unique_error`` at
    most, four times the standard deviation. ``freq`` is too high by ``freq_error`` rows at most,
    by none where the column has no more values than places. ``top`` and ``freq`` are null if no
    value is more frequent than that error; among equally frequent ones the smallest is named.
    """
    names = list(columns or df.columns)
    # The counters' map has the next power of two above 4/3 of the places; it loses 3.5 parts of that.
    capacity = 1 << math.ceil(math.log2(math.ceil(places / 0.75)))

    def sketches(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.approx_count_distinct(value, deviation).alias("unique"),
            F.call_function("approx_top_k", value, F.lit(TIED), F.lit(places)).alias("items"),
        )

    found = df.agg(F.array(*[sketches(name) for name in names]).alias("rows")).select(F.inline("rows"))
    known = F.filter("items", lambda item: item["item"].isNotNull())
    error = F.when(F.col("unique") > 0.75 * places, F.ceil(F.col("count") * 3.5 / capacity)).otherwise(F.lit(0))
    told = found.withColumn("items", known).withColumn("freq_error", error.cast("long"))
    freq = F.array_max(F.transform("items", lambda item: item["count"]))
    told = told.withColumn("freq", F.when(freq > F.col("freq_error"), freq))
    most = F.filter("items", lambda item: item["count"] == F.col("freq"))
    top = F.array_min(F.transform(most, lambda item: item["item"]))
    return told.select("column", "count", "unique", top.alias("top"), "freq", F.lit(DEVIATIONS * deviation).alias("unique_error"), "freq_error")
