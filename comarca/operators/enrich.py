"""Dimensions derived from facts, lookups, and joins to a dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.functions import per_unit

SALTS = 16
# A key with one row in so many is hot, if it has at least MIN_HOT_ROWS.
HOT_PARTS = 1000
MIN_HOT_ROWS = 1000
# Most keys that a measurement gives, and the places of its sketch.
MOST_HOT = 2 * HOT_PARTS
TRACKED = 1 << 15


def free_name(base: str, *taken: Sequence[str]) -> str:
    """A column name that none of the tables has."""
    used = {name.lower() for names in taken for name in names}
    while base.lower() in used:
        base += "_"
    return base


def _known(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in columns])


def derive_dimension(df: DataFrame, columns: Sequence[str], required: Sequence[str]) -> DataFrame:
    """The distinct combinations of some columns found in the facts, with the required ones known."""
    return df.where(_known(required)).select(*columns).distinct()


def unique_lookup(dimension: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with exactly one known value in a dimension, and that value.

    Dimension rows are counted: a key listed twice is ambiguous even if both rows agree, so
    that a city name found in two counties gives no answer.
    """
    known = free_name("_known", keys, [value])
    grouped = dimension.groupBy(*keys).agg(F.count(value).alias(known), F.max(value).alias(value))
    return grouped.where(F.col(known) == 1).drop(known)


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int = HOT_PARTS) -> list[int]:
    """Hashes of all keys that have at least one row in ``parts``, and of few others. Runs a job.

    Each task keeps a sketch of the frequent key hashes, of bounded size, and the sketches are
    merged: one scan of the keys, no shuffle of rows. A sketch of ``TRACKED`` places errs by less
    than one row in 8,000, upwards only; so no key of that frequency is missed, and at most about
    ``parts`` hashes come back. Rows with a null in a key are not counted, as they join nothing.
    """
    hashed = df.where(_known(keys)).select(F.xxhash64(*keys).alias("key"))
    found = hashed.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {MOST_HOT}, {TRACKED})").alias("top")
    ).first()
    least = found["rows"] / parts
    return sorted(item["item"] for item in found["top"] or [] if item["count"] >= max(least, MIN_HOT_ROWS))


def join_spread(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    salts: int = SALTS,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Equi-join a table whose keys may be hot with a smaller one that has few rows per key.

    Keys that are measured to be hot (``hot_keys``, one job, unless their hashes are given) are
    salted: their rows are spread over ``salts`` tasks and their rows of the lookup are repeated
    that often. All other rows have salt 0 and meet a lookup that is there once. The salt is a
    hash of the row and of the partition it comes from: copies of one row spread too, and a
    retried task sends its rows to the same place whatever their order. Both sides get a
    shuffle of their own, so AQE can broadcast a lookup it has measured to be small, or split a
    partition that is still too large. ``how`` is ``inner`` or ``left``. Filters on the result
    stay above the salt, so filter the inputs instead. The table is read once more to measure it, so it
    should be a stored one.
    """
    if how == "inner":
        df = df.where(_known(keys))
    types, other = dict(df.dtypes), dict(lookup.dtypes)
    if salts == 1 or any(types[key] != other[key] for key in keys):
        is_hot = F.lit(salts > 1)  # hashes of unlike types cannot be compared: salt all
    else:
        is_hot = F.xxhash64(*keys).isin(list(hot_keys(df, keys) if hot is None else hot))
    # Spark hashes no maps.
    hashed = [name for name, kind in df.dtypes if "map<" not in kind]
    row_hash = F.xxhash64(F.spark_partition_id(), *hashed)
    # A row without a key joins nothing, and may lie anywhere.
    spread = is_hot | ~_known(keys)
    salt = free_name("_salt", df.columns, lookup.columns)
    one = F.lit(1).cast("long")
    salted = df.withColumn(salt, F.pmod(row_hash, F.when(spread, F.lit(salts)).otherwise(one)))
    last_salt = F.when(is_hot, F.lit(salts - 1).cast("long")).otherwise(one - one)
    repeated = lookup.withColumn(salt, F.explode(F.sequence(one - one, last_salt)))
    return salted.join(repeated, [*keys, salt], how).drop(salt)


def fill_from_lookup(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str, salts: int = SALTS
) -> DataFrame:
    """Fill nulls of ``value`` from a lookup with unique keys; all other cells stay as they are.

    Only the rows that can change are joined: value missing and key known. The rest goes
    past the join unshuffled. Rows of a hot key are spread. The table is read once for either
    kind of row, so it should be a stored one.
    """
    fillable = F.col(value).isNull() & _known(keys)
    filled = join_spread(
        df.where(fillable).drop(value), lookup.select(*keys, value), keys, "left", salts
    )
    return df.where(~fillable).unionByName(filled.select(*df.columns))


def rate_per(
    dimension: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    numerator: str,
    denominator: str,
    per: int = 100_000,
    minimum: int | None = None,
    name: str = "ratio",
    salts: int = SALTS,
) -> DataFrame:
    """Join a dimension with per-key totals and add ``numerator`` per ``per`` of ``denominator``.

    Keys missing on either side are dropped. ``minimum`` keeps dimension rows whose
    denominator reaches it, before the join. Rows of a hot key are spread over ``salts``
    tasks; with 1, for a dimension of few rows per key, it is a plain join. Both sides should be stored tables:
    the join wants known keys, and Catalyst pushes that test down to the scan, where a
    computed key is then computed once more for every raw row.
    """
    if minimum is not None:
        dimension = dimension.where(F.col(denominator) >= minimum)
    if salts == 1:
        joined = dimension.join(totals, list(keys), "inner")
    else:
        joined = join_spread(dimension, totals, keys, "inner", salts)
    return joined.withColumn(name, per_unit(numerator, denominator, per))
