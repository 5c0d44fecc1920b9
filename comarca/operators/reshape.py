"""Between nested, delimited, long and wide layouts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_elements(
    df: DataFrame, path: str, id_columns: Sequence[str] = (), position: str = "element_id"
) -> DataFrame:
    """One row per element of a document list, as (id columns, position, attributes).

    ``path`` leads to an array of attribute lists. The position within the document is a
    stable id. Elements without attributes stay, with a null list.
    """
    return df.select(*id_columns, F.posexplode_outer(path).alias(position, "attributes"))


def attributes_long(
    df: DataFrame,
    path: str,
    id_columns: Sequence[str] = (),
    slots: Sequence[str] = (),
    position: str = "element_id",
) -> DataFrame:
    """One row per attribute: id columns, element position, attribute name and its value slots."""
    elements = explode_elements(df, path, id_columns, position)
    exploded = elements.select(*id_columns, position, F.explode("attributes").alias("attribute"))
    fields = [F.col(f"attribute.{field}").alias(field) for field in ("name", *slots)]
    return exploded.select(*id_columns, position, *fields)


def attributes_wide(
    df: DataFrame,
    attributes: str,
    names: Sequence[str],
    slots: Sequence[str],
) -> DataFrame:
    """Turn an attribute list per row into one column per name.

    An attribute's value is its first non-null slot; a repeated attribute gives its smallest
    value, an absent one null. Rows without any of the names are dropped. The whole list is
    in the row, so nothing is shuffled: no generated id, no group, no pivot. Each list is
    cut down and sorted once, by name and value; a column is then the first item of its name.
    """

    def item(attribute: Column) -> Column:
        value = F.coalesce(*[attribute[slot] for slot in slots])
        return F.struct(
            attribute["name"].alias("name"),
            value.isNull().alias("absent"),
            value.alias("value"),
        )

    def value_of(name: str) -> Column:
        place = F.array_position("_items.name", name).cast("int") - 1
        return F.get("_items.value", place).alias(name)

    def wanted(attribute: Column) -> Column:
        return attribute["name"].isin(*names)

    others = [c for c in df.columns if c != attributes]
    items = F.sort_array(F.transform(F.filter(attributes, wanted), item)).alias("_items")
    listed = df.where(F.exists(attributes, wanted)).select(*others, items)
    return listed.select(*others, *[value_of(name) for name in names])


def pivot_first(
    df: DataFrame, keys: Sequence[str], name_column: str, names: Sequence[str], value_column: str
) -> DataFrame:
    """Long (key, name, value) rows to one row per key with a column per name.

    The cell is the smallest value, null if there is none. The column list is given, so no
    job is needed to learn it. Keys without any of the names are dropped.
    """
    cells = [
        F.min(F.when(F.col(name_column) == F.lit(name), F.col(value_column))).alias(name)
        for name in names
    ]
    return df.where(F.col(name_column).isin(*names)).groupBy(*keys).agg(*cells)


def explode_delimited(
    df: DataFrame, column: str, separator: str, drop_empty: bool = False
) -> DataFrame:
    """One row per token of a delimited text, in place of the text.

    A trailing separator yields an empty token, kept unless ``drop_empty``. Null text yields
    no row.
    """
    tokens = df.withColumn(column, F.explode(F.split(column, re.escape(separator))))
    return tokens.where(F.col(column) != "") if drop_empty else tokens


def bucket_sums(
    df: DataFrame,
    keys: Sequence[str],
    bucket_column: str,
    value_column: str,
    buckets: Mapping[str, tuple[int | None, int | None]],
    total: str,
) -> DataFrame:
    """Sum a value into ranges of another column, one output column per range, plus a total.

    ``buckets`` maps output column to inclusive (low, high); None leaves that end open. A
    null in the bucket column falls in no range.
    """

    def in_range(low: int | None, high: int | None) -> Column:
        column = F.col(bucket_column)
        if low is None:
            return column <= high
        return column >= low if high is None else column.between(low, high)

    sums = [
        F.sum(F.when(in_range(low, high), F.col(value_column)).otherwise(F.lit(0))).alias(name)
        for name, (low, high) in buckets.items()
    ]
    all_buckets = reduce(Column.__add__, [F.col(name) for name in buckets])
    return df.groupBy(*keys).agg(*sums).withColumn(total, all_buckets)
