"""Expressions that map codes to labels and kinds to indicators."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from comarca.functions.text import as_column


def code_to_label(
    column: Column | str, mapping: Mapping[str, str], default: Column | str | None = None
) -> Column:
    """Look the value up in a literal map; a missing code gives ``default`` (null if none)."""
    column = as_column(column)
    pairs = F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])
    label = F.try_element_at(pairs, column)
    if default is None:
        return label
    return F.coalesce(label, F.lit(default) if isinstance(default, str) else default)


def indicator(column: Column | str, value: object) -> Column:
    """1 where the column equals the value, null elsewhere: ready to be counted."""
    return F.when(as_column(column) == F.lit(value), F.lit(1))
