"""Number expressions that never raise on malformed input, with ANSI mode on or off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from comarca.functions.text import as_column


def to_int(
    column: Column | str,
    zero_tokens: Sequence[str] = ("..",),
    thousands: str = ".",
    data_type: str = "int",
) -> Column:
    """Parse ``1.204`` as 1204 and a zero token as 0; blank or malformed text gives null."""
    column = as_column(column)
    digits = F.replace(column, F.lit(thousands), F.lit(""))
    return F.when(column.isin(*zero_tokens), F.lit(0).cast(data_type)).otherwise(
        digits.try_cast(data_type)
    )


def leading_int(column: Column | str) -> Column:
    """The number before the first blank: ``100 y más`` -> 100, ``Total`` -> null."""
    return F.regexp_extract(as_column(column), r"([0-9]*)\s+", 1).try_cast("int")


def per_unit(numerator: Column | str, denominator: Column | str, per: int = 100_000) -> Column:
    """``numerator`` per ``per`` units of ``denominator`` as a double; null over zero."""
    return F.try_divide(as_column(numerator) * F.lit(per), as_column(denominator))
