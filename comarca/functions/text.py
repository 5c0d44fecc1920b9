"""Text expressions. All stay on the JVM; none starts a Python worker."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LATIN1_ONLY = r"^[\x{0}-\x{FF}]*$"

# How the first two bytes of any accented letter look when read as ISO-8859-1.
GARBLED_LETTER = r"[\x{C2}-\x{F4}][\x{80}-\x{BF}]"

# One garbled Latin-1 letter, or any other character.
LETTER_OR_CHARACTER = r"(?s)[\x{C2}\x{C3}][\x{80}-\x{BF}]|."


def as_column(value: Column | str) -> Column:
    """A column given by itself or by its name."""
    return F.col(value) if isinstance(value, str) else value


def repair_text(column: Column | str) -> Column:
    """Undo UTF-8 text that was read as ISO-8859-1 (``EspaÃ±a`` -> ``España``).

    The whole string is turned back into its Latin-1 bytes and kept only if they are valid
    UTF-8, so every accented letter is covered and clean text passes through. Text in which only
    some letters are garbled (``EspaÃ±a ñ``, ``日本 Ã±``) is repaired letter by letter. The first
    condition spares most clean text the others, which are needed: ``encode`` raises on
    characters beyond Latin-1 and ``decode`` on bytes that are no UTF-8.
    """
    column = as_column(column)
    raw = F.encode(column, "ISO-8859-1")
    some = column.rlike(GARBLED_LETTER)
    whole = some & column.rlike(LATIN1_ONLY) & F.is_valid_utf8(raw)
    letters = F.transform(
        F.regexp_extract_all(column, F.lit(LETTER_OR_CHARACTER), F.lit(0)),
        lambda x: F.when(F.length(x) == 2, F.decode(F.encode(x, "ISO-8859-1"), "UTF-8")).otherwise(x),
    )
    return F.when(whole, F.decode(raw, "UTF-8")).when(some, F.array_join(letters, "")).otherwise(column)


def contains_any(column: Column | str, words: Iterable[str]) -> Column:
    """True when the text holds at least one of the words; null text stays null."""
    column = as_column(column)
    return reduce(Column.__or__, [column.contains(word) for word in words])


def has_prefix(column: Column | str, prefixes: Iterable[str]) -> Column:
    """True when the text starts with one of the prefixes (pushed down as StartsWith)."""
    column = as_column(column)
    return reduce(Column.__or__, [column.startswith(prefix) for prefix in prefixes])


def strip_code(column: Column | str) -> Column:
    """The name behind a leading numeric code: ``44990  Lugarejo`` -> ``Lugarejo``."""
    return F.regexp_extract(as_column(column), r"[0-9]*\s+(.+)", 1)
