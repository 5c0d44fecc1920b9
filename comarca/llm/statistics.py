"""Statistics of texts as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed, in lambdas too."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of so many words that the text holds twice or more.

    Windows are compared by 64-bit hash: sorted by it, equal ones are neighbours. Then the
    places of those found twice are brought back in order, and the words that they cover are counted.
    """

    def hashes(own: Column) -> Column:
        return F.transform(
            F.slice(own, 1, F.greatest(F.size(own) - (window - 1), F.lit(0))),
            lambda word, at: F.xxhash64(word, *[own[at + k] for k in range(1, window)]),
        )

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))

        def places(s: Column) -> Column:
            twice = F.transform(
                s,
                lambda x, k: F.when(
                    (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["at"]
                ),
            )
            return F.array_sort(F.filter(twice, lambda at: at.isNotNull()))

        def count(p: Column) -> Column:
            steps = F.transform(p, lambda at, k: F.coalesce(F.least(F.get(p, k + 1) - at, F.lit(window)), F.lit(window)))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return let(let(ordered, places), count)

    def counted(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(covered(found))

    return let(let(words, hashes), counted)


def with_counts(texts: DataFrame, text_column: str = "text", repeats: bool = True) -> DataFrame:
    """Add counts (long) of a text column: n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_distinct, n_upper, n_digits, n_marks and with ``repeats`` n_repeat_words.

    A word is a run of other characters than blank and 0x09 to 0x0D; a line is what lies
    between line feeds and holds a word. A null text has none of either.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = texts.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))
    words = F.col("words")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOL)),
        "n_lines": let(lines, F.size),
        "n_dup_lines": let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_upper": F.regexp_count(text, F.lit(r"[A-Z]")),
        "n_digits": F.regexp_count(text, F.lit(r"[0-9]")),
        "n_marks": F.regexp_count(text, F.lit(r"[!?:;/=_(){}\[\]@~^+-]")),
    }
    if repeats:
        counts["n_repeat_words"] = repeated_words(words)
    return texts.withColumns({name: count.cast("long") for name, count in counts.items()}).drop("words")


#: Ratios made of the counts: name -> (count, per count).
RATIOS = {
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "copied_lines": ("n_dup_lines", "n_lines"),
    "distinct_words": ("n_distinct", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "line_words": ("n_words", "n_lines"),
}


def with_ratios(counted: DataFrame) -> DataFrame:
    """Add the ratios (double) of the counts; of nothing they are 0."""
    return counted.withColumns(
        {
            name: F.coalesce(F.try_divide(F.col(count).cast("double"), F.col(per)), F.lit(0.0))
            for name, (count, per) in RATIOS.items()
        }
    )
