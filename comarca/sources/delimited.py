"""Delimited text with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_delimited(
    spark: SparkSession, path: str, separator: str = ";", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Read delimited text as strings, named by its header.

    Nothing is inferred: codes keep their leading zeros and the data is not scanned twice.
    Doubled quotes inside a value become one. Rows end at the line end, so a large file is
    split over many tasks. Blank values are null. Files with different headers are separate
    sources, since columns are matched by position within one read; reading them together fails.
    """
    return spark.read.options(
        header=True, sep=separator, encoding=encoding, escape='"', inferSchema=False,
        enforceSchema=False,
    ).csv(path)


def write_delimited(
    df: DataFrame,
    path: str,
    separator: str = ";",
    encoding: str = "ISO-8859-1",
    mode: str = "overwrite",
) -> None:
    """Write the layout that ``read_delimited`` reads: quoted values, header, null as blank."""
    df.write.mode(mode).options(
        header=True,
        sep=separator,
        encoding=encoding,
        escape='"',
        quoteAll=True,
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
