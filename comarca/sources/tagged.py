"""Several sources of the same kind of thing, as one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_tag(path: str) -> str:
    """The kind named by a file: its last path segment up to the first dot."""
    return path.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0]


def ingest_tagged(
    parts: Sequence[tuple[DataFrame, Mapping[str, Column], str]], kind_column: str
) -> DataFrame:
    """Project sources of different shape onto one schema, tag each with its kind, union all.

    Each part is (source, output column -> expression, tag). Copies within a source
    collapse; the same row in two sources stays twice, because its kind differs. With a
    different tag per source that is one distinct over the union, hence one shuffle
    whatever the number of sources; sources sharing a tag are made distinct one by one.
    """
    projected = [
        source.select(
            *[expression.alias(name) for name, expression in mapping.items()],
            F.lit(tag).alias(kind_column),
        )
        for source, mapping, tag in parts
    ]
    tags = [tag for _, _, tag in parts]
    if len(set(tags)) == len(tags):
        return reduce(DataFrame.unionByName, projected).distinct()
    return reduce(DataFrame.unionByName, [part.distinct() for part in projected])
