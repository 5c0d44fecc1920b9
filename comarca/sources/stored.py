"""Partitioned parquet tables."""

from __future__ import annotations

import time
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "overwrite",
    only_given_partitions: bool = False,
) -> None:
    """Write parquet in one folder level per key, on any file system Spark can reach.

    Rows are rebalanced by the keys first, so a folder gets few files; AQE splits a folder
    that outgrows the advisory partition size over several tasks and lets one task write
    many small folders. Overwriting replaces the whole table, or with
    ``only_given_partitions`` just the folders present in ``df``. Null and empty keys both
    read back as null.
    """
    writer = df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys)
    if only_given_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> DataFrame:
    """Read a partitioned table under a given schema, with the columns in its order.

    The schema keeps ``05001`` text where it is a folder name, and spares the inference.
    """
    reader = spark.read.schema(schema)
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    return reader.parquet(path).select(*[f"`{name}`" for name in names])


# Versioned tables: each rebuild in a folder of its own, and a list of those that are complete.
VERSIONS = "version string, at long"


def write_versioned(df: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Write a table as a new version below ``path`` and make it the current one, last of all.

    Readers see the version before until the list of versions has the new one, which is one small
    file put in place when it is whole. A rebuild that fails, at whatever task, leaves a folder
    nobody reads. Versions are kept, for readers that still use them; remove old folders below
    ``versions`` at will. Returns the version's name.
    """
    version = uuid4().hex
    write_partitioned(df, f"{path.rstrip('/')}/versions/{version}", keys)
    switch_version(df.sparkSession, path, version)
    return version


def switch_version(spark: SparkSession, path: str, version: str) -> None:
    """Make a complete version the current one, an earlier one too."""
    entry = spark.createDataFrame([(version, time.time_ns())], VERSIONS).coalesce(1)
    entry.write.mode("append").parquet(f"{path.rstrip('/')}/complete")


def current_version(spark: SparkSession, path: str) -> str:
    """The version that was completed last. Runs a job over one row per version."""
    complete = spark.read.schema(VERSIONS).parquet(f"{path.rstrip('/')}/complete")
    return complete.orderBy(F.desc("at"), "version").first()["version"]


def read_versioned(
    spark: SparkSession, path: str, schema: T.StructType | str, version: str | None = None
) -> DataFrame:
    """Read the version that is current now, or a given one; it stays the same while it is read."""
    chosen = version or current_version(spark, path)
    return read_partitioned(spark, f"{path.rstrip('/')}/versions/{chosen}", schema)
