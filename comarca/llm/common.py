"""Helpers shared by the operators on training documents."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.operators import bloom_filter, cannot_have, join_spread, may_have
from comarca.sources import scratch_path

# A group with at least one in HOT_PARTS of all rows is hot; so there are at most HOT_PARTS of them.
HOT_PARTS = 1000
# Id lists up to this many rows (a few MB) may be broadcast; longer ones are joined by shuffle.
BROADCAST_ROWS = 200_000
# Bytes of texts that go to a Python worker at once; Spark's own limit is 64 MB and 10,000 rows.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, jobs send texts to Python in batches of ``BATCH_BYTES`` or one longer text.

    An executor holds a batch several times, in the JVM's native memory and in the worker, and both
    keep what they once took. A limit that the session was given holds instead. Nothing stays set.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: a stable, cut lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_small(df: DataFrame, name: str) -> DataFrame:
    """The same, for what sends texts to Python."""
    with small_batches(df.sparkSession):
        return staged(df, name)


def rows_of(docs: DataFrame) -> DataFrame:
    """Every row as one struct named ``row``, so that no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def attach(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """Join every row with its group's row. ``size`` holds the number of rows of the group.

    Groups with at least a thousandth of all rows, of which there are at most a thousand, are
    broadcast; so a hot group is joined where its rows lie. All others go through a shuffle
    in which no key has more than a thousandth of the rows. Both tables are read more than
    once and should be stored. Rows without a group are dropped.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    is_hot = F.col(size) * HOT_PARTS >= total
    hot = F.broadcast(groups.where(is_hot))
    by_hot = rows.join(hot, key, "inner")
    rest = rows.join(F.broadcast(groups.where(is_hot).select(*([key] if isinstance(key, str) else key))), key, "left_anti")
    by_shuffle = rest.join(groups.where(~is_hot), key, "inner")
    return by_hot.unionByName(by_shuffle)


def bounded(ids: DataFrame) -> DataFrame:
    """A stored id list, marked for broadcast only if it has few rows."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(ids) if few else ids


def few(listed: DataFrame) -> bool:
    """Whether a stored list is short enough to be broadcast."""
    return listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def key_of(id_column: Column) -> Column:
    """An id as a text that is never null; a null id is ''."""
    return F.coalesce(id_column.cast("string"), F.lit(""))


def matched(rows: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows joined with a stored list on keys without nulls.

    A short list is broadcast. A long one is turned into a Bloom filter of bounded size, so that only
    rows that may be in it are shuffled; the texts of all others stay where they are.
    """
    if few(listed):
        return rows.join(F.broadcast(listed), keys)
    found = staged(bloom_filter(listed, keys), "bloom")
    return may_have(rows, found, keys).join(listed, keys)


def unmatched(rows: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in a stored list of distinct keys; again only those that may be in it
    are shuffled, and spread where a key is hot. ``rows`` is read twice if the list is long."""
    listed = listed.select(*keys)
    if few(listed):
        return rows.join(F.broadcast(listed), keys, "left_anti").select(*rows.columns)
    found = staged(bloom_filter(listed, keys), "bloom")
    maybe = join_spread(may_have(rows, found, keys), listed.withColumn("_listed", F.lit(True)), keys, "left")
    return cannot_have(rows, found, keys).unionByName(maybe.where("_listed is null").select(*rows.columns))


def is_held_out(id_column: Column) -> Column:
    """A fifth of all documents, by the checksum of the id's decimal digits; null counts as ''."""
    digits = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % 5 == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, limit: int, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Texts and 0/1 labels of at most ``limit`` labelled documents that are not held out.

    The documents with the smallest hash of their id are taken, all of them if there are no
    more than ``limit``. The ids are broadcast, which ``limit`` bounds; so no text is
    shuffled. Null ids and null labels are left out; an id labelled twice takes the larger
    label. Columns: id, text (null as ''), label (int).
    """
    known = F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~is_held_out(F.col(id_column))
    chosen = (
        labels.where(known).groupBy(F.col(id_column).alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(limit)
    )
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    return docs.select(F.col(id_column).alias("id"), text).join(F.broadcast(chosen), "id")
