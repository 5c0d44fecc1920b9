"""Shards of nearly equal bytes, cut out of a range partition by sampled splitters.

The key of a record is (hash of its text, id, row), so that equal texts lie side by side. Draws of
keys, weighted by bytes and rows, give quantile boundaries, which cut the records into many more
ranges than shards; a text that fills whole ranges by itself is cut by id and row. The ranges are measured, and those that
came out overfull are drawn from again and subdivided. The exact sizes of the ranges then
say where every record lies in the order of all bytes, and so its shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comarca.llm.common import staged

RANGES = 4096
DRAWS_PER_RANGE = 16
ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 1 << 16
# A range with more than this many times the mean bytes or rows is subdivided.
OVERFULL = 2.0
# Stands for a null id, before all others.
NO_ID = -(1 << 63)


KEY = np.dtype([("hash", np.int64), ("id", np.int64), ("row", np.int64)])


def _splitters(records: DataFrame, total: int, count: int, ranges: int, parts: int | None, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of weighted draws, as (hash, id, row); and the hashes drawn repeatedly.

    A record's weight is its share of the bytes or of the rows, whichever is larger, so that a
    range is bounded in both. Each is drawn that share of ``ranges * DRAWS_PER_RANGE`` times, rounded
    at random; so at most twice as many rows come to the driver, whatever the table's size, in
    expectation. ``records`` have a column ``range``; each range is cut by itself, into ``parts``, or if None into one part for
    every ``DRAWS_PER_RANGE`` draws, at least two. Every ``turn`` draws anew.
    """
    draws = ranges * DRAWS_PER_RANGE
    chance = F.pmod(F.xxhash64("id", "hash", "row", F.lit(7 + turn)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.greatest(F.col("size") / F.lit(float(max(total, 1))), F.lit(1.0 / max(count, 1)))
    times = F.floor(share * F.lit(draws) + chance).alias("times")
    drawn = records.select("range", "hash", F.coalesce("id", F.lit(NO_ID)).alias("id"), "row", times).where("times > 0")
    sample = drawn.orderBy("hash", "id", "row").toPandas()
    cuts = [sample.iloc[:0]]
    for _, own in sample.groupby("range"):
        reached = np.cumsum(own["times"].to_numpy())
        pieces = parts or max(2, -(-int(reached[-1]) // DRAWS_PER_RANGE))
        at = np.searchsorted(reached, reached[-1] * np.arange(1, pieces) / pieces, side="right")
        cuts.append(own.iloc[np.unique(np.minimum(at, len(own) - 1))])
    found = pd.concat(cuts)
    keys = np.empty(len(found), KEY)
    for name in KEY.names:
        keys[name] = found[name].to_numpy(np.int64)
    weights = sample.groupby("hash")["times"].sum()
    return keys, weights.index.to_numpy(np.int64)[weights.to_numpy() > 1]


def _joined(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Splitters of two draws in order. The first within a hash falls back to the start of that hash,
    so that equal texts are cut apart only where they fill a range."""
    keys = np.unique(np.concatenate([keys, more]))
    opens = np.r_[True, keys["hash"][1:] != keys["hash"][:-1]][: len(keys)]
    keys["id"][opens] = keys["row"][opens] = NO_ID
    return np.unique(keys)


def _ranged(records: DataFrame, total: int, count: int, ranges: int) -> tuple[DataFrame, np.ndarray]:
    """The records with their range, stored, and the hashes that may lie in several ranges.

    The ranges of the first draw are measured. Those with more than ``OVERFULL`` times the mean bytes, their
    largest record aside, or rows are drawn from again, alone, and subdivided, until there are none. They are at
    most ``2 * ranges / OVERFULL``, so few numbers go through the driver.
    """
    keys, often = _splitters(records.withColumn("range", F.lit(0)), total, count, ranges, ranges, 0)
    keys = _joined(keys, np.empty(0, KEY))
    most_bytes, most_rows = OVERFULL * total / ranges, max(OVERFULL * count / ranges, 1)
    turn = 0
    while True:
        number = _range_of(keys)("hash", F.coalesce("id", F.lit(NO_ID)), "row")
        ranged = staged(records.withColumn("range", number), "ranged")
        sums = ranged.groupBy("range").agg(F.sum("size") - F.max("size"), F.count("*")).toDF("range", "bytes", "rows")
        full = staged(sums.where((F.col("bytes") > most_bytes) | (F.col("rows") > most_rows)).select("range"), "overfull")
        turn += 1
        more, again = _splitters(ranged.join(F.broadcast(full), "range"), total, count, ranges, None, turn)
        often = np.union1d(often, again)
        finer = _joined(keys, more)
        if len(finer) == len(keys):
            return ranged, np.union1d(often, keys["hash"][1:][keys["hash"][1:] == keys["hash"][:-1]])
        keys = finer


def _range_of(keys: np.ndarray):
    """A column function: the number of the range that a (hash, id, row) lies in."""
    hashes = np.ascontiguousarray(keys["hash"])
    split = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])

    @F.pandas_udf("int")
    def number(own_hash: pd.Series, own_id: pd.Series, own_row: pd.Series) -> pd.Series:
        values = own_hash.to_numpy(np.int64)
        found = np.searchsorted(hashes, values, side="right")
        within = np.flatnonzero(np.isin(values, split))
        own = np.empty(len(within), KEY)
        for name, column in zip(KEY.names, (own_hash, own_id, own_row), strict=True):
            own[name] = column.to_numpy(np.int64)[within]
        found[within] = np.searchsorted(keys, own, side="right")
        return pd.Series(found.astype(np.int32))

    return number


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    ranges: int = RANGES,
) -> DataFrame:
    """Deal all rows out to ``shards`` shards of nearly equal bytes. Runs jobs.

    Columns: id, size (UTF-8 bytes of the text, null as none, plus 1), text_crc32 (unsigned),
    shard (from 0), slot (place in the shard, gapless from 0). Rows of equal texts get one
    shard and stand side by side, unless they have more bytes than a range, a share of
    1 / ``ranges``. Null texts count as empty, null ids as the smallest; repeated rows get slots of
    their own. An empty table gives no rows. Other columns are not looked at. There are more
    ranges on more rows, about one for a million, up to 65,536.
    """
    raw = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    records = staged(
        docs.select(
            F.col(id_column).cast("long").alias("id"),
            (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.xxhash64(raw).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "records",
    )
    total, count = records.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = min(max(ranges, count // ROWS_PER_RANGE), MOST_RANGES)
    ranged, often = _ranged(records, total, count, ranges)

    # A few times MOST_RANGES rows at most: what lies before each range.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )

    # Texts with more bytes than a range, and where others that lie in several ranges begin: at a range's start.
    drawn = records.sparkSession.createDataFrame([(int(h),) for h in often], "hash long")
    of_hash = ranged.join(F.broadcast(drawn), "hash").groupBy("hash").agg(
        (F.sum("size") > F.lit(total / ranges)).alias("apart"), F.min("range").alias("range"), F.max("range").alias("last")
    )
    of_hash = of_hash.where(F.col("apart") | (F.col("last") > F.col("range"))).join(F.broadcast(offsets), "range")
    groups = of_hash.select("hash", "apart", F.col("bytes_before").alias("first_before"))

    order = Window.partitionBy("range").orderBy("hash", "id", "row")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("range", "hash").orderBy("id", "row")
    placed = ranged.select(
        "id", "size", "text_crc32", "range", "hash",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("bytes_in"),
        (F.row_number().over(order) - 1).alias("rows_in"),
        F.coalesce(F.sum("size").over(same.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("copies_in"),
    ).join(F.broadcast(offsets), "range").join(F.broadcast(staged(groups, "groups")), "hash", "left")
    # Equal texts go by where the first of them lies, those with more bytes than a range each by itself.
    own = F.col("bytes_before") + F.col("bytes_in")
    place = F.when(F.col("apart"), own).otherwise(F.coalesce("first_before", own - F.col("copies_in")))
    shard = F.least(F.floor(place * shards / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int")
    placed = staged(
        placed.select("id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("rows_in")).alias("at")),
        "placed",
    )
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot")
    )
