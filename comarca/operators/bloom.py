"""Bloom filters as tables: which rows may have a key out of a long list.

A filter is 4096 blocks of 32,768 bits, one row per block in use, so at most 16 MB whatever the
list; that bound is what lets it be broadcast. A key's 64-bit hash picks the block and three
bits in it. Ten million keys let about one foreign row in 250 through, a hundred million
nearly all: then the filter saves little, but no row that has a key is ever lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 12
BLOCK_BITS = 1 << 15
PROBES = 3


def _places(keys: Sequence[str]) -> tuple[Column, list[Column]]:
    """The block of a key, and its bits there; the hash gives 12 and three times 15 bits.

    None of this is ever null, as Catalyst can see; else it would hash each row once more to filter.
    """
    key_hash = F.xxhash64(*keys)
    bits = [F.shiftrightunsigned(key_hash, 12 + 15 * probe) for probe in range(PROBES)]
    block = key_hash.bitwiseAND(F.lit(BLOCKS - 1).cast("long"))
    return block, [bit.bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")).cast("int") for bit in bits]


def bloom_filter(keys_table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filter of all keys of a table, as (_block, _bits). Nulls are keys too."""
    block, bits = _places(keys)
    placed = keys_table.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
    return placed.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def may_have(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a table that may have a key of the filter; all that do are among them.

    Keys must have the types they had in the filter's table. The filter is broadcast, so rows are
    dropped in the task that reads them.
    """
    return _probed(df, found, keys, keep=True)


def cannot_have(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All other rows."""
    return _probed(df, found, keys, keep=False)


def _probed(df: DataFrame, found: DataFrame, keys: Sequence[str], keep: bool) -> DataFrame:
    block, bits = _places(keys)

    def is_set(bit: Column) -> Column:
        byte = F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit.bitwiseAND(F.lit(7))) == 1

    hit = F.coalesce(reduce(Column.__and__, [is_set(bit) for bit in bits]), F.lit(False))
    probed = df.withColumn("_block", block).join(F.broadcast(found), "_block", "inner" if keep else "left")
    return probed.where(hit if keep else ~hit).select(*[F.col(f"`{name}`") for name in df.columns])
