"""Places in a sequence that is stored in many pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def starts_before(
    pieces: DataFrame, block: Column | str, number: str, size: str, start: str = "start"
) -> DataFrame:
    """Add to each piece the sum of ``size`` over all pieces that come before it.

    Pieces are in the order of their block, and inside it of ``number``; ``block`` may be a table's
    file, or a number cut down. Blocks are summed in parallel, each in one task; only one total per
    block goes through one task, and each piece is joined with its block's. Null sizes count as 0. The
    table is read twice, so it should be cheap.
    """
    key = F.col(block) if isinstance(block, str) else block
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_block").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    known = F.coalesce(F.col(size), F.lit(0))
    placed = pieces.withColumn("_block", key)
    totals = placed.groupBy("_block").agg(F.sum(known).alias("_total"))
    blocks = totals.select("_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    placed = placed.withColumn(start, F.coalesce(F.sum(known).over(inside), F.lit(0)))
    found = placed.join(blocks, "_block").withColumn(start, F.col(start) + F.col("_before"))
    return found.drop("_block", "_before")
