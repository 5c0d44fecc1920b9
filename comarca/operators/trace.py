"""A cleanup whose rows carry what became of them, so that one pass gives table and counts.

A traced table has, beside its columns, whether a row is still in (``_in``) and, for each step so
far, how many rows of that step it stands for (``_rows0``, ``_rows1``, ...). A filter only marks rows
as out. A dedup brings together all rows of a key, sums their counts and keeps the survivor's
columns, and rows that are out take part in nothing but the sums. Counts are columns like others:
a retried task computes them again instead of adding them twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.operators.clean import canonical_value, not_sentinel

IN = "_in"


def _rows(step: int) -> str:
    return f"_rows{step}"


@dataclass(frozen=True)
class Traced:
    """A traced table and the names of its steps."""

    df: DataFrame
    steps: tuple[str, ...]

    @classmethod
    def start(cls, df: DataFrame, step: str) -> Traced:
        one = F.lit(1).cast("long").alias(_rows(0))
        return cls(df.select("*", F.lit(True).alias(IN), one), (step,))

    def _columns(self) -> list[str]:
        counted = [_rows(k) for k in range(len(self.steps))]
        return [c for c in self.df.columns if c not in (IN, *counted)]

    def keep(self, step: str, condition: Column) -> Traced:
        """Rows for which the condition holds stay in; null counts as false."""
        holds = F.col(IN) & F.coalesce(condition, F.lit(False))
        marked = self.df.withColumn(IN, holds)
        last = F.when(F.col(IN), F.col(_rows(len(self.steps) - 1))).otherwise(F.lit(0).cast("long"))
        return Traced(marked.withColumn(_rows(len(self.steps)), last), (*self.steps, step))

    def without(self, step: str, column: str, sentinels: Sequence[object]) -> Traced:
        """As ``drop_sentinel``."""
        return self.keep(step, not_sentinel(column, sentinels))

    def canonical(self, step: str, column: str, fixes: Mapping[str, str], allowed: Sequence[str]) -> Traced:
        """As ``canonicalise``."""
        fixed = Traced(self.df.withColumn(column, canonical_value(column, fixes)), self.steps)
        return fixed.keep(step, F.col(column).isin(*allowed))

    def single(self, step: str, keys: Sequence[str], order_by: Sequence[str] = ()) -> Traced:
        """As ``dedup``: one row per key that has rows in, the smallest. Keys without stay, as out."""
        payload = [c for c in order_by if c not in keys]
        payload += [c for c in self._columns() if c not in keys and c not in payload]
        survivor = F.min(F.when(F.col(IN), F.struct(F.lit(True).alias(IN), *payload))).alias("_survivor")
        sums = [F.sum(_rows(k)).alias(_rows(k)) for k in range(len(self.steps))]
        grouped = self.df.groupBy(*keys).agg(survivor, *sums)
        alive = F.col("_survivor").isNotNull()
        kept = grouped.select(
            *[F.col(c) if c in keys else F.col("_survivor").getField(c).alias(c) for c in self._columns()],
            alive.alias(IN), *[_rows(k) for k in range(len(self.steps))],
            alive.cast("long").alias(_rows(len(self.steps))),
        )
        return Traced(kept, (*self.steps, step))

    def over(self, df: DataFrame) -> Traced:
        """The same steps over a stored copy of the traced table."""
        return Traced(df, self.steps)

    def table(self) -> DataFrame:
        """The rows that are still in, as the cleanup without traces gives them."""
        return self.df.where(IN).select(*[f"`{c}`" for c in self._columns()])

    def audit(self) -> DataFrame:
        """(step, rows) for all steps, from one pass over the table."""
        rows = [
            F.struct(F.lit(step).alias("step"), F.coalesce(F.sum(_rows(k)), F.lit(0)).alias("rows"))
            for k, step in enumerate(self.steps)
        ]
        return self.df.agg(F.array(*rows).alias("audit")).select(F.inline("audit"))
