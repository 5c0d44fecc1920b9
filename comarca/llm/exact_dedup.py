"""Exact dedup over a persistent digest index, bucketed and sorted by hash.

The index is a bucketed parquet table with one row per text seen: its SHA-256 digest and the id of
the document that stays. A batch of documents is reduced to one row per digest, merge-joined
against the index (whose side needs no shuffle) and what is new is appended.

Every call is a run with a name. Its rows carry the mark of the attempt that wrote them, and count
only once the run's attempt is committed, which is the last thing a call does to the index. So a
call that broke off leaves nothing behind that counts, and a call under the name of an earlier
one, broken or not, decides as that one did, or would have.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm.common import attach, key_of, rows_of, staged, unmatched, unpacked
from comarca.sources import scratch_path

BUCKETS = 32
# Digests of 40 bytes that a bucket is meant to hold.
BUCKET_ROWS = 2_000_000
COMMITS = "run string, attempt string, at long"


def buckets_for(rows: int) -> int:
    """Buckets for an index that is to hold so many texts."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class DigestIndex:
    """A digest table at ``location``; open the same location again to go on with it."""

    spark: SparkSession
    name: str
    location: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, location: str, buckets: int = BUCKETS) -> DigestIndex:
        """The index at a folder shared by all executors; an empty one if the folder is new.

        ``buckets`` must be that of the folder; ``buckets_for`` says how many are right. Close the
        index when done: that takes its name out of the catalog and leaves the files.
        """
        name = f"digests_{uuid4().hex}"
        place = f"{location}/digests".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, keep_row BIGINT, attempt STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        index = cls(spark, name, location, buckets)
        index._commit("", "").where(F.lit(False)).write.mode("append").parquet(f"{location}/commits")
        return index

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _commit(self, run: str, attempt: str) -> DataFrame:
        """One commit. Rows handed over by Python would pass workers of their own on the executors."""
        columns = [F.lit(run).alias("run"), F.lit(attempt).alias("attempt"), F.lit(time.time_ns()).cast("long").alias("at")]
        return self.spark.range(0, 1, 1, 1).select(*columns)

    def attempts(self, besides: str | None = None) -> list[str]:
        """The attempts that count: of every run, but for one, the last committed. One row per run."""
        commits = self.spark.read.schema(COMMITS).parquet(f"{self.location}/commits")
        last = commits.where(~F.col("run").eqNullSafe(besides)).groupBy("run").agg(F.max_by("attempt", "at").alias("attempt"))
        return [row["attempt"] for row in last.collect()]

    def entries(self, attempts: list[str] | None = None) -> DataFrame:
        """The texts seen by some attempts, by default by all that count."""
        self.spark.catalog.refreshTable(self.name)  # others may have written to the folder
        return self.spark.table(self.name).where(F.col("attempt").isin(self.attempts() if attempts is None else attempts))

    def add(self, candidates: DataFrame, attempt: str, attempts: list[str]) -> None:
        """Append those of the given distinct digests that neither the given attempts nor this one hold."""
        known = self.entries([*attempts, attempt]).select("digest").hint("merge")
        new = candidates.join(known, "digest", "left_anti")
        # Stored first: the table must not be read while it is written.
        new = staged(new.select("digest", "keep_id", "keep_row", F.lit(attempt).alias("attempt")), "digests-new")
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
            .write.insertInto(self.name))

    def commit(self, run: str, attempt: str) -> None:
        self._commit(run, attempt).write.mode("append").parquet(f"{self.location}/commits")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, row number and SHA-256 of the UTF-8 text (null as '') of every row, stored."""
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    return staged(
        docs.select(
            F.col(id_column).cast("long").alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "digests",
    )


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    index: DigestIndex | None = None,
    batches: int = 2,
    run: str | None = None,
) -> DataFrame:
    """Decide for every row whether it stays. Runs jobs; the index is written at once.

    Columns: id, row, digest, keep_id, group_size (rows here with this text), kept.

    Documents come in batches from the largest id down, so that the first arrival of a text, the
    row with the largest id, is the one that stays. A text that an earlier run put into the
    index keeps that earlier document: no row here stays for it. ``run`` names this run: repeat a
    call that broke off, or whose result was lost, under the same name and over the same documents,
    and it decides alike. Null texts count as empty. Null ids are the smallest. Of rows with equal
    text and id one stays. An empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = digests(docs, id_column, text_column)
    own = index is None
    if own:
        index = DigestIndex.open(spark, scratch_path(spark, "digest-index"), buckets_for(rows.count()))
    attempt = uuid4().hex
    run = run or attempt
    earlier = index.attempts(besides=run)

    steps = [k / batches for k in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("id", steps)).first()[0] if steps else None
    batch = F.lit(batches - 1)
    for k, cut in enumerate(sorted(set(cuts or []), reverse=True)):
        batch = F.when((F.col("id") > cut) & (batch == batches - 1), k).otherwise(batch)
    numbered = rows.withColumn("batch", batch)
    for k in range(batches):
        first = F.max(F.struct("id", "row")).alias("first")
        groups = numbered.where(F.col("batch") == k).groupBy("digest").agg(first)
        candidates = groups.select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"))
        index.add(candidates, attempt, earlier)

    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    entries = sizes.join(index.entries([*earlier, attempt]), "digest")
    new = (F.col("attempt") == attempt).alias("new")
    groups = staged(entries.select("digest", "keep_id", "keep_row", "group_size", new), "digest-groups")
    index.commit(run, attempt)
    if own:
        index.close()
    kept = (F.col("row") == F.col("keep_row")) & F.col("new")
    decided = attach(rows, groups, "digest", "group_size")
    return decided.select("id", "row", "digest", "keep_id", "group_size", kept.alias("kept"))


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without exact copies, with all their columns; see ``exact_dedup``.

    The ids to drop are broadcast if they are few; else a filter of them tells which rows
    are shuffled, so that other texts are not. If an id stands for several rows, its rows are told apart by their text.
    """
    decided = staged(exact_dedup(docs, id_column, text_column), "decided")
    per_id = decided.groupBy("id").agg(
        F.count("*").alias("rows"), F.count_if("kept").alias("keeps"),
    )
    per_id = staged(per_id.where((F.col("rows") > 1) | (F.col("keeps") == 0)), "dropped-ids")
    gone = per_id.select(key_of(F.col("id")).alias("name"))
    named = rows_of(docs).select("row", key_of(F.col("row").getField(id_column).cast("long")).alias("name"))
    kept = unpacked(unmatched(named, gone, ["name"]), docs.columns)
    if per_id.where("rows > 1").isEmpty():
        return kept
    # Ids with several rows: one row for each text that stays.
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    several = per_id.where("rows > 1").select("id")
    stays = decided.where("kept")
    stays = stays.join(several, stays["id"].eqNullSafe(several["id"]), "left_semi").select("id", "digest")
    one = rows.dropDuplicates(["id", "digest"])
    same = one["id"].eqNullSafe(stays["id"]) & (one["digest"] == stays["digest"])
    return kept.unionByName(unpacked(one.join(stays, same, "left_semi"), docs.columns))
