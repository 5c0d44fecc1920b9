"""Results do not change when tasks fail and run again, with their rows in another order."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from comarca.operators import dedup, fill_from_lookup, find_dupes, profile, unique_lookup
from comarca.plans.run import staged
from comarca.sources import read_partitioned, scratch_path, write_partitioned
from helpers import rows

SCHEMA = "name string, city string, code string"


@pytest.fixture
def facts(spark):
    city = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(3000, numPartitions=8).select(
        F.concat(F.lit("n"), F.col("id") % 700).alias("name"),
        city.alias("city"),
        F.when(F.col("id") % 4 == 0, F.lit("1")).alias("code"),
    )


@pytest.fixture
def shaky(facts):
    def failing_once(batches):
        """Every other task fails at the end of its first attempt; a rerun shuffles its rows."""
        context = TaskContext.get()
        for batch in batches:
            yield batch.sample(frac=1, random_state=context.attemptNumber())
        if context.attemptNumber() == 0 and context.partitionId() % 2:
            raise RuntimeError("lost")

    return facts.mapInPandas(failing_once, SCHEMA)


def test_fill(spark, facts, shaky):
    lookup = unique_lookup(
        spark.createDataFrame([("hot", "9"), ("k1", "7"), ("k2", "5")], "city string, code string"),
        ["city"],
        "code",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        expected = rows(fill_from_lookup(facts, lookup, ["city"], "code"))
        assert rows(fill_from_lookup(shaky, lookup, ["city"], "code")) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_dupes_and_profile(facts, shaky):
    assert rows(dedup(shaky, ["name", "city"])) == rows(dedup(facts, ["name", "city"]))
    assert rows(find_dupes(shaky, ["name"])) == rows(find_dupes(facts, ["name"]))
    assert rows(profile(shaky)) == rows(profile(facts))


def test_writes(spark, facts, shaky):
    assert rows(staged(spark, shaky, "shaky")) == rows(facts)
    path = scratch_path(spark, "shaky")
    write_partitioned(shaky, path, ["city", "code"])
    assert rows(read_partitioned(spark, path, SCHEMA)) == rows(facts)
