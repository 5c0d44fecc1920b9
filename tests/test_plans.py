"""What the plans look like: scans pruned, shuffles few, hot keys split, no Python workers."""

import re

import pytest
from pyspark.sql import functions as F

from comarca.queries import QUERIES
from comarca.operators import (
    count_by,
    dedup,
    fill_from_lookup,
    profile,
    rate_per,
    top_k,
    unique_lookup,
)
from comarca.sources import ingest_tagged, read_partitioned, write_partitioned
from helpers import final_plan, plan, rows

SF_DIR = "/root/testdata/sf0.001"
PYTHON = re.compile("ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn|PythonUDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not PYTHON.search(text)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert "Window" not in text
    assert no_rows_gathered(text)
    assert hot_keys_are_split(text)


def hot_keys_are_split(text):
    """Rows meet by key only after a partial aggregate, or salted."""
    lines = [line.lstrip("+-: ") for line in text.splitlines()]
    return all(
        "_salt" in line or re.match("(Hash|Sort|ObjectHash)Aggregate", child)
        for line, child in zip(lines, lines[1:], strict=False)
        if line.startswith("Exchange hashpartitioning")
    )


def no_rows_gathered(text):
    """Every single-partition exchange sits on a partial aggregate or a limit."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line and not re.search("partial_|LocalLimit", lines[i + 1]):
            return False
    return True


@pytest.fixture
def merge_joins(spark):
    """Joins as they run on large tables, with skew seen at test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_facts(spark, same_rows=False):
    """A third of the rows belong to one key; its value is missing and can be filled."""
    note = F.lit("copy") if same_rows else F.sha2(F.col("id").cast("string"), 256)
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("city"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit("1")).alias("code"),
        note.alias("note"),
    ).repartition(16)


def partition_sizes(df):
    return [n for n in df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]


def test_fill_spreads_a_hot_key_over_tasks(spark, merge_joins):
    facts = hot_facts(spark)
    lookup = spark.range(5000).select(
        F.concat(F.lit("k"), "id").alias("city"), F.lit("7").alias("code")
    ).unionByName(spark.createDataFrame([("hot", "9")], "city string, code string"))
    lookup = unique_lookup(lookup, ["city"], "code")
    filled = fill_from_lookup(facts, lookup, ["city"], "code")
    assert "SortMergeJoin" in plan(filled)
    assert filled.where("city = 'hot' and code = '9'").count() == 10_000
    assert filled.count() == 60_000
    missing = facts.where("code is null")
    joined = fill_from_lookup(missing, lookup, ["city"], "code")
    assert max(partition_sizes(joined)) < 30_000 / 8


def test_fill_spreads_copies_of_one_row(spark, merge_joins):
    copies = hot_facts(spark, same_rows=True).where("code is null").repartition(64)
    lookup = spark.createDataFrame([("hot", "9"), ("k1", "7")], "city string, code string")
    filled = fill_from_lookup(copies, unique_lookup(lookup, ["city"], "code"), ["city"], "code")
    assert filled.where("city = 'hot' and code = '9'").count() == 10_000
    assert len(partition_sizes(filled.where("city = 'hot'"))) >= 8


def test_rates_spread_a_hot_city(spark, merge_joins):
    people = hot_facts(spark).select("city", F.lit(10).cast("long").alias("people"), "note")
    totals = count_by(hot_facts(spark), ["city"])
    rated = rate_per(people, totals, ["city"], "total", "people")
    assert rated.count() == 60_000
    assert rated.where("city = 'hot' and total = 20000").count() == 20_000
    assert max(partition_sizes(rated)) < 20_000 / 4


def test_rates_on_stored_tables_shuffle_little_and_repair_nothing(spark, merge_joins):
    text = plan(QUERIES["report_venue_rates"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") <= 4
    assert "regexp" not in text and "Generate" not in text


def test_texts_are_counted_by_digest(spark, merge_joins):
    text = plan(QUERIES["find_dupe_text"](spark, SF_DIR))
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert keys and not any("text" in key for key in keys)


def test_aqe_splits_what_the_salts_leave_hot(spark, merge_joins):
    facts = hot_facts(spark).where("code is null")
    lookup = spark.createDataFrame([("hot", "9"), ("k1", "7")], "city string, code string")
    lookup = unique_lookup(lookup, ["city"], "code")
    filled = fill_from_lookup(facts, lookup, ["city"], "code", salts=1)
    assert "skew=true" in final_plan(filled)


def test_rows_with_a_known_value_are_not_shuffled(spark, merge_joins):
    facts = hot_facts(spark)
    lookup = spark.createDataFrame([("hot", "9")], "city string, code string")
    text = plan(fill_from_lookup(facts, lookup, ["city"], "code"))
    top = text[text.index("Union") :]
    first_branch = top[: top.index("SortMergeJoin")]
    assert "hashpartitioning" not in first_branch


def test_dedup_sends_one_row_per_key_and_task(spark):
    df = hot_facts(spark).where("city = 'hot'")
    text = plan(dedup(df, ["city"]))
    assert "partial_min" in text[text.index("hashpartitioning") :]
    assert "Window" not in text
    assert dedup(df, ["city"]).count() == 1


def test_profile_reads_each_column_once_and_counts_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF_DIR}/part.parquet")
    text = plan(profile(df))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(schemas) == sorted(f"{name}:{kind}" for name, kind in df.dtypes)
    assert text.count("Exchange hashpartitioning") == len(df.columns)
    assert text.count("partial_count(1)") == len(df.columns)
    assert "Expand" not in text


def test_attributes_wide_needs_no_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["attributes_wide_parts"](spark, SF_DIR))


def test_ingest_shuffles_once_for_any_number_of_sources(spark):
    sources = [spark.range(10).withColumnRenamed("id", f"c{i}") for i in range(4)]
    parts = [(s, {"n": F.col(f"c{i}")}, f"kind{i}") for i, s in enumerate(sources)]
    assert plan(ingest_tagged(parts, "kind")).count("Exchange") == 1


def test_top_k_does_not_sort_globally(spark):
    ranked = top_k(count_by(spark.range(100), ["id"]), "total", 5, ["id"])
    assert "TakeOrderedAndProject" in plan(ranked)
    assert "rangepartitioning" not in plan(ranked)


def test_queries_on_a_stored_table_prune_folders_and_columns(spark, tmp_path):
    schema = "name string, address string, county string"
    df = spark.createDataFrame([("a", "x", "burgos"), ("b", "y", "soria")], schema)
    write_partitioned(df, str(tmp_path / "t"), ["county"])
    stored = read_partitioned(spark, str(tmp_path / "t"), schema)
    counted = count_by(stored.where(F.col("county") == "burgos"), ["name"])
    text = plan(counted)
    assert re.search(r"PartitionFilters: \[.*county.* = burgos", text)
    assert "ReadSchema: struct<name:string>" in text
    assert rows(counted) == [("a", 1)]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("find_dupes_lineitem", "l_orderkey:bigint,l_linenumber:int"),
        ("count_by_filtered", "p_name:string,p_brand:string,p_type:string"),
        ("distinct_languages", "lang:string"),
    ],
)
def test_scans_read_only_the_columns_needed(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, SF_DIR))


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["sentinel_rows"](spark, SF_DIR))
    assert "EqualTo(event_type,error)" in text
    text = plan(QUERIES["text_theme_matches"](spark, SF_DIR))
    assert "StringContains(text,tion)" in text
