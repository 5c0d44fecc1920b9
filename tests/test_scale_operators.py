"""Bloom filters, sums before pieces, and what they spare."""

from collections import Counter

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from comarca.operators import (
    Traced,
    audit,
    bloom_filter,
    canonicalise,
    cannot_have,
    dedup,
    drop_sentinel,
    find_long_dupes,
    hot_keys,
    join_spread,
    may_have,
    profile_sketch,
    starts_before,
    value_pairs,
    value_sets,
    value_sets_up_to,
)
from comarca.plans import tables
from helpers import plan, rows

KEYS = ["a", "b"]


def keyed(spark, n, every=1):
    a = F.when(F.col("id") % 7 != 0, F.col("id"))
    return spark.range(0, n, every).select(a.alias("a"), F.concat(F.lit("x"), "id").alias("b"), F.lit("row").alias("note"))


def test_a_filter_loses_no_row_and_passes_few_others(spark):
    found = bloom_filter(keyed(spark, 100_000, 50).select("a", "b"), KEYS)
    facts = keyed(spark, 100_000)
    passed = may_have(facts, found, KEYS)
    assert passed.columns == facts.columns
    listed = {r["b"] for r in passed.collect()}
    assert {f"x{k}" for k in range(0, 100_000, 50)} <= listed
    assert len(listed) < 2000 + 1000
    others = cannot_have(facts, found, KEYS)
    assert rows(others.unionByName(passed)) == rows(facts)


def test_a_filter_is_bounded_and_may_be_empty(spark):
    found = bloom_filter(keyed(spark, 200_000).select("a", "b"), KEYS)
    assert found.count() <= 4096
    assert found.agg(F.max(F.octet_length("_bits"))).first()[0] == 4096
    none = bloom_filter(keyed(spark, 0), KEYS)
    facts = keyed(spark, 100)
    assert may_have(facts, none, KEYS).count() == 0 and cannot_have(facts, none, KEYS).count() == 100


def texts(spark, n):
    """Long texts: one is a third of all rows, some come twice, most once; some are null or empty."""
    own = F.repeat(F.sha2(F.col("id").cast("string"), 256), 20)
    text = F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot "), 300)).when(F.col("id") % 100 == 1, F.lit(None))
    text = text.when(F.col("id") % 100 == 2, F.lit("")).when(F.col("id") % 50 == 4, F.repeat(F.floor(F.col("id") / 100).cast("string"), 200))
    return spark.range(n, numPartitions=8).select(F.col("id"), text.otherwise(own).alias("text"))


def test_only_texts_that_repeat_leave_the_tasks_that_read_them(spark, tmp_path):
    texts(spark, 6000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    expected = Counter(r["text"] for r in stored.collect())
    found = find_long_dupes(stored, "text")
    assert {r["text"]: r["count"] for r in found.collect()} == {t: n for t, n in expected.items() if n > 1}
    counts = [r["count"] for r in found.collect()]
    assert counts == sorted(counts, reverse=True)
    text = found._jdf.queryExecution().executedPlan().toString()
    before_shuffle = text[text.index("partial_min") :]
    assert "BroadcastHashJoin" in before_shuffle
    # What passes the filter: the rows that repeat, and hardly any other.
    hashed = stored.select(F.coalesce(F.sha2("text", 256), F.lit("")).alias("d"))
    repeated = bloom_filter(hashed.groupBy("d").count().where("count > 1"), ["d"])
    repeats = sum(n for n in expected.values() if n > 1)
    assert repeats <= may_have(hashed, repeated, ["d"]).count() <= repeats + 20


@pytest.mark.parametrize("blocks", [1, 7, 1024])
def test_starts_before(spark, blocks):
    pieces = spark.range(3000).select((F.lit(2999) - F.col("id")).alias("number"), (F.col("id") % 11).alias("size"))
    pieces = pieces.unionByName(spark.createDataFrame([(5000, None), (5001, 2)], "number long, size long"))
    found = starts_before(pieces, F.floor(F.col("number") / blocks), "number", "size").orderBy("number").collect()
    at = 0
    for row in found:
        assert row["start"] == at
        at += row["size"] or 0
    assert starts_before(pieces.limit(0), "number", "number", "size").count() == 0


def facts_with_hot_keys(spark, n=60_000):
    """Key 0 has a third of the rows, 2 and 3 a thirtieth each, some have none; the rest one each."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.col("id") % 3 + 1).when(F.col("id") % 10 == 4, F.lit(None))
    return spark.range(n, numPartitions=6).select(key.otherwise(F.col("id") + 10).alias("k"), F.lit("x").alias("j"), F.col("id").alias("v"))


def hashes(spark, keys):
    df = spark.createDataFrame([(k, "x") for k in keys], "k long, j string")
    return {r[0] for r in df.select(F.xxhash64("k", "j")).collect()}


def test_hot_keys_are_measured(spark):
    facts = facts_with_hot_keys(spark).withColumn("k", F.col("k").cast("long"))
    counts = {r["k"]: r["count"] for r in facts.where("k is not null").groupBy("k").count().collect()}
    hot = {k for k, n in counts.items() if n >= 1000}
    assert len(hot) == 3 and 0 in hot
    assert set(hot_keys(facts, ["k", "j"])) == hashes(spark, hot)
    assert hot_keys(spark.range(50_000).select(F.col("id").alias("k")), ["k"]) == []
    assert hot_keys(spark.range(0).select(F.col("id").alias("k")), ["k"]) == []
    assert hot_keys(facts.where("k is null"), ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("kind", ["long", "int"])
def test_only_hot_keys_repeat_the_lookup(spark, how, kind):
    facts = facts_with_hot_keys(spark, 12_000).withColumn("k", F.col("k").cast("long"))
    lookup = spark.range(12_020).select(F.col("id").cast(kind).alias("k"), F.lit("x").alias("j"), (F.col("id") * 2).alias("w"))
    joined = join_spread(facts, lookup, ["k", "j"], how)
    assert rows(joined) == rows(facts.join(lookup, ["k", "j"], how))


def repeated_rows(spark, facts, lookup, monkeypatch):
    """How many rows the lookup has on its side of the join."""
    sizes = []
    frame = type(lookup)
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, other, *rest: sizes.append(other.count()) or join(self, other, *rest))
    join_spread(facts, lookup, ["k", "j"], "inner")
    return sizes[-1]


def test_a_uniform_table_has_its_lookup_once(spark, monkeypatch):
    lookup = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("j"))
    uniform = spark.range(40_000).select((F.col("id") % 20_000).alias("k"), F.lit("x").alias("j"))
    assert repeated_rows(spark, uniform, lookup, monkeypatch) == 20_000
    skewed = facts_with_hot_keys(spark).withColumn("k", F.col("k").cast("long"))
    assert repeated_rows(spark, skewed, lookup, monkeypatch) == 20_000 + 3 * 15


def test_rows_without_a_key_are_spread_in_a_left_join(spark):
    facts = spark.range(8000, numPartitions=4).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([(1, 2)], "k long, w long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_spread(facts, lookup, ["k"], "left")
        sizes = joined.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 8000 and max(sizes) < 4000


# Traced cleanups -----------------------------------------------------------------------

COUNTIES = ["Avila", "ávila", "LEON", "madrid", None, "Zamora"]
ENTRIES = "name string, address string, county string, city string, postal_code string, sports string, social_kind string"


def entries(spark, n=2000):
    county = F.get(F.array(*[F.lit(c) for c in COUNTIES]), (F.col("id") * 7 % 6).cast("int"))
    name = F.when(F.col("id") % 9 == 0, "ANULADO").when(F.col("id") % 11 != 0, F.concat(F.lit("n"), F.col("id") % 40))
    return spark.range(n, numPartitions=6).select(
        name.alias("name"), F.concat(F.lit("a"), F.col("id") % 77).alias("address"), county.alias("county"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("city"), F.lit("1").alias("postal_code"),
        F.lit("s").alias("sports"), F.lit("association").alias("social_kind"),
    )


def by_steps(df, first):
    """The cleanup step by step, each counted on its own."""
    fixes, valid, keys = tables.fixed.COUNTY_FIXES, tables.fixed.VALID_COUNTIES, tables.UNIQUE["social"]
    kept = drop_sentinel(df, "name", ["ANULADO"])
    one = canonicalise(kept, "county", fixes, valid) if first else dedup(kept, keys)
    two = dedup(one, keys) if first else canonicalise(one, "county", fixes, valid)
    return two, [r["rows"] for r in audit([("a", df), ("b", kept), ("c", one), ("d", two)]).collect()]


@pytest.mark.parametrize("first", [False, True])
def test_a_trace_gives_the_table_and_the_counts_of_its_steps(spark, first):
    df = entries(spark)
    expected, counts = by_steps(df, first)
    trace = tables.social_trace(df, first)
    assert rows(trace.table()) == rows(expected) == rows(tables.clean_social(df, first))
    assert trace.table().columns == df.columns and trace.table().dtypes == df.dtypes
    found = trace.audit().collect()
    assert [r["rows"] for r in found] == counts and len(set(counts)) == 4
    names = ["in a county", "one per key"] if first else ["one per key", "in a county"]
    assert [r["step"] for r in found] == ["gathered", "without voided", *names]
    assert [r["rows"] for r in tables.social_trace(df.limit(0)).audit().collect()] == [0, 0, 0, 0]


def test_counts_come_from_one_scan_and_one_dedup(spark, tmp_path):
    entries(spark).write.parquet(str(tmp_path / "e"))
    text = plan(tables.social_trace(spark.read.parquet(str(tmp_path / "e"))).audit())
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_counts_are_the_same_when_tasks_fail_and_run_again(spark):
    def failing_once(batches):
        context = TaskContext.get()
        yield from batches
        if context.attemptNumber() == 0 and context.partitionId() % 2:
            raise RuntimeError("lost")

    df = entries(spark)
    shaky = df.mapInPandas(failing_once, ENTRIES)
    for first in (False, True):
        assert rows(tables.social_trace(shaky, first).audit()) == rows(tables.social_trace(df, first).audit())


# Sketched profiles ---------------------------------------------------------------------


def test_a_sketched_profile_keeps_to_its_errors_in_one_scan(spark, tmp_path):
    n = 120_000
    spark.range(n, numPartitions=6).select(
        F.col("id").alias("own"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 30_000)).alias("mixed"),
        (F.col("id") % 40).alias("few"),
        F.when(F.col("id") % 2 == 0, F.lit("b")).when(F.col("id") % 5 > 0, F.lit("a")).alias("gaps"),
        F.lit(None).cast("string").alias("none"),
    ).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = profile_sketch(stored)
    assert plan(found).count("FileScan") == 1 and plan(found).count("Exchange") == 1
    found = {r["column"]: r for r in found.collect()}
    exact = {c: Counter(str(r[0]) for r in stored.select(c).collect() if r[0] is not None) for c in stored.columns}
    for name, counted in exact.items():
        row = found[name]
        assert row["count"] == sum(counted.values())
        assert abs(row["unique"] - len(counted)) <= row["unique_error"] * len(counted)
        if row["freq"] is not None:
            assert counted[row["top"]] <= row["freq"] <= counted[row["top"]] + row["freq_error"]
            assert max(counted.values()) <= row["freq"]
    assert (found["few"]["top"], found["few"]["freq"], found["few"]["freq_error"]) == ("0", 3000, 0)
    assert (found["gaps"]["top"], found["gaps"]["freq"], found["gaps"]["freq_error"]) == ("b", 60_000, 0)
    assert found["mixed"]["top"] == "hot" and found["mixed"]["freq_error"] > 0
    assert (found["own"]["top"], found["own"]["freq"]) == (None, None)
    assert tuple(found["none"])[1:5] == (0, 0, None, None)


def test_a_sketched_profile_of_nothing(spark):
    df = spark.createDataFrame([], "a string, `b c` int")
    assert [tuple(r)[:5] for r in profile_sketch(df).collect()] == [("a", 0, 0, None, None), ("b c", 0, 0, None, None)]


# Value sets ----------------------------------------------------------------------------


def with_many_values(spark, n=30_000):
    """Key "many" has a third of all values, null some; the others a few each, one of them none."""
    key = F.when(F.col("id") % 3 == 0, "many").when(F.col("id") % 10 > 0, F.concat(F.lit("k"), F.col("id") % 7000))
    value = F.when(key != "k1", F.col("id") % 20_000)
    return spark.range(n, numPartitions=6).select(key.alias("k"), value.alias("v"))


def test_sets_up_to_a_limit_equal_the_sets(spark):
    df = with_many_values(spark)
    whole = {r["k"]: r["values"] for r in value_sets(df, ["k"], "v").collect()}
    found = {r["k"]: (r["size"], r["values"]) for r in value_sets_up_to(df, ["k"], "v", 100).collect()}
    assert found == {k: (len(v), v if len(v) <= 100 else None) for k, v in whole.items()}
    assert found["many"][1] is None and found["k1"] == (0, []) and None in found
    pairs = Counter(r["k"] for r in value_pairs(df, ["k"], "v").collect())
    assert pairs == Counter({k: len(v) for k, v in whole.items() if v})
    assert value_sets_up_to(df.limit(0), ["k"], "v", 100).count() == 0


def test_a_key_with_many_values_is_in_no_one_task(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = with_many_values(spark).withColumn("k", F.coalesce("k", F.lit("none")))
        pairs = value_pairs(df, ["k"], "v")
        sized = join_spread(pairs, pairs.select("k").distinct(), ["k"], "inner")
        many = sized.where("k = 'many'").rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(many) == 10_000 and max(many) < 5_000
