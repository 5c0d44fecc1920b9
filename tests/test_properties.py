"""Operators against plain-Python brute force on random small tables."""

import re
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from comarca.functions import repair_text, to_int
from comarca.operators import (
    bucket_sums,
    count_matrix,
    dedup,
    derive_dimension,
    fill_from_lookup,
    find_dupes,
    profile,
    unique_lookup,
)
from comarca.sources import read_partitioned, scratch_path, write_partitioned
from helpers import rows

SCHEMA = "name string, county string, city string, code string, age int, people int"

few = st.sampled_from(["a", "b", "c", None])
record = st.tuples(
    few,
    st.sampled_from(["x", "y"]),
    few,
    st.sampled_from(["01", "02", None]),
    st.one_of(st.none(), st.integers(0, 100)),
    st.one_of(st.none(), st.integers(0, 9)),
)
tables = st.lists(record, max_size=30)
quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def table(spark, records):
    return spark.createDataFrame(records, SCHEMA)


def null_first(values):
    return [(v is not None, v) for v in values]


@quick
@given(tables)
def test_dedup(spark, records):
    df = table(spark, records)
    best = {}
    for r in records:
        key, rest = r[:2], r[2:]
        if key not in best or null_first(rest) < null_first(best[key][2:]):
            best[key] = r
    assert Counter(rows(dedup(df, ["name", "county"]))) == Counter(best.values())


@quick
@given(tables)
def test_fill(spark, records):
    df = table(spark, records)
    dimension = {(county, city, code) for _, county, city, code, _, _ in records if code}
    known = defaultdict(list)
    for _, city, code in dimension:
        known[city].append(code)
    answers = {c: v[0] for c, v in known.items() if len(v) == 1 and c is not None}
    expected = [(*r[:3], r[3] or answers.get(r[2]), *r[4:]) for r in records]
    lookup = unique_lookup(derive_dimension(df, ["county", "city", "code"], ["code"]), ["city"], "code")
    assert Counter(rows(fill_from_lookup(df, lookup, ["city"], "code"))) == Counter(expected)


@quick
@given(tables)
def test_find_dupes(spark, records):
    counted = Counter(r[:3] for r in records)
    expected = {(*key, n) for key, n in counted.items() if n > 1}
    found = rows(find_dupes(table(spark, records), ["name", "county", "city"]))
    assert len(found) == len(expected)
    assert set(found) == expected


@quick
@given(tables)
def test_profile(spark, records):
    expected = set()
    for i, name in enumerate(["name", "county", "city", "code", "age", "people"]):
        values = Counter(str(r[i]) for r in records if r[i] is not None)
        top = min(values.items(), key=lambda item: (-item[1], item[0]), default=(None, None))
        expected.add((name, sum(values.values()), len(values), *top))
    assert set(rows(profile(table(spark, records)))) == expected


@quick
@given(tables)
def test_bucket_sums_add_up(spark, records):
    buckets = {"low": (None, 15), "mid": (16, 80), "high": (81, None)}
    known = [(*r[:4], r[4], r[5] or 0) for r in records]
    expected = defaultdict(lambda: [0, 0, 0])
    for _, county, _, _, age, people in known:
        sums = expected[county]
        if age is not None:
            sums[0 if age <= 15 else 1 if age <= 80 else 2] += people
    summed = bucket_sums(table(spark, known), ["county"], "age", "people", buckets, "total")
    assert rows(summed) == sorted((k, *v, sum(v)) for k, v in expected.items())


@quick
@given(tables)
def test_count_matrix(spark, records):
    expected = defaultdict(lambda: [0, 0, 0])
    for name, _, city, _, age, _ in records:
        expected[city][0] += name == "a"
        expected[city][1] += name == "b"
        expected[city][2] += age is not None
    kinds = {"as": "a", "bs": "b"}
    counted = count_matrix(table(spark, records), ["city"], "name", kinds, "age")
    assert set(rows(counted)) == {(k, *v) for k, v in expected.items()}


@quick
@given(tables)
def test_write_and_read_back(spark, records):
    df = table(spark, records)
    path = scratch_path(spark, "property")
    write_partitioned(df, path, ["county", "code"])
    back = read_partitioned(spark, path, SCHEMA)
    assert Counter(rows(back)) == Counter(rows(df))


letters = st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40)


@quick
@given(st.lists(letters, max_size=50))
def test_garbled_text_is_always_repaired(spark, texts):
    pairs = [(text, text.encode("utf-8").decode("iso-8859-1")) for text in texts]
    df = spark.createDataFrame(pairs, "clean string, garbled string")
    assert df.where(repair_text("garbled") != df.clean).count() == 0


def read_again(text):
    """The text decoded whole if that works, else its garbled letters one by one."""
    try:
        return text.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return re.sub(
            "[\xc2\xc3][\x80-\xbf]", lambda m: m[0].encode("latin-1").decode("utf-8"), text
        )


high = st.sampled_from([chr(n) for n in range(0x7F, 0x102)] + ["Ã", "Â", "\n", "a", "–"])


@quick
@given(st.lists(st.text(high, max_size=6), max_size=200))
def test_text_is_read_again_whole_or_by_letter(spark, texts):
    df = spark.createDataFrame([(text, read_again(text)) for text in texts], "s string, t string")
    assert df.where(repair_text("s") != df.t).count() == 0


@quick
@given(st.lists(st.integers(-(2**31), 2**31 - 1), max_size=50))
def test_dotted_numbers_are_parsed(spark, numbers):
    pairs = [(n, f"{n:,}".replace(",", ".")) for n in numbers]
    df = spark.createDataFrame(pairs, "n int, written string")
    assert rows(df.select("n")) == rows(df.select(to_int("written")))
