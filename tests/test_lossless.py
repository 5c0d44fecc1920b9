"""What once lost or swapped data without an error."""

import pytest

from comarca.functions.text import repair_text
from comarca.operators.enrich import join_spread, unique_lookup
from comarca.plans import fixed, tables
from comarca.sources import read_delimited


def venue_file(folder, name):
    headers = list(dict.fromkeys(fixed.VENUE_COLUMNS.values()))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(";".join(headers) + "\n" + ";".join(f"{h}-{folder.name}-{name}" for h in headers) + "\n", "latin-1")


@pytest.mark.parametrize(
    "files", [["2020/bares.csv", "2021/bares.csv"], ["all/bares.norte.csv", "all/bares.sur.csv"]]
)
def test_files_of_one_stem_are_all_kept(spark, tmp_path, files):
    for file in files:
        folder, name = file.split("/")
        venue_file(tmp_path / folder, name)
    gathered = tables.load_venues(spark, f"{tmp_path}/", files)
    assert gathered.count() == 2
    assert {row["garito_kind"] for row in gathered.collect()} == {"bares"}


def test_mixed_headers_are_refused(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a;b\n1;2\n")
    (tmp_path / "two.csv").write_text("b;a\n3;4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path)).collect()


def test_helper_names_do_not_clash(spark):
    facts = spark.createDataFrame([(1, "kept")], "key int, _salt string")
    lookup = spark.createDataFrame([(1, "x")], "key int, value string")
    assert [tuple(row) for row in join_spread(facts, lookup, ["key"], "inner").collect()] == [(1, "kept", "x")]
    known = spark.createDataFrame([(1, "x")], "_known int, value string")
    assert unique_lookup(known, ["_known"], "value").count() == 1


def test_large_counts_stay_in_the_sum(spark):
    columns = {name: "" for name in (fixed.MUNICIPALITY, fixed.SEX, fixed.AGE, fixed.PEOPLE)}
    code = next(iter(fixed.COUNTY_OF_CODE))
    names = list(columns)
    values = [(f"{code}999 Nuevo", fixed.BOTH_SEXES, "3 años", "3.000.000.000"), (f"{code}999 Nuevo", fixed.BOTH_SEXES, "4 años", "5")]
    raw = spark.createDataFrame(values, ", ".join(f"`{name}` string" for name in names))
    row = tables.population(raw).first().asDict()
    assert sum(v for v in row.values() if isinstance(v, int)) >= 3_000_000_005, row


def test_mixed_text_is_repaired(spark):
    texts = ["EspaÃ±a ñ", "日本 Ã±", "España", "Ávila 日本", "Ã", "a\nÃ¡ é", None]
    found = spark.createDataFrame([(t,) for t in texts], "c string").select(repair_text("c")).collect()
    assert [row[0] for row in found] == ["España ñ", "日本 ñ", "España", "Ávila 日本", "Ã", "a\ná é", None]
