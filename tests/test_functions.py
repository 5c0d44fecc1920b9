"""Column expressions: text, numbers, labels."""

import pytest
from pyspark.sql import functions as F

from comarca.functions import (
    code_to_label,
    contains_any,
    has_prefix,
    indicator,
    leading_int,
    per_unit,
    repair_text,
    strip_code,
    to_int,
)


def evaluate(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def garble(text):
    return text.encode("utf-8").decode("iso-8859-1")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_repair_text(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        clean = ["áéíóú ÁÉÍÓÚ üÜ ñÑ", "Ábabuj", "plain", "", "日本", "naïve – dash", "Ñ"]
        garbled = [garble(text) for text in clean]
        assert evaluate(spark, repair_text("c"), garbled) == clean
        assert evaluate(spark, repair_text("c"), clean) == clean
        assert evaluate(spark, repair_text("c"), [None]) == [None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_repair_text_covers_every_letter_once_replaced_one_by_one(spark):
    letters = "áÁéíÍóÓÚúüñ"
    assert evaluate(spark, repair_text("c"), [garble(c) for c in letters]) == list(letters)


def test_repair_text_is_idempotent(spark):
    values = [garble("Peñón"), "Peñón", "x"]
    once = repair_text("c")
    assert evaluate(spark, repair_text(once), values) == evaluate(spark, once, values)


def test_contains_any(spark):
    values = ["Museo del Vino", "casa de vinos", "Queso", "pan", None]
    found = evaluate(spark, contains_any("c", ["Vino", "vino", "ueso"]), values)
    assert found == [True, True, True, False, None]


def test_has_prefix(spark):
    values = ["05001  X", "50500  Y", "TOTAL", None]
    assert evaluate(spark, has_prefix("c", ["05", "09"]), values) == [True, False, False, None]


def test_strip_code(spark):
    values = ["44990  Lugarejo", "05019 Ávila", "05 La Y de Z", "TOTAL", None]
    assert evaluate(spark, strip_code("c"), values) == ["Lugarejo", "Ávila", "La Y de Z", "", None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_to_int(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = ["1.204", "..", "", "7", "12.345.678", "x", None, "-3"]
        assert evaluate(spark, to_int("c"), values) == [1204, 0, None, 7, 12345678, None, None, -3]
        large = ["9.999.999.999"]
        assert evaluate(spark, to_int("c"), large) == [None]
        assert evaluate(spark, to_int("c", data_type="long"), large) == [9999999999]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_leading_int(spark):
    values = ["0 años", "1 año", "100 y más", "Total", "", None]
    assert evaluate(spark, leading_int("c"), values) == [0, 1, 100, None, None, None]


def test_per_unit(spark):
    df = spark.createDataFrame([(3, 60000), (1, 0), (None, 5), (2, None)], "n long, d long")
    assert [r[0] for r in df.select(per_unit("n", "d")).collect()] == [5.0, None, None, None]
    assert dict(df.select(per_unit("n", "d").alias("r")).dtypes) == {"r": "double"}


def test_code_to_label(spark):
    labels = {"05": "ávila", "09": "burgos"}
    assert evaluate(spark, code_to_label("c", labels), ["05", "28", None]) == ["ávila", None, None]
    assert evaluate(spark, code_to_label("c", labels, "other"), ["28"]) == ["other"]
    assert evaluate(spark, code_to_label("c", labels, F.col("c")), ["28"]) == ["28"]


def test_indicator(spark):
    assert evaluate(spark, indicator("c", "a"), ["a", "b", None]) == [1, None, None]
