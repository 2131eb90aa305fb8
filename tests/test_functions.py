import datetime as dt

from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.functions import fixed


def one(spark, values, schema, expr):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_parse_flag_words_and_default(spark):
    vals = ["true", "1", "OUI", "Yes", "false", "0", "non", "NO", "maybe", None]
    got = one(spark, vals, "x string", fx.parse_flag("x"))
    assert got == [True, True, True, True, False, False, False, False, True, True]


def test_valid_email_accepts_one_label_domain_only(spark):
    vals = ["a.b+c@mail.com", "a@b.co.uk", "no-at.com", "x@y.c", None]
    assert one(spark, vals, "x string", fx.valid_email("x")) == ["a.b+c@mail.com", None, None, None, None]


def test_clean_phone_keeps_digits_and_plus(spark):
    assert one(spark, ["+33 (6) 12-34", "06.12"], "x string", fx.clean_phone("x")) == ["+3361234", "0612"]


def test_initcap_splits_on_spaces_only(spark):
    assert one(spark, [" jEAN-paul dupont "], "x string", fx.initcap_trim("x")) == ["Jean-paul Dupont"]


def test_blank_covers_tabs_and_unicode_space(spark):
    vals = ["", "   ", "\t\n", " ", "x", " a ", None]
    assert one(spark, vals, "x string", fx.is_blank("x")) == [True, True, True, True, False, False, True]


def test_to_double_guards_java_only_forms(spark):
    vals = [" 12.5 ", "1e3", "-5", "1.0d", "NaN", "1_000", "abc", "", None, ".5"]
    got = one(spark, vals, "x string", fx.to_double("x"))
    assert got == [12.5, 1000.0, -5.0, None, None, None, None, None, None, 0.5]


def test_age_is_17_on_18th_birthday(spark):
    # floor(days / 365.25) under-counts on the birthday itself
    df = spark.createDataFrame([(dt.date(2008, 4, 20),)], "b date")
    assert df.select(fx.age_years("b", "2026-04-20")).first()[0] == 17


def test_bands_and_loyalty_with_nulls(spark):
    ages = [18, 25, 26, 35, 36, 50, 51, 65, 66, None]
    got = one(spark, ages, "a int", fx.age_band("a"))
    assert got == ["18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "51-65", "51-65", "65+", "65+"]
    ten = [0, 364, 365, 1094, 1095, None]
    assert one(spark, ten, "t int", fx.loyalty("t")) == ["BRONZE", "BRONZE", "SILVER", "SILVER", "GOLD", "BRONZE"]


def test_round_is_half_up_on_decimal_text(spark):
    vals = [1.005, 2.675, 100.0]
    assert one(spark, vals, "x double", F.round("x", 2)) == [1.01, 2.68, 100.0]
    assert one(spark, [10.0], "x double", fx.with_tax("x")) == [12.0]


def test_truncate_and_lookup_default(spark):
    assert len(one(spark, ["x" * 600], "x string", fx.truncate("x"))[0]) == fixed.ALERT_MESSAGE_MAX
    got = one(spark, ["CRITICAL", "INFO", "--severity", None], "s string",
              fx.lookup("s", fixed.SEVERITY_COLOURS, fixed.SEVERITY_COLOUR_OTHER))
    assert got == ["#FF0000", "#0000FF", "#808080", "#808080"]


def test_date_parts_zero_padded_and_null(spark):
    df = spark.createDataFrame([("2024-03-07",), ("n/a",)], "d string").select(fx.parse_date("d").alias("d"))
    rows = df.select(fx.year_str("d"), fx.month_str("d"), fx.day_str("d")).collect()
    assert [tuple(r) for r in rows] == [("2024", "03", "07"), (None, None, None)]
