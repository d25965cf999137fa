"""Scalar functions on single values."""

import pytest
from pyspark.sql import functions as F

from bazaarlake.functions import dates, numbers, text
from bazaarlake.sources.files import parse_moment


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("wOULDN'T o'BRIEN mary-jane 3rd st.", "Wouldn'T O'Brien Mary-Jane 3rd St."),
        ("", ""),
        (None, None),
        ("x2y #abc  d", "X2y #Abc  D"),
    ],
)
def test_title_case(spark, given, expected):
    assert value(spark, text.title_case(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("they'll say don't", "They'll Say Don't"),
        ("'tis o'malley's", "'tis O'malley's"),
        ("o'day i'd", "O'day I'd"),
    ],
)
def test_contractions(spark, given, expected):
    assert value(spark, text.repair_contractions(text.title_case(F.lit(given)))) == expected


@pytest.mark.parametrize("given", [None, "", "  ", "nan", "NaN", " NAN "])
def test_unknown(spark, given):
    assert value(spark, text.title_or_unknown(F.lit(given).cast("string"))) == "Unknown"


@pytest.mark.parametrize(
    "given, expected",
    [("13days", 13), ("-2", 2), ("1.5", 15), ("", None), ("none", None), (None, None)],
)
def test_digits_int(spark, given, expected):
    assert value(spark, text.digits_int(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("10%%", 0.10),
        ("20pct", 0.20),
        ("1", 0.01),
        ("12.5%", 0.125),
        ("none", 0.0),
        (None, 0.0),
    ],
)
def test_discount(spark, given, expected):
    assert float(value(spark, text.discount_fraction(F.lit(given).cast("string")))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("(099) 945-67", "099-945-67"),
        ("9994567", "999-456-7"),
        ("-123456-", "123456"),
        (" ", "Unknown"),
        (None, "Unknown"),
    ],
)
def test_phone(spark, given, expected):
    assert value(spark, text.phone_dashed(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    "born, on, years",
    [
        ("2000-02-29", "2026-02-28", 25),
        ("2000-02-29", "2026-03-01", 26),
        ("1990-05-05", "2020-05-05", 30),
        ("1990-05-06", "2020-05-05", 29),
    ],
)
def test_age(spark, born, on, years):
    age = dates.age_years(F.lit(born).cast("timestamp"), F.lit(on).cast("date"))
    assert value(spark, age) == years


def test_dates(spark):
    day = F.lit("2024-05-06").cast("date")
    assert value(spark, dates.date_key(day)) == 20240506
    assert str(value(spark, dates.key_date(F.lit(20240506)))) == "2024-05-06"
    assert value(spark, dates.month_name_padded(day)) == "May      "
    assert value(spark, dates.iso_weekday(day)) == 1


def test_rounding_is_half_away_from_zero(spark):
    def mean(total, count):
        return value(spark, numbers.mean(F.lit(total).cast("decimal(18,2)"), F.lit(count)))

    assert mean("0.01", 2) == 0.01
    assert mean("-0.01", 2) == -0.01
    assert mean("10.00", 3) == 3.33
    assert mean("10.00", 0) is None
    assert value(spark, numbers.percent(F.lit(1), F.lit(8))) == 12.5


def test_label_keeps_the_separator_of_a_missing_part(spark):
    assert value(spark, text.label(" - ", F.lit(None).cast("string"), F.lit("x"))) == " - x"


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2021-03-04", "2021-03-04 00:00:00"),
        ("2021-03-04 05:06:07", "2021-03-04 05:06:07"),
        ("3/4/21", "2021-03-04 00:00:00"),
        ("3/4/75 9:05", "1975-03-04 09:05:00"),
        ("3/4/2021", "2021-03-04 00:00:00"),
        ("2021-99-99", "None"),
        ("soon", "None"),
    ],
)
def test_parse_moment(spark, given, expected):
    moment = F.date_format(parse_moment(F.lit(given)), "yyyy-MM-dd HH:mm:ss")
    assert str(value(spark, moment)) == expected
