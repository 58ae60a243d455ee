import pytest
from pyspark.sql import functions as F

from subtide.functions.numbers import (
    decimal_text,
    money_text,
    percent,
    percent_text,
    ratio,
    round_as_printed,
    round_half_even,
)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "number, places, text",
    [
        (13.0, 0, "13.0"),
        (66.7, 1, "66.7"),
        (2.5, 2, "2.5"),
        (100.0, 2, "100.0"),
        (0.05, 2, "0.05"),
        (-4.0, 1, "-4.0"),
        (123456789012.5, 1, "123456789012.5"),
        (None, 1, None),
    ],
)
def test_decimal_text(spark, number, places, text):
    assert value(spark, decimal_text(F.lit(number).cast("double"), places)) == text


@pytest.mark.parametrize("number", [0.25, 0.35, 6.25, 12.25, 33.333, 49.95, 1234.55, 0.05, 99.95])
def test_roundings_agree_with_python(spark, number):
    assert value(spark, round_as_printed(F.lit(number), 1)) == float(f"{number:.1f}")
    scaled = round(number * 10) / 10
    assert value(spark, round_half_even(F.lit(number), 1)) == scaled


def test_ratios_by_zero_are_missing(spark):
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, percent(F.lit(1), F.lit(0), 1)) is None
    assert value(spark, percent(F.lit(1), F.lit(3), 1)) == 33.3


def test_display_texts(spark):
    assert value(spark, money_text(F.lit(1234567))) == "$1,234,567"
    assert value(spark, percent_text(F.lit(12.34))) == "12.3%"
