"""Expressions, value by value."""

import re
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from depotflow.functions import dates, numbers, text


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("pattern,value,expected", [
    ("_L%", "Blank", True), ("_L%R_", "Clark", True), ("[B-J]%", "jonas", True), ("[BJ]%", "Clark", False),
    ("%[^a]%", "Adam", True), ("%[^a]%", "aAa", False), ("[A-Z]%", "8Opal", False), ("[A-Z]%", "Überlingen", True),
    ("[a-g]%", "Ärmel", True), ("[a-g]%", "graf", True), ("[a-f]%", "graf", False),
    ("a[1-9][0-9]", "A50", True), ("a[1-9]", "a0", False), ("[[]x]", "[x]", True), ("50%", "50 kg", True),
    ("a.c", "abc", False), ("[0-9][0-9]", "12\n", False), ("a\\b%", "A\\bc", True), ("%", "", True), ("x_", "x\n", True),
])
def test_like(spark, pattern, value, expected):
    assert one(spark, text.like(F.lit(value), pattern)) is expected


def test_like_unknown(spark):
    assert one(spark, text.like(F.lit(None).cast("string"), "[a]%")) is None
    assert one(spark, text.like(F.lit("a%b"), "a!%_", escape="!")) is True
    assert one(spark, text.like(F.lit("a%b"), "[a]!%_", escape="!")) is True
    assert one(spark, text.like(F.lit("axb"), "[a]!%_", escape="!")) is False


def brute_like(value, pattern):
    """LIKE without classes, letter by letter."""
    if not pattern:
        return not value
    if pattern[0] == "%":
        return any(brute_like(value[i:], pattern[1:]) for i in range(len(value) + 1))
    return bool(value) and pattern[0] in ("_", value[0]) and brute_like(value[1:], pattern[1:])


@settings(max_examples=200, deadline=None)
@given(st.text("ab.%\n", max_size=6), st.text("ab.%_", max_size=5))
def test_like_regex_matches_brute_force(value, pattern):
    # Python reads this part of the regex syntax as Java does, but for the end mark.
    regex = text.like_regex(pattern)[:-2] + r"\Z"
    assert bool(re.match(regex, value)) == brute_like(value, pattern)


def test_text(spark):
    assert one(spark, text.byte_length(F.lit("grün"))) == 8
    assert one(spark, text.byte_length(F.lit("😀"))) == 4
    assert one(spark, text.char_count(F.lit("rot  "))) == 3
    assert one(spark, text.replace_text(F.lit("HustenSAFTschmuggler"), "saft", "bier")) == "Hustenbierschmuggler"
    assert one(spark, text.replace_text(F.lit("a.b"), ".", "$1\\")) == "a$1\\b"
    assert one(spark, text.joined_with_blanks(F.lit("a"), 3, F.lit("b"))) == "a   b"
    assert one(spark, text.joined_with_blanks(F.lit("a"), 3, F.lit(None))) is None
    assert one(spark, text.quoted(F.lit("rot"))) == "'rot'"
    assert one(spark, text.shifted_code(F.lit("L05"), "K", 100)) == "K105"
    assert one(spark, text.same_text(F.lit("Rot "), "rOT")) is True
    assert [one(spark, text.valid_postcode(F.lit(v).cast("string"))) for v in ("ABC12", "99082", "990821", "99082\n", None)] \
        == [False, True, False, False, False]


@pytest.mark.parametrize("raw,expected", [
    ("18.05.90", datetime(1990, 5, 18)), ("01.08.1990", datetime(1990, 8, 1)), ("10.06.22", datetime(2022, 6, 10)),
    ("1.1.50", datetime(1950, 1, 1)), ("31.12.49", datetime(2049, 12, 31)),
])
def test_german_dates(spark, raw, expected):
    assert one(spark, dates.parse_german(F.lit(raw))) == expected
    assert dates.german(raw) == expected


def test_german_text(spark):
    day = F.lit(datetime(1990, 8, 5, 13, 30)).cast("timestamp_ntz")
    assert one(spark, dates.german_text(day)) == "05.08.1990"
    assert one(spark, dates.month_name(day)) == "August"
    assert one(spark, dates.weekday_name(day)) == "Sonntag"
    assert one(spark, dates.long_date(day)) == "Sonntag der 5. August 1990"
    assert one(spark, dates.day_month_year(F.lit(date(2022, 6, 29)), "#")) == "29#6#2022"
    assert one(spark, dates.week_sentence(F.lit(date(2022, 7, 17)))) == "Sonntag in der 28 Kalenderwoche"


def test_weeks(spark):
    assert one(spark, dates.iso_week(F.lit(date(2021, 1, 1)))) == 53
    assert one(spark, dates.iso_week(F.lit(date(2022, 7, 17)))) == 28
    assert one(spark, dates.weekday_number(F.lit(date(2022, 7, 17)))) == 7
    assert one(spark, dates.weekday_number(F.lit(date(2022, 7, 17)), first_day=7)) == 1
    # 1 January 2021 was a Friday: week 1 ended on the 3rd.
    assert one(spark, dates.week_of_year(F.lit(date(2021, 1, 3)))) == 1
    assert one(spark, dates.week_of_year(F.lit(date(2021, 1, 4)))) == 2
    assert one(spark, dates.week_of_year(F.lit(date(2021, 1, 3)), first_day=7)) == 2


def test_boundaries(spark):
    def months(a, b):
        return one(spark, dates.months_between(F.lit(a), F.lit(b)))

    assert months(date(2021, 8, 31), date(2021, 9, 1)) == 1
    assert months(date(2021, 8, 1), date(2021, 8, 31)) == 0
    assert months(date(2022, 1, 1), date(2021, 12, 31)) == -1
    late, early = (F.lit(datetime(2021, 1, 1 + i, 23 - 23 * i)).cast("timestamp_ntz") for i in (0, 1))
    assert one(spark, dates.days_between(late, early)) == 1


def test_day_ranges(spark):
    noon = F.lit(datetime(2022, 6, 30, 12)).cast("timestamp_ntz")
    assert one(spark, dates.at(noon, date(2022, 6, 30))) is False
    assert one(spark, dates.on_day(noon, date(2022, 6, 30))) is True
    assert one(spark, dates.between_literals(noon, date(2022, 6, 29), date(2022, 6, 30))) is False
    assert one(spark, dates.through_days(noon, date(2022, 6, 29), date(2022, 6, 30))) is True
    assert one(spark, dates.in_month(F.lit(datetime(2022, 12, 31, 23)).cast("timestamp_ntz"), 2022, 12)) is True
    assert one(spark, dates.same_day(noon, F.lit(datetime(2022, 6, 30)).cast("timestamp_ntz"))) is True


def test_month_numbers():
    assert [dates.month_number(t) for t in ("8", "August", "juli", "März", "0", "13", "Foo", "-1")] \
        == [8, 8, 7, 3, None, None, None, None]


def test_numbers(spark):
    assert one(spark, numbers.whole_division(F.lit(5), F.lit(2))) == 2
    assert one(spark, numbers.whole_division(F.lit(-5), F.lit(2))) == -2
    assert one(spark, numbers.ratio(F.lit(5.88), F.lit(0.0))) is None
    assert one(spark, numbers.ratio_status(F.lit(0.0))) == 8
    assert one(spark, numbers.ratio(F.lit(None).cast("double"), F.lit(4.0))) == 0.25
    assert one(spark, numbers.ratio(F.lit(12.88), F.lit(None).cast("double"))) == 12.88
    drawn = spark.range(5).select(numbers.statement_random(1)).distinct().collect()
    assert len(drawn) == 1 and 0 <= drawn[0][0] < 1
    assert one(spark, F.round(F.lit(233.871), 2)) == 233.87 and one(spark, F.round(F.lit(233.871), -2)) == 200
