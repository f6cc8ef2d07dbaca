"""Date expressions: German texts, boundary counts, week numbers and prunable date ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# German month and weekday names.
MONTHS = ("Januar", "Februar", "März", "April", "Mai", "Juni",
          "Juli", "August", "September", "Oktober", "November", "Dezember")
WEEKDAYS = ("Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag")

# Two-digit years from here on belong to the last century.
CENTURY_PIVOT = 50


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_german(value: ColumnOrName) -> Column:
    """``dd.mm.yy`` or ``dd.mm.yyyy`` text as a timestamp at midnight."""
    text = F.trim(_col(value))
    day_month = F.substring_index(text, ".", 2)
    year = F.substring_index(text, ".", -1)
    century = F.when(year.cast("int") >= CENTURY_PIVOT, "19").otherwise("20")
    full_year = F.when(F.char_length(year) == 2, F.concat(century, year)).otherwise(year)
    return F.to_timestamp_ntz(F.concat(day_month, F.lit("."), full_year), F.lit("d.M.yyyy"))


def german(text: str) -> datetime:
    """The same for one literal."""
    day, month, year = (int(part) for part in text.strip().split("."))
    if year < 100:
        year += 1900 if year >= CENTURY_PIVOT else 2000
    return datetime(year, month, day)


def german_text(value: ColumnOrName) -> Column:
    return F.date_format(_col(value), "dd.MM.yyyy")


def month_name(value: ColumnOrName) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(_col(value)))


def weekday_name(value: ColumnOrName) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(_col(value)) + 1)


def weekday_number(value: ColumnOrName, first_day: int = 1) -> Column:
    """1 to 7, counted from ``first_day`` (1 Monday, 7 Sunday)."""
    return F.pmod(F.weekday(_col(value)) + (1 - first_day), F.lit(7)) + 1


def week_of_year(value: ColumnOrName, first_day: int = 1) -> Column:
    """Calendar week in which week 1 holds 1 January, however short it is."""
    new_year = F.trunc(_col(value), "year")
    return F.call_function("div", F.dayofyear(_col(value)) + weekday_number(new_year, first_day) - 2, F.lit(7)) + 1


def iso_week(value: ColumnOrName) -> Column:
    return F.weekofyear(_col(value))


def day_month_year(value: ColumnOrName, separator: str) -> Column:
    """Day, month and year without leading zeros: 29#6#2022."""
    day = _col(value)
    return F.concat_ws(separator, F.dayofmonth(day), F.month(day), F.year(day))


def week_sentence(value: ColumnOrName) -> Column:
    return F.concat(weekday_name(value), F.lit(" in der "), iso_week(value).cast("string"), F.lit(" Kalenderwoche"))


def long_date(value: ColumnOrName) -> Column:
    """Weekday, day, month name and year: Freitag der 18. Mai 1990."""
    day = _col(value)
    return F.concat(weekday_name(day), F.lit(" der "), F.dayofmonth(day).cast("string"), F.lit(". "),
                    month_name(day), F.lit(" "), F.year(day).cast("string"))


def days_between(start: ColumnOrName, end: Column) -> Column:
    """Day boundaries from start to end."""
    return F.datediff(end, _col(start))


def months_between(start: ColumnOrName, end: Column) -> Column:
    """Month boundaries from start to end: 31 August to 1 September is one."""
    begin = _col(start)
    return (F.year(end) - F.year(begin)) * 12 + F.month(end) - F.month(begin)


def age_sentence(value: ColumnOrName, as_of: Column) -> Column:
    """Age in years of 365 days and in months of what is left over."""
    days = days_between(value, as_of)
    years = F.call_function("div", days, F.lit(365))
    rest = (days.cast("decimal(12,4)") % F.lit("365.25").cast("decimal(12,4)")).cast("double")
    months = (rest / F.lit(30.4375)).cast("int")
    return F.concat(F.lit("vor "), years.cast("string"), F.lit(" Jahren und "), months.cast("string"), F.lit(" Monaten."))


def _midnight(day: date | datetime) -> datetime:
    return datetime(day.year, day.month, day.day)


def _stamp(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def within(value: ColumnOrName, start: date | datetime, end: date | datetime) -> Column:
    """Half-open range ``[start, end)``; it reaches the Parquet scan as a pushed filter."""
    moment = _col(value)
    return (moment >= _stamp(_midnight(start))) & (moment < _stamp(_midnight(end)))


def on_day(value: ColumnOrName, day: date | datetime) -> Column:
    """Any time of the day counts."""
    return within(value, day, _midnight(day) + timedelta(days=1))


def through_days(value: ColumnOrName, first: date | datetime, last: date | datetime) -> Column:
    """From the first to the last day, the whole last day included."""
    return within(value, first, _midnight(last) + timedelta(days=1))


def in_month(value: ColumnOrName, year: int, month: int) -> Column:
    following = datetime(year + month // 12, month % 12 + 1, 1)
    return within(value, datetime(year, month, 1), following)


def in_year(value: ColumnOrName, year: int) -> Column:
    return within(value, datetime(year, 1, 1), datetime(year + 1, 1, 1))


def at(value: ColumnOrName, moment: date | datetime) -> Column:
    """Equality with a date literal, which stands for midnight of that day."""
    return _col(value) == _stamp(_midnight(moment))


def since(value: ColumnOrName, moment: date | datetime) -> Column:
    return _col(value) >= _stamp(_midnight(moment))


def after(value: ColumnOrName, moment: date | datetime) -> Column:
    return _col(value) > _stamp(_midnight(moment))


def between_literals(value: ColumnOrName, low: date | datetime, high: date | datetime) -> Column:
    """Both ends included, each standing for midnight: a time of day on the last day is outside."""
    return _col(value).between(_stamp(_midnight(low)), _stamp(_midnight(high)))


def same_day(left: ColumnOrName, right: ColumnOrName) -> Column:
    return F.to_date(_col(left)) == F.to_date(_col(right))


def month_number(text: str) -> int | None:
    """1 to 12 from a number or a German name; None for anything else."""
    word = text.strip()
    if word.isdecimal():
        return int(word) if 1 <= int(word) <= 12 else None
    names = [name.lower() for name in MONTHS]
    return names.index(word.lower()) + 1 if word.lower() in names else None
