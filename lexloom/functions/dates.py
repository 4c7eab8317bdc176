"""Dates in the many ways sources write them.  What cannot be read is null, never a made-up day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Month names of four languages.
MONTHS = {
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
}


def made(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")), "yyyy-MM-dd")


def compact(text: Column) -> Column:
    """yyyyMMdd; the sentinel of nines and years beyond 2100 mean no date."""
    day = F.try_to_date(text, "yyyyMMdd")
    return F.when(text.rlike("^[0-9]{8}$") & (F.year(day) <= 2100), day)


def iso_prefix(text: Column) -> Column:
    return F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")


def iso_strict(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def from_number(number: Column) -> Column:
    """20240131 as a number."""
    digits = F.lpad(number.cast("string"), 8, "0")
    return F.try_to_date(digits, "yyyyMMdd")


def spelled(text: Column, language: str) -> Column:
    """"3 de mayo de 1998", "1er mars 2001", "7. Oktober 1999"."""
    names = F.create_map(*[x for i, name in enumerate(MONTHS[language].split(), 1) for x in (F.lit(name), F.lit(i))])
    pattern = "([0-9]{1,2})[^0-9 ]* (?:de )?([a-zéûäç]+) (?:de )?([0-9]{4})"
    part = lambda i: F.regexp_extract(F.lower(text), pattern, i)
    month = F.try_element_at(names, part(2))
    return F.when(month.isNotNull(), made(F.nullif(part(3), F.lit("")), month, F.nullif(part(1), F.lit(""))))


def ladder(text: Column, *formats: str) -> Column:
    """The first format that reads the text."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def http_date(text: Column) -> Column:
    """"Wed, 31 Jan 2024 10:00:00 GMT", the weekday not looked at."""
    return F.try_to_timestamp(F.substring(text, 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))


def working_days(start: Column, end: Column, skipped: tuple[int, ...] = (5, 6)) -> Column:
    """The days of a span without the skipped weekdays (Monday is 0); an empty span has none."""
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return F.filter(days, lambda d: ~F.weekday(d).isin(*skipped))


def previous_scheduled(day: Column, skipped: tuple[int, ...] = (5, 6)) -> Column:
    back = F.sequence(F.date_sub(day, 7), F.date_sub(day, 1))
    return F.array_max(F.filter(back, lambda d: ~F.weekday(d).isin(*skipped)))


def clamped(day: Column, least: str = "1970-01-02") -> Column:
    return F.greatest(day, F.lit(least).cast("date"))


def decade(day: Column) -> Column:
    return F.concat(F.substring(F.date_format(day, "yyyy"), 1, 3), F.lit("0s"))


def window_name(age: Column) -> Column:
    """How far back a change window must reach, by the days since."""
    return F.when(age <= 7, "OneWeek").when(age <= 14, "TwoWeeks").when(age <= 31, "OneMonth").when(age <= 93, "ThreeMonths").when(age <= 186, "SixMonths").otherwise("OneYear")
