"""Dates of postings, which sources give in several ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Postings before this day are out of scope.
FLOOR = "2026-01-01"
#: The fixed offset of local days.
OFFSET_HOURS = -3


def _try_date(text: Column, pattern: str, form: str) -> Column:
    return F.when(text.rlike(pattern), F.to_date(F.try_to_timestamp(text, F.lit(form))))


def published_date(raw: Column, reference: Column) -> Column:
    """The date a text stands for, relative words counted back from ``reference``; null if it cannot be told.

    Understood are ISO dates at the start of the text, dd/mm/yyyy, the words for the day before yesterday,
    yesterday and today, and so many days, months of 30 days, or hours (which are the reference day) ago. Where an
    ISO or dd/mm/yyyy form is no real day, nothing else is tried.
    """
    text = F.trim(raw)
    low = F.lower(text)
    count = lambda unit: F.regexp_extract(low, rf"h[aá]\s+(?:mais\s+de\s+)?(\d+)\s+{unit}", 1)
    days, months, hours = count("dias?"), count("m[eê]s(?:es)?"), count("horas?")
    back = lambda n: F.date_sub(reference, n)
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))))
        .when(text.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy"))))
        .when(low.rlike(r"(?U)\banteontem\b"), back(2)).when(low.rlike(r"(?U)\bontem\b"), back(1)).when(low.rlike(r"(?U)\bhoje\b"), reference)
        .when(days != "", back(days.try_cast("int"))).when(months != "", back(months.try_cast("int") * 30)).when(hours != "", reference)
    )


def loose_date(raw: Column) -> Column:
    """The date in the first ten characters, in any of three numeric forms; the form that duplicates are compared by."""
    text = F.substring(F.trim(raw), 1, 10)
    return F.coalesce(
        _try_date(text, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), _try_date(text, r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), _try_date(text, r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    )


def close_dates(a: Column, b: Column, days: int = 7) -> Column:
    """Whether both dates are known and at most ``days`` apart."""
    return F.coalesce(F.abs(F.datediff(a, b)) <= days, F.lit(False))


def local_day(utc: Column) -> Column:
    """The day of a UTC timestamp at the fixed offset."""
    return F.to_date(utc + F.make_dt_interval(hours=F.lit(OFFSET_HOURS)))


def epoch_day(seconds: Column) -> Column:
    """The day of epoch seconds at the fixed offset."""
    return F.date_from_unix_date(F.floor((seconds + OFFSET_HOURS * 3600) / 86400).cast("int"))


def file_day(path: Column, modified: Column) -> Column:
    """The day in a file name's stamp yyyymmdd_hhmmss, or else that of its modification."""
    stamp = F.regexp_extract(path, r"(\d{8})_\d{6}[^/]*$", 1)
    return F.coalesce(F.when(stamp != "", F.to_date(F.try_to_timestamp(stamp, F.lit("yyyyMMdd")))), local_day(modified))


def age_hours(now: Column, then: Column) -> Column:
    return (F.unix_timestamp(now) - F.unix_timestamp(then)) / 3600.0


def in_scope(day: Column, reference: Column) -> Column:
    """False for days before the floor, unless the batch itself is older than the floor; unknown days are in."""
    floor = F.lit(FLOOR).cast("date")
    return F.coalesce((reference < floor) | (day >= floor), F.lit(True))
