"""Calendar rules: local days of instants, ages, deadlines. Every "now" is a parameter."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import clean_text


def seoul_date(ts: Column) -> Column:
    """Calendar day in Seoul of a UTC timestamp without zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), ts))


def within_seoul_days(ts: Column, first: str | None = None, last: str | None = None) -> Column:
    """The instant lies in these local days. Said on the instant itself, so that the condition reaches the scan."""
    at = lambda day, days: F.lit(f"{date.fromisoformat(day) + timedelta(days)} 15:00:00").cast("timestamp_ntz")
    out = F.lit(True)
    if first:
        out = out & (ts >= at(first, -1))
    return out & (ts < at(last, 0)) if last else out


def is_open(end: Column, as_of: Column) -> Column:
    """The deadline has not passed; the sentinel day is always open."""
    return (end == F.to_date(F.lit(K.ALWAYS_OPEN))) | (end >= as_of)


def always_open(end: Column) -> Column:
    return F.year(end) >= K.ALWAYS_OPEN_YEAR


def days_left(end: Column, as_of: Column) -> Column:
    return F.datediff(end, as_of)


def age_years(born: Column, as_of: Column) -> Column:
    """Whole years: the year counts once month and day of birth are reached, so 29 February counts from 1 March. Before the
    birth they are the whole years up to it, below zero, so the last year before it is 0 and not -1."""
    past = born <= as_of
    first, last = F.when(past, born).otherwise(as_of), F.when(past, as_of).otherwise(born)
    short = F.struct(F.month(last), F.dayofmonth(last)) < F.struct(F.month(first), F.dayofmonth(first))
    years = F.year(last) - F.year(first) - short.cast("int")
    return F.when(past, years).otherwise(-years)


def parse_date(x: Column) -> Column:
    """The first of three patterns that gives a day that exists; two-digit years are of this century."""
    t = clean_text(x)
    patterns = (
        r"(\d{4})\s*[./-]\s*(\d{1,2})\s*[./-]\s*(\d{1,2})",
        r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일",
        r"(\d{2})\s*[./-]\s*(\d{1,2})\s*[./-]\s*(\d{1,2})",
    )

    def day(p: str) -> Column:
        year, *rest = (F.regexp_extract(t, p, k) for k in (1, 2, 3))
        full = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
        return F.when(year != "", F.try_to_date(F.concat_ws("-", full, *(F.lpad(r, 2, "0") for r in rest)), "yyyy-MM-dd"))

    return F.coalesce(*map(day, patterns))


def iso_head(x: Column) -> Column:
    """The first ten characters if they look like a date; whether the day exists is not asked."""
    head = F.substring(clean_text(x), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head)


def period(start: Column, end: Column) -> Column:
    shown = lambda d: F.coalesce(F.date_format(d, "yyyy/MM/dd"), F.lit("—"))
    return F.when(always_open(end), "상시모집").otherwise(F.concat(shown(start), F.lit(" ~ "), shown(end)))


def in_lookback(day: Column, as_of: Column, days: int, keep_undated: bool) -> Column:
    return F.coalesce(day.between(F.date_sub(as_of, days), as_of), F.lit(keep_undated))


def not_ended(end: Column, as_of: Column, keep_undated: bool) -> Column:
    return F.coalesce(end >= as_of, F.lit(keep_undated))


def elapsed_ms(start: Column, end: Column) -> Column:
    ms = lambda t: F.unix_millis(t.cast("timestamp"))
    return F.greatest(ms(end) - ms(start), F.lit(0))
