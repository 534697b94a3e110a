"""Date parsing, month arithmetic and the cutoff windows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "to_timestamp", "midnight", "month_first", "month_last", "in_rolling_year", "in_cutoff_month",
    "year_month_text", "yyyymm", "due_month_label", "is_iso_date", "cutoff_lit", "next_month_first",
    "rolling_year_start", "last_second_before",
]

NTZ = "timestamp_ntz"
# Day-first is tried before month-first, in the declared order of the contract formats.
_OTHER_FORMATS = (("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", ("d/M/yyyy", "M/d/yyyy")), ("^[0-9]{8}$", ("yyyyMMdd",)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: str | date | datetime) -> date:
    """Plan-time date of a parameter; raises ValueError when it is not YYYY-MM-DD."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(str(value).strip(), "%Y-%m-%d").date()


def cutoff_lit(value: str | date) -> Column:
    """A parameter date as a zone-free midnight timestamp literal."""
    return F.lit(as_date(value).isoformat()).cast(NTZ)


def next_month_first(value: str | date) -> date:
    d = as_date(value)
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


def rolling_year_start(cutoff: str | date) -> date:
    """First day of the month after the cutoff, one year earlier."""
    following = next_month_first(cutoff)
    return following.replace(year=following.year - 1)


def last_second_before(value: str | date) -> datetime:
    d = as_date(value)
    return datetime(d.year, d.month, d.day) - timedelta(seconds=1)


def to_timestamp(c: Column | str) -> Column:
    """Lenient timestamp: ISO text, d/M/yyyy, M/d/yyyy or yyyyMMdd; anything else is null."""
    text = F.trim(_col(c).cast("string"))
    options = [F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), text.try_cast(NTZ))]
    for pattern, formats in _OTHER_FORMATS:
        options += [F.when(text.rlike(pattern), F.try_to_timestamp(text, F.lit(f)).cast(NTZ)) for f in formats]
    return F.coalesce(*options)


def midnight(c: Column | str) -> Column:
    return F.date_trunc("day", _col(c)).cast(NTZ)


def month_first(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def month_last(c: Column | str) -> Column:
    return F.last_day(_col(c).cast("date"))


def in_rolling_year(c: Column | str, cutoff: str | date) -> Column:
    """From the first day of the twelve months ending with the cutoff month to midnight of the cutoff."""
    return _col(c).between(cutoff_lit(rolling_year_start(cutoff)), cutoff_lit(cutoff))


def in_cutoff_month(c: Column | str, cutoff: str | date) -> Column:
    """Between the first and midnight of the last day of the cutoff month."""
    first = as_date(cutoff).replace(day=1)
    last = next_month_first(cutoff) - timedelta(days=1)
    return _col(c).between(cutoff_lit(first), cutoff_lit(last))


def year_month_text(c: Column | str) -> Column:
    """Year and month joined by a dash, month not padded; a null date gives a bare dash."""
    c = _col(c)
    return F.concat(
        F.coalesce(F.year(c).cast("string"), F.lit("")), F.lit("-"), F.coalesce(F.month(c).cast("string"), F.lit(""))
    )


def yyyymm(c: Column | str) -> Column:
    c = _col(c)
    return (F.year(c) * 100 + F.month(c)).cast("long")


def due_month_label(due: Column | str, cutoff: str | date) -> Column:
    """Position of the due month against the cutoff month; a null due date is "Due Month"."""
    end = month_last(due)
    cut = F.last_day(F.lit(as_date(cutoff)))
    return F.when(end < cut, "Credit").when(end > cut, "Debit").otherwise("Due Month")


def is_iso_date(c: Column | str) -> Column:
    """Strict YYYY-MM-DD check, including that the day exists."""
    text = _col(c).cast("string")
    return F.coalesce(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull(), F.lit(False))
