"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date parts understood everywhere.
DATE_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def check_part(part: str) -> str:
    if part.lower() not in DATE_PARTS:
        raise ValueError(f"date part must be one of {DATE_PARTS}, not {part!r}")
    return part.lower()


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dateadd(part: str, n: int | Column, moment: str | Column) -> Column:
    """``moment`` plus ``n`` parts; months keep the day where the month has it."""
    amount = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add(check_part(part).upper(), amount, _column(moment))


def datediff(part: str, start: str | Column, end: str | Column) -> Column:
    """Number of part boundaries between two moments (31 January to 1 February is one month)."""
    part = check_part(part)
    a, b = (F.date_trunc(part, _column(c)).cast("timestamp_ntz") for c in (start, end))
    return F.timestamp_diff(part.upper(), a, b)


def last_day(moment: str | Column) -> Column:
    """Last day of the month as a date."""
    return F.last_day(_column(moment))


def month_start(moment: str | Column) -> Column:
    return F.trunc(_column(moment), "month")


def overdue_days(start: str | Column, end: str | Column, allowed_days: str | Column | int) -> Column:
    """Whole days by which ``end - start`` exceeds the allowed days, at least 0; NULL without an end."""
    allowed = F.lit(allowed_days) if isinstance(allowed_days, int) else _column(allowed_days)
    seconds = F.timestamp_diff("SECOND", _column(start), _column(end)) - allowed * 86400
    return F.greatest(F.floor(seconds / 86400), F.lit(0)).cast("long")
