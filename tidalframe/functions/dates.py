"""Dates, periods and calendar features."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_period(period: str) -> tuple[int, str]:
    """``"3 months"`` → ``(3, "month")``."""
    found = re.fullmatch(r"\s*(\d+)\s*(day|week|month|quarter|year)s?\s*", period)
    if not found:
        raise ValueError(f"not a period: {period!r}")
    return int(found.group(1)), found.group(2)


def shift(date, period: str, sign: int = 1) -> Column:
    """A date moved by a period; months are calendar months."""
    n, unit = split_period(period)
    n *= sign
    if unit in ("day", "week"):
        return F.date_add(_col(date), n * (7 if unit == "week" else 1))
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.add_months(_col(date), n * months)


def minus(date, period: str) -> Column:
    return shift(date, period, -1)


def days_between(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def first_day(partial: str) -> dt.date:
    """First day named by ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``."""
    parts = [int(p) for p in partial.split("-")]
    return dt.date(*(parts + [1, 1])[:3])


def last_day(partial: str) -> dt.date:
    """Last day named by ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``."""
    parts = [int(p) for p in partial.split("-")]
    if len(parts) == 1:
        return dt.date(parts[0], 12, 31)
    if len(parts) == 2:
        return dt.date(parts[0], parts[1], calendar.monthrange(*parts)[1])
    return dt.date(*parts)


def parse_ymd(x) -> Column:
    """``20010131`` as a number or text → date, null when it is none."""
    return F.try_to_date(_col(x).cast("string"), "yyyyMMdd")


def parse_month_year(x) -> Column:
    """``Jan 2001`` → first day of that month."""
    return F.try_to_date(_col(x), "MMM yyyy")


def from_parts(year, month, day=1) -> Column:
    """Date from parts; a month that is no number gives null."""
    day = F.lit(day) if isinstance(day, int) else _col(day)
    return F.make_date(_col(year), _col(month).try_cast("int"), day)


def floor_to(date, unit: str) -> Column:
    """First day of the period that holds the date."""
    return _col(date) if unit == "day" else F.trunc(_col(date), unit)


def signature(date: str) -> dict[str, Column]:
    """Calendar features of a date column, one expression per feature."""
    d = F.col(date)
    ts = d.cast("timestamp")
    month, mday, yday = F.month(d), F.dayofmonth(d), F.dayofyear(d)
    wday, hour = F.dayofweek(d), F.hour(ts)
    week = F.floor((yday - 1) / 7).cast("int") + 1
    first_wday = F.dayofweek(F.trunc(d, "month"))
    return {
        "index_num": F.unix_date(d).cast("long") * 86400,
        "year": F.year(d),
        "year_iso": F.extract(F.lit("YEAROFWEEK"), d).cast("int"),
        "half": F.when(month <= 6, 1).otherwise(2),
        "quarter": F.quarter(d),
        "month": month,
        "month_xts": month - 1,
        "month_lbl": F.date_format(d, "MMMM"),
        "day": mday,
        "hour": hour,
        "minute": F.minute(ts),
        "second": F.second(ts).cast("int"),
        "hour12": F.pmod(hour, F.lit(12)).cast("int"),
        "am_pm": F.when(hour < 12, 1).otherwise(2),
        "wday": wday,
        "wday_xts": wday - 1,
        "wday_lbl": F.date_format(d, "EEEE"),
        "mday": mday,
        "qday": F.datediff(d, F.trunc(d, "quarter")) + 1,
        "yday": yday,
        "mweek": F.floor((mday + first_wday - 2) / 7).cast("int") + 1,
        "week": week,
        "week_iso": F.weekofyear(d),
        "week2": F.pmod(week, F.lit(2)),
        "week3": F.pmod(week, F.lit(3)),
        "week4": F.pmod(week, F.lit(4)),
        "mday7": F.floor((mday - 1) / 7).cast("int") + 1,
    }


# Fixed value: signature columns a daily model leaves out.
UNUSED_FOR_DAYS = r"(_xts$)|(_iso$)|(^hour)|(^minute)|(^second)|(^am_pm)"
