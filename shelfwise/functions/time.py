"""Dates, windows and calendar periods."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def day_start(day: date) -> Column:
    """Midnight of a day as a zone-free timestamp literal, good for push-down."""
    return F.lit(day).cast("timestamp_ntz")


def within(stamp: Column, first: date, past: date) -> Column:
    """Half-open window of whole days: ``first <= stamp < past``."""
    return (stamp >= day_start(first)) & (stamp < day_start(past))


def end_of_day(day: Column) -> Column:
    """The last microsecond of a day."""
    return F.date_add(day, 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND")


# Day and month of one or two digits, and a time of hours and minutes, with or without seconds.
DAY_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?: +(\d{1,2}):(\d{2})(?::(\d{2}))?)?\s*$"


def parse_stamp(value: Column, kind: DataType) -> Column:
    """A zone-free timestamp. Text is read day first; any other form of text is null."""
    if not isinstance(kind, StringType):
        return value.cast("timestamp_ntz")
    part = [F.regexp_extract(value, DAY_FIRST, n) for n in range(1, 7)]
    two = [F.lpad(F.when(p != "", p).otherwise("0"), 2, "0") for p in part]
    iso = F.concat(part[2], F.lit("-"), two[1], F.lit("-"), two[0], F.lit(" "), two[3], F.lit(":"), two[4], F.lit(":"), two[5])
    return F.when(value.rlike(DAY_FIRST), iso.try_cast("timestamp_ntz"))


def days_since(reference: Column, stamp: Column) -> Column:
    return F.datediff(reference, stamp.cast("date"))


def quarter_start(stamp: Column) -> Column:
    return F.trunc(stamp, "QUARTER")


def month_start(stamp: Column) -> Column:
    return F.trunc(stamp, "MONTH")


def quarter_label(stamp: Column) -> Column:
    """``2026Q2``."""
    return F.concat(F.year(stamp).cast("string"), F.lit("Q"), F.quarter(stamp).cast("string"))


def month_label(stamp: Column) -> Column:
    """``2026-04``."""
    return F.date_format(stamp, "yyyy-MM")


def month_index(day: Column) -> Column:
    """Months counted from year 0, so that differences are numbers of months."""
    return F.year(day) * 12 + F.month(day) - 1


def quarter_index(day: Column) -> Column:
    return F.year(day) * 4 + F.quarter(day) - 1
