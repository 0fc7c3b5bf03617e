"""Dates, quarters and period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leasegrid import constants as C

MIXED_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "d MMM yyyy",
    "MMM yyyy",
)


def mixed_timestamp(c: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in MIXED_FORMATS])


def stamp14(c: Column) -> Column:
    """'YYYYMMDDHHMMSS' text to a timestamp; NULL if malformed."""
    return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMddHHmmss"))


def readable_stamp(c: Column) -> Column:
    return F.date_format(stamp14(c), "yyyy-MM-dd HH:mm:ss")


def quarter_of_month(month: Column) -> Column:
    return F.ceil(month / 3).cast("int")


def month_name_quarter(name: Column) -> Column:
    """'Mar' -> 1. NULL for anything that is not a month name."""
    pairs = [F.lit(x) for i, m in enumerate(C.MONTHS) for x in (m, i // 3 + 1)]
    return F.try_element_at(F.create_map(*pairs), name)


def reporting_quarter(month: Column) -> Column:
    """Quarter of an archive file month; only Mar/Jun/Sep/Dec count."""
    return F.when(month.isin(3, 6, 9, 12), (month / 3).cast("int"))


def quarter_last_month(year: Column, quarter: Column) -> Column:
    """First day of the last month of the quarter."""
    return F.make_date(year, quarter * 3, F.lit(1))


def quarter_first_month(year: Column, quarter: Column) -> Column:
    return F.make_date(year, quarter * 3 - 2, F.lit(1))


def future_quarter_ends(base: Column, steps: int) -> Column:
    """Array of the ``steps`` quarter-end dates after the quarter of ``base``."""
    start = F.trunc(base, "quarter")
    return F.transform(
        F.sequence(F.lit(1), F.lit(steps)), lambda i: F.last_day(F.add_months(start, i * 3 + 2))
    )
