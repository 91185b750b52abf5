"""Dates, seasons and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.fixed_values import SEASON_MONTHS, SPREADSHEET_EPOCH, WARM_HALF_MONTHS
from hazeline.functions.numeric import to_double

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def parse_date(text: Column, formats: tuple[str, ...] = ("yyyyMMdd", "yyyy-MM-dd")) -> Column:
    """Date from the first format that fits, else null."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def serial_date(text: Column) -> Column:
    """Spreadsheet serial day (as text or number) to date."""
    days = F.floor(to_double(text)).cast("int")
    return F.date_add(F.to_date(F.lit(SPREADSHEET_EPOCH)), days)


def month_label(date: Column) -> Column:
    """Jan to Dec, by look-up; formatting every row's date is far slower."""
    return F.get(F.lit(list(MONTHS)), F.month(date) - 1)


def season(month: Column) -> Column:
    """spring, summer, fall, winter; null for a null month."""
    result = F
    for name, months in SEASON_MONTHS.items():
        result = result.when(month.isin(*months), name)
    return result


def half_year(month: Column) -> Column:
    """summer (April to September) or winter."""
    first, last = WARM_HALF_MONTHS
    return F.when(month.between(first, last), "summer").when(month.isNotNull(), "winter")


def year_start(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def date_steps(first: str, last: str, months: int) -> Column:
    """Array of dates from first to last in steps of whole months."""
    return F.sequence(
        F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.make_interval(months=F.lit(months))
    )


def fill_date_parts(df, date: str = "date"):
    """Year, month and day taken from the date where they are missing."""
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), fn(date)) if name in df.columns else fn(date)
            for name, fn in parts.items()
        }
    )
