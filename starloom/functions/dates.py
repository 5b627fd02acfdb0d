"""Date parts and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def season_start_year(d, first_month: int = 10) -> Column:
    """Fiscal-year start: month >= ``first_month`` -> year, else year - 1."""
    c = as_col(d)
    return F.when(F.month(c) >= first_month, F.year(c)).otherwise(F.year(c) - 1)


def season_label(year) -> Column:
    """``2022`` -> ``'2022-23'``."""
    y = as_col(year)
    return F.concat(y.cast("string"), F.lit("-"),
                    F.substring((y + 1).cast("string"), 3, 2))


def date_key(d) -> Column:
    """Integer key YYYYMMDD."""
    return F.date_format(as_col(d), "yyyyMMdd").cast("int")


def iso_day_of_week(d) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return F.weekday(as_col(d)) + 1


def day_name(d, padded: bool = False) -> Column:
    """English day name; ``padded`` blank-pads to 9 like ``to_char(d,'Day')``."""
    name = F.date_format(as_col(d), "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def month_name(d) -> Column:
    return F.date_format(as_col(d), "MMMM")


def date_parts(d) -> dict[str, Column]:
    """The calendar attributes of one date, as named Columns."""
    c = as_col(d)
    dow = iso_day_of_week(c)
    return {
        "date_key": date_key(c),
        "full_date": c,
        "year": F.year(c),
        "quarter_of_year": F.quarter(c),
        "month_of_year": F.month(c),
        "month_name": month_name(c),
        "day_of_month": F.dayofmonth(c),
        "day_of_week": dow,
        "day_of_week_name": day_name(c),
        "day_of_year": F.dayofyear(c),
        "week_of_year": F.weekofyear(c),
        "is_weekend": dow.isin(6, 7),
    }
