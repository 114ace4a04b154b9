"""Calendar expressions. All are native columns, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def strict_date(text: Column) -> Column:
    """`YYYY-MM-DD` text as a date; anything else is NULL.

    A bare cast would also take `2023-04`, `2023-4-1` or a trailing time. Cutting
    the text to the pattern first costs less than a formatter-driven parse, and it
    names the text only once, so an expression behind it is not evaluated twice.
    """
    return F.regexp_extract(text.cast("string"), ISO_DATE, 0).try_cast("date")


def month_end(start: Column, months: Column | int) -> Column:
    """Last day of the month that lies `months` after `start`."""
    return F.last_day(F.add_months(start, months))


def previous_month_end(day: Column) -> Column:
    return month_end(day, -1)


def date_key(day: Column) -> Column:
    """Date as a sortable YYYYMMDD integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def _whole(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor)).cast("int")


def decode_date_key(key: Column) -> Column:
    """Date behind a YYYYMMDD integer; NULL stays NULL, an impossible key raises."""
    return F.make_date(_whole(key, 10000), _whole(key, 100) % 100, key % 100)


def _fiscal_shift(day: Column, start_month: int) -> Column:
    # Moves the first fiscal month onto January, after which the plain calendar
    # year and quarter of the shifted date are the fiscal ones.
    return F.add_months(day, 1 - start_month)


def fiscal_year(day: Column, start_month: int = 4) -> Column:
    """Label such as `FY2023-24`."""
    first = F.year(_fiscal_shift(day, start_month))
    second = F.right((first + 1).cast("string"), F.lit(2))
    return F.concat(F.lit("FY"), first.cast("string"), F.lit("-"), second)


def fiscal_quarter(day: Column, start_month: int = 4) -> Column:
    """Label `FQ1` to `FQ4`."""
    return F.concat(
        F.lit("FQ"), F.quarter(_fiscal_shift(day, start_month)).cast("string")
    )
