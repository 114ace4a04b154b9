"""Joins between the fact and its dimensions, and report slicers.

Every join here is a left equi-join without a hint. The calendar, currency and
product dimensions carry their true, small size and are broadcast by Spark. The
counterparty dimension grows with the book, so its size decides at run time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook.operators.dimensions import one_per_code
from tenorbook.operators.fact import DATE_ROLES

STAR_KEYS = {
    "dim_counterparty": "cpty_code",
    "dim_product": "deal_type",
    "dim_currency": "currency",
}


def star(fct: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact with the attributes of counterparty, product and currency."""
    joined = fct
    for name, key in STAR_KEYS.items():
        if name == "dim_counterparty":
            side = one_per_code(dims[name]).withColumnRenamed(key, "named_code")
            # The length follows from the code. As a second key it makes Spark shuffle
            # the reduced side for this join, without which a hot code is not split.
            code, named = F.col(key), F.col("named_code")
            same = (code == named) & (F.length(code) == F.length(named))
            joined = joined.join(side, same, "left").drop("named_code")
        else:
            joined = joined.join(dims[name], key, "left")
    attributes = [
        column
        for name, key in STAR_KEYS.items()
        for column in dims[name].columns
        if column != key
    ]
    return joined.select(*fct.columns, *attributes)


def with_date_role(fct: DataFrame, calendar: DataFrame, role: str) -> DataFrame:
    """Fact with the calendar attributes of its trade, value or maturity date.

    Columns are prefixed with the role. The join is left because sight money has
    no maturity and maturities may run past the calendar.
    """
    if role not in DATE_ROLES:
        raise ValueError(f"role must be one of {DATE_ROLES}, not {role!r}")
    key = f"{role}_date_key"
    renamed = calendar.select(
        F.col("date_key").alias(key),
        *[F.col(c).alias(f"{role}_{c}") for c in calendar.columns if c != "date_key"],
    )
    return fct.join(renamed, key, "left").select(*fct.columns, *renamed.columns[1:])


def slice_by_calendar(fct: DataFrame, calendar: DataFrame, role: str, **wanted) -> DataFrame:
    """Deals whose trade, value or maturity day the calendar slicers keep.

    The first and last day kept are read from the calendar when the slice is composed, two numbers whatever the size of the book, and
    become a range filter on the date key, which the scan takes to skip files and row groups. Days need not lie next to each
    other: the semi join behind the range decides.
    """
    if role not in DATE_ROLES:
        raise ValueError(f"role must be one of {DATE_ROLES}, not {role!r}")
    days = slice_by(calendar, **wanted).select("date_key")
    first, last = days.agg(F.min("date_key"), F.max("date_key")).first()
    key = F.col(f"{role}_date_key")
    return fct.filter(key.between(F.lit(first), F.lit(last))).join(days, key == F.col("date_key"), "left_semi")


def slice_by(frame: DataFrame, **wanted) -> DataFrame:
    """Keeps the rows whose columns equal a value, or are among a list of values."""
    for column, value in wanted.items():
        if isinstance(value, (list, tuple, set, frozenset)):
            frame = frame.filter(F.col(column).isin(list(value)))
        else:
            frame = frame.filter(F.col(column) == F.lit(value))
    return frame
