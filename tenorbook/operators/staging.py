"""Typing of the raw extracts. A bad value becomes NULL; no row is dropped."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tenorbook.config import RATE_TYPE
from tenorbook.functions.dates import strict_date


def _day(raw: DataFrame, name: str) -> Column:
    """A date column of the extract: typed columns are cast, text must fit the pattern."""
    typed = isinstance(raw.schema[name].dataType, (DateType, TimestampType, TimestampNTZType))
    return F.col(name).cast("date") if typed else strict_date(F.col(name))


def deal_casts(raw: DataFrame) -> dict[str, Column]:
    """Typed form of every raw deal column that is not plain text."""
    return {
        "trade_date": _day(raw, "trade_date"),
        "value_date": _day(raw, "value_date"),
        "maturity_date": _day(raw, "maturity_date"),
        "nominal_amount": F.col("nominal_amount").try_cast("decimal(20,2)"),
        "rate_pct": F.col("rate_pct").try_cast("decimal(10,6)"),
        "created_dt": F.col("created_dt").try_cast("timestamp_ntz"),
        "last_modified_dt": F.col("last_modified_dt").try_cast("timestamp_ntz"),
    }


def stage_deals(raw: DataFrame) -> DataFrame:
    """Typed deals, with the percentage rate also as a fraction.

    A hundredth is exact in decimals, and multiplying costs a tenth of dividing.
    """
    typed = deal_casts(raw)
    hundredth = F.lit(Decimal("0.01"))
    rate_decimal = (typed["rate_pct"] * hundredth).cast("decimal(16,11)")
    return raw.select(
        "deal_id",
        "deal_type",
        "cpty_code",
        "cpty_name",
        "cpty_country",
        typed["trade_date"].alias("trade_date"),
        typed["value_date"].alias("value_date"),
        typed["maturity_date"].alias("maturity_date"),
        "currency",
        typed["nominal_amount"].alias("nominal_amount"),
        typed["rate_pct"].alias("rate_pct"),
        rate_decimal.alias("rate_decimal"),
        "deal_status",
        "portfolio",
        "book",
        typed["created_dt"].alias("created_dt"),
        typed["last_modified_dt"].alias("last_modified_dt"),
    )


def _exact(raw: Column, rate_type: str) -> tuple[Column, Column]:
    """A rate as rate_type, and whether that changes its value. Text is judged by all its digits."""
    typed = raw.try_cast(rate_type)
    text = F.trim(raw.cast("string"))
    # Digits behind the point that are not trailing noughts; the cast rounds away what exceeds its places.
    places = F.length(F.regexp_extract(text, r"^[+-]?[0-9]*\.([0-9]*?)0*\z", 1))
    kept = int(rate_type.rstrip(")").split(",")[1]) if "," in rate_type else 0
    whole = raw.try_cast("decimal(38,18)")
    lost = typed.isNotNull() & ((places > kept) | F.coalesce(whole != typed, F.lit(False)))
    return typed, lost


def rate_losses(raw: DataFrame, rate_type: str = RATE_TYPE) -> DataFrame:
    """Rates of the feed that rate_type cannot hold in full: rate_date, currency_code, raw_value, staged_value."""
    typed, lost = _exact(F.col("sdr_per_unit"), rate_type)
    return raw.filter(lost).select(
        "rate_date", "currency_code", F.col("sdr_per_unit").cast("string").alias("raw_value"), typed.alias("staged_value")
    )


def stage_fx_rates(raw: DataFrame, rate_type: str = RATE_TYPE, round_rates: bool = False) -> DataFrame:
    """Typed rates. A rate with more places than rate_type fails the run, unless round_rates asks to round it.

    The default type keeps six places. Up to 17 digits in all, the product with an amount keeps every place;
    `rate_losses` lists the rates a type cannot hold.
    """
    typed, lost = _exact(F.col("sdr_per_unit"), rate_type)
    if not round_rates:
        told = F.concat(F.lit("rate "), F.col("sdr_per_unit").cast("string"), F.lit(f" does not fit {rate_type}; set a wider rate_type or round_rates"))
        typed = F.when(lost, F.raise_error(told)).otherwise(typed)
    return raw.select(
        _day(raw, "rate_date").alias("rate_date"),
        "currency_code",
        typed.alias("sdr_per_unit"),
    )
