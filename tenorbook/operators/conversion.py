"""Conversion of every deposit into SDR."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook.functions.dates import previous_month_end


def to_sdr(deals: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Deals with the rate of the month-end before their value date.

    Left join: a deal without a rate stays, with NULL SDR. No broadcast hint: the
    feed has a row per currency and month, which Spark broadcasts on its own while
    its size is under the session's threshold. A feed beyond it is sort-merge
    joined, and adaptive execution splits a hot (currency, month) on the deal side.
    """
    d, fx = deals.alias("d"), fx_rates.alias("fx")
    same_rate = (F.col("fx.currency_code") == F.col("d.currency")) & (
        F.col("fx.rate_date") == previous_month_end(F.col("d.value_date"))
    )
    return d.join(fx, same_rate, "left").select(
        "d.deal_id",
        "d.deal_type",
        "d.cpty_code",
        "d.cpty_name",
        "d.cpty_country",
        "d.trade_date",
        "d.value_date",
        "d.maturity_date",
        "d.currency",
        "d.nominal_amount",
        "d.rate_pct",
        "d.rate_decimal",
        "d.deal_status",
        "d.portfolio",
        "d.book",
        F.col("fx.rate_date").alias("fx_rate_date"),
        "fx.sdr_per_unit",
        (F.col("d.nominal_amount") * F.col("fx.sdr_per_unit")).alias(
            "nominal_amount_sdr"
        ),
        "d.created_dt",
        "d.last_modified_dt",
    )
