"""The deposit fact: one row per deal, dates encoded as calendar keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook.functions.dates import date_key

DATE_ROLES = ("trade", "value", "maturity")


def fact_deposits(int_deals: DataFrame) -> DataFrame:
    keys = [
        date_key(F.col(f"{role}_date")).alias(f"{role}_date_key") for role in DATE_ROLES
    ]
    return int_deals.select(
        "deal_id",
        "deal_type",
        "cpty_code",
        "currency",
        *keys,
        "nominal_amount",
        "nominal_amount_sdr",
        "rate_pct",
        "rate_decimal",
        "deal_status",
        "portfolio",
        "book",
        "fx_rate_date",
        "sdr_per_unit",
        "created_dt",
        "last_modified_dt",
    )
