"""Maturity ladder of the active book at successive month-ends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.functions.dates import decode_date_key, month_end
from tenorbook.functions.labels import maturity_bucket


def _is_sight(cfg: Config) -> Column:
    return F.coalesce(F.col("deal_type") == cfg.sight_type, F.lit(False))


def _bucket(days: Column, is_sight: Column, cfg: Config) -> Column:
    return maturity_bucket(
        days, is_sight, cfg.bucket_edges, cfg.sight_bucket, cfg.last_bucket
    )


def active_deals(fct: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Deals in the active state, with the maturity date decoded from its key."""
    return fct.filter(F.col("deal_status") == cfg.active_status).select(
        "deal_id",
        "deal_type",
        "nominal_amount_sdr",
        "maturity_date_key",
        decode_date_key(F.col("maturity_date_key")).alias("maturity_date"),
    )


def maturity_profile(fct: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Active book by maturity date: one row per date, one for all sight money.

    A deal's bucket depends on nothing but its maturity and whether it is sight
    money, so this is all the ladder has to know about the deals. Counts and
    decimal sums add up exactly, and the partial aggregate runs before the shuffle,
    so neither the number of deals nor a hot maturity date grows what is moved.
    """
    term_key = F.when(~_is_sight(cfg), F.col("maturity_date_key"))
    return (
        fct.filter(F.col("deal_status") == cfg.active_status)
        .groupBy(_is_sight(cfg).alias("is_sight"), term_key.alias("maturity_date_key"))
        .agg(
            F.count("*").alias("deal_count"),
            F.sum("nominal_amount_sdr").alias("total_sdr"),
        )
    )


def exposed_profile(fct: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Maturity profile at every as-of date where it is still outstanding.

    The as-of dates are generated per profile row instead of being cross joined
    with the deals: the row count is bounded by dates, not by deals.
    """
    as_of = month_end(F.lit(cfg.as_of_start), F.col("n"))
    dated = (
        maturity_profile(fct, cfg)
        .select(
            "*",
            F.explode(F.sequence(F.lit(0), F.lit(cfg.as_of_months - 1))).alias("n"),
        )
        .select(
            as_of.alias("as_of_date"),
            "is_sight",
            decode_date_key(F.col("maturity_date_key")).alias("maturity_date"),
            "deal_count",
            "total_sdr",
        )
    )
    days = F.col("days_to_maturity")
    return (
        dated.withColumn("days_to_maturity", F.datediff("maturity_date", "as_of_date"))
        .filter((days > 0) | F.col("is_sight"))
        .select(
            "as_of_date",
            "is_sight",
            "maturity_date",
            "days_to_maturity",
            _bucket(days, F.col("is_sight"), cfg).alias("maturity_bucket"),
            "deal_count",
            "total_sdr",
        )
    )


def maturity_ladder(fct: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Deal count and SDR total per as-of date and maturity bucket."""
    return (
        exposed_profile(fct, cfg)
        .groupBy("as_of_date", "maturity_bucket")
        .agg(
            F.sum("deal_count").alias("deal_count"),
            F.sum("total_sdr").alias("total_sdr"),
        )
    )


def deals_outstanding_at(
    fct: DataFrame, as_of: dt.date, cfg: Config = Config()
) -> DataFrame:
    """The individual deals behind one as-of date of the ladder.

    Keys sort like dates, so the test for "still outstanding" is made on the integer
    key: on a published fact it reaches the scan as a range filter.
    """
    as_of_key = as_of.year * 10000 + as_of.month * 100 + as_of.day
    outstanding = fct.filter(
        (F.col("maturity_date_key") > as_of_key) | (F.col("deal_type") == cfg.sight_type)
    )
    dated = active_deals(outstanding, cfg).withColumn("as_of_date", F.lit(as_of))
    days = F.datediff("maturity_date", "as_of_date")
    return dated.withColumn("days_to_maturity", days).select(
        "as_of_date",
        "deal_id",
        "deal_type",
        "maturity_date",
        "days_to_maturity",
        _bucket(F.col("days_to_maturity"), _is_sight(cfg), cfg).alias("maturity_bucket"),
        "nominal_amount_sdr",
    )


def average_active_book(ladder: DataFrame) -> DataFrame:
    """Mean over the as-of dates of the ladder's SDR total.

    A date on which no deal, or no deal with a rate, is outstanding has no total and
    does not count.
    """
    per_date = ladder.groupBy("as_of_date").agg(
        F.sum("deal_count").alias("deal_count"), F.sum("total_sdr").alias("total_sdr")
    )
    return per_date.agg(
        F.count("*").alias("as_of_dates"),
        F.sum("deal_count").alias("sum_deal_count"),
        F.sum("total_sdr").alias("sum_total_sdr"),
        (F.sum("total_sdr") / F.count("total_sdr"))
        .cast("decimal(38,2)")
        .alias("average_sdr"),
    )
