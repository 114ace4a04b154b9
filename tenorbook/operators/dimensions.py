"""The four dimensions and the spines behind them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorbook import fixed_values
from tenorbook.functions.dates import (
    date_key,
    fiscal_quarter,
    fiscal_year,
    month_end,
)
from tenorbook.functions.labels import region_of


def static_relation(
    spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]
) -> DataFrame:
    """Inline rows as a relation.

    Python rows would become an RDD of unknown size, against which joins shuffle.
    An Arrow table becomes a local relation, whose true size the optimizer knows.
    """
    arrays = [pa.array(column) for column in zip(*rows)]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))


def date_bounds(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Fixed bounds for the spines below."""
    return spark.range(0, 1, 1, 1).select(
        F.lit(start).alias("start"), F.lit(end).alias("end")
    )


def observed_bounds(frame: DataFrame, start: Column, end: Column) -> DataFrame:
    """Bounds taken from the data: one row, combined on the map side."""
    return frame.agg(F.min(start).alias("start"), F.max(end).alias("end"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from `start` to `end`, both included."""
    return bounds.select(F.explode(F.sequence("start", "end")).alias("full_date"))


def month_end_spine(bounds: DataFrame) -> DataFrame:
    """Every month-end from the month of `start` to the month of `end`."""
    first, last = F.col("start"), F.col("end")
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
    return bounds.select(
        "start", F.explode(F.sequence(F.lit(0), months)).alias("n")
    ).select(month_end(F.col("start"), F.col("n")).alias("as_of_date"))


def dim_date(spine: DataFrame, fiscal_start_month: int = 4) -> DataFrame:
    day = F.col("full_date")
    return spine.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        fiscal_year(day, fiscal_start_month).alias("fiscal_year"),
        fiscal_quarter(day, fiscal_start_month).alias("fiscal_quarter"),
    )


def dim_currency(spark: SparkSession) -> DataFrame:
    return static_relation(
        spark, ("currency", "currency_name", "is_sdr_basket"), fixed_values.CURRENCIES
    )


def dim_product(spark: SparkSession) -> DataFrame:
    return static_relation(
        spark,
        ("deal_type", "product_name", "product_description"),
        fixed_values.PRODUCTS,
    )


def dim_counterparty(int_deals: DataFrame) -> DataFrame:
    """Counterparties seen in the book; the region is looked up after the distinct."""
    return (
        int_deals.select("cpty_code", "cpty_name", "cpty_country")
        .distinct()
        .withColumn("region", region_of("cpty_country"))
    )


def one_per_code(counterparties: DataFrame) -> DataFrame:
    """One row per code: its last name, then country, in order; a NULL comes first.

    Joins use this side, so a code under two names neither repeats a deal nor counts
    a total twice. The dimension itself keeps all names, and the grain check shows them.
    """
    last = F.max(F.struct("cpty_name", "cpty_country", "region")).alias("last")
    return counterparties.groupBy("cpty_code").agg(last).select("cpty_code", "last.*")
