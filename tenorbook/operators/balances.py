"""Balances at points in time: the ladder of deals already valued, and the book day by day.

A deal that lives from its value date to its maturity adds to every date in between. Here it adds once, at the date its
life (or its stay in a bucket) begins, and is taken off once, at the date it ends. Those differences are summed by date
and then carried forward. What is moved is bounded by dates, whatever the number of deals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.functions.dates import decode_date_key, month_end
from tenorbook.operators.dimensions import date_bounds, date_spine

_SUMS = ("deal_count", "rated_count", "total_sdr")


def _counts() -> list[Column]:
    """Deals, deals with an SDR value, and their SDR, which are what all totals below are made of."""
    sdr = F.col("nominal_amount_sdr")
    return [F.count("*").alias("deal_count"), F.count(sdr).alias("rated_count"), F.sum(sdr).alias("total_sdr")]


def _summed() -> list[Column]:
    return [F.sum(c).cast("decimal(38,8)" if c == "total_sdr" else "long").alias(c) for c in _SUMS]


def _event(where: str, position: Column, sign: int) -> Column:
    sums = [F.col(c) if sign > 0 else F.negate(F.col(c)) for c in _SUMS]
    return F.struct(position.alias(where), *[s.alias(c) for s, c in zip(sums, _SUMS, strict=True)])


def _month_number(day: Column, cfg: Config) -> Column:
    """Number of the first as-of date that is not before a day, which is the end of the day's month."""
    months = F.year(day) * 12 + F.month(day) - (cfg.as_of_start.year * 12 + cfg.as_of_start.month)
    return F.least(F.greatest(months, F.lit(0)), F.lit(cfg.as_of_months))


def _valued(fct: DataFrame, cfg: Config) -> DataFrame:
    """Active deals with a value date that are sight money or mature after it."""
    is_sight = F.coalesce(F.col("deal_type") == cfg.sight_type, F.lit(False))
    value, maturity = F.col("value_date_key"), F.col("maturity_date_key")
    return fct.filter((F.col("deal_status") == cfg.active_status) & value.isNotNull() & (is_sight | (maturity > value))).select(
        is_sight.alias("is_sight"), value, F.when(~is_sight, maturity).alias("maturity_date_key"), "nominal_amount_sdr"
    )


def value_maturity_profile(fct: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Active book by the as-of date from which it counts and by maturity: at most as-of dates times days rows."""
    valued = _month_number(decode_date_key(F.col("value_date_key")), cfg)
    return _valued(fct, cfg).groupBy("is_sight", valued.alias("from_n"), "maturity_date_key").agg(*_counts())


def point_in_time_ladder(fct: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The maturity ladder of deals valued by the as-of date: as_of_date, maturity_bucket, deal_count, total_sdr.

    A deal counts from the first as-of date that is not before its value date; one without a valid value date never does. Each
    bucket is a stretch of as-of dates, given by maturity alone: a profile row has at most two events per bucket.
    """
    n, maturity = F.lit(cfg.as_of_months), decode_date_key(F.col("maturity_date_key"))
    edges = [0, *[days for days, _ in cfg.bucket_edges]]
    labels = [*[label for _, label in cfg.bucket_edges], cfg.last_bucket]
    stays = [F.struct(F.lit(cfg.sight_bucket).alias("maturity_bucket"), F.col("from_n").alias("first"), F.when(F.col("is_sight"), n).otherwise(0).alias("last"))]
    for k, label in enumerate(labels):
        begin = F.col("from_n") if k + 1 == len(edges) else F.greatest("from_n", _month_number(F.date_sub(maturity, edges[k + 1]), cfg))
        end = _month_number(F.date_sub(maturity, edges[k]), cfg)
        stays.append(F.struct(F.lit(label).alias("maturity_bucket"), begin.alias("first"), F.when(~F.col("is_sight"), end).otherwise(0).alias("last")))
    stayed = value_maturity_profile(fct, cfg).select(*_SUMS, F.inline(F.filter(F.array(*stays), lambda s: s["first"] < s["last"])))
    events = F.array(_event("n", F.col("first"), 1), _event("n", F.col("last"), -1))
    changes = stayed.select("maturity_bucket", F.inline(events)).filter(F.col("n") < n).groupBy("maturity_bucket", "n").agg(*_summed())
    # Carried to every later as-of date: a bucket has at most one change per date.
    carried = changes.select("maturity_bucket", F.explode(F.sequence("n", n - 1)).alias("n"), *_SUMS).groupBy("maturity_bucket", "n").agg(*_summed())
    return carried.filter("deal_count > 0").select(
        month_end(F.lit(cfg.as_of_start), F.col("n")).alias("as_of_date"),
        "maturity_bucket",
        "deal_count",
        F.when(F.col("rated_count") > 0, F.col("total_sdr")).alias("total_sdr"),
    )


def daily_book(fct: DataFrame, start: dt.date, end: dt.date, cfg: Config = Config()) -> DataFrame:
    """The live book on every day from start to end: full_date, deal_count, total_sdr.

    A deal lives from its value date to the day before its maturity, sight money from its value date on. Changes are summed by day, carried
    forward inside their month, and months' totals are carried to later months, so no step orders all days in one task. A day on which no deal
    with an SDR value lives has 0.
    """
    first = F.greatest(decode_date_key(F.col("value_date_key")), F.lit(start))
    lives = _valued(fct, cfg).select(first.alias("first"), decode_date_key(F.col("maturity_date_key")).alias("last"), "nominal_amount_sdr")
    spans = lives.filter((F.col("first") <= F.lit(end)) & (F.col("last").isNull() | (F.col("last") > F.col("first")))).groupBy("first", "last").agg(*_counts())
    events = F.array(_event("day", F.col("first"), 1), _event("day", F.col("last"), -1))
    changes = spans.select(F.inline(events)).filter(F.col("day") <= F.lit(end)).groupBy("day").agg(*_summed())
    inside = changes.select(F.explode(F.sequence("day", F.least(F.last_day("day"), F.lit(end)))).alias("day"), *_SUMS).groupBy("day").agg(*_summed())
    month = F.trunc("day", "month")
    months = changes.groupBy(month.alias("month")).agg(*_summed()).filter(F.add_months("month", 1) <= F.lit(end))
    later = F.sequence(F.add_months("month", 1), F.lit(end), F.expr("INTERVAL 1 MONTH"))
    before = months.select(F.explode(later).alias("month"), *_SUMS).groupBy("month").agg(*[c.alias(f"before_{n}") for c, n in zip(_summed(), _SUMS, strict=True)])
    days = date_spine(date_bounds(fct.sparkSession, start, end)).select("full_date", F.trunc("full_date", "month").alias("month"))
    joined = days.join(inside, F.col("full_date") == F.col("day"), "left").join(before, "month", "left")

    def both(name: str, kind: str) -> Column:
        inside_month, earlier = (F.coalesce(c, F.lit(0)).cast(kind) for c in (name, f"before_{name}"))
        return (inside_month + earlier).alias(name)

    # One digit less than 38, so that the sum of two keeps all eight places.
    return joined.select("full_date", both("deal_count", "long"), both("total_sdr", "decimal(37,8)"))


def monthly_average_book(daily: DataFrame) -> DataFrame:
    """Per month: its end, its days in the daily book, and the mean SDR total over them."""
    sums = daily.groupBy(F.last_day("full_date").alias("month_end")).agg(
        F.count("*").alias("days"), F.sum("deal_count").alias("deal_days"), F.sum("total_sdr").cast("decimal(38,8)").alias("sdr_days")
    )
    return sums.select("*", (F.col("sdr_days") / F.col("days")).cast("decimal(38,2)").alias("average_sdr"))
