"""Exposure reports over the star schema.

Each report first totals the fact by the key it needs and only then joins the
dimension, so at most one row per key meets the join. The partial aggregate on the
map side takes the weight off a hot key. Reports cover the active book unless
`status` names another state, or None for all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenorbook.functions.labels import region_of
from tenorbook.operators.dimensions import one_per_code

ACTIVE = "VALIDATED"


def _in_status(fct: DataFrame, status: str | None) -> DataFrame:
    return fct if status is None else fct.filter(F.col("deal_status") == status)


def book_totals(fct: DataFrame, *keys: str, status: str | None = ACTIVE) -> DataFrame:
    """Deal count and SDR total per key of the fact."""
    return (
        _in_status(fct, status)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("deal_count"),
            F.sum("nominal_amount_sdr").alias("total_sdr"),
        )
    )


def _roll_up(totals: DataFrame, *labels: str) -> DataFrame:
    return totals.groupBy(*labels).agg(
        F.sum("deal_count").alias("deal_count"), F.sum("total_sdr").alias("total_sdr")
    )


def exposure_by_portfolio(fct: DataFrame, status: str | None = ACTIVE) -> DataFrame:
    return book_totals(fct, "portfolio", status=status)


def exposure_by_currency(
    fct: DataFrame, currencies: DataFrame, status: str | None = ACTIVE
) -> DataFrame:
    totals = book_totals(fct, "currency", status=status)
    return totals.join(currencies, "currency", "left").select(
        "currency", "currency_name", "is_sdr_basket", "deal_count", "total_sdr"
    )


def exposure_by_product(
    fct: DataFrame, products: DataFrame, status: str | None = ACTIVE
) -> DataFrame:
    totals = book_totals(fct, "deal_type", status=status)
    return totals.join(products, "deal_type", "left").select(
        "deal_type", "product_name", "deal_count", "total_sdr"
    )


def exposure_by_counterparty(
    fct: DataFrame, counterparties: DataFrame, status: str | None = ACTIVE
) -> DataFrame:
    totals = book_totals(fct, "cpty_code", status=status)
    return totals.join(one_per_code(counterparties), "cpty_code", "left").select(
        "cpty_code", "cpty_name", "cpty_country", "region", "deal_count", "total_sdr"
    )


def exposure_by_region(
    fct: DataFrame, counterparties: DataFrame, status: str | None = ACTIVE
) -> DataFrame:
    totals = book_totals(fct, "cpty_code", status=status)
    regions = one_per_code(counterparties).select("cpty_code", "region")
    return _roll_up(totals.join(regions, "cpty_code", "left"), "region")


def counterparty_book(deals: DataFrame, status: str | None = ACTIVE) -> DataFrame:
    """`exposure_by_counterparty` straight from converted deals, which carry names and countries.

    Totals of the state asked for and the last name of each code, taken over all states as in the dimension, come from one aggregate, so
    the deals are read once and no dimension is built to be joined.
    """
    counts = F.lit(True) if status is None else F.coalesce(F.col("deal_status") == status, F.lit(False))
    named = F.when(F.col("cpty_code").isNotNull(), F.struct("cpty_name", "cpty_country"))  # a NULL code names nobody
    totals = deals.groupBy("cpty_code").agg(
        F.max(named).alias("last"),
        F.count_if(counts).alias("deal_count"),
        F.sum(F.when(counts, F.col("nominal_amount_sdr"))).alias("total_sdr"),
    )
    kept = totals.filter("deal_count > 0").select("cpty_code", "last.*", "deal_count", "total_sdr")
    region = F.when(F.col("cpty_code").isNotNull(), region_of("cpty_country"))
    return kept.select("cpty_code", "cpty_name", "cpty_country", region.alias("region"), "deal_count", "total_sdr")


def region_book(deals: DataFrame, status: str | None = ACTIVE) -> DataFrame:
    """`exposure_by_region` straight from converted deals."""
    return _roll_up(counterparty_book(deals, status), "region")


def region_share(region_exposure: DataFrame) -> DataFrame:
    """Share of each region in the SDR total.

    The window has no partition key on purpose: its input is the finished region
    report, which holds at most eight rows whatever the size of the book.
    """
    everything = F.sum("total_sdr").over(Window.partitionBy())
    return region_exposure.select(
        "region",
        "total_sdr",
        everything.alias("grand_total_sdr"),
        (F.col("total_sdr") / everything).cast("decimal(18,6)").alias("share"),
    )


def deposits_by_fiscal_year(
    fct: DataFrame,
    calendar: DataFrame,
    products: DataFrame,
    role: str = "value",
    status: str | None = ACTIVE,
) -> DataFrame:
    """Totals per fiscal year and product, on the chosen date of the deal."""
    key = f"{role}_date_key"
    totals = book_totals(fct, key, "deal_type", status=status)
    years = calendar.select(F.col("date_key").alias(key), "fiscal_year")
    names = products.select("deal_type", "product_name")
    labelled = totals.join(years, key, "left").join(names, "deal_type", "left")
    return _roll_up(labelled, "fiscal_year", "product_name")


def exposure_sdr_basket(
    fct: DataFrame, currencies: DataFrame, status: str | None = ACTIVE
) -> DataFrame:
    """One row: totals inside and outside the SDR basket."""
    by_currency = exposure_by_currency(fct, currencies, status)
    inside = F.coalesce(F.col("is_sdr_basket") == "Y", F.lit(False))
    return by_currency.agg(
        F.sum(F.when(inside, F.col("deal_count"))).alias("basket_deals"),
        F.sum(F.when(inside, F.col("total_sdr"))).alias("basket_sdr"),
        F.sum(F.when(~inside, F.col("deal_count"))).alias("other_deals"),
        F.sum(F.when(~inside, F.col("total_sdr"))).alias("other_sdr"),
    )


def cost_of_funds_by_currency(
    fct: DataFrame, status: str | None = ACTIVE
) -> DataFrame:
    """Mean rate per currency, weighted by SDR and unweighted.

    Only deals with both a rate and an SDR value carry weight. The SDR value is
    narrowed to 27 digits so that its product with the rate keeps every decimal.
    """
    rate = F.col("rate_pct")
    weight = F.when(rate.isNotNull(), F.col("nominal_amount_sdr").cast("decimal(27,8)"))
    sums = (
        _in_status(fct, status)
        .groupBy("currency")
        .agg(
            F.count("*").alias("deal_count"),
            F.sum(rate * weight).alias("rate_times_sdr"),
            F.sum(weight).cast("decimal(38,8)").alias("weight_sdr"),
            F.sum(rate).alias("rate_sum"),
            F.count(rate).alias("rate_count"),
        )
    )
    # nullif: a currency whose rated deals sum to nothing has no weighted mean.
    weighted = F.col("rate_times_sdr") / F.nullif("weight_sdr", F.lit(0))
    simple = F.col("rate_sum") / F.nullif("rate_count", F.lit(0))
    return sums.select(
        "currency",
        "deal_count",
        "rate_times_sdr",
        "weight_sdr",
        weighted.cast("decimal(18,6)").alias("weighted_rate_pct"),
        simple.cast("decimal(18,6)").alias("mean_rate_pct"),
    )


def top_counterparties(
    fct: DataFrame,
    counterparties: DataFrame,
    k: int = 10,
    status: str | None = ACTIVE,
) -> DataFrame:
    """The k largest depositors; ties are broken by code.

    The ranking is made on the totals. The dimension is then reduced to the ranked
    codes by a semi join, which Spark carries below the distinct behind it, so the
    names of all other counterparties are never shuffled.
    """
    largest_first = (F.desc_nulls_last("total_sdr"), F.col("cpty_code"))
    ranked = (
        book_totals(fct, "cpty_code", status=status).orderBy(*largest_first).limit(k)
    )
    # The filter passes every row. Naming both totals keeps the two uses of the
    # ranking alike, so that the book is totalled once and its shuffle reused.
    codes = ranked.filter("deal_count > 0").select("cpty_code")
    named = counterparties.join(codes, "cpty_code", "left_semi")
    return (
        ranked.join(one_per_code(named), "cpty_code", "left")
        .select(
            "cpty_code",
            "cpty_name",
            "cpty_country",
            "region",
            "deal_count",
            "total_sdr",
        )
        .orderBy(*largest_first)
    )
