"""Data-quality queries. None of them changes or drops a deal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tenorbook import fixed_values
from tenorbook.operators.dimensions import static_relation
from tenorbook.operators.staging import deal_casts
from tenorbook.operators.star import STAR_KEYS

FOREIGN_KEYS = {
    **{key: (name, key) for name, key in STAR_KEYS.items()},
    "trade_date_key": ("dim_date", "date_key"),
    "value_date_key": ("dim_date", "date_key"),
    "maturity_date_key": ("dim_date", "date_key"),
}

DOMAINS = {
    "deal_status": fixed_values.DEAL_STATUSES,
    "deal_type": fixed_values.DEAL_TYPES,
}


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once."""
    return (
        frame.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def grain_report(relations: Mapping[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """One row per relation: how many keys repeat, and how many rows too many."""
    return _union(
        duplicate_keys(frame, *keys).agg(
            F.lit(name).alias("relation"),
            F.lit(", ".join(keys)).alias("grain"),
            F.count("*").alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("excess_rows"),
        )
        for name, (frame, keys) in relations.items()
    )


def orphan_keys(fct: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign-key values without a dimension row, with the deals that use them.

    All six keys become rows of one pass over the fact and are counted in their own
    type, text or whole number; only the distinct values are turned into text and meet
    the dimensions. NULL keys refer to nothing and are no orphans. A left join with a
    marker stands in for the anti join: Spark would push an anti join below the count,
    onto six rows per deal.
    """

    def entry(key: str) -> Column:
        is_text = isinstance(fct.schema[key].dataType, StringType)
        as_text, as_number = (F.col(key), None) if is_text else (None, F.col(key).cast("long"))
        return F.struct(
            F.lit(key).alias("foreign_key"),
            (F.lit(None).cast("string") if as_text is None else as_text).alias("key_text"),
            (F.lit(None).cast("long") if as_number is None else as_number).alias("key_number"),
        )

    used = (
        fct.select(F.inline(F.array(*[entry(key) for key in FOREIGN_KEYS])))
        .filter(F.col("key_text").isNotNull() | F.col("key_number").isNotNull())
        .groupBy("foreign_key", "key_text", "key_number")
        .agg(F.count("*").alias("deal_count"))
        .select("foreign_key", F.coalesce("key_text", F.col("key_number").cast("string")).alias("key_value"), "deal_count")
    )
    known = _union(
        dims[name].select(
            F.lit(foreign_key).alias("foreign_key"),
            F.col(key).cast("string").alias("key_value"),
        )
        for foreign_key, (name, key) in FOREIGN_KEYS.items()
    )
    marked = known.distinct().withColumn("is_known", F.lit(True))
    return (
        used.join(marked, ["foreign_key", "key_value"], "left")
        .filter(F.col("is_known").isNull())
        .drop("is_known")
    )


def dimension_usage(dim: DataFrame, fct: DataFrame, key: str) -> DataFrame:
    """Every row of a dimension with the number of deals that refer to it."""
    used = fct.groupBy(key).agg(F.count("*").alias("deal_count"))
    return dim.join(used, key, "left").select(
        *dim.columns, F.coalesce("deal_count", F.lit(0)).alias("deal_count")
    )


def region_coverage(counterparties: DataFrame) -> DataFrame:
    """Counterparties per region, most first; `Other` should be empty."""
    return (
        counterparties.groupBy("region")
        .agg(F.count("*").alias("counterparty_count"))
        .orderBy(F.desc("counterparty_count"), "region")
    )


def missing_fx(int_deals: DataFrame) -> DataFrame:
    """Deals without a rate, per currency and month of the value date."""
    return (
        int_deals.filter(F.col("sdr_per_unit").isNull())
        .groupBy(
            "currency",
            F.year("value_date").alias("value_year"),
            F.month("value_date").alias("value_month"),
        )
        .agg(
            F.count("*").alias("deal_count"),
            F.sum("nominal_amount").alias("total_nominal"),
        )
    )


def domain_report(deals: DataFrame) -> DataFrame:
    """Every state and product code in use, and whether it is an accepted one."""
    used = (
        deals.select(*DOMAINS)
        .unpivot([], list(DOMAINS), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("deal_count"))
    )
    accepted = reduce(
        lambda a, b: a | b,
        [
            (F.col("column_name") == column) & F.col("value").isin(list(values))
            for column, values in DOMAINS.items()
        ],
    )
    return used.select(
        "column_name",
        "value",
        F.coalesce(accepted, F.lit(False)).alias("is_accepted"),
        "deal_count",
    )


def cast_failures(raw_deals: DataFrame) -> DataFrame:
    """Raw values that are not empty but have no typed form."""
    entries = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("raw_value"),
            typed.isNull().alias("untyped"),
        )
        for column, typed in deal_casts(raw_deals).items()
    ]
    # Filtered inside the array, so that only failures become rows.
    failed = F.filter(F.array(*entries), lambda x: x["untyped"] & (F.trim(x["raw_value"]) != ""))
    return raw_deals.select("deal_id", F.inline(failed)).drop("untyped")


def maturity_violations(
    deals: DataFrame, sight_type: str = "SIGHT_DEP"
) -> DataFrame:
    """Sight deals with a maturity, and other deals without one."""
    is_sight = F.coalesce(F.col("deal_type") == sight_type, F.lit(False))
    return deals.filter(is_sight != F.col("maturity_date").isNull())


def maturity_report(deals: DataFrame, sight_type: str = "SIGHT_DEP") -> DataFrame:
    """Per product: deals, deals with a maturity and breaches of the rule above."""
    is_sight = F.coalesce(F.col("deal_type") == sight_type, F.lit(False))
    return deals.groupBy("deal_type").agg(
        F.count("*").alias("deal_count"),
        F.count("maturity_date").alias("with_maturity"),
        F.count_if(is_sight != F.col("maturity_date").isNull()).alias("violations"),
    )


def row_counts(relations: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per relation; staging and conversion must not lose or add any."""
    return _union(
        frame.agg(F.lit(name).alias("relation"), F.count("*").alias("row_count"))
        for name, frame in relations.items()
    )


def column_listing(spark: SparkSession, relations: Mapping[str, DataFrame]) -> DataFrame:
    """Columns and types of the relations, read from their schemas alone."""
    rows = [
        (name, position, field.name, field.dataType.simpleString())
        for name, frame in relations.items()
        for position, field in enumerate(frame.schema.fields, 1)
    ]
    return static_relation(
        spark, ("relation", "position", "column_name", "data_type"), rows
    )
