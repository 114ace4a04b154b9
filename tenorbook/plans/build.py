"""The models in dependency order, as lazy frames or as published tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tenorbook.config import Config
from tenorbook.operators import dimensions
from tenorbook.operators.conversion import to_sdr
from tenorbook.operators.fact import fact_deposits
from tenorbook.operators.ladder import maturity_ladder
from tenorbook.operators.staging import stage_deals, stage_fx_rates
from tenorbook.sources.files import Sources

LAYERS = {
    "staging": ("stg_deals", "stg_fx_rates"),
    "intermediate": ("int_deals_with_sdr",),
    "mart": (
        "dim_counterparty",
        "dim_currency",
        "dim_date",
        "dim_product",
        "fct_currency_deposits",
        "mart_maturity_ladder",
    ),
}


class Models:
    """Every model as an attribute, composed from its inputs on first access."""

    def __init__(
        self, spark: SparkSession, sources: Sources, cfg: Config = Config()
    ) -> None:
        self.spark = spark
        self.sources = sources
        self.cfg = cfg

    @cached_property
    def stg_deals(self) -> DataFrame:
        return stage_deals(self.sources.deals)

    @cached_property
    def stg_fx_rates(self) -> DataFrame:
        return stage_fx_rates(
            self.sources.fx_rates, self.cfg.rate_type, self.cfg.round_rates
        )

    @cached_property
    def int_deals_with_sdr(self) -> DataFrame:
        return to_sdr(self.stg_deals, self.stg_fx_rates)

    @cached_property
    def dim_counterparty(self) -> DataFrame:
        return dimensions.dim_counterparty(self.int_deals_with_sdr)

    @cached_property
    def dim_currency(self) -> DataFrame:
        return dimensions.dim_currency(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        days = dimensions.date_spine(
            dimensions.date_bounds(
                self.spark, self.cfg.calendar_start, self.cfg.calendar_end
            )
        )
        return dimensions.dim_date(days, self.cfg.fiscal_start_month)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.spark)

    @cached_property
    def fct_currency_deposits(self) -> DataFrame:
        return fact_deposits(self.int_deals_with_sdr)

    @cached_property
    def mart_maturity_ladder(self) -> DataFrame:
        return maturity_ladder(self.fct_currency_deposits, self.cfg)


def build(
    spark: SparkSession,
    sources: Sources,
    cfg: Config = Config(),
    layers: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """All models, or those of the named layers. Nothing runs until one is used."""
    unknown = set(layers or ()) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    models = Models(spark, sources, cfg)
    return {
        name: getattr(models, name)
        for layer, names in LAYERS.items()
        if layers is None or layer in layers
        for name in names
    }


def publish_views(frames: Mapping[str, DataFrame]) -> None:
    """Each frame as a temporary view of the same name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
