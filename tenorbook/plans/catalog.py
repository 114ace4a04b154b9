"""Named queries over a book derived from order tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.operators import balances, dimensions, exposure, ladder, quality, star
from tenorbook.operators.staging import stage_deals, stage_fx_rates
from tenorbook.plans.build import Models, publish_views
from tenorbook.plans.publishing import publish
from tenorbook.schemas import DEALS_RAW, ORDER_TABLES
from tenorbook.sources.buckets import bucket_published
from tenorbook.sources.files import Sources, read_fx_rates, write_csv
from tenorbook.sources.loading import load_deals, loaded_deals, rejected_lines
from tenorbook.sources.order_book import deals_from_orders, fx_from_month_ends
from tenorbook.sources.scratch import new_folder
from tenorbook.sources.versions import published_counts, published_tables

# A deal is valued two days after its order and matures within seven years of that.
LONGEST_TERM = dt.timedelta(days=2 + 7 * 365)
AS_OF = dt.date(2000, 6, 30)


class Book:
    """Sources and models over one folder of order tables, composed on first use."""

    def __init__(
        self, spark: SparkSession, folder: str, **rules: str
    ) -> None:
        """`rules` are further values of the configuration."""
        self.spark = spark
        self.rules = rules
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(ORDER_TABLES[name]).parquet(
            f"{self.folder}/{name}.parquet"
        )

    @cached_property
    def config(self) -> Config:
        """Calendar and as-of months that cover the orders, from their first and last day."""
        day = F.col("o_orderdate").cast("date")
        first, last = self.table("orders").agg(F.min(day), F.max(day)).first()
        if first is None:
            return Config(**self.rules)
        return Config(
            **self.rules,
            calendar_start=first.replace(month=1, day=1),
            calendar_end=(last + LONGEST_TERM).replace(month=12, day=31),
            as_of_start=first.replace(day=1),
            as_of_months=(last.year - first.year) * 12 + last.month - first.month + 1,
        )

    @property
    def book_end(self) -> dt.date:
        """Last day of the last as-of month."""
        months = self.config.as_of_start.month - 1 + self.config.as_of_months
        year, month = divmod(months, 12)
        return dt.date(self.config.as_of_start.year + year, month + 1, 1) - dt.timedelta(1)

    @cached_property
    def sources(self) -> Sources:
        period = dimensions.date_bounds(self.spark, self.config.as_of_start, self.book_end)
        return Sources(
            deals_from_orders(
                self.table("orders"), self.table("customer"), self.table("nation")
            ),
            fx_from_month_ends(dimensions.month_end_spine(period)),
        )

    @cached_property
    def models(self) -> Models:
        return Models(self.spark, self.sources, self.config)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self.models, name)

    def pick(self, *names: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in names}

    @property
    def fct(self) -> DataFrame:
        return self["fct_currency_deposits"]

    @cached_property
    def traded_month_ends(self) -> DataFrame:
        """Month-ends from the first to the last trade in the book."""
        traded = F.col("trade_date")
        return dimensions.month_end_spine(
            dimensions.observed_bounds(self["stg_deals"], traded, traded)
        )

    @cached_property
    def traded_fx_rates(self) -> DataFrame:
        return fx_from_month_ends(self.traded_month_ends)

    @cached_property
    def covered_days(self) -> DataFrame:
        """Days from the first trade to the last maturity in the book."""
        return dimensions.date_spine(
            dimensions.observed_bounds(
                self["stg_deals"], F.col("trade_date"), F.col("maturity_date")
            )
        )

    @cached_property
    def trading_calendar(self) -> DataFrame:
        """Calendar that ends with the trading period, as a book calendar would."""
        bounds = dimensions.date_bounds(
            self.spark, self.config.calendar_start, self.book_end
        )
        return dimensions.dim_date(dimensions.date_spine(bounds))


def _grain(b: Book) -> DataFrame:
    return quality.grain_report(
        {
            "fct_currency_deposits": (b.fct, ("deal_id",)),
            "dim_counterparty": (b["dim_counterparty"], ("cpty_code",)),
            "dim_currency": (b["dim_currency"], ("currency",)),
            "dim_product": (b["dim_product"], ("deal_type",)),
            "dim_date": (b["dim_date"], ("full_date",)),
            "mart_maturity_ladder": (
                b["mart_maturity_ladder"],
                ("as_of_date", "maturity_bucket"),
            ),
            "stg_fx_rates": (b["stg_fx_rates"], ("rate_date", "currency_code")),
            "customer": (b.table("customer"), ("c_custkey",)),
        }
    )


def _orphans(b: Book) -> DataFrame:
    dims = b.pick("dim_counterparty", "dim_product", "dim_currency")
    return quality.orphan_keys(b.fct, {**dims, "dim_date": b.trading_calendar})


def _row_counts(b: Book) -> DataFrame:
    return quality.row_counts(
        {
            "src_deals": b.sources.deals,
            "stg_deals": b["stg_deals"],
            "int_deals_with_sdr": b["int_deals_with_sdr"],
            "fct_currency_deposits": b.fct,
        }
    )


def _by_fiscal_year(role: str) -> Callable[[Book], DataFrame]:
    return lambda b: exposure.deposits_by_fiscal_year(
        b.fct, b["dim_date"], b["dim_product"], role, b.config.active_status
    )


def _by_region(b: Book) -> DataFrame:
    return exposure.region_book(b["int_deals_with_sdr"], b.config.active_status)


def _sliced_by_region(b: Book) -> DataFrame:
    dollars = star.slice_by(b.fct, currency="USD")
    sliced = star.slice_by_calendar(dollars, b["dim_date"], "value", fiscal_year="FY1999-00")
    return exposure.exposure_by_region(
        sliced, b["dim_counterparty"], b.config.active_status
    )


def _daily(b: Book) -> DataFrame:
    return balances.daily_book(b.fct, b.config.as_of_start, b.book_end, b.config)


def _stored_extracts(b: Book) -> str:
    """Folder with both extracts as CSV files; every 211th deal's line is one field short, every 223rd one too long."""
    folder = new_folder(b.spark, "extracts")
    number = F.regexp_extract("deal_id", "([0-9]+)$", 1).cast("long")
    fields = F.array(*[F.coalesce(c, F.lit("")) for c in DEALS_RAW.names])
    dealt = F.when(number % 211 == 0, F.slice(fields, 1, len(DEALS_RAW.names) - 1)).when(number % 223 == 0, F.concat(fields, F.array(F.lit("extra"))))
    line = F.array_join(dealt.otherwise(fields), ",")
    # One text column whose name is the header line, written without quoting.
    lines = b.sources.deals.select(line.alias(",".join(DEALS_RAW.names)))
    lines.write.options(header=True, sep="\u0001", quote="").csv(f"{folder}/src_deals.csv")
    write_csv(b.traded_fx_rates, f"{folder}/src_fx_rates.csv")
    return folder


def _loaded(b: Book, folder: str) -> str:
    """Table loaded from the stored extract, twice, as a repeated delivery would be."""
    table = f"{folder}/deals"
    for _ in range(2):
        load_deals(b.spark, f"{folder}/src_deals.csv", table, "first")
    return table


def _loaded_deals(b: Book) -> DataFrame:
    return stage_deals(loaded_deals(b.spark, _loaded(b, _stored_extracts(b))))


def _rejected_lines(b: Book) -> DataFrame:
    return rejected_lines(b.spark, _loaded(b, _stored_extracts(b)))


def _stored_fx_rates(b: Book) -> DataFrame:
    folder = new_folder(b.spark, "rates")
    write_csv(b.traded_fx_rates, f"{folder}/src_fx_rates.csv")
    return stage_fx_rates(read_fx_rates(b.spark, f"{folder}/src_fx_rates.csv"), b.config.rate_type)


def _published(b: Book) -> str:
    """Folder with a version published from stored extracts."""
    folder = new_folder(b.spark, "published")
    write_csv(b.sources.deals, f"{folder}/in/src_deals.csv")
    write_csv(b.sources.fx_rates, f"{folder}/in/src_fx_rates.csv")
    publish(b.spark, Sources.from_files(b.spark, f"{folder}/in"), f"{folder}/out", b.config)
    return f"{folder}/out"


def _published_counts(b: Book) -> DataFrame:
    counts = published_counts(b.spark, _published(b))
    return counts.filter(F.col("relation").isin("src_deals", "stg_deals", "int_deals_with_sdr", "fct_currency_deposits"))


def _published_sliced_by_region(b: Book) -> DataFrame:
    tables = published_tables(b.spark, _published(b))
    dollars = star.slice_by(tables["fct_currency_deposits"], currency="USD")
    sliced = star.slice_by_calendar(dollars, tables["dim_date"], "value", fiscal_year="FY1999-00")
    return exposure.exposure_by_region(sliced, tables["dim_counterparty"], b.config.active_status)


def _published_columns(b: Book) -> DataFrame:
    """Columns of the published views, with the rows of each, as a user of the views sees them."""
    tables = published_tables(b.spark, _published(b))
    publish_views(tables)
    listed = quality.column_listing(b.spark, {name: b.spark.table(name) for name in tables})
    return listed.join(quality.row_counts(tables), "relation")


def _bucketed(b: Book) -> dict[str, DataFrame]:
    """Published deals in buckets, under names of their own."""
    path = new_folder(b.spark, "buckets")
    return bucket_published(b.spark, _published(b), path, path.rsplit("/", 1)[1].replace("-", "_"), buckets=16)


def _bucketed_grain(b: Book) -> DataFrame:
    return quality.grain_report({"fct_currency_deposits": (_bucketed(b)["fct_currency_deposits"], ("deal_id",))})


def _bucketed_names(b: Book) -> DataFrame:
    """Each deal of the fact with the counterparty's name as the converted deal has it, bucket by bucket."""
    tables = _bucketed(b)
    names = tables["int_deals_with_sdr"].select("deal_id", "cpty_name", "cpty_country")
    return tables["fct_currency_deposits"].join(names, "deal_id").select("deal_id", "cpty_name", "cpty_country", "nominal_amount_sdr")


QUERIES: dict[str, Callable[[Book], DataFrame]] = {
    # sources and staging
    "src_deals": lambda b: b.sources.deals,
    "src_fx_rates": lambda b: b.traded_fx_rates,
    "stg_deals": lambda b: b["stg_deals"],
    "stg_fx_rates": lambda b: stage_fx_rates(b.traded_fx_rates),
    "int_deals_with_sdr": lambda b: b["int_deals_with_sdr"],
    # dimensions and fact
    "date_spine": lambda b: b.covered_days,
    "month_end_spine": lambda b: b.traded_month_ends,
    "dim_date": lambda b: dimensions.dim_date(b.covered_days),
    "dim_currency": lambda b: quality.dimension_usage(
        b["dim_currency"], b.fct, "currency"
    ),
    "dim_product": lambda b: quality.dimension_usage(
        b["dim_product"], b.fct, "deal_type"
    ),
    "dim_counterparty": lambda b: b["dim_counterparty"],
    "fct_currency_deposits": lambda b: b.fct,
    "star_deposits": lambda b: star.star(b.fct, b.pick(*star.STAR_KEYS)),
    # maturity ladder
    "active_deals": lambda b: ladder.active_deals(b.fct, b.config),
    "mart_maturity_ladder": lambda b: b["mart_maturity_ladder"],
    "ladder_exposed_rows": lambda b: ladder.exposed_profile(b.fct, b.config),
    "ladder_at_date": lambda b: star.slice_by(
        b["mart_maturity_ladder"], as_of_date=AS_OF
    ),
    "ladder_deals_at_date": lambda b: ladder.deals_outstanding_at(
        b.fct, AS_OF, b.config
    ),
    "point_in_time_ladder": lambda b: balances.point_in_time_ladder(b.fct, b.config),
    "daily_book": _daily,
    "monthly_average_book": lambda b: balances.monthly_average_book(_daily(b)),
    "avg_active_book": lambda b: ladder.average_active_book(b["mart_maturity_ladder"]),
    # exposure reports
    "exposure_by_region": _by_region,
    "exposure_by_region_sliced": _sliced_by_region,
    "region_share": lambda b: exposure.region_share(_by_region(b)),
    "exposure_by_currency": lambda b: exposure.exposure_by_currency(
        b.fct, b["dim_currency"], b.config.active_status
    ),
    "exposure_by_product": lambda b: exposure.exposure_by_product(
        b.fct, b["dim_product"], b.config.active_status
    ),
    "exposure_by_portfolio": lambda b: exposure.exposure_by_portfolio(
        b.fct, b.config.active_status
    ),
    "exposure_by_counterparty": lambda b: exposure.counterparty_book(
        b["int_deals_with_sdr"], b.config.active_status
    ),
    "top_counterparties": lambda b: exposure.top_counterparties(
        b.fct, b["dim_counterparty"], status=b.config.active_status
    ),
    "exposure_sdr_basket": lambda b: exposure.exposure_sdr_basket(
        b.fct, b["dim_currency"], b.config.active_status
    ),
    "cost_of_funds_by_currency": lambda b: exposure.cost_of_funds_by_currency(
        b.fct, b.config.active_status
    ),
    "deposits_by_value_fy": _by_fiscal_year("value"),
    "deposits_by_trade_fy": _by_fiscal_year("trade"),
    "deposits_by_maturity_fy": _by_fiscal_year("maturity"),
    # data quality
    "dq_grain": _grain,
    "dq_orphans": _orphans,
    "dq_region_coverage": lambda b: quality.region_coverage(b["dim_counterparty"]),
    "dq_missing_fx": lambda b: quality.missing_fx(b["int_deals_with_sdr"]),
    "dq_domains": lambda b: quality.domain_report(b["stg_deals"]),
    "dq_cast_failures": lambda b: quality.cast_failures(b.sources.deals),
    "dq_maturity_rule": lambda b: quality.maturity_report(
        b["stg_deals"], b.config.sight_type
    ),
    "dq_row_counts": _row_counts,
    # loading and publishing; these write to the shared folder first
    "loaded_deals": _loaded_deals,
    "rejected_lines": _rejected_lines,
    "stored_fx_rates": _stored_fx_rates,
    "published_row_counts": _published_counts,
    "published_columns": _published_columns,
    "published_exposure_sliced": _published_sliced_by_region,
    "bucketed_grain": _bucketed_grain,
    "bucketed_names": _bucketed_names,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """The named query over the order tables in a folder."""
    return QUERIES[name](Book(spark, folder))
