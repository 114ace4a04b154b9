from __future__ import annotations

from decimal import Decimal

import pytest
from book import raw_deals, raw_rates, rows_of

from tenorbook.config import Config
from tenorbook.operators import quality
from tenorbook.plans.build import Models
from tenorbook.sources.files import Sources

RATES = [("2023-03-31", "USD", "0.5")]


@pytest.fixture(scope="module")
def raw(spark):
    return raw_deals(
        spark,
        {},
        {"deal_id": "D000"},
        {"deal_type": "REPO", "deal_status": "NEW", "currency": "XXX"},
        {"deal_type": "SIGHT_DEP", "cpty_name": "PBoC"},
        {"maturity_date": "", "nominal_amount": "abc", "value_date": "2023-4-1"},
        {"maturity_date": "2030-01-01", "deal_type": None, "rate_pct": " "},
    )


@pytest.fixture(scope="module")
def models(spark, raw):
    return Models(spark, Sources(raw, raw_rates(spark, *RATES, *RATES)), Config())


def test_grain(models):
    report = quality.grain_report(
        {
            "stg_deals": (models.stg_deals, ("deal_id",)),
            "dim_counterparty": (models.dim_counterparty, ("cpty_code",)),
            "dim_currency": (models.dim_currency, ("currency",)),
            "stg_fx_rates": (models.stg_fx_rates, ("rate_date", "currency_code")),
        }
    )
    assert sorted(rows_of(report, "*")) == [
        ("dim_counterparty", "cpty_code", 1, 1),
        ("dim_currency", "currency", 0, 0),
        ("stg_deals", "deal_id", 1, 1),
        ("stg_fx_rates", "rate_date, currency_code", 1, 1),
    ]


def test_orphans(models):
    names = ("dim_counterparty", "dim_currency", "dim_product", "dim_date")
    dims = {name: getattr(models, name) for name in names}
    found = quality.orphan_keys(models.fct_currency_deposits, dims)
    assert sorted(rows_of(found, "*")) == [
        ("currency", "XXX", 1),
        ("deal_type", "REPO", 1),
        # Once per repeated rate.
        ("maturity_date_key", "20300101", 2),
    ]


def test_usage_lists_unused_rows_too(models):
    used = quality.dimension_usage(models.dim_currency, models.stg_deals, "currency")
    counts = {row.currency: row.deal_count for row in used.collect()}
    assert (len(counts), counts["USD"], counts["EUR"]) == (10, 5, 0)


def test_domains(models):
    rejected = quality.domain_report(models.stg_deals).filter("NOT is_accepted")
    assert set(rows_of(rejected, "column_name", "value", "deal_count")) == {
        ("deal_status", "NEW", 1),
        ("deal_type", "REPO", 1),
        ("deal_type", None, 1),
    }


def test_cast_failures_skip_blank_values(raw):
    assert sorted(rows_of(quality.cast_failures(raw), "*")) == [
        ("D004", "nominal_amount", "abc"),
        ("D004", "value_date", "2023-4-1"),
    ]


def test_maturity_rule(models):
    assert sorted(rows_of(quality.maturity_violations(models.stg_deals), "deal_id")) == [
        ("D003",),
        ("D004",),
    ]
    report = {r.deal_type: r.violations for r in quality.maturity_report(models.stg_deals).collect()}
    assert report == {"FIXBIS_DEP": 1, "SIGHT_DEP": 1, "REPO": 0, None: 0}


def test_missing_fx(models):
    assert set(rows_of(quality.missing_fx(models.int_deals_with_sdr), "*")) == {
        ("USD", None, None, 1, None),
        ("XXX", 2023, 4, 1, Decimal(500000000)),
    }


def test_row_counts_show_the_repeated_rate(models):
    report = quality.row_counts(
        {"stg_deals": models.stg_deals, "int_deals_with_sdr": models.int_deals_with_sdr}
    )
    assert sorted(rows_of(report, "*")) == [("int_deals_with_sdr", 10), ("stg_deals", 6)]


def test_region_coverage_is_ordered(models):
    assert rows_of(quality.region_coverage(models.dim_counterparty), "*") == [("Asia-Pacific", 2)]


def test_column_listing(spark, models):
    listing = quality.column_listing(spark, {"dim_product": models.dim_product})
    assert rows_of(listing, "position", "column_name", "data_type") == [
        (1, "deal_type", "string"),
        (2, "product_name", "string"),
        (3, "product_description", "string"),
    ]
