from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from book import raw_deals, raw_rates, rows_of
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.operators import dimensions, exposure, star
from tenorbook.plans.build import Models
from tenorbook.sources.files import Sources

RATES = [("2023-03-31", "USD", "0.5"), ("2023-03-31", "CHF", "2")]


@pytest.fixture(scope="module")
def models(spark):
    deals = raw_deals(
        spark,
        {"nominal_amount": "100", "rate_pct": "2"},
        {"nominal_amount": "300", "rate_pct": "4", "deal_type": "SIGHT_DEP", "maturity_date": ""},
        {"nominal_amount": "50", "rate_pct": "1", "currency": "CHF", "cpty_code": "SNB_01",
         "cpty_name": "Swiss National Bank", "cpty_country": "CH", "portfolio": "TRSRY-EMEA"},
        {"nominal_amount": "10", "rate_pct": "n/a", "currency": "CHF", "cpty_code": "SNB_01",
         "cpty_name": "Swiss National Bank", "cpty_country": "CH", "portfolio": "TRSRY-EMEA"},
        {"nominal_amount": "70", "currency": "XXX", "cpty_country": "ZZ", "cpty_code": "Z"},
        {"nominal_amount": "9999", "deal_status": "CANCELLED"},
    )
    return Models(spark, Sources(deals, raw_rates(spark, *RATES)), Config())


def fct(models):
    return models.fct_currency_deposits


def test_by_currency(models):
    result = exposure.exposure_by_currency(fct(models), models.dim_currency)
    assert sorted(rows_of(result, "*")) == [
        ("CHF", "Swiss Franc", "N", 2, Decimal(120)),
        ("USD", "US Dollar", "Y", 2, Decimal(200)),
        ("XXX", None, None, 1, None),
    ]


def test_basket_counts_unknown_currencies_outside(models):
    result = exposure.exposure_sdr_basket(fct(models), models.dim_currency)
    assert rows_of(result, "*") == [(2, Decimal(200), 3, Decimal(120))]


def test_by_region_and_share(models):
    regions = exposure.exposure_by_region(fct(models), models.dim_counterparty)
    assert sorted(rows_of(regions, "*")) == [
        ("Asia-Pacific", 2, Decimal(200)),
        ("Europe", 2, Decimal(120)),
        ("Other", 1, None),
    ]
    shares = exposure.region_share(regions)
    assert sorted(rows_of(shares, "region", "share")) == [
        ("Asia-Pacific", Decimal("0.625")),
        ("Europe", Decimal("0.375")),
        ("Other", None),
    ]


def test_status_is_a_parameter(models):
    everything = exposure.exposure_by_portfolio(fct(models), status=None)
    assert everything.agg(F.sum("deal_count")).first()[0] == 6
    cancelled = exposure.exposure_by_portfolio(fct(models), status="CANCELLED")
    assert rows_of(cancelled, "*") == [("TRSRY-APAC", 1, Decimal("4999.5"))]


def test_cost_of_funds(models):
    result = exposure.cost_of_funds_by_currency(fct(models))
    found = {row.currency: row for row in result.collect()}
    # USD: (2 * 50 + 4 * 150) / 200; the CHF deal without a rate carries no weight.
    assert found["USD"].weighted_rate_pct == Decimal("3.5")
    assert found["USD"].mean_rate_pct == Decimal("3")
    assert found["CHF"].weighted_rate_pct == Decimal("1")
    assert (found["CHF"].deal_count, found["CHF"].weight_sdr) == (2, Decimal(100))
    assert found["XXX"].weighted_rate_pct is None


def test_fiscal_year_roles(models):
    def totals(role):
        frame = exposure.deposits_by_fiscal_year(
            fct(models), models.dim_date, models.dim_product, role
        )
        return {(r.fiscal_year, r.product_name): r.deal_count for r in frame.collect()}

    assert totals("value") == totals("trade") == {
        ("FY2023-24", "FIXBIS"): 4,
        ("FY2023-24", "Sight"): 1,
    }
    assert totals("maturity") == {("FY2024-25", "FIXBIS"): 4, (None, "Sight"): 1}


def test_top_k(models):
    ranked = exposure.top_counterparties(fct(models), models.dim_counterparty, 2)
    assert rows_of(ranked, "cpty_code", "cpty_name", "total_sdr") == [
        ("PBOC_01", "People's Bank of China", Decimal(200)),
        ("SNB_01", "Swiss National Bank", Decimal(120)),
    ]


def test_top_k_equals_a_cut_of_the_whole_report(spark, models):
    # Two names for one code, a code without a dimension row, and a tie.
    parties = models.dim_counterparty.unionByName(
        models.dim_counterparty.filter("cpty_code = 'PBOC_01'").withColumn(
            "cpty_name", F.lit("Another name")
        )
    ).filter("cpty_code <> 'Z'")
    whole = exposure.exposure_by_counterparty(fct(models), parties).orderBy(
        F.desc_nulls_last("total_sdr"), "cpty_code"
    )
    for k in (1, 2, 3, 4, 9):
        ranked = exposure.top_counterparties(fct(models), parties, k)
        assert rows_of(ranked, "*") == rows_of(whole, "*")[:k]
        codes = [r.cpty_code for r in ranked.collect()]
        assert len(set(codes)) == len(codes)


def test_a_code_under_two_names_and_countries_counts_once(models):
    other = models.dim_counterparty.filter("cpty_code = 'PBOC_01'").selectExpr(
        "cpty_code", "'Another name' AS cpty_name", "'US' AS cpty_country", "'Americas' AS region"
    )
    parties = models.dim_counterparty.unionByName(other)
    f = fct(models)
    for report in (
        exposure.exposure_by_counterparty(f, parties),
        exposure.exposure_by_region(f, parties),
    ):
        assert report.agg(F.sum("deal_count"), F.sum("total_sdr")).first() == (5, Decimal(320))
    dims = {name: getattr(models, name) for name in star.STAR_KEYS} | {"dim_counterparty": parties}
    assert star.star(f, dims).count() == 6


def test_every_report_adds_up_to_the_same_total(models):
    f, m = fct(models), models
    reports = [
        exposure.exposure_by_currency(f, m.dim_currency),
        exposure.exposure_by_product(f, m.dim_product),
        exposure.exposure_by_portfolio(f),
        exposure.exposure_by_counterparty(f, m.dim_counterparty),
        exposure.exposure_by_region(f, m.dim_counterparty),
        exposure.deposits_by_fiscal_year(f, m.dim_date, m.dim_product),
    ]
    sums = {r.agg(F.sum("deal_count"), F.sum("total_sdr")).first() for r in reports}
    assert sums == {(5, Decimal(320))}


def test_star_keeps_every_fact_row(models):
    dims = {name: getattr(models, name) for name in star.STAR_KEYS}
    wide = star.star(fct(models), dims)
    assert wide.count() == 6
    assert rows_of(wide.filter("currency = 'XXX'"), "region", "currency_name") == [("Other", None)]


def test_date_role_and_slicers(models):
    dated = star.with_date_role(fct(models), models.dim_date, "maturity")
    assert dated.count() == 6
    assert dated.filter("maturity_full_date IS NULL").count() == 1
    sliced = star.slice_by(dated, maturity_fiscal_year="FY2024-25", currency=["CHF", "XXX"])
    assert sliced.count() == 3
    assert star.slice_by(dated, maturity_full_date=date(2024, 4, 15)).count() == 5
    with pytest.raises(ValueError, match="role"):
        star.with_date_role(fct(models), models.dim_date, "booking")


def test_hot_counterparty_totals(spark):
    frame = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('C', id % 997)) AS cpty_code",
        "'VALIDATED' AS deal_status",
        "cast(1 AS decimal(33,8)) AS nominal_amount_sdr",
    )
    parties = (
        frame.select("cpty_code", F.lit("n").alias("cpty_name"), F.lit("CN").alias("cpty_country"))
        .distinct()
        .withColumn("region", F.lit("Asia-Pacific"))
    )
    assert rows_of(exposure.exposure_by_region(frame, parties), "*") == [
        ("Asia-Pacific", 30000, Decimal(30000))
    ]
    top = exposure.top_counterparties(frame, parties, 1)
    assert rows_of(top, "cpty_code", "deal_count") == [("HOT", 10000)]
    assert dimensions.dim_counterparty(parties).count() == 998
