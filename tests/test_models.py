from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from book import raw_deals, raw_rates, rows_of
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.operators import dimensions
from tenorbook.operators.conversion import to_sdr
from tenorbook.operators.fact import fact_deposits
from tenorbook.operators.staging import stage_deals, stage_fx_rates
from tenorbook.plans.catalog import Book
from tenorbook.sources.order_book import deals_from_orders


def test_staging_types(spark):
    staged = stage_deals(raw_deals(spark, {}))
    assert dict(staged.dtypes) == {
        "deal_id": "string",
        "deal_type": "string",
        "cpty_code": "string",
        "cpty_name": "string",
        "cpty_country": "string",
        "trade_date": "date",
        "value_date": "date",
        "maturity_date": "date",
        "currency": "string",
        "nominal_amount": "decimal(20,2)",
        "rate_pct": "decimal(10,6)",
        "rate_decimal": "decimal(16,11)",
        "deal_status": "string",
        "portfolio": "string",
        "book": "string",
        "created_dt": "timestamp_ntz",
        "last_modified_dt": "timestamp_ntz",
    }
    [row] = staged.collect()
    assert row.rate_pct == Decimal("2.5")
    assert row.rate_decimal == Decimal("0.025")
    assert row.created_dt == datetime(2023, 4, 13, 9, 15)


def test_bad_values_become_null_and_rows_stay(spark):
    staged = stage_deals(
        raw_deals(
            spark,
            {"nominal_amount": "1.005", "maturity_date": ""},
            {"nominal_amount": "5e8", "rate_pct": "n/a"},
            {"nominal_amount": "9" * 22, "trade_date": "2023-04"},
            {"nominal_amount": None, "created_dt": "yesterday"},
        )
    )
    assert rows_of(staged.orderBy("deal_id"), "nominal_amount", "maturity_date") == [
        (Decimal("1.01"), None),
        (Decimal("500000000.00"), date(2024, 4, 15)),
        (None, date(2024, 4, 15)),
        (None, date(2024, 4, 15)),
    ]
    assert staged.filter("rate_pct IS NULL AND rate_decimal IS NULL").count() == 1
    assert staged.filter("trade_date IS NULL").count() == 1
    assert staged.filter("created_dt IS NULL").count() == 1


def test_staging_accepts_numeric_columns(spark):
    raw = raw_deals(spark, {}).withColumn("nominal_amount", F.lit(2.345e6))
    assert stage_deals(raw).first().nominal_amount == Decimal("2345000.00")


RATES = [
    ("2023-03-31", "USD", "0.752140"),
    ("2023-02-28", "USD", "0.700000"),
    ("2022-12-31", "USD", "0.600000"),
    ("2024-01-31", "USD", "0.800000"),
]


@pytest.mark.parametrize(
    ("value_date", "rate_date"),
    [
        ("2023-04-15", date(2023, 3, 31)),
        ("2023-04-01", date(2023, 3, 31)),
        ("2023-03-31", date(2023, 2, 28)),
        ("2023-01-15", date(2022, 12, 31)),
        ("2024-02-29", date(2024, 1, 31)),
        ("2023-02-10", None),
        ("2000-13-01", None),
    ],
)
def test_rate_is_that_of_the_previous_month_end(spark, value_date, rate_date):
    deals = stage_deals(raw_deals(spark, {"value_date": value_date}))
    [row] = to_sdr(deals, stage_fx_rates(raw_rates(spark, *RATES))).collect()
    assert row.fx_rate_date == rate_date
    assert (row.nominal_amount_sdr is None) == (rate_date is None)


def test_conversion_is_exact_and_keeps_the_column_order(spark):
    deals = stage_deals(raw_deals(spark, {}))
    converted = to_sdr(deals, stage_fx_rates(raw_rates(spark, *RATES)))
    assert converted.first().nominal_amount_sdr == Decimal("376070000")
    assert dict(converted.dtypes)["nominal_amount_sdr"] == "decimal(33,8)"
    extra = ["fx_rate_date", "sdr_per_unit", "nominal_amount_sdr"]
    assert converted.columns == [*deals.columns[:15], *extra, *deals.columns[15:]]


def test_a_repeated_rate_repeats_the_deal(spark):
    deals = stage_deals(raw_deals(spark, {}))
    twice = stage_fx_rates(raw_rates(spark, RATES[0], RATES[0]))
    assert to_sdr(deals, twice).count() == 2


def test_fact_keys(spark):
    deals = stage_deals(raw_deals(spark, {"maturity_date": ""}, {"deal_status": "MATURED"}))
    fct = fact_deposits(to_sdr(deals, stage_fx_rates(raw_rates(spark, *RATES))))
    assert len(fct.columns) == 18
    assert rows_of(
        fct.orderBy("deal_id"), "trade_date_key", "value_date_key", "maturity_date_key"
    ) == [(20230413, 20230415, None), (20230413, 20230415, 20240415)]


def test_static_dimensions(spark):
    currencies = rows_of(dimensions.dim_currency(spark), "*")
    assert currencies[0] == ("USD", "US Dollar", "Y")
    assert len(currencies) == 10
    assert [c for c, _, basket in currencies if basket == "Y"] == [
        "USD",
        "EUR",
        "GBP",
        "JPY",
        "CNY",
    ]
    products = rows_of(dimensions.dim_product(spark), "deal_type", "product_name")
    assert products == [
        ("FIXBIS_DEP", "FIXBIS"),
        ("MTI_DEP", "MTI"),
        ("SIGHT_DEP", "Sight"),
        ("NOTICE_DEP", "Notice"),
    ]


def test_calendar_golden_rows(spark):
    cfg = Config()
    bounds = dimensions.date_bounds(spark, cfg.calendar_start, cfg.calendar_end)
    calendar = dimensions.dim_date(dimensions.date_spine(bounds))
    rows = {row.date_key: tuple(row)[1:] for row in calendar.collect()}
    assert len(rows) == 731
    for key, *expected in [
        (20230401, date(2023, 4, 1), 2023, 4, "April", 2, "FY2023-24", "FQ1"),
        (20230402, date(2023, 4, 2), 2023, 4, "April", 2, "FY2023-24", "FQ1"),
        (20230930, date(2023, 9, 30), 2023, 9, "September", 3, "FY2023-24", "FQ2"),
        (20231231, date(2023, 12, 31), 2023, 12, "December", 4, "FY2023-24", "FQ3"),
        (20240331, date(2024, 3, 31), 2024, 3, "March", 1, "FY2023-24", "FQ4"),
        (20240401, date(2024, 4, 1), 2024, 4, "April", 2, "FY2024-25", "FQ1"),
        (20250331, date(2025, 3, 31), 2025, 3, "March", 1, "FY2024-25", "FQ4"),
    ]:
        assert rows[key] == tuple(expected)


def test_month_end_spine(spark):
    bounds = dimensions.date_bounds(spark, date(2023, 4, 17), date(2025, 3, 1))
    ends = [row[0] for row in dimensions.month_end_spine(bounds).collect()]
    assert len(ends) == 24
    assert (ends[0], ends[10], ends[-1]) == (
        date(2023, 4, 30),
        date(2024, 2, 29),
        date(2025, 3, 31),
    )


def test_spines_of_an_empty_book_are_empty(spark):
    deals = stage_deals(raw_deals(spark, {})).filter("false")
    bounds = dimensions.observed_bounds(deals, F.col("trade_date"), F.col("trade_date"))
    assert dimensions.date_spine(bounds).count() == 0
    assert dimensions.month_end_spine(bounds).count() == 0


def test_counterparty_is_distinct_on_all_three_columns(spark):
    deals = stage_deals(
        raw_deals(
            spark,
            {},
            {},
            {"cpty_name": "PBoC"},
            {"cpty_code": "BON_01", "cpty_name": "Bank of Namibia", "cpty_country": "NA"},
            {"cpty_code": "X", "cpty_name": "X", "cpty_country": "ZZ"},
        )
    )
    found = dimensions.dim_counterparty(to_sdr(deals, stage_fx_rates(raw_rates(spark, *RATES))))
    assert sorted(rows_of(found, "cpty_code", "cpty_name", "region")) == [
        ("BON_01", "Bank of Namibia", "Africa"),
        ("PBOC_01", "PBoC", "Asia-Pacific"),
        ("PBOC_01", "People's Bank of China", "Asia-Pacific"),
        ("X", "X", "Other"),
    ]


def test_order_book_keeps_orphans_long_keys_and_repeated_customers(spark):
    orders = spark.sql(
        "SELECT * FROM VALUES"
        " (1234567890123L, 7L, 'O', 1.25D, timestamp_ntz'1999-05-31', '1-URGENT'),"
        " (3L, 99L, 'F', 10.0D, timestamp_ntz'1999-05-31', '5-LOW') AS t(o_orderkey,"
        " o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)"
    )
    customer = spark.sql(
        "SELECT * FROM VALUES (7L, 'Seven', 3), (7L, 'Seven bis', 3)"
        " AS t(c_custkey, c_name, c_nationkey)"
    )
    nation = spark.sql("SELECT * FROM VALUES (3, 'N', 1) AS t(n_nationkey, n_name, n_regionkey)")
    deals = deals_from_orders(orders, customer, nation).orderBy("deal_id")
    assert rows_of(deals, "deal_id", "cpty_name", "cpty_country", "portfolio") == [
        ("FIN-199905-0000000003", None, None, None),
        ("FIN-199905-1234567890123", "Seven", "DE", "TRSRY-AMER"),
    ]


@pytest.mark.parametrize(
    ("scale", "expected"),
    [
        ("0.001", (1500, 986, 484, 30, 17, 2, 2, 56)),
        ("0.01", (15000, 9862, 4838, 300, 186, 16, 11, 621)),
    ],
)
def test_order_book_counts(spark, scale, expected):
    deals = Book(spark, f"/root/testdata/sf{scale}")["int_deals_with_sdr"]
    counts = deals.agg(
        F.count("*"),
        F.count_if(F.col("deal_status") == "VALIDATED"),
        F.count_if(F.col("deal_status") == "MATURED"),
        F.count_if(F.col("deal_status") == "CANCELLED"),
        F.count_if(F.col("sdr_per_unit").isNull()),
        F.count_if(F.col("rate_pct").isNull()),
        F.count_if(F.col("value_date").isNull()),
        F.count_if(F.col("cpty_country") == "ZZ"),
    )
    assert tuple(counts.first()) == expected
