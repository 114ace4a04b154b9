"""Typed extracts, rate types and bounds that follow the data."""

from datetime import date
from decimal import Decimal

import pytest
from book import raw_deals, raw_rates
from pyspark.sql import functions as F

from tenorbook import Config, Sources, build, published_tables
from tenorbook.__main__ import main
from tenorbook.operators.staging import rate_losses, stage_deals, stage_fx_rates
from tenorbook.plans.catalog import Book
from tenorbook.sources.files import write_csv

FOLDER = "/root/testdata/sf0.001"


def test_typed_dates_stage_like_text(spark):
    raw = Book(spark, FOLDER).sources.deals.filter("value_date <> '2000-13-01'").limit(50).cache()
    days = ("trade_date", "value_date", "maturity_date")
    want = sorted(map(str, stage_deals(raw).collect()))
    for kind in ("date", "timestamp", "timestamp_ntz"):
        typed = raw.withColumns({d: F.expr(f"try_cast({d} AS {kind})") for d in days})
        assert sorted(map(str, stage_deals(typed).collect())) == want


def test_a_wider_rate_type_keeps_nine_places(spark):
    raw = spark.createDataFrame([("2024-01-31", "KRW", "0.000572491")], "rate_date string, currency_code string, sdr_per_unit string")
    assert stage_fx_rates(raw, "decimal(17,10)").first().sdr_per_unit == Decimal("0.0005724910")


def test_later_orders_move_the_bounds(spark, tmp_path):
    book = Book(spark, FOLDER)
    for name in ("orders", "customer", "nation"):
        table = book.table(name)
        if name == "orders":
            table = table.withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 4 YEARS"))
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    later = Book(spark, str(tmp_path))
    assert later.config.as_of_start == date(1999, 1, 1) and later.book_end == date(2005, 8, 31)
    unrated = later["int_deals_with_sdr"].filter("nominal_amount_sdr IS NULL").count()
    assert unrated == book["int_deals_with_sdr"].filter("nominal_amount_sdr IS NULL").count() or unrated < 60
    assert later["mart_maturity_ladder"].agg(F.max("as_of_date")).first()[0] == date(2005, 8, 31)


NINE = [("2023-03-31", "USD", "0.000572491"), ("2023-03-31", "EUR", "0.9000000000"), ("2023-03-31", "GBP", "n/a")]


def test_a_rate_that_does_not_fit_fails_or_is_rounded_on_request(spark):
    rates = raw_rates(spark, *NINE)
    with pytest.raises(Exception, match="0.000572491 does not fit decimal"):
        stage_fx_rates(rates).collect()
    sources = Sources(raw_deals(spark, {}), rates)
    with pytest.raises(Exception, match="does not fit"):
        build(spark, sources)["int_deals_with_sdr"].collect()
    rounded = build(spark, sources, Config(round_rates=True))["stg_fx_rates"].collect()
    assert {r.currency_code: r.sdr_per_unit for r in rounded} == {"USD": Decimal("0.000572"), "EUR": Decimal("0.900000"), "GBP": None}
    wide = build(spark, sources, Config(rate_type="decimal(17,9)"))["int_deals_with_sdr"].first()
    assert wide.sdr_per_unit == Decimal("0.000572491") and wide.nominal_amount_sdr == Decimal("286245.50000000000")
    lost = rate_losses(rates).collect()
    assert [tuple(r) for r in lost] == [("2023-03-31", "USD", "0.000572491", Decimal("0.000572"))]
    assert rate_losses(rates, "decimal(17,9)").count() == 0


def test_the_command_line_keeps_nine_places_or_fails(spark, tmp_path):
    write_csv(raw_deals(spark, {}), f"{tmp_path}/src_deals.csv")
    write_csv(raw_rates(spark, *NINE), f"{tmp_path}/src_fx_rates.csv")
    with pytest.raises(Exception, match="does not fit"):
        main([str(tmp_path), f"{tmp_path}/six", "--as-of-months", "1"])
    main([str(tmp_path), f"{tmp_path}/nine", "--as-of-months", "1", "--rate-type", "decimal(17,9)"])
    assert published_tables(spark, f"{tmp_path}/nine")["fct_currency_deposits"].first().sdr_per_unit == Decimal("0.000572491")
    main([str(tmp_path), f"{tmp_path}/round", "--as-of-months", "1", "--round-rates"])
    assert published_tables(spark, f"{tmp_path}/round")["fct_currency_deposits"].first().sdr_per_unit == Decimal("0.000572")


def test_rates_of_other_types(spark):
    frame = spark.createDataFrame([("2023-03-31", "USD", 0.1), ("2023-03-31", "EUR", 1e-7)], "rate_date string, currency_code string, sdr_per_unit double")
    assert [r.currency_code for r in rate_losses(frame).collect()] == ["EUR"]
    text = raw_rates(spark, ("2023-03-31", "A", " 1.5 "), ("2023-03-31", "B", "2"), ("2023-03-31", "C", "1e-3"), ("2023-03-31", "D", ".0000001"), ("2023-03-31", "E", "1e-8"))
    assert sorted(r.currency_code for r in rate_losses(text).collect()) == ["D", "E"]
