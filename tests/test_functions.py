from __future__ import annotations

import calendar
import datetime as dt
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenorbook import fixed_values
from tenorbook.config import Config
from tenorbook.functions.dates import (
    date_key,
    decode_date_key,
    fiscal_quarter,
    fiscal_year,
    month_end,
    previous_month_end,
    strict_date,
)
from tenorbook.functions.labels import maturity_bucket, region_of


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2023-04-01", date(2023, 4, 1)),
        ("2024-02-29", date(2024, 2, 29)),
        ("2023-02-29", None),
        ("2000-13-01", None),
        ("2023-04", None),
        ("2023-4-1", None),
        ("20230401", None),
        ("2023-04-01 10:00:00", None),
        ("2023-04-01\n", None),
        (" 2023-04-01", None),
        ("+2023-04-01", None),
        ("", None),
        (None, None),
    ],
)
def test_strict_date(spark, text, expected):
    [row] = one_column(spark, [text], "string").select(strict_date(F.col("x"))).collect()
    assert row[0] == expected


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text("0123456789- T:", max_size=12), min_size=200, max_size=400))
def test_strict_date_equals_formatter_parse(spark, texts):
    frame = one_column(spark, texts + ["2023-04-01", "1999-12-31"], "string").select(
        strict_date(F.col("x")).alias("a"), F.try_to_date("x", "yyyy-MM-dd").alias("b")
    )
    assert frame.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_calendar_expressions_over_every_day(spark):
    days = spark.range(0, 4000).select(
        F.date_add(F.lit(date(1996, 1, 1)), F.col("id").cast("int")).alias("d")
    )
    d = F.col("d")
    rows = days.select(
        d,
        date_key(d).alias("key"),
        decode_date_key(date_key(d)).alias("back"),
        previous_month_end(d).alias("prev"),
        month_end(d, 2).alias("later"),
        fiscal_year(d).alias("fy"),
        fiscal_quarter(d).alias("fq"),
    ).collect()
    for row in rows:
        day = row.d
        assert row.key == int(day.strftime("%Y%m%d"))
        assert row.back == day
        assert row.prev == day.replace(day=1) - dt.timedelta(days=1)
        months = day.year * 12 + day.month - 1 + 2
        last = calendar.monthrange(months // 12, months % 12 + 1)[1]
        assert row.later == date(months // 12, months % 12 + 1, last)
        start = day.year if day.month >= 4 else day.year - 1
        assert row.fy == f"FY{start}-{(start + 1) % 100:02d}"
        assert row.fq == f"FQ{(day.month - 4) % 12 // 3 + 1}"


def test_fiscal_start_is_a_parameter(spark):
    frame = one_column(spark, [date(2023, 9, 30), date(2023, 10, 1)], "date")
    rows = frame.select(fiscal_year(F.col("x"), 10), fiscal_quarter(F.col("x"), 10)).collect()
    assert [tuple(r) for r in rows] == [("FY2022-23", "FQ4"), ("FY2023-24", "FQ1")]


def test_null_key_decodes_to_null_and_bad_key_raises(spark):
    frame = one_column(spark, [None], "int").select(decode_date_key(F.col("x")))
    assert frame.collect()[0][0] is None
    with pytest.raises(Exception, match="(?i)month|date"):
        one_column(spark, [20231301], "int").select(decode_date_key(F.col("x"))).collect()


@pytest.mark.parametrize(
    ("days", "label"),
    [
        (1, "2. <= 1 Week"),
        (7, "2. <= 1 Week"),
        (8, "3. <= 1 Month"),
        (30, "3. <= 1 Month"),
        (31, "4. <= 3 Months"),
        (90, "4. <= 3 Months"),
        (91, "5. <= 6 Months"),
        (180, "5. <= 6 Months"),
        (181, "6. <= 1 Year"),
        (365, "6. <= 1 Year"),
        (366, "7. > 1 Year"),
    ],
)
def test_bucket_edges(spark, days, label):
    frame = spark.range(1).select(
        maturity_bucket(F.lit(days), F.lit(False)).alias("term"),
        maturity_bucket(F.lit(days), F.lit(True)).alias("sight"),
    )
    assert tuple(frame.collect()[0]) == (label, "1. Overnight")


def test_regions(spark):
    sizes = {region: len(c) for region, c in fixed_values.REGION_COUNTRIES.items()}
    assert sizes == {
        "Asia-Pacific": 38,
        "Europe": 23,
        "Africa": 21,
        "Americas": 17,
        "Middle East": 11,
        "International": 2,
    }
    every = [c for codes in fixed_values.REGION_COUNTRIES.values() for c in codes]
    assert len(set(every)) == 112
    rows = one_column(spark, [*every, "ZZ", "cn", None], "string").select(
        "x", region_of("x").alias("region")
    )
    found = {row.x: row.region for row in rows.collect()}
    for region, codes in fixed_values.REGION_COUNTRIES.items():
        assert {found[c] for c in codes} == {region}
    assert found["NA"] == "Africa"
    assert found["ZZ"] == found["cn"] == found[None] == "Other"


@pytest.mark.parametrize(
    "bad",
    [
        {"calendar_end": date(2020, 1, 1)},
        {"as_of_months": 0},
        {"fiscal_start_month": 13},
        {"bucket_edges": ((30, "a"), (7, "b"))},
        {"bucket_edges": ((7, "a"),)},
    ],
)
def test_config_rejects_nonsense(bad):
    with pytest.raises(ValueError):
        Config(**bad)
