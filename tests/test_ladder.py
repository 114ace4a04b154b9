from __future__ import annotations

import calendar
import datetime as dt
from collections import defaultdict
from datetime import date
from decimal import Decimal

from book import raw_deals, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.operators import ladder
from tenorbook.operators.fact import fact_deposits
from tenorbook.operators.staging import stage_deals

FCT = (
    "deal_id string, deal_type string, deal_status string,"
    " maturity_date_key int, nominal_amount_sdr decimal(33,8)"
)


def fact(spark, rows):
    return spark.createDataFrame(rows, FCT)


def as_dict(frame):
    return {(r.as_of_date, r.maturity_bucket): (r.deal_count, r.total_sdr) for r in frame.collect()}


def month_ends(cfg: Config):
    for n in range(cfg.as_of_months):
        months = cfg.as_of_start.year * 12 + cfg.as_of_start.month - 1 + n
        year, month = months // 12, months % 12 + 1
        yield date(year, month, calendar.monthrange(year, month)[1])


def brute_force(rows, cfg: Config):
    """Every deal against every as-of date, one by one."""
    result = defaultdict(lambda: [0, None])
    for _, deal_type, status, key, sdr in rows:
        if status != cfg.active_status:
            continue
        matures = key and date(key // 10000, key // 100 % 100, key % 100)
        for as_of in month_ends(cfg):
            days = (matures - as_of).days if matures else None
            if deal_type == cfg.sight_type:
                bucket = "1. Overnight"
            elif days is None or days <= 0:
                continue
            else:
                names = [label for upper, label in cfg.bucket_edges if days <= upper]
                bucket = names[0] if names else "7. > 1 Year"
            cell = result[as_of, bucket]
            cell[0] += 1
            if sdr is not None:
                cell[1] = (cell[1] or Decimal(0)) + sdr
    return {cell: tuple(values) for cell, values in result.items()}


deals = st.tuples(
    st.just("D"),
    st.sampled_from(["FIXBIS_DEP", "MTI_DEP", "SIGHT_DEP", "NOTICE_DEP", None]),
    st.sampled_from(["VALIDATED", "VALIDATED", "MATURED", "CANCELLED", None]),
    st.none()
    | st.dates(date(2023, 3, 1), date(2026, 12, 31)).map(lambda d: int(d.strftime("%Y%m%d"))),
    st.none() | st.decimals(0, 10**12, places=8, allow_nan=False),
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(deals, max_size=150))
def test_ladder_equals_brute_force(spark, rows):
    cfg = Config()
    assert as_dict(ladder.maturity_ladder(fact(spark, rows), cfg)) == brute_force(rows, cfg)


def test_edges_around_one_as_of_date(spark):
    cfg = Config(as_of_start=date(2024, 1, 1), as_of_months=1)
    base = date(2024, 1, 31)
    offsets = [-1, 0, 1, 7, 8, 30, 31, 90, 91, 180, 181, 365, 366]
    rows = [
        (
            f"D{o}",
            "MTI_DEP",
            "VALIDATED",
            int((base + dt.timedelta(days=o)).strftime("%Y%m%d")),
            Decimal(1),
        )
        for o in offsets
    ]
    rows += [
        ("S1", "SIGHT_DEP", "VALIDATED", None, Decimal(1)),
        ("S2", "SIGHT_DEP", "VALIDATED", 20200101, Decimal(1)),
        ("N", "NOTICE_DEP", "VALIDATED", None, Decimal(1)),
    ]
    counts = {b: n for (_, b), (n, _) in as_dict(ladder.maturity_ladder(fact(spark, rows), cfg)).items()}
    assert counts == {
        "1. Overnight": 2,
        "2. <= 1 Week": 2,
        "3. <= 1 Month": 2,
        "4. <= 3 Months": 2,
        "5. <= 6 Months": 2,
        "6. <= 1 Year": 2,
        "7. > 1 Year": 1,
    }


def test_deals_without_a_rate_are_counted_but_not_summed(spark):
    cfg = Config(as_of_months=1)
    rows = [
        ("A", "SIGHT_DEP", "VALIDATED", None, None),
        ("B", "MTI_DEP", "VALIDATED", 20230502, None),
        ("C", "MTI_DEP", "VALIDATED", 20230503, Decimal(5)),
    ]
    assert as_dict(ladder.maturity_ladder(fact(spark, rows), cfg)) == {
        (date(2023, 4, 30), "1. Overnight"): (1, None),
        (date(2023, 4, 30), "2. <= 1 Week"): (2, Decimal(5)),
    }


def test_no_lower_date_bound_and_other_states_left_out(spark):
    staged = stage_deals(
        raw_deals(
            spark,
            {"trade_date": "2024-12-01", "maturity_date": "2025-12-01"},
            {"deal_status": "MATURED", "maturity_date": "2025-12-01"},
            {"deal_status": "CANCELLED", "maturity_date": "2025-12-01"},
        )
    )
    int_deals = staged.withColumns(
        {
            "fx_rate_date": F.lit(None).cast("date"),
            "sdr_per_unit": F.lit(1).cast("decimal(12,6)"),
            "nominal_amount_sdr": F.lit(1).cast("decimal(33,8)"),
        }
    )
    result = ladder.maturity_ladder(fact_deposits(int_deals))
    assert result.filter("deal_count <> 1").count() == 0
    assert result.count() == 24


def test_detail_adds_up_to_the_ladder(spark):
    cfg = Config()
    rows = [
        (f"D{i}", kind, "VALIDATED", 20230415 + 10000 * (i % 4) + i % 13, Decimal(i))
        for i in range(300)
        for kind in [["FIXBIS_DEP", "SIGHT_DEP", "MTI_DEP"][i % 3]]
    ]
    fct = fact(spark, rows)
    whole = ladder.maturity_ladder(fct, cfg)
    for as_of in (date(2023, 4, 30), date(2024, 6, 30), date(2025, 3, 31)):
        detail = ladder.deals_outstanding_at(fct, as_of, cfg)
        summed = detail.groupBy("as_of_date", "maturity_bucket").agg(
            F.count("*").alias("deal_count"), F.sum("nominal_amount_sdr").alias("total_sdr")
        )
        assert as_dict(summed) == as_dict(whole.filter(F.col("as_of_date") == as_of))
    profile = ladder.exposed_profile(fct, cfg)
    assert profile.agg(F.sum("deal_count")).first() == whole.agg(F.sum("deal_count")).first()
    assert profile.filter("days_to_maturity <= 0 AND NOT is_sight").count() == 0


def test_ladder_does_not_depend_on_partitioning_or_one_hot_date(spark):
    rows = spark.range(20000).selectExpr(
        "cast(id as string) AS deal_id",
        "'FIXBIS_DEP' AS deal_type",
        "'VALIDATED' AS deal_status",
        "if(id % 3 = 0, 20250401, cast(20240101 + id % 28 AS int)) AS maturity_date_key",
        "cast(id AS decimal(33,8)) AS nominal_amount_sdr",
    )
    once = as_dict(ladder.maturity_ladder(rows))
    assert once == as_dict(ladder.maturity_ladder(rows.repartition(17, "deal_id")))
    assert sum(n for (day, _), (n, _) in once.items() if day == date(2023, 4, 30)) == 20000


def test_average_active_book(spark):
    frame = spark.createDataFrame(
        [
            (date(2023, 4, 30), "1. Overnight", 1, Decimal(10)),
            (date(2023, 4, 30), "7. > 1 Year", 1, Decimal(20)),
            (date(2023, 5, 31), "7. > 1 Year", 2, Decimal(5)),
        ],
        "as_of_date date, maturity_bucket string, deal_count long, total_sdr decimal(38,8)",
    )
    assert rows_of(ladder.average_active_book(frame), "as_of_dates", "average_sdr") == [
        (2, Decimal("17.50"))
    ]
