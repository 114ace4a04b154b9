"""Point-in-time ladder and daily book against loops over deals and dates."""

from __future__ import annotations

import datetime as dt
import random
from calendar import monthrange
from collections import defaultdict
from decimal import Decimal

import pytest

from tenorbook import Config
from tenorbook.operators import balances

SCHEMA = "deal_id string, deal_type string, deal_status string, value_date_key int, maturity_date_key int, nominal_amount_sdr decimal(33,8)"
CFG = Config(as_of_start=dt.date(2023, 11, 1), as_of_months=16)
START, END = dt.date(2023, 11, 1), dt.date(2025, 2, 28)


def key(day):
    return day and day.year * 10000 + day.month * 100 + day.day


@pytest.fixture(scope="module")
def deals(spark):
    """Deals before, in and after the period; on edges; without value date, maturity, rate or type; matured on the value date."""
    rng = random.Random(9)
    rows = []
    for n in range(600):
        value = dt.date(2023, 6, 1) + dt.timedelta(rng.randrange(700))
        if rng.random() < 0.2:  # a month's first or last day
            value = value.replace(day=rng.choice([1, monthrange(value.year, value.month)[1]]))
        days = rng.choice([0, 1, 7, 8, 30, 31, 90, 180, 181, 365, 366, 1200, rng.randrange(900)])
        kind = rng.choice(["SIGHT_DEP", "MTI_DEP", "FIXBIS_DEP", "FIXBIS_DEP", None])
        maturity = None if rng.random() < 0.05 or (kind == "SIGHT_DEP" and rng.random() < 0.8) else value + dt.timedelta(days)
        amount = None if rng.random() < 0.1 else Decimal(rng.randrange(1, 10**14)).scaleb(-8)
        rows.append((f"D{n}", kind, rng.choice(["VALIDATED", "VALIDATED", "MATURED", None]), None if rng.random() < 0.05 else key(value), key(maturity), amount))
    return spark.createDataFrame(rows, SCHEMA)


def day(number):
    return None if number is None else dt.date(number // 10000, number // 100 % 100, number % 100)


def live(rows):
    """(row, value date, maturity or None for sight money) of deals that live at all."""
    for r in rows:
        value, maturity = day(r.value_date_key), day(r.maturity_date_key)
        if r.deal_status == "VALIDATED" and value is not None:
            if r.deal_type == "SIGHT_DEP":
                yield r, value, None
            elif maturity is not None:
                yield r, value, maturity


def test_point_in_time_ladder(deals):
    want = defaultdict(lambda: [0, None])
    for n in range(CFG.as_of_months):
        year, month = divmod(2023 * 12 + 10 + n, 12)
        as_of = dt.date(year, month + 1, monthrange(year, month + 1)[1])
        for r, value, maturity in live(deals.collect()):
            if value > as_of or (maturity is not None and maturity <= as_of):
                continue
            label = CFG.sight_bucket if maturity is None else next((x for d, x in CFG.bucket_edges if (maturity - as_of).days <= d), CFG.last_bucket)
            entry = want[as_of, label]
            entry[0] += 1
            if r.nominal_amount_sdr is not None:
                entry[1] = (entry[1] or 0) + r.nominal_amount_sdr
    got = {(r.as_of_date, r.maturity_bucket): [r.deal_count, r.total_sdr] for r in balances.point_in_time_ladder(deals, CFG).collect()}
    assert got == want and len({b for _, b in got}) == 7


def test_daily_book(deals):
    rows, want, today = list(live(deals.collect())), {}, START
    while today <= END:
        held = [r for r, value, maturity in rows if value <= today and (maturity is None or maturity > today)]
        want[today] = (len(held), sum((r.nominal_amount_sdr for r in held if r.nominal_amount_sdr is not None), Decimal(0)))
        today += dt.timedelta(1)
    daily = balances.daily_book(deals, START, END, CFG)
    assert {r.full_date: (r.deal_count, r.total_sdr) for r in daily.collect()} == want
    months = {r.month_end: r for r in balances.monthly_average_book(daily).collect()}
    february = [s for d, (_, s) in want.items() if (d.year, d.month) == (2024, 2)]
    row = months[dt.date(2024, 2, 29)]
    assert (row.days, row.sdr_days, row.average_sdr) == (29, sum(february), (sum(february) / 29).quantize(Decimal("0.01"), "ROUND_HALF_UP"))
    # A period that begins and ends inside months.
    part = balances.daily_book(deals, dt.date(2024, 1, 17), dt.date(2024, 3, 5), CFG)
    assert {r.full_date: (r.deal_count, r.total_sdr) for r in part.collect()} == {d: w for d, w in want.items() if dt.date(2024, 1, 17) <= d <= dt.date(2024, 3, 5)}


def test_own_buckets_and_an_empty_book(deals):
    cfg = Config(as_of_start=dt.date(2024, 1, 1), as_of_months=2, bucket_edges=((10, "near"),), sight_bucket="now", last_bucket="far")
    found = balances.point_in_time_ladder(deals, cfg).collect()
    assert {r.maturity_bucket for r in found} == {"now", "near", "far"} and {r.as_of_date.month for r in found} == {1, 2}
    none = deals.limit(0)
    assert balances.point_in_time_ladder(none, CFG).count() == 0
    assert {(r.deal_count, r.total_sdr) for r in balances.daily_book(none, START, END, CFG).collect()} == {(0, Decimal("0E-8"))}


def test_what_moves_does_not_grow_with_the_deals(spark, deals):
    """However many deals, the profile has a row per as-of date and maturity at most, and no step orders all days."""
    many = spark.range(200000).selectExpr(
        "string(id) AS deal_id", "'MTI_DEP' AS deal_type", "'VALIDATED' AS deal_status", "20231101 + int(id % 28) AS value_date_key",
        "20240101 + int(id % 20) AS maturity_date_key", "cast(1 AS decimal(33,8)) AS nominal_amount_sdr",
    )
    assert balances.value_maturity_profile(many, CFG).count() == 20
    for frame in (balances.point_in_time_ladder(many, CFG), balances.daily_book(many, START, END, CFG)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SinglePartition" not in plan and "CartesianProduct" not in plan
