"""Deal and rate extracts derived from an order book.

The extracts have the raw schema (all text, a few malformed values on purpose) and
stand in for a booking system. The rules are choices of this module alone; nothing
downstream knows of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook import fixed_values


def _pick(values: Sequence, position: str) -> str:
    """Entry at a 0-based position; NULL outside the list."""
    return f"get(array({', '.join(map(repr, values))}), cast({position} as int))"


def _padded(number: str, width: int) -> str:
    # lpad also truncates, which would merge keys that outgrow the width.
    text = f"cast({number} as string)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


def deals_from_orders(
    orders: DataFrame, customer: DataFrame, nation: DataFrame
) -> DataFrame:
    """One deal per order.

    Customer and nation are reduced to one row per key before their left joins, so
    an order never multiplies or disappears, and Spark drops a join altogether when
    no column of it is needed. `dq_grain` reports repeated customers.

    The customers' aggregate is already partitioned by their key, and adaptive
    execution splits a hot key only where both sides are shuffled for the join. A
    second key, which follows from the first, asks for that shuffle.
    """
    parties = (
        customer.groupBy("c_custkey")
        .agg(F.expr("min(struct(c_name, c_nationkey)) AS party"))
        .selectExpr("c_custkey", "party.c_name", "party.c_nationkey")
    )
    nations = nation.groupBy("n_nationkey").agg(F.expr("min(n_regionkey) AS region"))
    booked = orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "cast(o_orderdate AS date) AS traded",
        "o_orderpriority",
    )
    valued = "date_add(traded, 2)"
    product = (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'SIGHT_DEP'"
        " WHEN '2-HIGH' THEN 'NOTICE_DEP' WHEN '3-MEDIUM' THEN 'MTI_DEP'"
        " ELSE 'FIXBIS_DEP' END"
    )
    term = (
        "CASE o_orderpriority WHEN '1-URGENT' THEN NULL"
        f" WHEN '2-HIGH' THEN {_pick(fixed_values.NOTICE_DAYS, 'k % 4')}"
        " WHEN '3-MEDIUM' THEN cast(365 * (1 + k % 7) AS int)"
        f" ELSE {_pick(fixed_values.FIXED_TERM_DAYS, 'k % 9')} END"
    )
    rate = "cast(cast(k % 600 AS decimal(5,0)) * 0.01 AS decimal(10,4))"
    clock = (
        f"concat(cast(traded AS string), ' ', {_padded('7 + k % 11', 2)}, ':',"
        f" {_padded('k % 60', 2)}, ':', {_padded('(7 * k) % 60', 2)})"
    )
    return (
        booked.join(
            parties,
            F.expr("o_custkey = c_custkey AND o_custkey % 2 = c_custkey % 2"),
            "left",
        )
        .join(nations, F.expr("c_nationkey = n_nationkey"), "left")
        .selectExpr(
            f"concat('FIN-', year(traded) * 100 + month(traded), '-', {_padded('k', 10)})"
            " AS deal_id",
            f"{product} AS deal_type",
            f"concat('CP_', {_padded('o_custkey', 10)}) AS cpty_code",
            "c_name AS cpty_name",
            f"{_pick(fixed_values.BOOK_COUNTRIES, 'c_nationkey')} AS cpty_country",
            "cast(traded AS string) AS trade_date",
            f"if(k % 1499 = 0, '2000-13-01', cast({valued} AS string)) AS value_date",
            f"coalesce(cast(date_add({valued}, {term}) AS string), '') AS maturity_date",
            f"{_pick(fixed_values.BOOK_CURRENCIES, 'o_custkey % 10')} AS currency",
            "cast(cast(o_totalprice AS decimal(20,2)) AS string) AS nominal_amount",
            f"if(k % 997 = 0, 'n/a', cast({rate} AS string)) AS rate_pct",
            "CASE WHEN k % 50 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'MATURED'"
            " ELSE 'VALIDATED' END AS deal_status",
            f"{_pick(fixed_values.BOOK_PORTFOLIOS, 'region')} AS portfolio",
            f"concat('BK-', {_padded('o_custkey % 10 + 1', 3)}) AS book",
            f"{clock} AS created_dt",
            f"{clock} AS last_modified_dt",
        )
    )


def fx_from_month_ends(month_ends: DataFrame) -> DataFrame:
    """Rates of ten currencies at the given month-ends (column `as_of_date`).

    Each base rate moves through a seven-month cycle of up to three percent.
    """
    basket = ", ".join(
        f"struct('{code}' AS currency_code, cast({rate} AS decimal(7,6)) AS base)"
        for code, rate in fixed_values.BASE_RATES
    )
    months = "year(as_of_date) * 12 + month(as_of_date) - 1"
    percent = f"cast(97 + ({months}) % 7 AS decimal(5,0))"
    return month_ends.selectExpr("as_of_date", f"inline(array({basket}))").selectExpr(
        "cast(as_of_date AS string) AS rate_date",
        "currency_code",
        f"cast(cast(base * {percent} * 0.01 AS decimal(12,6)) AS string) AS sdr_per_unit",
    )
