"""Hand-made raw deals and rates for the edge cases."""

from __future__ import annotations

from tenorbook.schemas import DEALS_RAW, FX_RAW

_DEFAULT_DEAL = {
    "deal_type": "FIXBIS_DEP",
    "cpty_code": "PBOC_01",
    "cpty_name": "People's Bank of China",
    "cpty_country": "CN",
    "trade_date": "2023-04-13",
    "value_date": "2023-04-15",
    "maturity_date": "2024-04-15",
    "currency": "USD",
    "nominal_amount": "500000000",
    "rate_pct": "2.5",
    "deal_status": "VALIDATED",
    "portfolio": "TRSRY-APAC",
    "book": "BK-001",
    "created_dt": "2023-04-13 09:15:00",
    "last_modified_dt": "2023-04-13 09:15:00",
}


def raw_deals(spark, *changes: dict):
    """One raw deal per dict of changed columns; ids run D000, D001, ..."""
    rows = []
    for number, change in enumerate(changes):
        deal = {"deal_id": f"D{number:03d}", **_DEFAULT_DEAL, **change}
        rows.append(tuple(deal[name] for name in DEALS_RAW.names))
    return spark.createDataFrame(rows, DEALS_RAW)


def raw_rates(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), FX_RAW)


def rows_of(frame, *columns):
    return [tuple(row) for row in frame.select(*columns).collect()]
