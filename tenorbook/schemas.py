"""Schemas of the raw extracts: every column arrives as text."""

from __future__ import annotations

from pyspark.sql import types as T


def _all_text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


DEALS_RAW = _all_text(
    "deal_id",
    "deal_type",
    "cpty_code",
    "cpty_name",
    "cpty_country",
    "trade_date",
    "value_date",
    "maturity_date",
    "currency",
    "nominal_amount",
    "rate_pct",
    "deal_status",
    "portfolio",
    "book",
    "created_dt",
    "last_modified_dt",
)

FX_RAW = _all_text("rate_date", "currency_code", "sdr_per_unit")

# Order tables that deals can be derived from. A stated schema saves reading file
# footers on the driver before the first job.
ORDER_TABLES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
        " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}
