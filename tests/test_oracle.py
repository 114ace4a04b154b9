"""Every query over the book against its SQL twin, on whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from compare import connect, duck_result, spark_result
from tenorbook.plans import catalog

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in entry_module.queries().items() if n in catalog.QUERIES}
ORACLE = {n: s for n, s in entry_module.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as con:
        yield con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    schema, rows = spark_result(QUERIES[name](spark, FOLDER))
    expected_schema, expected_rows = duck_result(duck, ORACLE[name])
    assert schema == expected_schema
    assert len(rows) == len(expected_rows)
    assert rows == expected_rows


def test_entry_is_the_ladder(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["as_of_date", "maturity_bucket", "deal_count", "total_sdr"]
    assert result.count() > 0
