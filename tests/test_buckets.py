"""Bucketed storage: no shuffle by deal once the tables are stored."""

from __future__ import annotations

import uuid

import pytest

from tenorbook import Sources, publish
from tenorbook.operators import quality
from tenorbook.plans.catalog import Book
from tenorbook.sources.buckets import bucket_published, store_bucketed
from tenorbook.sources.files import write_csv


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def name(spark):
    prefix = f"b{uuid.uuid4().hex}"
    yield prefix
    for table in spark.catalog.listTables():
        if table.name.startswith(prefix):
            spark.sql(f"DROP TABLE {table.name}")


def test_grain_and_join_move_no_deals(spark, tmp_path, name):
    book = Book(spark, "/root/testdata/sf0.001")
    write_csv(book.sources.deals, f"{tmp_path}/in/src_deals.csv")
    write_csv(book.sources.fx_rates, f"{tmp_path}/in/src_fx_rates.csv")
    publish(spark, Sources.from_files(spark, f"{tmp_path}/in"), f"{tmp_path}/out", book.config)
    tables = bucket_published(spark, f"{tmp_path}/out", f"{tmp_path}/by_deal", name, buckets=8)
    fct, deals = tables["fct_currency_deposits"], tables["int_deals_with_sdr"]
    assert sorted(map(str, fct.collect())) == sorted(map(str, book.fct.collect()))
    repeats = quality.duplicate_keys(fct, "deal_id")
    assert "Exchange" not in plan_of(repeats) and "Bucketed: true" in plan_of(repeats)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = fct.join(deals.select("deal_id", "cpty_name"), "deal_id")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert joined.count() == 1500
        # A third table joins the buckets; only its own side moves.
        fresh = spark.range(1500).selectExpr("concat('x', id) AS deal_id", "id AS n")
        moved = plan_of(fct.join(fresh, "deal_id", "left"))
        assert moved.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The check over the report is one row moved per bucket.
    report = quality.grain_report({"fct": (fct, ("deal_id",))})
    assert "Exchange hashpartitioning" not in plan_of(report)
    assert [tuple(r) for r in report.collect()] == [("fct", "deal_id", 0, 0)]


def test_repeated_and_null_keys_are_found_in_their_bucket(spark, tmp_path, name):
    rows = [("A", 1)] * 3 + [("B", 2), (None, 3), (None, 4)] + [(f"k{n}", n) for n in range(50)]
    stored = store_bucketed(spark.createDataFrame(rows, "deal_id string, n int"), name, f"{tmp_path}/t", buckets=4)
    found = {r.deal_id: r.row_count for r in quality.duplicate_keys(stored, "deal_id").collect()}
    assert found == {"A": 3, None: 2} and stored.count() == 56
    with pytest.raises(ValueError, match="buckets"):
        store_bucketed(stored, f"{name}x", f"{tmp_path}/x", buckets=0)
