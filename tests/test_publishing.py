"""Versions, freshness, counting while writing, and failures half-way."""

from __future__ import annotations

import glob
import os

import pytest
from book import raw_deals, raw_rates, rows_of
from pyspark.sql import functions as F

from tenorbook import Config, PublishFailed, Sources, build, is_current, publish, published_counts, published_tables, retire
from tenorbook.operators.fact import fact_deposits
from tenorbook.plans import publishing
from tenorbook.plans.build import Models
from tenorbook.plans.catalog import Book
from tenorbook.sources import versions
from tenorbook.sources.files import write_csv

MODELS = ("int_deals_with_sdr", "dim_counterparty", "dim_currency", "dim_date", "dim_product", "fct_currency_deposits", "mart_maturity_ladder")
CFG = Config(as_of_months=3)


@pytest.fixture
def extracts(spark, tmp_path):
    """Two deals and a rate, and a way to write the deals anew."""

    def write(*changes):
        write_csv(raw_deals(spark, *changes), f"{tmp_path}/src_deals.csv")
        return Sources.from_files(spark, str(tmp_path))

    write_csv(raw_rates(spark, ("2023-03-31", "USD", "0.5")), f"{tmp_path}/src_fx_rates.csv")
    return write


def paths(spark, out):
    return {n: e.path for n, e in versions.manifest(spark, out).items() if e.path}


def test_counts_come_from_the_write(spark, tmp_path):
    """Raw, staged, converted and fact rows are those of four counts, and the orders are read by one job."""
    book = Book(spark, "/root/testdata/sf0.001")
    write_csv(book.sources.deals, f"{tmp_path}/src_deals.csv")
    write_csv(book.sources.fx_rates, f"{tmp_path}/src_fx_rates.csv")
    sources = Sources.from_files(spark, str(tmp_path))
    publish(spark, sources, f"{tmp_path}/out", CFG)
    counts = dict(rows_of(published_counts(spark, f"{tmp_path}/out"), "relation", "row_count"))
    lazy = Models(spark, sources, CFG)
    want = {n: getattr(lazy, n).count() for n in ("stg_deals", *MODELS)} | {"src_deals": sources.deals.count()}
    assert counts == want and counts["src_deals"] == 1500
    # One scan: the write's plan reads the deals' file once, and nothing but rates and deals.
    plan = publishing._counted(lazy.int_deals_with_sdr, publishing.Observation())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_a_failed_publish_changes_nothing_for_readers(spark, tmp_path, extracts, monkeypatch):
    out = f"{tmp_path}/out"
    publish(spark, extracts({}), out, CFG)
    before, shown = versions.current_version(spark, out), paths(spark, out)
    changed = extracts({}, {})

    def broken(self):
        return fact_deposits(self.int_deals_with_sdr).withColumn("book", F.expr("cast(raise_error('lost') AS string)"))

    monkeypatch.setattr(Models, "fct_currency_deposits", property(broken, lambda *_: None))
    with pytest.raises(PublishFailed, match="lost") as told:
        publish(spark, changed, out, CFG)
    # The ladder needs the fact; the dimensions do not, and were finished.
    assert list(told.value.failed) == ["fct_currency_deposits"] and told.value.skipped == ["mart_maturity_ladder"]
    begun = [v for v in os.listdir(out) if v.startswith("v") and v != before]
    assert set(os.listdir(f"{out}/{begun[0]}")) >= {"int_deals_with_sdr", "dim_counterparty"}
    assert versions.current_version(spark, out) == before and paths(spark, out) == shown
    assert published_tables(spark, out)["fct_currency_deposits"].count() == 1
    monkeypatch.undo()
    publish(spark, changed, out, CFG)
    assert published_tables(spark, out)["fct_currency_deposits"].count() == 2
    # Whoever named the old version still reads it.
    assert published_tables(spark, out, before)["fct_currency_deposits"].count() == 1


def test_what_is_fresh_is_skipped(spark, tmp_path, extracts):
    out = f"{tmp_path}/out"
    sources = extracts({})
    assert not any(is_current(spark, sources, out, CFG).values())
    publish(spark, sources, out, CFG)
    first, shown = versions.current_version(spark, out), paths(spark, out)
    assert set(shown) == set(MODELS) and all(is_current(spark, sources, out, CFG).values())
    publish(spark, sources, out, CFG)
    assert versions.current_version(spark, out) == first
    # Other as-of months concern the ladder alone.
    publish(spark, sources, out, Config(as_of_months=5))
    assert {n for n, p in paths(spark, out).items() if p != shown[n]} == {"mart_maturity_ladder"}
    assert published_tables(spark, out)["mart_maturity_ladder"].select("as_of_date").distinct().count() == 5
    counts = dict(rows_of(published_counts(spark, out), "relation", "row_count"))
    assert counts["src_deals"] == counts["fct_currency_deposits"] == 1
    # New deals concern all but the dimensions without deals.
    publish(spark, extracts({}, {"cpty_code": "B"}), out, Config(as_of_months=5))
    assert {n for n, p in paths(spark, out).items() if p == shown[n]} == {"dim_currency", "dim_date", "dim_product"}
    assert dict(rows_of(published_counts(spark, out), "relation", "row_count"))["src_deals"] == 2
    publish(spark, extracts({}), out, CFG, force=True)
    assert all(p != shown[n] for n, p in paths(spark, out).items())


def test_marts_from_stored_deals(spark, tmp_path, extracts):
    """The mart layer alone reads the published deals: the extracts may be gone, and no CSV is parsed."""
    out = f"{tmp_path}/out"
    with pytest.raises(ValueError, match="first publish"):
        publish(spark, None, out, CFG, layers={"mart"})
    publish(spark, extracts({}, {}), out, CFG)
    shown = paths(spark, out)
    for part in glob.glob(f"{tmp_path}/src_deals.csv/part-*"):
        os.remove(part)
    publish(spark, None, out, Config(as_of_months=4), layers={"mart"})
    now = paths(spark, out)
    assert {n for n in now if now[n] != shown[n]} == {"mart_maturity_ladder"}
    ladder = published_tables(spark, out)["mart_maturity_ladder"]
    assert rows_of(ladder.groupBy("as_of_date").sum("deal_count"), "sum(deal_count)") == [(2,)] * 4
    with pytest.raises(ValueError, match="sources"):
        publish(spark, None, out, CFG)
    with pytest.raises(ValueError, match="gold"):
        publish(spark, None, out, CFG, layers={"gold"})


def test_sources_that_are_no_files_are_always_written(spark, tmp_path):
    out = f"{tmp_path}/out"
    sources = Sources(raw_deals(spark, {}), raw_rates(spark, ("2023-03-31", "USD", "0.5")))
    publish(spark, sources, out, CFG)
    shown = paths(spark, out)
    publish(spark, sources, out, CFG)
    assert {n for n, p in paths(spark, out).items() if p == shown[n]} == {"dim_currency", "dim_date", "dim_product"}
    assert set(build(spark, sources, CFG, {"mart"})) <= set(paths(spark, out))


def test_retire_keeps_what_is_referred_to(spark, tmp_path, extracts):
    out = f"{tmp_path}/out"
    sources = extracts({})
    for months in (1, 2, 3, 4):
        publish(spark, sources, out, Config(as_of_months=months))
    every = versions.complete_versions(spark, out)
    # The first version's deals are still in use; the second and third hold ladders only.
    assert retire(spark, out, keep=1) == every[1:3]
    assert published_tables(spark, out)["fct_currency_deposits"].count() == 1
    assert published_tables(spark, out)["mart_maturity_ladder"].count() > 0
    assert not glob.glob(f"{out}/{every[1]}*") and glob.glob(f"{out}/{every[0]}*")
    with pytest.raises(ValueError):
        retire(spark, out, keep=0)


def test_versions_of_two_publishes_at_once(spark, tmp_path):
    out = str(tmp_path)
    one, two = versions.next_version(spark, out), versions.next_version(spark, out)
    assert one != two
    for version in (one, two):
        versions.write_manifest(spark, out, version, [versions.Entry("m", f"{version}/m", "", None)])
        versions.mark_complete(spark, out, version)
    assert versions.current_version(spark, out) == max(one, two)
    with pytest.raises(FileExistsError):
        versions.mark_complete(spark, out, one)
    assert versions.next_version(spark, out).startswith("v00000002-")
