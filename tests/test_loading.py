"""Tolerant and incremental loading."""

from __future__ import annotations

import glob
import os
from collections import Counter

import pytest

from tenorbook.schemas import DEALS_RAW
from tenorbook.sources.loading import load_deals, loaded_deals, rejected_lines, stray_deals


def line(key, value_date="2023-04-15", **more):
    row = dict.fromkeys(DEALS_RAW.names, "x") | {"deal_id": key, "value_date": value_date} | more
    return ",".join(row[n] for n in DEALS_RAW.names)


def extract(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join([",".join(DEALS_RAW.names), *lines]) + "\n")
    return str(path)


def files_of(table, kind, part):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{table}/kind={kind}/part={part}/*.parquet")}


def keys(frame):
    return sorted(r.deal_id for r in frame.select("deal_id").collect())


def test_short_and_long_lines_are_set_aside(spark, tmp_path):
    short, long = "S,x,y", line("L") + ",17th,18th"
    quoted = line("Q", cpty_name='"Bank, ""of"" Basel"')
    path = extract(tmp_path, "a.csv", line("A"), short, line("B", "2023-05-02"), long, "", quoted, line("U", "soon"), line("E", ""))
    table = f"{tmp_path}/deals"
    report = load_deals(spark, path, table, "a")
    assert (report.lines, report.dated, report.undated, report.stray, report.rejected) == (7, 3, 2, 0, 2)
    assert report.dated + report.undated + report.stray + report.rejected == report.lines
    assert keys(loaded_deals(spark, table)) == ["A", "B", "E", "Q", "U"]
    assert loaded_deals(spark, table).schema == DEALS_RAW
    assert sorted(map(tuple, rejected_lines(spark, table).collect())) == sorted([("a", short), ("a", long)])
    assert loaded_deals(spark, table).filter("deal_id = 'Q'").first().cpty_name == 'Bank, "of" Basel'


def test_a_reload_replaces_its_months_only(spark, tmp_path):
    table = f"{tmp_path}/deals"
    april = [line(f"A{k}", f"2023-04-{k + 1:02d}") for k in range(5)]
    load_deals(spark, extract(tmp_path, "april.csv", *april, line("AU", ""), "bad,line"), table, "april", ["2023-04"])
    load_deals(spark, extract(tmp_path, "may.csv", line("M0", "2023-05-01"), line("MU", ""), "bad,too"), table, "may", ["2023-05"])
    may, rest = files_of(table, "dated", "2023-05"), files_of(table, "undated", "may") | files_of(table, "rejected", "may")
    whole = Counter(map(tuple, loaded_deals(spark, table).collect()))
    assert len(whole) == 8 and may and rest
    # The same batch again: same rows, other months' files untouched.
    load_deals(spark, f"{tmp_path}/april.csv", table, "april", ["2023-04"])
    assert Counter(map(tuple, loaded_deals(spark, table).collect())) == whole
    assert files_of(table, "dated", "2023-05") == may and files_of(table, "undated", "may") | files_of(table, "rejected", "may") == rest
    # A corrected batch: one deal less, one more; its undated deal and its bad line are gone for good.
    load_deals(spark, extract(tmp_path, "april2.csv", *april[1:], line("A9", "2023-04-30")), table, "april", ["2023-04"])
    assert keys(loaded_deals(spark, table)) == ["A1", "A2", "A3", "A4", "A9", "M0", "MU"]
    assert [r.malformed_line for r in rejected_lines(spark, table).collect()] == ["bad,too"]
    assert files_of(table, "dated", "2023-05") == may


def test_a_stray_deal_replaces_nothing(spark, tmp_path):
    table = f"{tmp_path}/deals"
    load_deals(spark, extract(tmp_path, "april.csv", line("A0"), line("A1")), table, "april")
    report = load_deals(spark, extract(tmp_path, "may.csv", line("M0", "2023-05-01"), line("late")), table, "may", ["2023-05"])
    assert report.stray == 1 and keys(loaded_deals(spark, table)) == ["A0", "A1", "M0"]
    assert [tuple(r)[:2] for r in stray_deals(spark, table).collect()] == [("may", "late")]


def test_one_month_is_read_from_its_files(spark, tmp_path):
    table = f"{tmp_path}/deals"
    load_deals(spark, extract(tmp_path, "a.csv", line("A"), line("M", "2023-05-01"), line("U", "")), table, "a")
    one = loaded_deals(spark, table, ["2023-05"])
    assert keys(one) == ["M"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_empty_and_foreign_extracts(spark, tmp_path):
    table = f"{tmp_path}/deals"
    report = load_deals(spark, extract(tmp_path, "none.csv"), table, "none")
    assert report.lines == 0 and loaded_deals(spark, table).count() == 0 and rejected_lines(spark, table).count() == 0
    (tmp_path / "moved.csv").write_text(",".join(reversed(DEALS_RAW.names)) + "\n" + ",".join("x" * 16) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_deals(spark, f"{tmp_path}/moved.csv", table, "moved")
    assert loaded_deals(spark, table).count() == 0
