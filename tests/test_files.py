from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from book import raw_deals, raw_rates, rows_of

from tenorbook import Config, Sources, build, publish, publish_views, published_tables
from tenorbook.__main__ import main
from tenorbook.plans.build import LAYERS, Models
from tenorbook.plans.catalog import QUERIES, Book
from tenorbook.schemas import DEALS_RAW
from tenorbook.sources.files import load_raw, malformed_lines, read_deals, write_csv, write_tables

RATES = [("2023-03-31", "USD", "0.5")]


@pytest.fixture
def csv_dir(spark, tmp_path):
    deals = raw_deals(
        spark,
        {"cpty_country": "NA", "cpty_name": 'Bank "of", Namibia'},
        {"maturity_date": None, "deal_type": "SIGHT_DEP", "cpty_name": " padded "},
    )
    write_csv(deals, f"{tmp_path}/src_deals.csv")
    write_csv(raw_rates(spark, *RATES), f"{tmp_path}/src_fx_rates.csv")
    return str(tmp_path)


def test_csv_round_trip(spark, csv_dir):
    deals = Sources.from_files(spark, csv_dir).deals
    assert deals.schema == DEALS_RAW
    assert sorted(rows_of(deals, "deal_id", "cpty_country", "cpty_name", "maturity_date")) == [
        ("D000", "NA", 'Bank "of", Namibia', "2024-04-15"),
        ("D001", "CN", " padded ", None),
    ]


def test_foreign_csv_dialect(spark, tmp_path):
    path = tmp_path / "deals.csv"
    row = dict.fromkeys(DEALS_RAW.names, "")
    row |= {"deal_id": "A", "cpty_name": '"Banca ""d\'Italia"", Rome"', "rate_pct": "2.50"}
    path.write_text(",".join(row) + "\n" + ",".join(row.values()) + "\n")
    [read] = read_deals(spark, str(path)).collect()
    assert (read.cpty_name, read.rate_pct) == ('Banca "d\'Italia", Rome', "2.50")
    assert read.maturity_date is None


def test_moved_columns_are_refused(spark, tmp_path):
    path = tmp_path / "deals.csv"
    names = list(reversed(DEALS_RAW.names))
    path.write_text(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_deals(spark, str(path)).collect()


def test_load_raw_and_numeric_parquet(spark, csv_dir, tmp_path):
    loaded = load_raw(spark, csv_dir, f"{tmp_path}/raw")
    assert loaded.deals.count() == 2
    assert rows_of(loaded.fx_rates, "*") == RATES
    loaded.deals.withColumn(
        "nominal_amount", loaded.deals.nominal_amount.cast("double")
    ).write.parquet(f"{tmp_path}/typed")
    typed = Sources(read_deals(spark, f"{tmp_path}/typed", "parquet"), loaded.fx_rates)
    assert build(spark, typed)["fct_currency_deposits"].filter("nominal_amount_sdr > 0").count() == 2


def test_catalog_sources(spark, csv_dir):
    files = Sources.from_files(spark, csv_dir)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_book")
    try:
        files.deals.write.mode("overwrite").saveAsTable("raw_book.src_deals")
        files.fx_rates.write.mode("overwrite").saveAsTable("raw_book.src_fx_rates")
        assert Sources.from_catalog(spark, "raw_book").deals.count() == 2
    finally:
        spark.sql("DROP DATABASE raw_book CASCADE")


def test_layers(spark, csv_dir):
    sources = Sources.from_files(spark, csv_dir)
    assert list(build(spark, sources)) == [n for names in LAYERS.values() for n in names]
    assert list(build(spark, sources, layers={"mart"})) == list(LAYERS["mart"])
    with pytest.raises(ValueError, match="gold"):
        build(spark, sources, layers={"gold"})


def test_views(spark, csv_dir):
    frames = build(spark, Sources.from_files(spark, csv_dir))
    publish_views(frames)
    joined = spark.sql(
        "SELECT region, count(*) AS n FROM fct_currency_deposits"
        " JOIN dim_counterparty USING (cpty_code) GROUP BY region"
    )
    assert joined.count() == 2
    for name in frames:
        spark.catalog.dropTempView(name)


def test_publish_equals_lazy_models(spark, csv_dir, tmp_path):
    sources = Sources.from_files(spark, csv_dir)
    out = f"{tmp_path}/published"
    published = publish(spark, sources, out, Config(as_of_months=3))
    lazy = build(spark, sources, Config(as_of_months=3), layers={"intermediate", "mart"})
    assert set(published) == set(lazy)
    for name, frame in lazy.items():
        assert sorted(map(str, rows_of(published[name], *frame.columns))) == sorted(
            map(str, rows_of(frame, "*"))
        )
        assert dict(published[name].dtypes) == dict(frame.dtypes)
    [ladder] = glob.glob(f"{out}/v*/mart_maturity_ladder")
    days = [d for d in os.listdir(ladder) if d.startswith("as_of_date=")]
    assert len(days) == 3
    for day in days:
        files = os.listdir(f"{ladder}/{day}")
        assert len([f for f in files if f.endswith(".parquet")]) == 1


def test_command_line(spark, csv_dir, tmp_path, capsys):
    main([csv_dir, f"{tmp_path}/cli", "--as-of-start", "2024-01-01", "--as-of-months", "1"])
    assert "mart_maturity_ladder" in capsys.readouterr().out
    ladder = published_tables(spark, f"{tmp_path}/cli")["mart_maturity_ladder"]
    assert sorted(rows_of(ladder, "maturity_bucket", "deal_count")) == [
        ("1. Overnight", 1),
        ("4. <= 3 Months", 1),
    ]


def test_malformed_lines_are_refused_and_listed(spark, tmp_path):
    path = tmp_path / "deals.csv"
    good = ",".join(["A", *["x"] * 15])
    lines = [",".join(DEALS_RAW.names), good, "B,x,y", good + ",17th"]
    path.write_text("\n".join(lines) + "\n")
    listed = malformed_lines(spark, str(path))
    assert sorted(r.malformed_line for r in listed.collect()) == sorted(lines[2:])
    for refused in (lambda: read_deals(spark, str(path)).collect(), lambda: read_deals(spark, str(path)).select("deal_id").collect()):
        with pytest.raises(Exception, match="(?i)malformed"):
            refused()


def test_published_fact_is_clustered_by_maturity(spark, tmp_path):
    # A third of the rows share one maturity, a few have none.
    fct = spark.range(0, 90000, 1, 4).selectExpr(
        "concat('D', id) AS deal_id",
        "CASE WHEN id % 50 = 1 THEN NULL WHEN id % 3 = 0 THEN 20000101 ELSE cast(19990101 + id % 20000 AS int) END AS maturity_date_key",
        "repeat(uuid(), 10) AS filler",
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1MB")
    try:
        write_tables({"fct": fct}, str(tmp_path), cluster_by={"fct": ("maturity_date_key", "deal_id")})
    finally:
        spark.conf.unset(key)
    assert spark.read.parquet(f"{tmp_path}/fct").count() == 90000
    spans = []
    for name in sorted(f for f in os.listdir(tmp_path / "fct") if f.endswith(".parquet")):
        meta = pq.ParquetFile(tmp_path / "fct" / name).metadata
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(1).statistics
            spans.append((stats.min, stats.max, meta.row_group(group).num_rows))
    # The frequent maturity, with 30,000 rows, spans tasks; another is in one group alone.
    assert max(n for _, _, n in spans) < 30000
    assert sum(low <= 20000101 <= high for low, high, _ in spans if low is not None) >= 2
    assert sum(low <= 20000801 <= high for low, high, _ in spans if low is not None) == 1


def test_rules_reach_the_reports_and_the_command_line(spark, csv_dir, tmp_path, capsys):
    rules = ["--active-status", "VALIDATED", "--sight-type", "FIXBIS_DEP", "--fiscal-start-month", "7"]
    labels = ["--bucket", "7=week", "--bucket", "30=month", "--sight-bucket", "now", "--last-bucket", "later"]
    main([csv_dir, f"{tmp_path}/cli", "--as-of-start", "2024-01-01", "--as-of-months", "1", *rules, *labels])
    ladder = published_tables(spark, f"{tmp_path}/cli")["mart_maturity_ladder"]
    assert rows_of(ladder, "maturity_bucket", "deal_count") == [("now", 1)]
    years = published_tables(spark, f"{tmp_path}/cli")["dim_date"].filter("full_date = DATE '2024-06-30'")
    assert years.first().fiscal_year == "FY2023-24"


def test_another_state_reaches_the_named_reports(spark):
    book = Book(spark, "/root/testdata/sf0.001", active_status="MATURED")
    want = book.fct.filter("deal_status = 'MATURED'").count()
    for name in ("exposure_by_region", "exposure_by_currency", "exposure_by_product", "exposure_by_portfolio",
                 "exposure_by_counterparty", "cost_of_funds_by_currency", "deposits_by_value_fy"):
        assert sum(r.deal_count for r in QUERIES[name](book).collect()) == want, name


def test_marts_are_the_same_from_csv_parquet_and_catalog(spark, tmp_path):
    book = Book(spark, "/root/testdata/sf0.001")
    write_csv(book.sources.deals, f"{tmp_path}/src_deals.csv")
    write_csv(book.sources.fx_rates, f"{tmp_path}/src_fx_rates.csv")
    raw = load_raw(spark, str(tmp_path), f"{tmp_path}/raw")
    assert len([f for f in os.listdir(tmp_path / "raw" / "src_fx_rates") if f.endswith(".parquet")]) == 1
    spark.sql("CREATE DATABASE IF NOT EXISTS round_trip")
    try:
        raw.deals.write.mode("overwrite").saveAsTable("round_trip.src_deals")
        raw.fx_rates.write.mode("overwrite").saveAsTable("round_trip.src_fx_rates")
        inputs = [Sources.from_files(spark, str(tmp_path)), raw, Sources.from_catalog(spark, "round_trip")]
        for name in LAYERS["mart"]:
            want = book[name]
            for sources in inputs:
                got = getattr(Models(spark, sources, book.config), name)
                assert got.dtypes == want.dtypes
                assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    finally:
        spark.sql("DROP DATABASE round_trip CASCADE")
