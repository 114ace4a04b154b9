"""Publishes the marts from a folder of extracts: `python -m tenorbook ...`."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tenorbook.config import Config
from tenorbook.plans.publishing import publish
from tenorbook.sources.files import Sources
from tenorbook.sources.versions import manifest


def _edge(text: str) -> tuple[int, str]:
    days, label = text.split("=", 1)
    return int(days), label


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    default = Config()
    day = dt.date.fromisoformat
    parser = argparse.ArgumentParser(prog="tenorbook", description=__doc__)
    parser.add_argument("source", help="folder with src_deals and src_fx_rates")
    parser.add_argument("out", help="folder for the published tables")
    parser.add_argument("--format", default="csv", help="csv, parquet, ...")
    parser.add_argument("--calendar-start", type=day, default=default.calendar_start)
    parser.add_argument("--calendar-end", type=day, default=default.calendar_end)
    parser.add_argument("--as-of-start", type=day, default=default.as_of_start)
    parser.add_argument("--as-of-months", type=int, default=default.as_of_months)
    parser.add_argument("--fiscal-start-month", type=int, default=default.fiscal_start_month)
    parser.add_argument("--active-status", default=default.active_status)
    parser.add_argument("--sight-type", default=default.sight_type)
    parser.add_argument("--rate-type", default=default.rate_type)
    parser.add_argument("--round-rates", action="store_true", help="round rates that --rate-type cannot hold")
    parser.add_argument("--sight-bucket", default=default.sight_bucket)
    parser.add_argument("--last-bucket", help="label beyond the last edge")
    parser.add_argument(
        "--bucket", action="append", type=_edge, metavar="DAYS=LABEL", help="one per edge, rising"
    )
    parser.add_argument("--layer", action="append", help="intermediate, mart; default: both")
    parser.add_argument("--force", action="store_true", help="write what is fresh, too")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    cfg = Config(
        calendar_start=args.calendar_start,
        calendar_end=args.calendar_end,
        as_of_start=args.as_of_start,
        as_of_months=args.as_of_months,
        fiscal_start_month=args.fiscal_start_month,
        active_status=args.active_status,
        sight_type=args.sight_type,
        rate_type=args.rate_type,
        round_rates=args.round_rates,
        bucket_edges=tuple(args.bucket) if args.bucket else Config.bucket_edges,
        sight_bucket=args.sight_bucket,
        last_bucket=args.last_bucket,
    )
    spark = SparkSession.builder.appName("tenorbook").getOrCreate()
    sources = Sources.from_files(spark, args.source, args.format)
    publish(spark, sources, args.out, cfg, args.layer, args.force)
    for name, entry in manifest(spark, args.out).items():
        if entry.path:
            print(f"{args.out}/{entry.path} {entry.row_count}")


if __name__ == "__main__":
    main()
