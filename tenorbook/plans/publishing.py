"""Publishing: models written as one version, tier by tier, skipping what is fresh, counting while writing."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict
from functools import cache
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tenorbook.config import Config
from tenorbook.plans.build import LAYERS, Models
from tenorbook.sources.files import Sources, arranged
from tenorbook.sources.versions import (
    Entry,
    current_version,
    listing,
    manifest,
    mark_complete,
    next_version,
    published_tables,
    write_manifest,
)

PARTITIONED = {"mart_maturity_ladder": "as_of_date"}
#: Years of the value date first, so that slices by either date skip files and row groups.
CLUSTERED = {"fct_currency_deposits": ("value_date_key div 10000", "maturity_date_key", "deal_id")}

#: What each model is made from, and the rules of the configuration it follows.
PARENTS = {
    "int_deals_with_sdr": ("sources",),
    "dim_counterparty": ("int_deals_with_sdr",),
    "dim_currency": (),
    "dim_date": (),
    "dim_product": (),
    "fct_currency_deposits": ("int_deals_with_sdr",),
    "mart_maturity_ladder": ("fct_currency_deposits",),
}
RULES = {
    "int_deals_with_sdr": ("rate_type", "round_rates"),
    "dim_date": ("calendar_start", "calendar_end", "fiscal_start_month"),
    "mart_maturity_ladder": (
        "as_of_start", "as_of_months", "active_status", "sight_type", "bucket_edges", "sight_bucket", "last_bucket",
    ),
}

#: Models of one tier need none of each other.
TIERS = (
    ("int_deals_with_sdr",),
    ("dim_counterparty", "dim_currency", "dim_date", "dim_product", "fct_currency_deposits"),
    ("mart_maturity_ladder",),
)


class PublishFailed(RuntimeError):
    """Says which models failed and which were left out because of them; readers stay on the last version."""

    def __init__(self, failed: dict[str, BaseException], skipped: list[str]) -> None:
        self.failed, self.skipped = failed, skipped
        super().__init__(f"failed: {sorted(failed)}; left out: {skipped}; first cause: {next(iter(failed.values()))}")


@cache
def _code() -> str:
    """Changes with the package's own code, so that new rules make old tables stale."""
    package, digest = Path(__file__).resolve().parent.parent, hashlib.sha256()
    for part in ("functions", "operators", "plans", "fixed_values.py", "schemas.py"):
        for source in sorted((package / part).rglob("*.py")) or [package / part]:
            digest.update(source.read_bytes())
    return digest.hexdigest()


def _digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def source_fingerprint(spark: SparkSession, sources: Sources | None) -> str:
    """From names, lengths and times of the input files. Sources that are not plain files never look the same."""
    if sources is None or not sources.files:
        return ""
    return _digest([listing(spark, path) for path in sources.files])


def fingerprint(model: str, cfg: Config, parents: list[str]) -> str:
    """What a model's rows follow from; empty if that cannot be told."""
    if not all(parents):
        return ""
    rules = {k: v for k, v in asdict(cfg).items() if k in RULES.get(model, ())}
    return _digest(model, _code(), rules, parents)


def _counted(frame: DataFrame, seen: Observation) -> DataFrame:
    return frame.observe(seen, F.count(F.lit(1)).alias("n"))


def publish(
    spark: SparkSession,
    sources: Sources | None,
    out_dir: str,
    cfg: Config = Config(),
    layers: Collection[str] | None = None,
    force: bool = False,
) -> dict[str, DataFrame]:
    """Writes the converted deals and the marts as one version and returns its tables.

    `out_dir` is a folder all executors reach. Marts start from the written deals, the
    ladder from the written fact: extracts are parsed once, and a lost executor costs no
    more than the step at hand. Readers see the new version when all of it is there.

    - A model whose input, rules and code are those of the current version is not written
      again; the new version refers to the old table. Nothing to write: no new version.
    - `layers={"mart"}` takes the converted deals from the current version, whatever the
      sources are by now, and needs none; `{"intermediate"}` leaves the marts as they are.
    - Models of a tier are written at once. When one fails, those that need it are left
      out, the others are finished, and nothing is published.
    - Rows of the raw, staged and converted deals are counted by the write itself.
    - `force` writes everything.
    """
    wanted = {"intermediate", "mart"} if layers is None else set(layers)
    unknown = wanted - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    old = manifest(spark, out_dir)
    models = Models(spark, sources, cfg)
    names = {name for layer in wanted for name in LAYERS[layer]} & set(PARENTS)
    if "int_deals_with_sdr" in names and sources is None:
        raise ValueError("converted deals need sources")
    if not old and not names >= set(PARENTS):
        raise ValueError("the first publish needs the intermediate and the mart layer")
    version = next_version(spark, out_dir)
    prints = {"sources": source_fingerprint(spark, sources)}
    entries: dict[str, Entry] = {}
    failed: dict[str, BaseException] = {}
    skipped: list[str] = []

    def take(entry: Entry) -> None:
        entries[entry.model] = entry
        prints[entry.model] = entry.fingerprint
        # What depends on this model from here on starts at the written table.
        setattr(models, entry.model, spark.read.parquet(f"{out_dir}/{entry.path}"))

    def write(name: str) -> Entry:
        path, seen = f"{version}/{name}", Observation()
        target = f"{out_dir}/{path}"
        stages = {}
        if name == "int_deals_with_sdr":
            stages = {"src_deals": Observation(), "stg_deals": Observation()}
            models.sources = Sources(_counted(sources.deals, stages["src_deals"]), sources.fx_rates)
            models.stg_deals = _counted(models.stg_deals, stages["stg_deals"])
        column = PARTITIONED.get(name)
        # Counted behind the dealing, whose sampling pass would count once more.
        rows = _counted(arranged(getattr(models, name), column, CLUSTERED.get(name)), seen)
        (rows.write.partitionBy(column) if column else rows.write).parquet(target)
        counts = {**{n: o.get["n"] for n, o in stages.items()}, name: seen.get["n"]}
        stored = spark.read.parquet(target).count()  # from the files' footers
        if counts[name] != stored:
            # Part of the write ran twice after a lost executor; count by scans instead.
            counts = {n: getattr(Models(spark, sources, cfg), n).count() if n == "stg_deals" else sources.deals.count() for n in stages} | {name: stored}
        entries.update({n: Entry(n, "", "", c) for n, c in counts.items() if n != name})
        # A table is never changed, so its place names it where its inputs cannot.
        return Entry(name, path, prints[name] or _digest(path), counts[name])

    def attempt(name: str) -> tuple[str, Entry | BaseException]:
        try:
            return name, write(name)
        except Exception as error:  # noqa: BLE001  reported with the others
            return name, error

    for tier in TIERS:
        todo = []
        for name in tier:
            if any(p in failed or p in skipped for p in PARENTS[name]):
                skipped.append(name)
                continue
            prints[name] = fingerprint(name, cfg, [prints[p] for p in PARENTS[name]])
            known = old.get(name)
            if known and (name not in names or (not force and prints[name] and prints[name] == known.fingerprint)):
                take(known)
                if name == "int_deals_with_sdr":
                    entries.update({n: old[n] for n in ("src_deals", "stg_deals") if n in old})
            else:
                todo.append(name)
        for name, result in _at_once(spark, attempt, todo):
            if isinstance(result, Entry):
                take(result)
            else:
                failed[name] = result
    if failed:
        raise PublishFailed(failed, skipped)
    if any(e.path.startswith(f"{version}/") for e in entries.values()) or not old:
        write_manifest(spark, out_dir, version, list(entries.values()))
        mark_complete(spark, out_dir, version)
    return published_tables(spark, out_dir)


def _at_once(spark: SparkSession, work: Callable, names: list[str]) -> list[tuple]:
    """The models of a tier as jobs side by side; each thread keeps the session's local properties."""
    if len(names) < 2:
        return [work(name) for name in names]
    with ThreadPoolExecutor(len(names)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), names))


def is_current(spark: SparkSession, sources: Sources, out_dir: str, cfg: Config = Config()) -> dict[str, bool]:
    """Per model whether a publish would leave it as it is."""
    old, prints = manifest(spark, out_dir), {"sources": source_fingerprint(spark, sources)}
    for tier in TIERS:
        for name in tier:
            prints[name] = fingerprint(name, cfg, [prints[p] for p in PARENTS[name]])
    return {n: bool(prints[n]) and n in old and old[n].fingerprint == prints[n] for n in PARENTS}


__all__ = ["PublishFailed", "current_version", "is_current", "publish", "published_tables"]
