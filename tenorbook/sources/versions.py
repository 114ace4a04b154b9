"""Published versions: folders written once, and a marker that makes one of them the current.

    out/v00000002-6f1c…/<model>      tables of one publish, never changed afterwards
    out/v00000002-6f1c…/manifest     what the version consists of, one row per model
    out/_published/v00000002-6f1c…   empty; says that the version is complete

Readers take the last marker, so a publish that fails half-way changes nothing for them. The version is in the
marker's name, not in its content: a file system or object store shows a file of no bytes whole or not at all. Two
publishes at once end in two versions, of which the last by name counts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MARKERS = "_published"


@dataclass(frozen=True)
class Entry:
    """One model of a version: where it lies, what it was made from, how many rows it has (None: not counted)."""

    model: str
    path: str
    fingerprint: str
    row_count: int | None


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, path = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and modification time of all files at or below a path. Only names reach the driver, as in any scan."""
    system, root = _file_system(spark, path)
    if not system.exists(root):
        return []
    found, files = [], system.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append((name, status.getLen(), status.getModificationTime()))
    return sorted(found)


def complete_versions(spark: SparkSession, out_dir: str) -> list[str]:
    """Versions that readers may see, oldest first."""
    return [n for n in _names(spark, f"{out_dir}/{MARKERS}") if n.startswith("v")]


def current_version(spark: SparkSession, out_dir: str) -> str | None:
    return max(complete_versions(spark, out_dir), default=None)


def next_version(spark: SparkSession, out_dir: str) -> str:
    """A name after every complete and every begun version."""
    taken = [n for n in [*_names(spark, out_dir), *complete_versions(spark, out_dir)] if n.startswith("v")]
    number = max((int(n[1:].split("-")[0]) for n in taken), default=0) + 1
    return f"v{number:08d}-{uuid.uuid4().hex[:12]}"


def write_manifest(spark: SparkSession, out_dir: str, version: str, entries: list[Entry]) -> None:
    columns = {name: [getattr(e, name) for e in entries] for name in ("model", "path", "fingerprint", "row_count")}
    schema = pa.schema([("model", pa.string()), ("path", pa.string()), ("fingerprint", pa.string()), ("row_count", pa.int64())])
    spark.createDataFrame(pa.table(columns, schema)).coalesce(1).write.parquet(f"{out_dir}/{version}/manifest")


def mark_complete(spark: SparkSession, out_dir: str, version: str) -> None:
    system, path = _file_system(spark, f"{out_dir}/{MARKERS}/{version}")
    if not system.createNewFile(path):
        raise FileExistsError(f"version {version} is published already")


def manifest(spark: SparkSession, out_dir: str, version: str | None = None) -> dict[str, Entry]:
    """The models of a version, the current one unless named; none before the first publish."""
    version = version or current_version(spark, out_dir)
    if version is None:
        return {}
    return {row.model: Entry(*row) for row in spark.read.parquet(f"{out_dir}/{version}/manifest").select("model", "path", "fingerprint", "row_count").collect()}


def published_tables(spark: SparkSession, out_dir: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the current one unless named."""
    return {name: spark.read.parquet(f"{out_dir}/{e.path}") for name, e in manifest(spark, out_dir, version).items() if e.path}


def published_counts(spark: SparkSession, out_dir: str, version: str | None = None) -> DataFrame:
    """relation, row_count, as counted while the version was written."""
    entries = [e for e in manifest(spark, out_dir, version).values() if e.row_count is not None]
    schema = pa.schema([("relation", pa.string()), ("row_count", pa.int64())])
    return spark.createDataFrame(pa.table({"relation": [e.model for e in entries], "row_count": [e.row_count for e in entries]}, schema))


def retire(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Deletes folders of complete versions that none of the last `keep` refers to, and returns their names.

    Readers of a retired version lose it, so `keep` has to outlast the longest reader. Folders without a marker are left alone, as their
    publish may still run.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    every = complete_versions(spark, out_dir)
    used = {e.path.split("/")[0] for v in every[-keep:] for e in manifest(spark, out_dir, v).values() if e.path} | set(every[-keep:])
    gone = [v for v in every if v not in used]
    for version in gone:
        for path in (f"{out_dir}/{MARKERS}/{version}", f"{out_dir}/{version}"):
            system, target = _file_system(spark, path)
            system.delete(target, True)
    return gone
