"""Extracts and published tables as files or catalog tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tenorbook.schemas import DEALS_RAW, FX_RAW

# Doubled quotes inside quoted fields, as most exporters write them.
QUOTING = {"quote": '"', "escape": '"'}


@dataclass(frozen=True)
class Sources:
    """The two raw relations a run starts from."""

    deals: DataFrame
    fx_rates: DataFrame
    #: Files the relations are read from, if that is all they are.
    files: tuple[str, ...] = ()

    @classmethod
    def from_files(cls, spark: SparkSession, base: str, fmt: str = "csv") -> Sources:
        suffix = ".csv" if fmt == "csv" else ""
        paths = (f"{base}/src_deals{suffix}", f"{base}/src_fx_rates{suffix}")
        return cls(
            read_deals(spark, paths[0], fmt), read_fx_rates(spark, paths[1], fmt), paths
        )

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Sources:
        return cls(
            spark.read.table(f"{database}.src_deals"),
            spark.read.table(f"{database}.src_fx_rates"),
        )


def _read(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    if fmt == "csv":
        # enforceSchema=False makes Spark compare the header with the schema, so a
        # file with moved columns fails instead of being read under wrong names. A
        # line with too few or too many fields fails the read; `malformed_lines`
        # lists such lines. Fields can only be counted when none is pruned.
        return (
            spark.read.schema(schema)
            .options(header=True, enforceSchema=False, mode="FAILFAST", columnPruning=False)
            .options(**QUOTING)
            .csv(path)
        )
    # A columnar table has its own types; staging accepts text and numbers alike.
    return spark.read.format(fmt).load(path).select(*schema.names)


def read_deals(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, fmt, DEALS_RAW)


def read_fx_rates(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, fmt, FX_RAW)


def malformed_lines(spark: SparkSession, path: str, schema: StructType = DEALS_RAW) -> DataFrame:
    """Lines of a CSV extract with too few or too many fields, as they stand in the file."""
    lines = (
        spark.read.schema(StructType([*schema.fields, StructField("malformed_line", StringType())]))
        .options(header=True, columnNameOfCorruptRecord="malformed_line", columnPruning=False)
        .options(**QUOTING)
        .csv(path)
    )
    return lines.filter("malformed_line IS NOT NULL").select(*schema.names[:1], "malformed_line")


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header; blanks at the ends of a value are kept."""
    frame.write.mode("overwrite").options(
        header=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **QUOTING,
    ).csv(path)


def load_raw(spark: SparkSession, csv_dir: str, out_dir: str) -> Sources:
    """Both CSV extracts as parquet tables of text columns, the short rates in few files."""
    extracts = Sources.from_files(spark, csv_dir)
    extracts.deals.write.mode("overwrite").parquet(f"{out_dir}/src_deals")
    extracts.fx_rates.hint("rebalance").write.mode("overwrite").parquet(f"{out_dir}/src_fx_rates")
    return Sources.from_files(spark, out_dir, "parquet")


def arranged(
    frame: DataFrame,
    partition_by: str | None = None,
    cluster_by: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows dealt for the writer.

    A partitioned table is rebalanced on its column first: few files per value, and
    adaptive execution splits a value too large for one task. A clustered one is
    dealt and sorted by ranges of its columns, so that readers skip files and row
    groups; a last column without repeats lets a frequent value span many tasks.
    Columns may be SQL expressions.
    """
    if cluster_by:
        columns = [F.expr(column) for column in cluster_by]
        return frame.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return frame.hint("rebalance", partition_by) if partition_by else frame


def write_tables(
    frames: Mapping[str, DataFrame],
    out_dir: str,
    partition_by: Mapping[str, str] | None = None,
    cluster_by: Mapping[str, tuple[str, ...]] | None = None,
) -> None:
    """Each frame as a parquet table, dealt as `arranged` says."""
    for name, frame in frames.items():
        column = (partition_by or {}).get(name)
        rows = arranged(frame, column, (cluster_by or {}).get(name))
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(column) if column else writer).parquet(f"{out_dir}/{name}")
