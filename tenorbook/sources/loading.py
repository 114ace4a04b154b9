"""Loading deal extracts batch by batch into a table that is partitioned by value month.

The table holds four kinds of lines, as partitions (kind, part):

    dated     part = value month, yyyy-MM; a batch replaces the months it brings
    undated   part = batch; deals without a valid value date
    stray     part = batch; deals of months the batch was not meant to bring
    rejected  part = batch; lines with too few or too many fields, as they stand in the file

A load parses the file once, in permissive mode, and writes all kinds with one job that overwrites the partitions it
has rows for and no other. So a repeated load changes nothing, a corrected one replaces what it brings, and other months keep their
files. Kinds that go by batch get an empty marker row each time, so that what an earlier load of the batch left there goes.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tenorbook.functions.dates import strict_date
from tenorbook.schemas import DEALS_RAW
from tenorbook.sources.files import QUOTING

BY_BATCH = ("undated", "stray", "rejected")


@dataclass(frozen=True)
class LoadReport:
    """Lines of a load by what became of them; `lines` is their sum."""

    lines: int
    dated: int
    undated: int
    stray: int
    rejected: int


def tolerant_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a CSV extract: its columns, or where it has too few or too many fields the line itself in `malformed_line`.

    Empty lines are no lines. The header must name the columns in their order.
    """
    schema = StructType([*DEALS_RAW.fields, StructField("malformed_line", StringType())])
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord="malformed_line", columnPruning=False)
        .options(**QUOTING)
        .csv(path)
    )


def load_deals(spark: SparkSession, path: str, table: str, batch: str, months: Collection[str] | None = None) -> LoadReport:
    """Loads one extract into the table (a folder all executors reach) and says what became of its lines.

    batch names the delivery; loading a batch again replaces it. months (yyyy-MM): the months the batch brings whole. Deals of
    other months are stray and replace nothing. Without it every month in the file counts as whole.
    """
    month = F.date_format(strict_date(F.col("value_date")), "yyyy-MM")
    kind = F.when(F.col("malformed_line").isNotNull(), "rejected").when(month.isNull(), "undated")
    if months is not None:
        kind = kind.when(~month.isin(list(months)), "stray")
    kind = kind.otherwise("dated")
    seen = Observation()
    names = ("dated", *BY_BATCH)
    lines = tolerant_lines(spark, path).withColumn("kind", kind)
    counted = lines.observe(seen, F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col("kind") == n).alias(n) for n in names])
    # A rejected line's columns are guesses of the parser; only the line itself is kept.
    good = F.col("kind") != "rejected"
    rows = counted.select(
        *[F.when(good, F.col(c)).alias(c) for c in DEALS_RAW.names],
        "malformed_line",
        F.lit(False).alias("is_marker"),
        "kind",
        F.when(F.col("kind") == "dated", month).otherwise(F.lit(batch)).alias("part"),
    )
    markers = spark.range(0, len(BY_BATCH), 1, 1).select(
        F.lit(True).alias("is_marker"), F.element_at(F.array(*map(F.lit, BY_BATCH)), F.col("id").cast("int") + 1).alias("kind"), F.lit(batch).alias("part")
    )
    whole = rows.unionByName(markers, allowMissingColumns=True)
    # Few files per partition; adaptive execution splits a month too large for one task.
    whole.hint("rebalance", "kind", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "part").parquet(table)
    return LoadReport(**{n: seen.get[n] for n in ("lines", *names)})


def _stored(spark: SparkSession, table: str, *kinds: str) -> DataFrame:
    columns = [*DEALS_RAW.fields, StructField("malformed_line", StringType())]
    schema = StructType(columns).add("is_marker", "boolean").add("kind", "string").add("part", "string")
    return spark.read.schema(schema).parquet(table).filter(F.col("kind").isin(*kinds) & ~F.col("is_marker"))


def loaded_deals(spark: SparkSession, table: str, months: Collection[str] | None = None) -> DataFrame:
    """The raw deals of all batches; with `months` (yyyy-MM) those months' files alone are read."""
    if months is not None:
        return _stored(spark, table, "dated").filter(F.col("part").isin(list(months))).select(*DEALS_RAW.names)
    return _stored(spark, table, "dated", "undated").select(*DEALS_RAW.names)


def stray_deals(spark: SparkSession, table: str) -> DataFrame:
    """Deals that arrived with a batch of other months."""
    return _stored(spark, table, "stray").select(F.col("part").alias("batch"), *DEALS_RAW.names)


def rejected_lines(spark: SparkSession, table: str) -> DataFrame:
    """batch and the lines that were refused."""
    return _stored(spark, table, "rejected").select(F.col("part").alias("batch"), "malformed_line")
