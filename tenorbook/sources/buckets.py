"""Tables stored in buckets of the deal's key, so that checks and joins by deal need no shuffle.

Writing costs one shuffle by the key. From then on every aggregate by the key, and every join with a table of the same
number of buckets on the same key, reads a bucket per task and moves nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenorbook.sources.versions import published_tables

#: Published tables that carry the deal's key.
BY_DEAL = ("int_deals_with_sdr", "fct_currency_deposits")


def store_bucketed(frame: DataFrame, table: str, path: str, key: str = "deal_id", buckets: int = 64) -> DataFrame:
    """Stores a frame as a catalog table at `path`, one sorted file per bucket, and returns it.

    `buckets` is for good: tables that are to be joined need the same number, and a bucket should fit a task (some
    hundred megabytes). A key that repeats without end lies in one bucket whole; its task streams it.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    # Dealt by the hash that also numbers the buckets: each task writes one of them.
    dealt = frame.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return frame.sparkSession.table(table)


def bucket_published(spark: SparkSession, out_dir: str, path: str, prefix: str, buckets: int = 64) -> dict[str, DataFrame]:
    """The current version's tables of deals, in buckets, as catalog tables `<prefix>_<model>` under `path`."""
    tables = published_tables(spark, out_dir)
    return {name: store_bucketed(tables[name], f"{prefix}_{name}", f"{path}/{name}", buckets=buckets) for name in BY_DEAL}
