"""The place of every row in its group's order, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorbook.llm.common import stored


def placed(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Stores the rows with `at`, a number that rises in the order of key and `order`, and returns the stored table.

    Rows are dealt by ranges of key, order and, last, a number of their own, so that a group of any size, equal rows included, spans as
    many tasks as its size asks for. Numbers are unique; those of one range are consecutive.
    """
    own = F.monotonically_increasing_id()
    ranged = rows.select("*", own.alias("_own")).repartitionByRange(F.col(key), *order, F.col("_own")).sortWithinPartitions(F.col(key), *order, F.col("_own"))
    return stored(ranged.drop("_own").withColumn("at", own))


def with_position(rows: DataFrame, key: str) -> DataFrame:
    """Placed rows with `position`, from 1 within the key.

    A key's rows are counted per range first; what lies before each range is a sum over a key's ranges, at most one row per task of the
    sort. Rows then meet their range's sum by (key, range), so a large key is no large group in the join either.
    """
    parted = rows.withColumn("_part", F.shiftright("at", 33))
    runs = parted.groupBy(key, "_part").agg(F.min("at").alias("_begin"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select(F.col(key).alias("_key"), F.col("_part").alias("_range"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_begin") + 1).alias("_shift"))
    joined = parted.join(before, (F.col("_part") == F.col("_range")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*rows.columns, (F.col("at") + F.col("_shift")).alias("position"))
