"""Labels derived from codes and day counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenorbook import fixed_values


def region_of(country: str) -> Column:
    """Region of the two-letter code in a column.

    Spark turns each long IN list into a hash-set lookup in generated code, so
    this needs no join.
    """
    branches = " ".join(
        f"WHEN {country} IN ({', '.join(map(repr, countries))}) THEN '{region}'"
        for region, countries in fixed_values.REGION_COUNTRIES.items()
    )
    return F.expr(f"CASE {branches} ELSE '{fixed_values.OTHER_REGION}' END")


def maturity_bucket(
    days: Column,
    is_sight: Column,
    edges: tuple[tuple[int, str], ...] = fixed_values.BUCKET_EDGES,
    sight_label: str = fixed_values.SIGHT_BUCKET,
    last_label: str = fixed_values.LAST_BUCKET,
) -> Column:
    """Time bucket of a deposit; sight money is overnight whatever its dates say."""
    bucket = F.when(is_sight, sight_label)
    for upper, label in edges:
        bucket = bucket.when(days <= upper, label)
    return bucket.otherwise(last_label)
