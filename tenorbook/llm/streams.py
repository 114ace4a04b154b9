"""Rows of a key streamed in order through a Python generator."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Of = Callable[[tuple, Iterator[tuple]], Iterator[tuple]]


def by_key(frame: DataFrame, keys: list[str], order: list[str], of: Of, fields: str | T.StructType) -> DataFrame:
    """`of(key, rows)` for the rows of each key in order; what it yields are the rows of the result.

    keys are the frame's first columns. Spark deals by the keys and sorts, on disk where need be, and rows are read as `of` asks for them, so
    a key of any size takes no memory by itself. Rows that `of` leaves are skipped.
    """
    schema = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    arrow, n = to_arrow_schema(schema), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = (row for key, members in itertools.groupby(rows, key=lambda row: row[:n]) for row in of(key, members))
        while some := list(itertools.islice(found, 2048)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), arrow, strict=True)], schema=arrow)

    return frame.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
