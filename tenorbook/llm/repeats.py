"""Finding all repeated windows of a corpus without a row per window.

A scan cuts the windows of each text into short ranges of consecutive starts, in a way that depends only on the windows'
own content, and names each range twice: `a` names content that every window of the range contains, `c` names all
content of the range. `settle` then decides whole ranges: if `c` occurs elsewhere, all its windows are repeated; if `a`
occurs nowhere else, none is. The ranges in between (at the ends of repeated passages) are cut smaller in another scan,
together with one representative of every settled range that they may meet. At single windows nothing is left.

All steps are counts by name, which Spark combines before the shuffle, and joins with stored tables, which it can split;
no group of equal names is ever gathered in a task. Decisions rest on both names; what `a` does not cover of a range
rests on the 64 bits of `c`.

A text is told from others by its id and its 64-bit hash, which go with every range; ids may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tenorbook.llm.common import pieces, stored

_KEY = ["doc_id", "text_hash"]


def row_schema(kind: DataType) -> str:
    return f"a long, c long, doc_id {kind.simpleString()}, text_hash long, at long"


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text_hash, text: rows with equal keys are equal, so marks on one hold for all."""
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))


def _at(lo: np.ndarray, hi: np.ndarray, asks: np.ndarray) -> np.ndarray:
    """One number for where in its text a range is: asks (1 bit), length (31), begin (32). Shuffled rows stay short."""
    return (asks.astype(np.int64) << 63) | ((hi - lo) << 32) | lo


def placed(rows: DataFrame) -> DataFrame:
    """doc_id, text_hash, lo, hi, asks of rows with `at`."""
    lo, length = F.col("at").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("at", 32).bitwiseAND(0x7FFFFFFF)
    return rows.select(*_KEY, lo.alias("lo"), (lo + length).alias("hi"), (F.col("at") < 0).alias("asks"))


def packed(docs: DataFrame) -> DataFrame:
    """Keyed rows with the text compressed for a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for batch in batches:
            for part in pieces(batch, "text"):
                raw = [None if t is None else t.encode() for t in part.column("text").to_pylist()]
                small = [None if r is None else codec.compress(r, asbytes=True) for r in raw]
                sizes = pa.array([None if r is None else len(r) for r in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), sizes, pa.array(small, pa.binary())], [*_KEY, "size", "small"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, size long, small binary")


def unpacked(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of a batch of packed rows, with their texts."""
    codec, begin, total = pa.Codec("zstd"), 0, 0
    sizes = [n or 0 for n in batch.column("size").to_pylist()]
    for k in range(len(sizes) + 1):
        if k == len(sizes) or k > begin and total + sizes[k] > most:
            part = batch.slice(begin, k - begin)
            raw = [None if s is None else codec.decompress(s, n, asbytes=True) for s, n in zip(part.column("small").to_pylist(), sizes[begin:k], strict=True)]
            yield part, pa.array(raw, pa.large_binary())
            begin, total = k, 0
        total += sizes[k] if k < len(sizes) else 0


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["_id"]) & (left["text_hash"] == right["_hash"])


def with_ranges(docs: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """Packed rows joined with the list of their ranges (lo, hi, asks). Copies have the same ranges, which are listed once."""
    lists = ranges.groupBy(*_KEY).agg(F.collect_set(F.struct("lo", "hi", "asks")).alias("ranges"))
    lists = stored(lists.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "ranges"))
    rows = packed(docs)
    return rows.join(lists, _same(rows, lists), how).drop("_id", "_hash")


def settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(marks, rest): ranges all of whose windows are repeated, and ranges to be cut smaller.

    A range has the 128-bit name (a, c). Rows are used twice; a scan is cheaper to repeat than to store.
    """
    asks = F.col("at") < 0
    twice = rows.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.max(asks).alias("any")).filter("n > 1 and any").select(F.col("a").alias("_a"))
    twice = stored(twice)
    met = stored(rows.join(twice, F.col("a") == F.col("_a")).drop("_a"))
    whole = met.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_KEY, "at")).alias("one")).filter("n > 1")
    whole = stored(whole.select(F.col("a").alias("_a"), F.col("c").alias("_c"), "one"))
    found = stored(met.join(whole.select("_a", "_c"), (F.col("a") == F.col("_a")) & (F.col("c") == F.col("_c")), "left"))
    marks = placed(found.filter(F.col("_a").isNotNull() & asks))
    left = found.filter("_a is null").select("a", *_KEY, "at")
    open_ = stored(left.filter(asks).select(F.col("a").alias("_a")).distinct())
    quiet = F.col("at").bitwiseAND((1 << 63) - 1).alias("at")
    others = left.filter(~asks).unionByName(whole.select(F.col("_a").alias("a"), "one.*").select("a", *_KEY, quiet))
    others = others.join(open_, F.col("a") == F.col("_a"), "left_semi")
    return marks, placed(left.filter(asks).unionByName(others))


def settle_windows(rows: DataFrame) -> DataFrame:
    """The marks among ranges of one window each, with the 128-bit name (a, c)."""
    asks = F.col("at") < 0
    rows = stored(rows)
    twice = rows.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.max(asks).alias("any")).filter("n > 1 and any")
    twice = stored(twice.select(F.col("a").alias("_a"), F.col("c").alias("_c")))
    return placed(rows.filter(asks).join(twice, (F.col("a") == F.col("_a")) & (F.col("c") == F.col("_c"))))


def scan(docs: DataFrame, cut: Callable[[pa.Array], tuple], kind: DataType) -> DataFrame:
    """Ranges of all texts; `cut` gives (text, a, c, lo, hi) arrays for an array of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                of, *names, lo, hi = cut(part.column("text"))
                yield _out(part, of, names, lo, hi, np.ones(len(of), bool))

    return docs.mapInArrow(run, row_schema(kind))


def rescan(rows: DataFrame, cut: Callable[[pa.Array, list], tuple], kind: DataType) -> DataFrame:
    """Smaller ranges of listed ones; `cut` gives (text, a, c, lo, hi, asks) arrays for texts and their lists of ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in unpacked(batch):
                of, *names, lo, hi, asks = cut(texts, part.column("ranges").to_pylist())
                yield _out(part, of, names, lo, hi, asks)

    return rows.mapInArrow(run, row_schema(kind))


def _out(part: pa.RecordBatch, of: np.ndarray, names: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
    a, c = (pa.array(x.view("int64")) for x in names)
    keys = [part.column(k).take(pa.array(of)) for k in _KEY]
    return pa.RecordBatch.from_arrays([a, c, *keys, pa.array(_at(lo, hi, asks))], ["a", "c", *_KEY, "at"])
