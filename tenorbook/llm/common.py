"""Shared helpers: reading tables, storing intermediate results, hashing texts as arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only where a local session names none (as in tests) is one made and named; a cluster without one is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        found = tempfile.mkdtemp(prefix="tenorbook-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(frame: DataFrame) -> DataFrame:
    """Writes the frame to the shared folder and reads it again.

    Later steps start from the files, so a lost executor costs no earlier step, and Spark knows their true
    size, by which it decides on broadcasts.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/tenorbook-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def held_out(key: str = "doc_id") -> Column:
    """True for the fifth of the rows from which nothing may be learned."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each text begins (one more entry than texts). Null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no piece has more than `most` bytes of text, unless it is a single row."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for k, n in enumerate(lengths.tolist()):
        if k > begin and total + n > most:
            yield batch.slice(begin, k - begin)
            begin, total = k, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of an array of 64-bit values, from prefix sums modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int):
        power, self.inverse = self._tables(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    @classmethod
    def _tables(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            inverse = pow(base, -1, 1 << 64)
            have = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)], dtype=np.uint64) for b in (base, inverse))
            if size <= 1 << 22:
                cls._powers[base] = have
        return have

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin])


#: Odd bases and byte values of the two independent hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BYTE_VALUES = tuple(mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(k)) for k in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of several texts: where each begins and ends, its text and its hashes."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = flat(texts)
        n = len(self.data)
        word = ~_SPACE[self.data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        first[edges] = word[edges]
        last[edges - 1] = word[edges - 1]
        self.begin = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: words before each text; one more entry than texts
        self.upto = np.searchsorted(self.begin, self.offsets)
        self.counts = np.diff(self.upto)

    def hashes(self, which: int = 0) -> np.ndarray:
        out = np.empty(len(self.begin), np.uint64)
        at = 0
        while at < len(out):  # some megabytes at a time, at a word's begin, so that a long text takes no more memory
            upto = max(at + 1, int(np.searchsorted(self.begin, self.begin[at] + (1 << 22))))
            low, high = self.begin[at], self.end[upto - 1]
            rolling = Rolling(BYTE_VALUES[which][self.data[low:high]], BASES[which])
            out[at:upto] = rolling.of(self.begin[at:upto] - low, self.end[at:upto] - low)
            at = upto
        return out
