"""Removal of repeated word sequences, found by recompression.

Words are symbols named by hash. Rounds shorten each text: a run round replaces a run of one symbol by a new one, a pair round
replaces every pair whose first symbol is a "left" one and whose second is a "right" one, by a coin that depends on the symbol and
the round. New names are hashes of what they replace, so all tasks name the same runs and pairs alike without a dictionary. What happens
to a stretch depends on the stretch alone but for its ends: an outer run may go on outside, a first right or last left
symbol may pair with a neighbour. With these popped in every round, the symbols inside a window are the same
wherever the window occurs.

A window is known by the least-named of its inner symbols of the last round that begin near its begin, or, if a round
leaves none there, by the first one of the round before. All windows known by one occurrence of a symbol form a
range, named by the symbol with the words that follow it (in every window of the range) and by all words of the range. `repeats` settles ranges that share high-level symbols, and
verifies the rest window by window, by 128-bit names of their words.

Every occurrence is removed, also the first; a window is `window` words of one text. Null and empty texts have no words. Rows with
equal id and text are copies and stay rows of their own. Texts are read whole, long ones in overlapping parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook.llm import repeats
from tenorbook.llm.common import Rolling, Words, mixed, stored

WINDOW = 35
#: True: run round, False: pair round.
ROUNDS = (True, False, False)


def lead_of(window: int) -> int:
    """A window's symbol begins so many words after the window at most: always inside, with words of the window behind it."""
    if window < 1:
        raise ValueError("a window has at least one word")
    return min(20, 4 * window // 7)


_ONE, _TWO = 0x9E6C63D0876A9A63, 0xC2B2AE3D27D4EB4F
_PART = 1 << 18


def _anchors(names: np.ndarray, doc: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: where its symbol begins, the round and the symbol's name."""
    n, lead = len(names), lead_of(window)
    begin, end, name, of = np.arange(n), np.arange(1, n + 1), names, doc
    place, level, known = starts.copy(), np.zeros(len(starts), np.int8), names[starts]
    alive, low, high = np.arange(len(starts)), starts.copy(), starts + window
    first, last = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for k, runs in enumerate(ROUNDS, 1):
        m = len(begin)
        first[begin], last[end] = np.arange(m), np.arange(m)
        new_low, new_high = first[low], last[high]
        if runs:
            head = np.r_[True, (name[1:] != name[:-1]) | (of[1:] != of[:-1])]
            heads = np.flatnonzero(head)
            run = np.cumsum(head) - 1
            size = np.diff(np.r_[heads, m])
            tails = heads + size - 1
            low, high = end[tails[run[new_low]]], begin[heads[run[new_high]]]
            name = np.where(size > 1, mixed(name[heads] * np.uint64(31) + size.astype(np.uint64)), name[heads])
            begin, end, of = begin[heads], end[tails], of[heads]
        else:
            right = (mixed(name + np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
            low = np.where(right[new_low], end[new_low], low)
            high = np.where(right[new_high], high, begin[new_high])
            joins = np.r_[~right[:-1] & right[1:] & (of[1:] == of[:-1]), False]
            keep = np.r_[True, ~joins[:-1]]
            joined = mixed(name[:-1] * np.uint64(0x9FB21C651E98DF25) + mixed(name[1:]) + np.uint64(k)) if m > 1 else name[:0]
            name = np.where(joins, np.r_[joined, name[-1:]], name)[keep]
            end = np.where(joins, np.r_[end[1:], end[-1:]], end)[keep]
            begin, of = begin[keep], of[keep]
        fine = (low < high) & (low - starts[alive] <= lead)
        alive, low, high = alive[fine], low[fine], high[fine]
        if not len(alive):
            break
        first[begin], last[end] = np.arange(len(begin)), np.arange(len(begin))
        place[alive], level[alive], known[alive] = low, k, name[first[low]]
    else:
        upto = np.searchsorted(begin, starts[alive] + lead, "right") - 1
        least = _least(mixed(name), first[low], np.minimum(upto, last[high]))
        place[alive], known[alive] = begin[least], name[least]
    return place, level, known


def _least(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the least of keys[low..high] is, the first one of equals; for stretches shorter than 32."""
    number = np.uint64((1 << 24) - 1)
    keys = (keys & ~number) | np.arange(len(keys), dtype=np.uint64)
    size, out = high - low + 1, np.empty(len(low), np.int64)
    for k in range(5):
        own = np.flatnonzero((size >> k) == 1)
        if len(own):
            out[own] = (np.minimum(keys[low[own]], keys[high[own] - (1 << k) + 1]) & number).astype(np.int64)
        keys = np.minimum(keys, np.r_[keys[1 << k :], keys[max(len(keys) - (1 << k), 0) :]][: len(keys)])
    return out


def _cut(window: int, texts: pa.Array) -> tuple:
    words = Words(texts)
    one = words.hashes()
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    out: list[tuple] = []
    for at in range(0, max(len(one) - window + 1, 0), _PART):
        part = slice(at, at + _PART + window - 1)
        own, of = one[part], doc[part]
        starts = np.flatnonzero(of[: len(of) - window + 1] == of[window - 1 :])
        if not len(starts):
            continue
        place, level, known = _anchors(own, of, starts, window)
        change = np.r_[True, (place[1:] != place[:-1]) | (level[1:] != level[:-1]) | (np.diff(starts) != 1)]
        heads = np.flatnonzero(change)
        tails = np.r_[heads[1:] - 1, len(starts) - 1]
        lo, hi, s = starts[heads], starts[tails], place[heads]
        shape = mixed((s - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - lo).astype(np.uint64) * np.uint64(64) + level[heads].astype(np.uint64))
        rolling = Rolling(own, _ONE)
        a = mixed(known[heads] + level[heads].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ rolling.of(s, s + window - lead_of(window)))
        base = at - words.upto[of[lo]]
        out.append((of[lo], a, mixed(rolling.of(lo, hi + window) + shape), lo + base, hi + base))
    none = np.zeros(0, np.int64)
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (none, *[none.view(np.uint64)] * 2, none, none)


def expand(ranges: list, size: int = 1) -> tuple[np.ndarray, ...]:
    """(text, lo, hi, asks) of lists of ranges."""
    of = np.repeat(np.arange(len(ranges)), [len(r) for r in ranges])
    lo, hi = (np.array([x[c] for r in ranges for x in r], np.int64) for c in ("lo", "hi"))
    asks = np.array([x["asks"] for r in ranges for x in r], bool)
    return of, lo, hi, asks


def every(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range, position) of all positions of ranges."""
    of = np.repeat(np.arange(len(lo)), hi - lo + 1)
    return of, np.arange(len(of)) - np.r_[0, np.cumsum(hi - lo + 1)][of] + lo[of]


def _windows(window: int, texts: pa.Array, ranges: list) -> tuple:
    words = Words(texts)
    r1, r2 = Rolling(words.hashes(0), _ONE), Rolling(words.hashes(1), _TWO)
    of, lo, hi, asks = expand(ranges)
    row, start = every(lo, hi)
    begin = words.upto[of[row]] + start
    c1, c2 = r1.of(begin, begin + window), r2.of(begin, begin + window)
    return of[row], c1, c2, start, start, asks[row]


def marks(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Ranges (lo, hi) of starts of repeated windows, by doc_id and text_hash, for keyed rows."""
    kind = docs.schema["doc_id"].dataType
    whole, rest = repeats.settle(repeats.scan(docs, lambda texts: _cut(window, texts), kind))
    near = repeats.rescan(repeats.with_ranges(docs, rest, "inner"), lambda texts, ranges: _windows(window, texts, ranges), kind)
    return whole.unionByName(repeats.settle_windows(near))


def covered(ranges: list | None, n: int, window: int) -> np.ndarray:
    """Which of n positions lie in a window of the ranges."""
    steps = np.zeros(n + 1, np.int64)
    for x in ranges or ():
        steps[x["lo"]] += 1
        steps[min(x["hi"] + window, n)] -= 1
    return np.cumsum(steps[:-1]) > 0


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_removed, kept_sha256 and `kept`, the remaining words (null if nothing goes)."""
    rows = repeats.keyed(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in repeats.unpacked(batch):
                out = []
                for raw, ranges in zip(texts.to_pylist(), part.column("ranges").to_pylist(), strict=True):
                    words = (raw or b"").split()
                    gone = covered(ranges, len(words), window) if ranges else None
                    left = b" ".join(words if gone is None else compress(words, ~gone))
                    out.append((len(words), 0 if gone is None else int(gone.sum()), hashlib.sha256(left).hexdigest(), None if gone is None else left.decode()))
                n, removed, digest, kept = zip(*out, strict=True) if out else ((), (), (), ())
                columns = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), *columns], ["doc_id", "text_hash", "n_words", "n_removed", "kept_sha256", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return repeats.with_ranges(rows, marks(rows, window), "left").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents with repeated words taken out of the text; other texts and columns are unchanged."""
    changed = dedupe(docs, key, text, window).filter("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept").alias("_kept"))
    changed = stored(changed.dropDuplicates(["_id", "_hash"]))
    joined = docs.join(changed, docs[key].eqNullSafe(changed["_id"]) & (F.xxhash64(docs[text]) == changed["_hash"]), "left")
    return joined.select(*[F.coalesce(changed["_kept"], docs[c]).alias(c) if c == text else docs[c] for c in docs.columns])
