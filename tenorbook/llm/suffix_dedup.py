"""Removal of repeated byte strings, with suffixes ordered by deep-shallow sorting.

Anchors. A window of `window` bytes is known by the least-hashed position in its first half; windows known by one occurrence of
an anchor form a range, named by the half window that follows the anchor (in every window of the range) and by all bytes
of the range. `repeats` settles ranges and then blocks of ranges; what is left lies at the ends of repeated passages.

Suffixes. The windows still open are suffixes of their texts. Each shard orders its open suffixes by deep-shallow sorting:
multikey quicksort on eight bytes at a time down to a shallow depth, then a blind trie for each group that still agrees. Suffixes
that stand together and agree for a whole window are one class; a class is named by the 128-bit digest of its bytes, and classes
of all shards meet by name.

Texts are UTF-8 bytes; null is empty; matches never cross texts. Every occurrence is removed, overlaps count, and
windows are judged on the input. Rows with equal id and text are copies. Long texts are scanned in overlapping parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tenorbook.llm import repeats
from tenorbook.llm.common import BYTE_VALUES, Rolling, flat, mixed
from tenorbook.llm.substring_dedup import covered, every, expand

WINDOW = 400
#: Bytes that an anchor's hash sees, and windows in a block.
GRAM, BLOCK = 16, 16
#: Depth of the multikey quicksort, in bytes, and the group size below which suffixes are compared directly.
SHALLOW, SMALL = 32, 8
_ONE = 0x9E6C63D0876A9A63
_PART, _POSITION = 1 << 20, np.uint64((1 << 24) - 1)


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row."""
    n = len(keys) - width + 1
    size = -(-len(keys) // width) * width
    blocks = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, width)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _rolling(data: np.ndarray) -> Rolling:
    return Rolling(BYTE_VALUES[0][data], _ONE)


def _number(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64)


def _cut(window: int, texts: pa.Array) -> tuple:
    data, offsets = flat(texts)
    half = window // 2
    out: list[tuple] = []
    for at in range(0, max(len(data) - window + 1, 0), _PART):
        own = data[at : at + _PART + window - 1]
        doc = np.searchsorted(offsets, np.arange(at, at + len(own) - window + 1), "right") - 1
        fits = np.arange(at + window, at + window + len(doc)) <= offsets[doc + 1]
        if not fits.any():
            continue
        rolling = _rolling(own)
        p = np.arange(len(own) - GRAM + 1)
        keys = (rolling.of(p, p + GRAM) & ~_POSITION) | _number(p)
        starts = np.flatnonzero(fits)
        place = (_sliding_least(keys, half + 1)[starts] & _POSITION).astype(np.int64)
        heads = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (np.diff(starts) != 1)])
        lo, hi, s = starts[heads], starts[np.r_[heads[1:] - 1, len(starts) - 1]], place[heads]
        shape = mixed(_number(s - lo) * np.uint64(1 << 20) + _number(hi - lo))
        base = at - offsets[doc[lo]]
        out.append((doc[lo], rolling.of(s, s + half), mixed(rolling.of(lo, hi + window) + shape), lo + base, hi + base))
    none = np.zeros(0, np.int64)
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (none, *[none.view(np.uint64)] * 2, none, none)


def _blocks(window: int, texts: pa.Array, ranges: list) -> tuple:
    """Blocks of each range. They are laid out from the anchor, which is the same place wherever the windows occur."""
    data, offsets = flat(texts)
    rolling = _rolling(data)
    half = window // 2
    of, lo, hi, asks = expand(ranges)
    base = offsets[of]
    p = np.arange(max(len(data) - GRAM + 1, 0))
    keys = rolling.of(p, p + GRAM) & ~_POSITION
    anchor = np.array([b + x + int(np.argmin(keys[b + x : b + x + half + 1])) for b, x in zip(base.tolist(), hi.tolist(), strict=True)], np.int64) - base
    far, near = (anchor - lo) // BLOCK, (anchor - hi) // BLOCK
    row, block = every(near, far)
    begin = np.maximum(anchor[row] - (block + 1) * BLOCK + 1, lo[row])
    end = np.minimum(anchor[row] - block * BLOCK, hi[row])
    at = base[row]
    inner = rolling.of(at + np.maximum(anchor[row] - block * BLOCK, 0), at + anchor[row] - (block + 1) * BLOCK + 1 + window)
    a = mixed(inner + _number(block))
    shape = mixed(_number(anchor[row] - begin) * np.uint64(1 << 20) + _number(end - begin))
    return of[row], a, mixed(rolling.of(at + begin, at + end + window) + shape), begin, end, asks[row]


class _Trie:
    """A blind trie: nodes are [depth at which children differ, {byte: child}, some suffix below]; leaves are lists of equal suffixes."""

    def __init__(self, data: bytes, length: int, first: int):
        self.data, self.length, self.root = data, length, [first]

    def _agree(self, x: int, y: int) -> int:
        data, low, high = self.data, 0, self.length
        while low < high:
            middle = (low + high + 1) // 2
            if data[x + low : x + middle] == data[y + low : y + middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def add(self, suffix: int) -> None:
        data, node = self.data, self.root
        while isinstance(node, tuple):  # blindly, by the branching bytes alone
            node = node[1].get(data[suffix + node[0]]) or node[2]
        other = node[0]
        depth = self._agree(suffix, other)
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][data[suffix + node[0]]]
        if depth == self.length:
            node.append(suffix)
        elif isinstance(node, tuple) and node[0] == depth:
            node[1][data[suffix + depth]] = [suffix]
        else:
            fork = (depth, {data[other + depth]: node, data[suffix + depth]: [suffix]}, node if isinstance(node, list) else node[2])
            if above is None:
                self.root = fork
            else:
                above[1][data[suffix + above[0]]] = fork

    def classes(self) -> Iterator[list[int]]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [child for _, child in sorted(node[1].items(), reverse=True)]
            else:
                yield node


def ordered_classes(data: np.ndarray, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> Iterator[list[int]]:
    """Classes of suffixes that agree for `length` bytes, in the order of the suffixes."""
    raw = data.tobytes()
    view = np.lib.stride_tricks.sliding_window_view(data, 8) if len(data) >= 8 else None
    stack = [(np.asarray(starts), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            yield [int(group[0])]
        elif depth >= min(shallow, length - 7) or len(group) <= SMALL:
            trie = _Trie(raw, length, int(group[0]))
            for suffix in group[1:].tolist():
                trie.add(suffix)
            yield from trie.classes()
        else:  # multikey quicksort, eight bytes a key
            key = np.ascontiguousarray(view[group + depth]).view(">u8").ravel()
            pivot = np.partition(key, len(key) // 2)[len(key) // 2]
            less, more = key < pivot, key > pivot
            parts = [(group[less], depth), (group[~less & ~more], depth + 8), (group[more], depth)]
            stack += [(g, d) for g, d in reversed(parts) if len(g)]


def _windows(window: int, texts: pa.Array, ranges: list) -> tuple:
    data, offsets = flat(texts)
    of, lo, hi, asks = expand(ranges)
    row, start = every(lo, hi)
    begin = offsets[of[row]] + start
    unique, back = np.unique(begin, return_inverse=True)
    names = np.zeros((len(unique), 2), np.uint64)
    raw = data.tobytes()
    for suffixes in ordered_classes(data, unique, window) if len(unique) else ():
        name = np.frombuffer(hashlib.blake2b(raw[suffixes[0] : suffixes[0] + window], digest_size=16).digest(), np.uint64)
        names[np.searchsorted(unique, suffixes)] = name
    names = names[back]
    return of[row], names[:, 0].copy(), names[:, 1].copy(), start, start, asks[row]


def marks(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Ranges (lo, hi) of starts of repeated windows, by doc_id and text_hash, for keyed rows."""
    if not 64 <= window <= 510:
        raise ValueError("a window has 64 to 510 bytes")
    kind = docs.schema["doc_id"].dataType
    whole, rest = repeats.settle(repeats.scan(docs, lambda texts: _cut(window, texts), kind))
    blocks = repeats.rescan(repeats.with_ranges(docs, rest, "inner"), lambda texts, ranges: _blocks(window, texts, ranges), kind)
    parts, rest = repeats.settle(blocks)
    near = repeats.rescan(repeats.with_ranges(docs, rest, "inner"), lambda texts, ranges: _windows(window, texts, ranges), kind)
    return whole.unionByName(parts).unionByName(repeats.settle_windows(near))


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, text_hash, n_bytes, n_removed, n_spans, kept_sha256 and `kept`, the remaining bytes (null if nothing goes)."""
    rows = repeats.keyed(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in repeats.unpacked(batch):
                out = []
                for raw, ranges in zip(texts.to_pylist(), part.column("ranges").to_pylist(), strict=True):
                    raw, spans, removed, kept = raw or b"", 0, 0, None
                    if ranges:
                        gone = covered(ranges, len(raw), window)
                        spans, removed = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), int(gone.sum())
                        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((len(raw), removed, spans, hashlib.sha256(raw if kept is None else kept).hexdigest(), kept))
                columns = list(zip(*out, strict=True)) if out else [()] * 5
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), *arrays], ["doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return repeats.with_ranges(rows, marks(rows, window), "left").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
