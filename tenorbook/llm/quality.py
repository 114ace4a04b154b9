"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at the quantiles of the training rows. Boosting goes round the features in turn:
one shallow tree of one feature is fitted to what the model does not explain yet and added, damped, to that
feature's lookup table. Then pairs of features, chosen by how much of the rest their joint bins explain, get
tables in the same way from trees that cut each of the two features once. A score is the sum of table
entries at the text's bins, so scoring a batch is one addition of looked-up values per table.

Features come from the whole text alone (character classes, word shapes, repetition). The model is fitted on a
bounded sample of labelled rows (`bound`, by hash of the key); every text is scored.

Null and empty texts are texts without words and get a score as any other. Without labels every score is 0.5.
Rows that are repeated are scored alike. Keys may be null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook.llm.common import Words, held_out, pieces, stored

_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "wide": range(0x80, 0x100), "line": [0x0A],
    "stop": map(ord, ".,;:?'\"-()"), "bar": [ord("|")], "mark": map(ord, "#$%&*@^~=+<>{}[]\\/_`"), "shout": [ord("!")],
}
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _n, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _n
FEATURES = [*_CLASSES, "bytes", "words", "word_length", "distinct", "echo", "plain", "capital", "longest", "sentence"]


def _per(numbers: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of stretches of `numbers`, empty ones included."""
    sums = np.zeros(len(numbers) + 1)
    np.cumsum(numbers, out=sums[1:])
    return sums[cuts[1:]] - sums[cuts[:-1]]


def features(texts: pa.Array) -> np.ndarray:
    words = Words(texts)
    size, n = np.diff(words.offsets), words.counts
    kind = _CLASS_OF[words.data]
    owner = np.repeat(np.arange(len(size)), size)
    counts = np.bincount(owner * (len(_CLASSES) + 1) + kind, minlength=len(size) * (len(_CLASSES) + 1)).reshape(len(size), -1)
    share = counts[:, :-1] / np.maximum(size, 1)[:, None]
    names, of = words.hashes(), np.repeat(np.arange(len(n), dtype=np.uint64), n)
    ordered = np.sort((of << np.uint64(44)) | (names >> np.uint64(20)))
    fresh = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    echo = np.r_[False, (names[1:] == names[:-1]) & (of[1:] == of[:-1])] if len(names) else np.zeros(0, bool)
    length = words.end - words.begin
    first = kind[words.begin] if len(n) and len(names) else np.zeros(0, np.uint8)
    last = kind[words.end - 1] if len(names) else np.zeros(0, np.uint8)
    letter = [list(_CLASSES).index(x) for x in ("upper", "lower", "wide")]
    some, stops = np.maximum(n, 1), counts[:, list(_CLASSES).index("stop")]
    longest = np.zeros(len(n))
    np.maximum.at(longest, of.astype(np.int64), length) if len(names) else None
    more = [
        np.log1p(size), np.log1p(n), _per(length, words.upto) / some, _per(fresh, words.upto) / some, _per(echo, words.upto) / some,
        _per(np.isin(last, letter), words.upto) / some, _per(first == 0, words.upto) / some, np.log1p(longest), np.log1p(n / (1 + stops)),
    ]
    return np.column_stack([share, *more])


@dataclass
class Model:
    cuts: list[np.ndarray]
    base: float = 0.0
    single: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)])

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.single):
            total += table[b[:, k]]
        for i, j, table in self.pairs:
            total += table[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _steps(g: np.ndarray, h: np.ndarray, depth: int, least: float) -> np.ndarray:
    """Leaf values by bin of a tree that halves the bins `depth` times where that explains most."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + 1) + gr**2 / (hr + 1), -1)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > g.sum() ** 2 / (h.sum() + 1):
            out[:cut], out[cut:] = _steps(g[:cut], h[:cut], depth - 1, least), _steps(g[cut:], h[cut:], depth - 1, least)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Cell values of the tree that cuts both sides of a table once, and what it explains."""
    cg, ch = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (g, h))

    def cells(c: np.ndarray) -> list[np.ndarray]:
        a, row, column, whole = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return [a, row - a, column - a, whole - row - column + a]

    gs, hs = cells(cg), cells(ch)
    gain = sum(x**2 / (y + 1) for x, y in zip(gs, hs, strict=True))
    if not gain.size:
        return np.zeros_like(g), 0.0
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [float(x[r, c] / (y[r, c] + 1)) for x, y in zip(gs, hs, strict=True)]
    out = np.empty_like(g)
    out[: r + 1, : c + 1], out[: r + 1, c + 1 :], out[r + 1 :, : c + 1], out[r + 1 :, c + 1 :] = value
    return out, float(gain[r, c])


def fit(x: np.ndarray, y: np.ndarray, most_bins: int = 48, rounds: int = 150, pair_rounds: int = 40, n_pairs: int = 8, rate: float = 0.15, least: float = 2.0) -> Model:
    """Fits the tables to features x and 0/1 labels y."""
    if not len(y):
        return Model([np.zeros(0)] * x.shape[1], 0.0)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, most_bins + 1)[1:-1])) for k in range(x.shape[1])]
    odds = (y.sum() + 0.5) / (len(y) - y.sum() + 0.5)
    model = Model(cuts, float(np.log(odds)), [np.zeros(len(c) + 1) for c in cuts])
    b, total = model.bins(x), np.full(len(y), model.base)
    for _ in range(rounds):
        for k, table in enumerate(model.single):
            p = 1 / (1 + np.exp(-total))
            g, h = (np.bincount(b[:, k], w, len(table)) for w in (y - p, p * (1 - p)))
            step = rate * _steps(g, h, 2, least)
            table += step
            total += step[b[:, k]]

    def sums(i: int, j: int) -> list[np.ndarray]:
        p, shape = 1 / (1 + np.exp(-total)), (len(cuts[i]) + 1, len(cuts[j]) + 1)
        return [np.bincount(b[:, i] * shape[1] + b[:, j], w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p))]

    every = [(i, j) for i in range(x.shape[1]) for j in range(i) if len(cuts[i]) and len(cuts[j])]
    chosen = sorted(every, key=lambda ij: -_cross(*sums(*ij))[1])[:n_pairs]
    model.pairs = [(i, j, np.zeros((len(cuts[i]) + 1, len(cuts[j]) + 1))) for i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _cross(*sums(i, j))[0]
            table += step
            total += step[b[:, i], b[:, j]]
    return model


def with_features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and an array of features per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                x = features(piece.column("text"))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), flat], ["doc_id", "x"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


def learn(known: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", bound: int = 20_000) -> Model:
    """Fits a model on at most `bound` labelled rows outside the held-out fifth, the ones with the least hash of the key.

    known: key and features x. The sample is what goes to the driver; its size does not depend on the input.
    """
    marks = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("y"))
    rows = known.join(marks, F.col("doc_id") == F.col("_key")).select("doc_id", "x", "y")
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(bound).select("x", "y").toArrow()
    y = sample["y"].to_numpy().astype(float)
    x = np.array(sample["x"].to_pylist(), float).reshape(len(y), len(FEATURES))
    return fit(x, (y > 0).astype(float))


def scored(known: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for rows that have features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    rows = known.mapInArrow(run, f"doc_id {known.schema['doc_id'].dataType.simpleString()}, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learns from the labelled documents and scores all: doc_id, held_out, score, predicted."""
    known = stored(with_features(docs, key, text))
    return scored(known, learn(known, labels, key=key))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents that score at least `threshold`, with all their columns; the model is learned as in `classify`."""
    model = learn(stored(with_features(docs.join(labels.select(key).distinct(), key, "left_semi"), key, text)), labels, key=key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield piece.filter(pa.array(model.score(features(piece.column(text))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
