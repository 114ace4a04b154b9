"""Similarity join on word n-grams: Jaccard similarity of at least a threshold, with Bayesian pruning of candidates.

Texts are sets of five-word shingles (a shorter text is one shingle). Texts with equal sets are one class and are handled once,
however many copies there are. Candidates: classes that share a band of MinHash values are linked to the least class
of that band, and connected classes form a candidate group; these are links by the number of rows, never pairs.

Within a group, blocks of bounded size meet in pairs. For each pair of texts the MinHash values are compared `step` at a time;
with m of n equal, the similarity has a Beta(m + 1, n - m + 1) posterior, and the pair is dropped as soon as
its probability of reaching the threshold is below `tolerance`. What is left is verified exactly on the shingles.
A block pair returns each text's number of links and a forest of its links, again linear in the block.
Bands follow the threshold: as few values in each as keep a pair at the threshold from being missed by all bands with a probability
above 1e-5 (at 0.8: 24 bands of 4, 3e-6). A threshold too low for that is refused.

Result: one row per document: doc_id, class_id (the least doc_id linked to it, directly or through others) and n_links, the
number of other documents at or above the threshold, copies included. A text without words, or null, has no shingle:
it is linked to nothing and is its own class. Ids may be null or repeated; equal rows are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorbook.llm.common import Rolling, Words, mixed, pieces, stored
from tenorbook.llm.graph import components
from tenorbook.llm.repeats import packed, unpacked

HASHES = 96
#: A pair at the threshold shares no band with at most this probability.
MISSED = 1e-5
_MULTIPLIERS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts as 64-bit values, ordered within each text, and where each text begins."""
    words = Words(texts)
    n = words.counts
    rolling = Rolling(words.hashes(), 0x9E6C63D0876A9A63)
    starts = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    offset = np.r_[0, np.cumsum(starts)]
    of = np.repeat(np.arange(len(n)), starts)
    begin = words.upto[:-1][of] + np.arange(offset[-1]) - offset[:-1][of]
    values = rolling.of(begin, np.minimum(begin + size, words.upto[1:][of]))
    order = np.lexsort((values, of)) if len(values) else np.zeros(0, int)
    values, of = values[order], of[order]
    fresh = np.r_[True, (values[1:] != values[:-1]) | (of[1:] != of[:-1])] if len(values) else np.zeros(0, bool)
    values, of = values[fresh], of[fresh]
    return values, np.searchsorted(of, np.arange(len(n) + 1))


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values, a row per text; texts without shingles have zeros."""
    out = np.zeros((len(offsets) - 1, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        for k, by in enumerate(_MULTIPLIERS):
            out[some, k] = np.minimum.reduceat(((values * by) >> np.uint64(32)).astype(np.uint32), offsets[some])
    return out


def _sums(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """A 128-bit name of each set: two sums of independently mixed members."""
    out = []
    for by in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mixed(values ^ np.uint64(by)), out=total[1:])
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out


def band_rows(threshold: float) -> int:
    """MinHash values per band: the most, as more mean fewer candidates, that miss a pair at the threshold at most by MISSED."""
    fine = [r for r in range(1, HASHES + 1) if HASHES % r == 0 and (1 - threshold**r) ** (HASHES // r) <= MISSED]
    if not 0 < threshold <= 1 or not fine:
        raise ValueError(f"threshold {threshold} needs more than {HASHES} MinHash values for a recall of {1 - MISSED}")
    return max(fine)


def _bands(signature: np.ndarray, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), HASHES // rows), np.uint64)
    for k in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, k::rows].astype(np.uint64) + np.arange(HASHES // rows, dtype=np.uint64))
    return keys.view(np.int64)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.ravel()))


def _sketch(rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            values, offsets = shingles(piece.column("text"))
            one, two = _sums(values, offsets)
            keys = _lists(_bands(signatures(values, offsets), rows))
            columns = [piece.column("doc_id"), piece.column("text_hash"), pa.array(one), pa.array(two), pa.array(np.diff(offsets)), keys]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "h1", "h2", "n", "bands"])


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with their signatures and shingles, each once per task; rows whose text is not the member's are left out.

    All rows of one id and text come to one task, or to a few where Spark splits them, so that copies of a head go no further.
    """
    seen: set[int] = set()
    for batch in batches:
        for piece, texts in unpacked(batch):
            values, offsets = shingles(texts)
            one, two = _sums(values, offsets)
            signature = signatures(values, offsets)
            keep = np.flatnonzero((one == piece.column("h1").to_numpy()) & (two == piece.column("h2").to_numpy()))
            cids = piece.column("cid").to_numpy()[keep]
            fresh = np.zeros(len(keep), bool)
            fresh[np.unique(cids, return_index=True)[1]] = True
            keep, cids = keep[fresh], cids[fresh]
            keep = keep[[c not in seen for c in cids.tolist()]] if len(keep) else keep
            seen.update(cids.tolist())
            if len(keep):
                raw = pa.array([signature[k].tobytes() for k in keep], pa.binary()), pa.array([values[offsets[k] : offsets[k + 1]].tobytes() for k in keep], pa.binary())
                names = ["group", "blocks", "cid", "copies"]
                yield pa.RecordBatch.from_arrays([*[piece.column(c).take(pa.array(keep)) for c in names], *raw], [*names, "signature", "shingles"])


@cache
def fewest_equal(compared: int, threshold: float, tolerance: float) -> int:
    """The least number of equal values among `compared` for which the posterior still allows the threshold."""
    grid = (np.arange(4000) + 0.5) / 4000
    for m in range(compared + 1):
        density = np.exp(lgamma(compared + 2) - lgamma(m + 1) - lgamma(compared - m + 1) + m * np.log(grid) + (compared - m) * np.log1p(-grid))
        if density[grid >= threshold].sum() / 4000 >= tolerance:
            return m
    return compared + 1


def similar(left: tuple, right: tuple | None, threshold: float, tolerance: float, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs at or above the threshold between two blocks of (signatures, sets), or within one block."""
    (a, sets), (b, others) = left, right or left
    equal = np.zeros((len(a), len(b)), np.int16)
    for begin in range(0, HASHES, step):
        if not begin:
            for k in range(step):
                equal += a[:, k, None] == b[None, :, k]
            i, j = np.nonzero(equal >= fewest_equal(step, threshold, tolerance))
            if right is None:
                i, j = i[i < j], j[i < j]
            met = equal[i, j].astype(np.int64)
            continue
        met = met + (a[i, begin : begin + step] == b[j, begin : begin + step]).sum(1)
        alive = met >= fewest_equal(begin + step, threshold, tolerance)
        i, j, met = i[alive], j[alive], met[alive]
    sizes, sizes_b = np.array([len(s) for s in sets]), np.array([len(s) for s in others])
    if len(i) < 1000:
        common = np.array([len(np.intersect1d(sets[x], others[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    else:
        common = _common(sets, others)[i, j]
    fits = common >= threshold * (sizes[i] + sizes_b[j] - common) - 1e-9
    return i[fits], j[fits]


def _common(sets: list[np.ndarray], others: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two blocks, as products of membership matrices, some columns at a time."""
    every, column = np.unique(np.concatenate([*sets, *others]), return_inverse=True)
    row = np.repeat(np.arange(len(sets) + len(others)), [len(s) for s in [*sets, *others]])
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(sets), len(others)), np.float32)
    for begin in range(0, len(every), width):
        part = slice(*np.searchsorted(column, [begin, begin + width]))
        member = np.zeros((len(sets) + len(others), width), np.float32)
        member[row[part], column[part] - begin] = 1
        out += member[: len(sets)] @ member[len(sets) :].T
    return np.rint(out).astype(np.int64)


def join(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, tolerance: float = 1e-7, block_shingles: int = 200_000, block_rows: int = 1024
) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id, head_hash and n_links.

    class_id and head_hash are the id and the text's hash of the head of the class, the least of both, null ids last. Unlike ids,
    which may be null or repeated, both together tell classes apart. Without words there is no head_hash.

    A block holds about `block_shingles` shingles or `block_rows` texts, whichever is fewer: short texts by the thousand would
    otherwise meet in one table of all their pairs.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketch = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        partial(_sketch, band_rows(threshold)), f"doc_id {kind}, text_hash long, h1 long, h2 long, n long, bands array<long>"
    )
    sketch = stored(sketch)
    classes = sketch.filter("n > 0").groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("head"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()))
    shared = classes.select("cid", F.explode("bands").alias("band"))
    firsts = stored(shared.groupBy("band").agg(F.min("cid").alias("first"), F.max("cid").alias("last")).filter("first < last").select("band", "first"))
    met = shared.join(firsts, "band").groupBy("cid").agg(F.min("first").alias("least"), F.collect_set("first").alias("firsts"))
    met = stored(met)  # a class is linked to the least of its bands' classes; the others, few and shared, to that one
    among = met.select(F.explode("firsts").alias("a"), F.col("least").alias("b")).distinct()
    groups = components(met.select(F.col("cid").alias("a"), F.col("least").alias("b")).unionByName(among))

    members = groups.join(classes.drop("bands"), F.col("node") == F.col("cid")).select("cid", "copies", "head", "h1", "h2", "n", F.col("label").alias("group"))
    members = stored(members)
    needed = F.ceil(F.greatest(F.sum("n") / block_shingles, F.count(F.lit(1)) / block_rows))
    blocks = stored(members.groupBy("group").agg(needed.cast("int").alias("blocks")))
    members = stored(members.join(blocks, "group"))
    # a merge join at every size, as the members grow with the corpus; texts are compressed for its shuffle
    keyed = packed(rows.withColumn("text_hash", F.xxhash64("text")))
    same = keyed["doc_id"].eqNullSafe(members["head.doc_id"]) & (keyed["text_hash"] == members["head.text_hash"])
    heavy = keyed.hint("merge").join(members, same).drop("head").mapInArrow(
        _heavy, "group long, blocks int, cid long, copies long, signature binary, shingles binary"
    )
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = heavy.withColumn("own", own).withColumn("other", other).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        cid, copies, block = (table[c].to_numpy() for c in ("cid", "copies", "own"))
        fresh = np.r_[True, cid[1:] != cid[:-1]]
        signature = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in table["signature"]])
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        sides = [np.flatnonzero(fresh & (block == b)) for b in dict.fromkeys((low, high))]
        parts = [(signature[s], [sets[x] for x in s]) for s in sides]
        if not all(map(len, sides)):
            return pa.table({c: pa.array([], pa.int64()) for c in ("cid", "other", "links")})
        i, j = similar(parts[0], parts[1] if len(parts) > 1 else None, threshold, tolerance)
        i, j = sides[0][i], sides[-1][j]
        links = np.bincount(i, copies[j], len(cid)) + np.bincount(j, copies[i], len(cid))
        root = list(range(len(cid)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        tree = []
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            if (p := find(x)) != (q := find(y)):
                root[p] = q
                tree.append((x, y))
        linked = np.flatnonzero(links)
        ends = np.array(tree, int).reshape(-1, 2)
        return pa.table(
            {
                "cid": np.r_[cid[linked], cid[ends[:, 0]]],
                "other": pa.array(np.r_[np.zeros(len(linked), np.int64), cid[ends[:, 1]]], mask=np.r_[np.ones(len(linked), bool), np.zeros(len(ends), bool)]),
                "links": np.r_[links[linked].astype(np.int64), np.zeros(len(ends), np.int64)],
            }
        )

    links = stored(dealt.groupBy("group", "low", "high").applyInArrow(meet, "cid long, other long, links long"))
    joined = components(links.filter("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select("cid", "h1", "h2", "copies", "head").join(joined, F.col("cid") == F.col("node"), "left").join(counts, "cid", "left")
    known = known.select("h1", "h2", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "cid").alias("label"))
    known = stored(known)
    heads = stored(known.groupBy("label").agg(F.min("head").alias("head")))
    known = known.drop("head").join(heads, "label").select("h1", "h2", F.col("head.doc_id").alias("class_id"), F.col("head.text_hash").alias("head_hash"), "n_links")
    known = stored(known)
    out = sketch.filter("n > 0").select("doc_id", "text_hash", "h1", "h2").join(known, ["h1", "h2"]).select("doc_id", "text_hash", "class_id", "head_hash", "n_links")
    alone = sketch.filter("n = 0").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(None).cast("long").alias("head_hash"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One document of each class with all columns: its head, the least id (null last) and then the least text hash; texts without words all stay.

    Of rows with the head's id and text the one whose columns come first as JSON stays.
    """
    classes = stored(join(docs, key, text, threshold).filter("head_hash is not null"))
    is_head = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("head_hash"))
    keys = F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    gone = stored(classes.filter(~is_head).select(*keys))
    twice = stored(classes.filter(is_head).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys))

    def named(rows: DataFrame, keys: DataFrame) -> Column:
        return rows[key].eqNullSafe(keys["_id"]) & (F.xxhash64(rows[text]) == keys["_hash"])

    # merged at every size, as the rows to drop grow with the corpus
    left = docs.hint("merge").join(gone, named(docs, gone), "left_anti")
    if twice.isEmpty():
        return left
    repeated, single = left.join(twice, named(left, twice), "left_semi"), left.join(twice, named(left, twice), "left_anti")
    row = F.struct(*[F.col(c) for c in docs.columns])
    first = repeated.groupBy(F.col(key).alias("_id"), F.col(text).alias("_text")).agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return single.unionByName(first.select("_row.*"))
