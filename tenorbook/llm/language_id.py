"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent n-grams, in order. A document's own list is compared with each profile by
out-of-place distance: the sum, over the document's n-grams, of how far each stands from its place in the profile, or the
length of a profile if it is not there. The nearest language wins, ties go to the smaller name.

N-grams are 1 to 3 bytes of the lower-cased UTF-8 text. Everything in ASCII but letters is one kind of space; bytes beyond ASCII count as
letters, also those of punctuation and emoji, and a character of three bytes is one n-gram of three;
an n-gram holds no space but at its ends. All n-grams of the whole text count. Profiles are learned from
a seeded random sample of about `per_language` documents of each language (a parameter; all, if there are fewer). The
same files give the same sample.

A text that is null or has no letter is `und` with score 0; the score of others is how much nearer the nearest
profile is than the next one, between 0 and 1. Without anything to learn from all are `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenorbook.llm.common import flat, held_out, pieces, stored

_SPACE = 0x20
_KEPT = np.full(256, _SPACE, np.uint8)
_KEPT[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEPT[0x80:] = np.arange(0x80, 0x100)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count) of all n-grams of up to 4096 texts, ordered by text and n-gram."""
    data, offsets = flat(pa.array([f" {t.lower()}  " for t in texts], pa.large_string()))
    data = _KEPT[data].astype(np.uint64)
    of = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(offsets)) << np.uint64(24)
    a, b, c = data[:-2], data[1:-1], data[2:]
    space = np.uint64(_SPACE)
    whole = of[:-2] == of[2:]
    eight, sixteen = np.uint64(8), np.uint64(16)
    pair, triple = (a << eight) | b, (a << sixteen) | (b << eight) | c
    keys = np.concatenate(
        [
            (of[:-2] | a)[whole & (a != space)],
            (of[:-2] | pair)[whole & ((a != space) | (b != space))],
            (of[:-2] | triple)[whole & (b != space)],
        ]
    )
    keys.sort()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    counts = np.diff(np.r_[starts, len(keys)])
    keys = keys[starts]
    return (keys >> np.uint64(24)).astype(np.int64), keys & np.uint64(0xFFFFFF), counts


def _ranked(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, rank, n-gram) of each text's most frequent n-grams; equal counts in order of the bytes."""
    of, gram, count = _codes(texts)
    least = np.uint64((1 << 28) - 1) - np.minimum(count, (1 << 28) - 1).astype(np.uint64)
    keys = np.sort((of.astype(np.uint64) << np.uint64(52)) | (least << np.uint64(24)) | gram)
    of = (keys >> np.uint64(52)).astype(np.int64)
    begin = np.searchsorted(of, np.arange(len(texts)))
    rank = np.arange(len(keys)) - begin[of]
    top = rank < length
    return of[top], rank[top], (keys & np.uint64(0xFFFFFF))[top]


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in pieces(batch, "text", 1 << 20):
        for begin in range(0, part.num_rows, 4096):
            yield part.slice(begin, 4096)


def profiles(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", length: int = 300, per_language: int = 3000) -> dict[str, list[int]]:
    """The most frequent n-grams of each language, best first, from rows outside the held-out fifth."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key)).select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = stored(known.groupBy("lang").agg((per_language / F.count(F.lit(1)) * (1 << 30)).alias("below")))
    # Drawn row by row, not by id: rows of one id or text are neither all in nor all out, so no language is lost and the sample stays bounded.
    drawn = known.withColumn("draw", F.rand(7) * (1 << 30))
    sample = drawn.join(sizes, "lang").filter(F.col("draw") < F.col("below")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _cut(batch):
                langs = part.column("lang").to_pylist()
                names = sorted(set(langs))
                of, gram, count = _codes(part.column("text").to_pylist())
                place = np.array([names.index(x) for x in langs], np.int64)[of]
                keys, back = np.unique((place << 24) | gram.astype(np.int64), return_inverse=True)
                totals = np.bincount(back, count, len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[x] for x in (keys >> 24).tolist()], pa.string()), pa.array(keys & 0xFFFFFF), pa.array(totals)], ["lang", "gram", "n"]
                )

    counts = sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).filter(F.col("place") <= length)
    rows = best.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "gram"))), lambda x: x["gram"]).alias("grams")).collect()
    return {r["lang"]: r["grams"] for r in sorted(rows)}


def identify(docs: DataFrame, known: dict[str, list[int]], key: str = "doc_id", text: str = "text", length: int = 300) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    names = list(known)
    tables = []
    for grams in known.values():
        codes = np.array(grams, np.uint64)
        order = np.argsort(codes)
        tables.append((codes[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _cut(batch):
                texts = part.column("text").to_pylist()
                lettered = np.array([_has_letter(t) for t in texts], bool)
                of, rank, gram = _ranked([t or "" for t in texts], length)
                far = np.zeros((len(names), len(texts)))
                for k, (codes, places) in enumerate(tables):
                    at = np.minimum(np.searchsorted(codes, gram), len(codes) - 1)
                    gap = np.where(codes[at] == gram, np.abs(places[at] - rank), length)
                    far[k] = np.bincount(of, gap, len(texts))
                if names:
                    best = far.argmin(0)
                    ordered = np.sort(far, 0)
                    nearest, most = ordered[0], np.maximum(np.bincount(of, minlength=len(texts)) * length, 1)
                    other = ordered[1] if len(names) > 1 else most
                    score = np.clip((other - nearest) / np.maximum(other, 1), 0, 1)
                found = [names[best[x]] if names and ok else "und" for x, ok in enumerate(lettered)]
                scores = np.where(lettered, score, 0.0) if names else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    told = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
