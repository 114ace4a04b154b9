"""The stages in a row over odd documents, each against brute force on what the one before it kept."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from tenorbook.ship import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, taken string, _id long, label string"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Null, repeated and clashing: ids, texts, columns. No labels, so that the quality stage keeps all."""
    ship(spark)
    base = tmp_path_factory.mktemp("odd")
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, item = prose(60), prose(20)
    near = prose(150).split()
    texts = [None, "", " \n", "one", *[prose(80) for _ in range(12)], *[f"{prose(30)} {passage} {prose(30)}" for _ in range(4)]]
    texts += [f"{prose(60)} {item} {prose(40)}", f"{prose(900)} {item.upper()}", item]  # a fifth, a fiftieth and all of it
    for _ in range(6):
        copy = list(near)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [texts[6]] * 4
    rows = [(k if k % 4 else None, t, "en", f"s{k % 3}" if k % 5 else None, 7, 1, "t", 3, "l") for k, t in enumerate(texts)]
    rows += [(5, prose(70), "en", "s1", 7, 1, "t", 3, "l"), (5, prose(70), None, "s1", 7, 1, "t", 3, "m"), rows[9], rows[9]]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "nowhere to be found")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return str(base)


def one_of_each(rows, hashes):
    words = [re.findall(WORD, r[1] or "") for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root = [root[a] if x == root[b] else x for x in root]
    groups: dict = {}
    for k, r in enumerate(rows):
        groups.setdefault(root[k] if sets[k] else ("alone", k), []).append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]], str(r))) for g in groups.values()]


def without_passages(rows, window=35):
    words = [re.findall(WORD, r[1] or "") for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = {i + d for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for d in range(window)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r[1]
        out.append((r[0], text, *r[2:4], None if text is None else len(text), *r[5:]))
    return out


def clean(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
    windows = set()
    for item in map(split, items):
        size = min(13, len(item))
        windows |= {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
    out = []
    for r in rows:
        w = split(r[1])
        hit = {i + d for size in {len(x) for x in windows} for i in range(len(w) - size + 1) if tuple(w[i : i + size]) in windows for d in range(size)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def test_every_stage_on_what_the_one_before_it_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = [tuple(r) for r in docs.collect()]
    steps = [lambda x: x, lambda x: one_of_each(x, hashes), without_passages, lambda x: clean(x, items)]
    for (name, stage), step in zip(pipeline.STAGES, steps, strict=False):
        before, want = want, step(want)
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert Counter(map(tuple, out.collect())) == Counter(want), name
        assert name == "quality" or before != want
        docs = spark.createDataFrame(want, docs.schema)
    mixed = pipeline.mixed(spark, docs, folder)
    assert mixed.columns == [*docs.columns, "mix_size", "mix_taken"]
    rows = [tuple(r) for r in mixed.collect()]
    assert all(0 < r[-1] <= 2 * r[-2] and r[-2] == len(re.findall(WORD, r[1])) for r in rows)
    assert not Counter(r[:-2] for r in rows) - Counter(want)


def test_run_over_odd_and_empty_tables(spark, folder, tmp_path):
    assert pipeline.run(spark, folder).count() > 5
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
