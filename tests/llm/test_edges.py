"""Public parameters, keys and values beyond those of the registered queries."""

from __future__ import annotations

import gzip
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenorbook.llm import decontamination, language_id, mixing, ngram_join, substring_dedup, topk_search, warc
from tenorbook.ship import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.mark.parametrize("window", [1, 2, 8, 10, 15, 20, 34, 60])
def test_any_window_removes_all_repeats(spark, window):
    rng = random.Random(window)
    passage = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(window, 3 * window))] for _ in range(6)]
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 40))]
        for p in rng.sample(passage, rng.randint(0, 2)):
            words += p + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 20))]
        texts.append(words)
    seen = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    want = []
    for k, t in enumerate(texts):
        gone = {i + d for i in range(len(t) - window + 1) if seen[tuple(t[i : i + window])] > 1 for d in range(window)}
        want.append((k, len(t), len(gone)))
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = substring_dedup.dedupe(docs, window=window).select("doc_id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, found)) == want and sum(n for _, _, n in want) > 0


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.6, 0.7, 0.9])
def test_recall_at_the_threshold(spark, threshold):
    """Pairs just at the threshold, each with words of its own: all are found, and pairs just below are not."""
    rng = random.Random(int(100 * threshold))
    rows, near, far = [], 0, 0
    for k in range(300):
        n = 200
        shared = round(2 * n * threshold / (1 + threshold))  # shingles in common of n in each
        shared += 1 if k % 2 == 0 else -4
        base = [f"p{k}x{i}" for i in range(shared + 4)]
        tails = [[f"p{k}{side}{i}" for i in range(n - shared)] for side in "lr"]
        rows += [(2 * k, " ".join(base + tails[0])), (2 * k + 1, " ".join(base + tails[1]))]
        near += k % 2 == 0
        far += k % 2
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    linked = ngram_join.join(docs, threshold=threshold).filter("n_links > 0").select("doc_id").collect()
    found = {r.doc_id // 2 for r in linked}
    print(f"threshold {threshold}: {sum(k % 2 == 0 for k in found)} of {near} pairs found, {sum(k % 2 for k in found)} of {far} below it")
    assert found == {k for k in range(300) if k % 2 == 0}


def test_bands_follow_the_threshold():
    assert ngram_join.band_rows(0.8) == 4 and ngram_join.band_rows(0.5) == 2 and ngram_join.band_rows(0.3) == 1
    for refused in (0.05, 0.0, 1.5):
        with pytest.raises(ValueError, match="threshold"):
            ngram_join.band_rows(refused)


def test_a_language_without_ids_is_learned(spark):
    rng = random.Random(1)
    words = {"en": ["the", "and", "with", "of", "house"], "de": ["der", "und", "mit", "von", "haus"]}
    rows = [(None if x == "en" else k, " ".join(rng.choice(words[x]) for _ in range(12)), x) for x in words for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for per in (100, 1000):
        known = language_id.profiles(docs, per_language=per)
        assert set(known) == {"en", "de"}
        told = language_id.identify(docs, known)
        assert told.join(docs, ["doc_id"]).filter("lang_pred <> lang").count() == 0
        assert told.filter("doc_id IS NULL AND lang_pred <> 'en'").count() == 0


def test_items_under_one_id_are_listed_each(spark):
    import hashlib

    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "two three"), (7, "five six"), (8, "not there"), (None, "four")], "item_id long, text string")
    row = decontamination.contamination(docs, items).first()
    assert row.n_items == 3 and row.items_sha256 == hashlib.sha256(b"7,7").hexdigest()


@pytest.mark.parametrize("size", [1.0, 1e7, 1e9, 1e12, 1e160])
def test_top_k_of_large_components(spark, size):
    """Scores equal whole-number arithmetic up to 2**63 and stand at its ends beyond."""
    rng = random.Random(8)
    rows = [(k, [rng.choice([-1, 1]) * rng.random() * size for _ in range(4)], 1, 2.0) for k in range(400)] + [(1000, [size] * 4, 1, 2.0), (1001, [-size] * 4, 1, 2.0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rid int, score double").repartition(3)
    whole = [(k, [int(np.floor(x * 256.0)) for x in v]) for k, v, *_ in rows]
    end = 2**63 - 1
    want = []
    for q, v in whole:
        if q % 50 == 0:
            best = sorted((-max(-end, min(end, sum(a * b for a, b in zip(v, w, strict=True)))), k) for k, w in whole if k != q)[:5]
            want += [(q, n, k, -s) for n, (s, k) in enumerate(best, 1)]
    for shard, block in ((4096, 4096), (64, 4)):
        found = topk_search.top_k(frame, shard_rows=shard, query_rows=block).select("query_id", "rank", "vec_id", "score").collect()
        assert sorted(map(tuple, found)) == sorted(want)


def test_pages_with_unclosed_tags_are_read_in_one_scan():
    for piece in ("<!--", "<script>", "<title>", "<a ", "<script", "<p><!-- x"):
        begin = time.process_time()
        warc.parsed(piece * (2_000_000 // len(piece)))
        assert time.process_time() - begin < 5, piece
    page = warc.parsed("<title>T</title><p>a<script>hidden</script><!-- b --><style>c</STYLE >d<script>e <!-- f <b>g")
    # The last script and comment never end: their tags go, what follows stays.
    assert page.title == "T" and page.text == "T\na d e g"


def test_warc_of_text_keys_and_gzip_members(spark):
    pages = spark.createDataFrame([("a-1", "http://a/", "<p>one</p>", 5, "x"), (None, None, None, 6, "y"), ("a-1", "http://a/", "<p>one</p>", 5, "x")], "page_id string, url string, html string, key int, block string")
    records = warc.responses(pages)
    assert records.schema["key"].dataType.simpleString() == "string"
    derived = warc.derive(records)
    assert sorted(str(r.key) for r in derived.collect()) == ["None"] * 2 + ["a-1"] * 4
    raw = [bytes(r.warc) for r in warc.encode(derived).collect()]
    files = [b"".join(raw), b"".join(map(gzip.compress, raw)), gzip.compress(b"".join(raw)), b"".join(raw)[:-30], None, b""]
    texts = [Counter(bytes(r.block) for r in warc.decode(spark.createDataFrame([(f,)], "content binary")).collect()) for f in files]
    assert texts[0] == texts[1] == texts[2] == Counter(bytes(r.block) for r in derived.collect())
    assert sum(texts[3].values()) == 5 and not texts[4] and not texts[5]


def test_mix_agrees_with_itself_and_spreads_copies(spark):
    """Equal texts that differ in another column: two runs over other partitions choose the same rows. Many copies become rows lot by lot."""
    docs = spark.range(3001).selectExpr("cast(null as long) as doc_id", "'some text many times over' as text", "'s' as source", "id as other", "1 as taken", "2 as _id")
    runs = [Counter(map(tuple, mixing.chosen(docs.repartition(n)).collect())) for n in (2, 5)]
    assert runs[0] == runs[1] and len({r[-1] for r in runs[0]}) == 2
    assert mixing.chosen(docs).columns == [*docs.columns, "size", "mix_taken"]
    many = spark.range(20000).selectExpr("1L as doc_id", "'some text' as text", "'s' as source")
    found = mixing.mix(many)
    assert found.count() == 20000 and found.filter("taken NOT BETWEEN 0 AND 2 * size").count() == 0
    assert found.agg({"taken": "sum"}).first()[0] == pytest.approx(60000, abs=40)


def test_copies_of_a_head_meet_once(spark):
    """Thousands of equal rows without an id, and a near copy: links are right, and the block task gets one row of them per task of the join."""
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", f"'{text}' as text").unionByName(spark.createDataFrame([(1, text + " more")], "doc_id long, text string"))
    found = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(docs).select("doc_id", "class_id", "n_links").collect())
    assert found == {(None, 1, 3000): 3000, (1, 1, 3000): 1}
    assert [tuple(r) for r in ngram_join.keep_one(docs).collect()] == [(1, text + " more")]
    # The dedupe itself, on three batches of one task.
    values, offsets = ngram_join.shingles(pa.array([text]))
    one, two = (int(x[0]) for x in ngram_join._sums(values, offsets))
    raw = text.encode()
    packed = {"small": pa.Codec("zstd").compress(raw, asbytes=True), "size": len(raw), "h1": one, "h2": two}
    batch = pa.RecordBatch.from_pylist([dict.fromkeys(("group", "blocks", "cid", "copies"), 1) | packed] * 50)
    assert sum(b.num_rows for b in ngram_join._heavy(iter([batch] * 3))) == 1


def test_token_counts_remember_short_words_only():
    from tenorbook.llm import queries, token_counts

    counter = token_counts.Counter(token_counts.vocabulary(queries.VOCABULARY))
    long = "ab" * 5000
    assert counter.text(f"one two {long} one") == counter.text("one two one") + counter.word(token_counts.MARK + long)
    assert set(counter.memory) == {"one", "two"}
    token_counts.REMEMBERED, kept = 3, token_counts.REMEMBERED
    try:
        counter.text(" ".join(f"w{k}" for k in range(50)))
        assert len(counter.memory) <= 3
    finally:
        token_counts.REMEMBERED = kept


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tenorbook.llm.common import shared_folder
    from tenorbook.sources import scratch

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    for folder in (shared_folder, scratch.shared_folder):
        with pytest.raises(ValueError, match="checkpoint"):
            folder(session)


def test_top_k_drops_far_shards_before_the_shuffle(spark):
    """In clustered vectors most pairs of query and shard are closed by the shard's box; a group of equal vectors is still cut to size."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 8))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    points = np.floor(256 * (centres[rng.integers(0, 30, 3000)] + rng.normal(scale=0.02, size=(3000, 8))))
    points[:1000] = points[0]
    frame = spark.createDataFrame([(k, p.tolist(), 8) for k, p in enumerate(points)], "rid long, v array<double>, dim int").repartition(4)
    rows = topk_search.sharded(frame, 64, 1024).withColumn("asks", F.col("rid") % 50 == 0).withColumn("id", F.col("rid"))
    rows = rows.cache()
    sizes = [r["count"] for r in rows.groupBy("shard").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 128
    boxes = rows.groupBy("shard", "dim").agg(*[F.array(*[f(F.col("v")[k]) for k in range(8)]).alias(n) for n, f in (("low", F.min), ("high", F.max))])
    best = {k: sorted(((points @ points[k])[np.arange(3000) != k]).tolist())[-5] for k in range(0, 3000, 50)}
    asked = rows.filter("asks").join(spark.createDataFrame([(k, int(v)) for k, v in best.items()], "rid long, floor long"), "rid").withColumnRenamed("shard", "home")
    pairs = {(r.rid, r.shard) for r in topk_search.open_pairs(asked, boxes, 16).collect()}
    assert len(pairs) < 0.4 * len(best) * len(sizes)
    where = {r.rid: r.shard for r in rows.select("rid", "shard").collect()}
    for k, floor in best.items():
        for other in np.flatnonzero(points @ points[k] >= floor).tolist():
            assert where[other] == where[k] or (k, where[other]) in pairs
    print(f"open pairs: {len(pairs)} of {len(best) * len(sizes)}")
    rows.unpersist()
