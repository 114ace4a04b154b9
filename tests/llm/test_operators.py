"""Each operator against brute force, held-out accuracy or a round trip, with odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry_module
from compare import connect, duck_result, spark_result
from tenorbook.llm import decontamination, language_id, mixing, ngram_join, quality, queries, repeats, substring_dedup, suffix_dedup, token_counts, topk_search, warc
from tenorbook.ship import ship

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, size int, _id long, ranges string, label string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, null ids, repeated rows, one long text, ties, clashing extra columns; copies and near copies."""
    ship(spark)
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)] + ["é", "日本", "x y"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, base = prose(60), prose(120).split()
    texts = [None, "", " \t\n ", "a", "one two three four", "na " * 300, "Is onhe. " * 150, prose(20000), shared, *[prose(50) + " " + shared + " " + prose(40) for _ in range(6)]]
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(120)] = rng.choice(words)
        texts.append(" ".join(near))
    texts += [texts[10]] * 3 + [prose(200) for _ in range(10)]
    rows = [(k if k % 9 else None, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, 1, 2, "r", "l") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[5:8], SCHEMA).repartition(3)


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def repeated(sequences, size):
    seen = Counter(tuple(s[i : i + size]) for s in sequences for i in range(len(s) - size + 1))
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - size + 1):
            if seen[tuple(s[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        yield gone


def test_mix(odd):
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count() and found and sorted(map(str, found)) == sorted(map(str, mixing.mix(odd).collect()))
    by = defaultdict(list)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source].append(r)
    sizes = {s: sum(r.size for r in g) for s, g in by.items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, left, open_, target = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in full} if full else share
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    for s, g in by.items():
        assert g[0].target == pytest.approx(target[s]) and g[0].source_size == sizes[s]
        assert sum(r.taken for r in g) == pytest.approx(target[s], abs=40)


def test_mix_of_rows_without_ids_keeps_each_source(spark):
    """Null ids, equal sizes, copies: every source gives the words that mix() takes from it; copies differ by a word at most."""
    rng = random.Random(11)
    rows = [(None, " ".join(rng.choice("abcdef") for _ in range(20)), f"s{k % 3}", 5) for k in range(300)]
    rows += [(None, "some text many times over and over again", f"s{k % 2}", 5) for k in range(150)] + [(None, None, "s0", 5)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    want, got, copies = Counter(), Counter(), defaultdict(list)
    for r in mixing.mix(docs, shard_words=1000).collect():
        want[r.source] += r.taken
    kept = mixing.chosen(docs, shard_words=1000)
    assert kept.columns == [*docs.columns, "mix_size", "taken"]
    for _, text, source, _, size, taken in map(tuple, kept.collect()):
        assert size == len(text.split()) and 0 < taken <= 2 * size
        got[source] += taken
        copies[source, text].append(taken)
    assert got == +want and len(want) == 3
    assert all(max(c) - min(c) <= 1 for c in copies.values()) and any(max(c) > min(c) for c in copies.values())


def test_apportion_is_highest_quotients(spark):
    votes = {1: 53.0, 2: 24.0, 3: 23.0, 4: 0.0, 5: 24.0}
    seats = Counter(p for _, p in sorted(((-v / (2 * k + 1), p) for p, v in votes.items() for k in range(50) if v))[:37])
    parties = spark.createDataFrame([(p, v, 37) for p, v in votes.items()], "p int, v double, s long")
    assert dict(mixing.apportion(parties, [], ["p"], "v", "s", "got").select("p", "got").collect()) == {p: seats[p] for p in votes}


def test_suffix_dedup(odd):
    texts = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    want = []
    for (key, raw), gone in zip(texts, repeated([t for _, t in texts], 400), strict=True):
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        want.append((key, len(raw), sum(gone), sum(g and not p for p, g in zip([False, *gone], gone, strict=False)), hashlib.sha256(kept).hexdigest()))
    assert rows_of(suffix_dedup.dedupe(odd), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)


def test_texts_without_ids_keep_their_own_ranges(spark):
    """Two texts without an id whose hashes agree in 23 bits: only one of them has the passage of a third."""
    ship(spark)
    passage = " ".join(f"passageword{i}" for i in range(40))
    pool = [(None, f"a{k} {passage}", True) for k in range(8192)] + [(None, " ".join(f"b{k}x{i}" for i in range(60)), False) for k in range(8192)]
    frame = spark.createDataFrame(pool, "doc_id long, text string, dirty boolean").selectExpr("text", "dirty", "xxhash64(text) & 8388607 as h")
    by = {r.h: r.text for r in frame.filter("dirty").collect()}
    pairs = [(by[r.h], r.text) for r in frame.filter("not dirty").collect() if r.h in by]
    docs = spark.createDataFrame([(None, pairs[0][0]), (None, pairs[0][1]), (1, passage)], "doc_id long, text string")
    found = {tuple(r) for r in substring_dedup.dedupe(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert found == {(None, 41, 40), (None, 60, 0), (1, 40, 40)}
    dirty, clean = (len(t) for t in pairs[0])
    found = {tuple(r) for r in suffix_dedup.dedupe(docs).select("doc_id", "n_bytes", "n_removed").collect()}
    assert found == {(None, dirty, len(passage)), (None, clean, 0), (1, len(passage), len(passage))}


def test_ranges_of_copies_are_listed_once(spark):
    ship(spark)
    rows = repeats.keyed(spark.createDataFrame([(None, "a b c")] * 5, "doc_id long, text string"), "doc_id", "text")
    lists = repeats.with_ranges(rows, rows.selectExpr("doc_id", "text_hash", "0L as lo", "1L as hi", "true as asks"), "left").collect()
    assert [len(r.ranges) for r in lists] == [1] * 5


def test_deep_shallow_order():
    import numpy as np

    data = np.frombuffer(b"abracadabra" * 30 + b"abra" + b"z" * 80 + b"abracadabra" * 8, np.uint8)
    starts = np.arange(len(data) - 40)
    classes = list(suffix_dedup.ordered_classes(data, starts, 40))
    keys = [data[c[0] : c[0] + 40].tobytes() for c in classes]
    assert keys == sorted(set(keys)) and sum(map(len, classes)) == len(starts)
    assert all(data[x : x + 40].tobytes() == k for k, c in zip(keys, classes, strict=True) for x in c)


def test_substring_dedup(odd):
    texts = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in odd.collect()]
    want = []
    for (key, words), gone in zip(texts, repeated([w for _, w in texts], 35), strict=True):
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want.append((key, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert rows_of(substring_dedup.dedupe(odd), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=str)
    assert substring_dedup.without_repeats(odd).columns == odd.columns and substring_dedup.without_repeats(odd).count() == odd.count()


def test_token_counts_equal_the_tokenizer(odd):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.vocabulary(queries.VOCABULARY)
    reference = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    reference.pre_tokenizer = pre_tokenizers.Metaspace()
    rng, counter = random.Random(3), token_counts.Counter(pieces)
    for text in ["", " ", "a  b", "▁x▁ y", "日本語🎉🎉", "<s></s>", *["".join(rng.choice("abthe é▁\n🎉𓀀") for _ in range(40)) for _ in range(500)]]:
        assert counter.text(text) == len(reference.encode(text, add_special_tokens=False).ids), text
    want = [(r.doc_id, len(reference.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()]
    assert rows_of(token_counts.count_tokens(odd, pieces), "doc_id", "n_tokens") == sorted(want, key=str)


@pytest.mark.parametrize("block_rows", [1024, 4])
def test_ngram_join(odd, block_rows):
    rows = odd.collect()
    sets = []
    for r in rows:
        w = (r.text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        least.setdefault(find(k), []).append(r.doc_id)
    want = [(r.doc_id, min((d for d in least[find(k)] if d is not None), default=None), links[k]) for k, r in enumerate(rows)]
    assert rows_of(ngram_join.join(odd, block_rows=block_rows), "doc_id", "class_id", "n_links") == sorted(want, key=str)
    assert max(links.values()) > 3


def test_keep_one_of_each_class(odd):
    """Null and repeated ids: classes found by brute force, of each the head, of equal rows one."""
    other = odd.sparkSession.createDataFrame([(3, "five quite other words here", None, "s9", 1, 2, "r", "l"), (3, "some words of no other text", None, "s9", 1, 2, "r", "l")], SCHEMA)
    docs = odd.unionByName(other)
    rows = docs.collect()
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (r.text or "").split()) else set() for r in rows]
    root = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            root = [root[a] if x == root[b] else x for x in root]
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) as h").collect()}
    want = [tuple(r) for k, r in enumerate(rows) if not sets[k]]
    for label in {root[k] for k in range(len(rows)) if sets[k]}:
        want.append(min((tuple(r) for k, r in enumerate(rows) if root[k] == label), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]], str(r))))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and rows_of(kept, *docs.columns) == sorted(want, key=str)
    assert sum(r[0] is None and bool((r[1] or "").split()) for r in want) > 1 and sum(r[0] == 3 for r in want) > 2


def test_pruning_never_drops_what_may_reach_the_threshold():
    assert ngram_join.fewest_equal(16, 0.8, 1e-7) <= 6 and ngram_join.fewest_equal(96, 0.8, 1e-7) >= 45


def test_language_and_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    told = language_id.identify(docs, language_id.profiles(docs)).filter("held_out").join(docs, "doc_id")
    assert told.filter("lang = lang_pred").count() >= 0.98 * told.count()
    rated = quality.classify(docs, labels).filter("held_out").join(labels, "doc_id")
    assert rated.filter("quality = predicted").count() >= 0.93 * rated.count()
    assert rated.filter("quality = 1 and predicted = 0").count() <= 0.03 * rated.filter("quality = 1").count()


def test_language_and_quality_of_odd_rows(spark, odd):
    told = language_id.identify(odd, language_id.profiles(odd)).collect()
    assert len(told) == odd.count() and all(0 <= r.score <= 1 for r in told) and {"und", "en"} == {r.lang_pred for r in told}
    labels = odd.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    rated = quality.classify(odd, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rated)
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_warc_round_trip(spark):
    ship(spark)
    page = "<html lang='en'><title>A &amp; B</title><script>x<y</script><p>One<br>two&nbsp;three <a href='/n'>next</a><!-- no --></p>"
    pages = spark.createDataFrame([(1, "http://a/", page), (2, None, None), (None, "http://b/", "")], "page_id long, url string, html string")
    records = warc.responses(pages)
    derived = warc.derive(records)
    both = records.unionByName(derived)
    back = warc.decode(warc.encode(both), "warc")
    fields = ["record_type", "record_id", "coalesce(target_uri, '')", "coalesce(refers_to, '')", "content_type", "block", "block_digest", "content_length"]
    plain = lambda f: sorted(str(tuple(r)) for r in f.selectExpr(*fields).collect())
    assert plain(back) == plain(both) and derived.count() == 6
    text = derived.filter("key = 1 and record_type = 'conversion'").first()
    source = records.filter("key = 1").first()
    assert bytes(text.block).decode() == "A & B\nOne\ntwo three next" and text.refers_to == source.record_id and text.target_uri == "http://a/"
    meta = bytes(derived.filter("key = 1 and record_type = 'metadata'").first().block).decode()
    assert source.payload_digest in meta and "outlink: /n" in meta and "source-content-type: text/html" in meta


def test_top_k(spark):
    ship(spark)
    rng = random.Random(5)
    vectors = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(700)]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(k + 700, vectors[3]) for k in range(300)] + [(50, vectors[50]), (None, vectors[9]), (2000, None), (2050, [1.0, None] * 3), (2100, [float("nan")] * 6), (2150, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    whole = [(k, [int(256 * x // 1) for x in v]) for k, v in rows if v and all(x is not None and x == x for x in v)]
    want = []
    for i, (q, v) in enumerate(whole):
        if q is not None and q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), k is None, k or 0) for j, (k, w) in enumerate(whole) if j != i)[:5]
            want += [(q, n, None if none else k, -s) for n, (s, none, k) in enumerate(best, 1)]
    for shard, block in ((4096, 4096), (64, 8)):
        assert rows_of(topk_search.top_k(frame, shard_rows=shard, query_rows=block), "query_id", "rank", "vec_id", "score") == sorted(want, key=str)


def test_decontamination(spark, odd):
    taken = [r.text for r in odd.filter("text is not null and length(text) > 200").collect()]
    items = [(1, " ".join(taken[0].split()[5:30]).upper()), (2, "One TWO three"), (3, None), (4, ""), (None, "four"), (5, "na na na"), (1, "na " * 20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
    want = []
    for r in odd.collect():
        words, hit, found = low(r.text), set(), []
        for name, text in items:
            item = low(text)
            size = min(13, len(item))
            parts = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
            at = [i for i in range(len(words) - size + 1) if size and tuple(words[i : i + size]) in parts]
            hit |= {i + d for i in at for d in range(size)}
            found += [str(name)] if at and name is not None else []
        n = sum(1 for name, text in items if (p := low(text)) and any(tuple(words[i : i + min(13, len(p))]) in {tuple(p[j : j + min(13, len(p))]) for j in range(len(p) - min(13, len(p)) + 1)} for i in range(len(words) - min(13, len(p)) + 1)))
        want.append((r.doc_id, len(words), len(hit), n, hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontamination.contamination(odd, bench), *columns) == sorted(want, key=str)
    assert decontamination.decontaminate(odd, bench).count() == sum(not w[-1] for w in want)


def test_empty_tables(spark, odd):
    ship(spark)
    none, bench = odd.limit(0), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    pieces = token_counts.vocabulary(queries.VOCABULARY)
    for frame in (
        mixing.mix(none), suffix_dedup.dedupe(none), token_counts.count_tokens(none, pieces), ngram_join.join(none), substring_dedup.dedupe(none),
        language_id.identify(none, language_id.profiles(none)), decontamination.contamination(none, bench), quality.classify(none, labels),
        topk_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")), warc.derive(warc.responses(spark.createDataFrame([], "page_id long, url string, html string"))),
    ):
        assert frame.count() == 0
    assert decontamination.contamination(odd, bench).filter("n_hit > 0").count() == 0
    assert quality.classify(odd, labels).filter("score <> 0.5").count() == 0


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_sql(spark, name):
    with connect(FOLDER) as con:
        assert spark_result(entry_module.queries()[name](spark, FOLDER)) == duck_result(con, entry_module.oracle_sql()[name])


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole, columns = docs.count(), docs.columns
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        assert out.columns[: len(columns)] == columns and (k == 4 or out.columns == columns)
        rows = out.toArrow()
        assert 0.7 * whole < rows.num_rows <= docs.count()
        docs = spark.createDataFrame(rows)
    assert docs.filter("taken > 2 * size or taken <= 0").count() == 0
    classes = ngram_join.join(pipeline.one_of_each(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER))
    assert classes.filter("n_links > 0").count() == 0
