"""Benchmark decontamination by a distributed positional inverted index.

The index holds one posting (term, document, position) for every occurrence of a benchmark term in the corpus; words that
no benchmark item has can never be looked up and are left out by the join with the benchmark's vocabulary.
It is made in one scan and stored. A header posting per document (the empty word, which no text contains)
carries the document's key and length, so nothing has to be scanned twice.

Phrase search goes from the rarest test terms. Each window of an item names its `rarest` least frequent
positions. Their posting lists, each shifted by the term's offset in the item, are intersected on (document,
item, shift): a window can only occur at a shift where all of its rare positions are present. The few shifts that are
left are intersected with the postings of all other terms of the window, and runs of matched item positions as long
as a window are the exact occurrences. With `slack` above 0 the rare terms may lie that far from their place,
which gives proximity matches instead of phrases.

Null and empty texts have no words. An item shorter than the window is one window. Items or documents that are repeated are
kept apart; ids are not assumed to be unique or non-null (null ids are not listed). No benchmark: nothing is hit.
Joins are decided by Spark from the true sizes of stored tables; none is forced into a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorbook.llm.common import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before lower-casing: ASCII letters and digits, and anything beyond ASCII.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def _lowered(word: Column) -> Column:
    """A-Z in lower case and all else unchanged; most words have no capital and pass as they are."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, _UPPER, _LOWER))


class Index:
    """Postings of all terms of `items` in `docs`.

    postings: term, rid, pos (from 1); headers: rid, doc_id, text_hash, n_words; item_terms: iid, ipos, length, term.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"):
        words = _words(F.col(item_text))
        self.items = stored(
            items.select(F.col(item_key).alias("item_id"), words.alias("words")).filter(F.size("words") > 0).withColumn("iid", F.monotonically_increasing_id())
        )
        spelled = self.items.select("iid", F.size("words").alias("length"), F.posexplode("words").alias("ipos", "word")).withColumn("word", _lowered(F.col("word")))
        terms = spelled.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
        header = docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("long").alias("term"))
        vocabulary = stored(terms.unionByName(header))
        self.item_terms = stored(spelled.join(vocabulary, "word").select("iid", "ipos", "length", "term"))

        rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("rid", F.monotonically_increasing_id())
        rows = rows.select("rid", "doc_id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("words"))
        rows = rows.select(
            "rid", "doc_id", "text_hash", F.size("words").alias("n"), F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "word")
        ).withColumn("word", _lowered(F.col("word")))
        first = F.col("pos") == 0
        found = rows.join(vocabulary, "word").select(
            "term", "rid", F.when(first, F.col("n")).otherwise(F.col("pos")).alias("pos"),
            F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("text_hash")).alias("text_hash"),
        )
        self._all = stored(found)

    @property
    def postings(self) -> DataFrame:
        return self._all.filter("term >= 0").select("term", "rid", "pos")

    @property
    def headers(self) -> DataFrame:
        return self._all.filter("term = -1").select("rid", "doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))


def _rare(index: Index, window: int, rarest: int) -> DataFrame:
    """iid, start, size, ipos, term: the least frequent positions of every window all of whose terms the corpus has."""
    frequency = stored(index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    terms = index.item_terms.join(frequency, "term", "left").fillna(0, ["df"])
    size = F.least(F.lit(window), F.col("length"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("ipos") - size + 1), F.least(F.col("ipos"), F.col("length") - size))
    rows = terms.select("iid", "ipos", "term", "df", size.alias("size"), F.explode(starts).alias("start"))
    of = Window.partitionBy("iid", "start")
    rows = rows.withColumns({"_place": F.row_number().over(of.orderBy("df", "ipos")), "_least": F.min("df").over(of)})
    return stored(rows.filter((F.col("_place") <= rarest) & (F.col("_least") > 0)).select("iid", "start", "size", "ipos", "term"))


def shifts(index: Index, window: int = 13, rarest: int = 3, slack: int = 0) -> DataFrame:
    """rid, iid, shift, start: where all rare positions of a window are present, each within `slack` words of its place."""
    rare = _rare(index, window, rarest)
    lists = rare.select("iid", "ipos", "term").distinct()
    near = F.explode(F.sequence(F.lit(-slack), F.lit(slack))) if slack else F.lit(0)
    there = index.postings.join(lists, "term").select("rid", "iid", "ipos", (F.col("pos") - F.col("ipos") + near).alias("shift"))
    there = there.groupBy("rid", "iid", "shift").agg(F.collect_set("ipos").alias("have"))
    windows = rare.groupBy("iid", "start").agg(F.collect_set("ipos").alias("want"))
    fewest = windows.groupBy("iid").agg(F.min(F.size("want")).alias("fewest"))
    there = there.join(fewest, "iid").filter(F.size("have") >= F.col("fewest"))
    full = there.join(windows, "iid").filter(F.size(F.array_except("want", "have")) == 0)
    return full.select("rid", "iid", "shift", "start")


def occurrences(index: Index, window: int = 13, rarest: int = 3) -> DataFrame:
    """rid, iid, pos: every document position inside an occurrence of an item's window."""
    found = stored(shifts(index, window, rarest))
    size = F.least(F.lit(window), F.col("length"))
    inside = (F.col("ipos") >= F.col("start")) & (F.col("ipos") < F.col("start") + size)
    wanted = found.join(index.item_terms, "iid").filter(inside)
    wanted = wanted.select("rid", "iid", "shift", "ipos", "term", size.alias("size"), (F.col("shift") + F.col("ipos")).alias("pos")).distinct()
    rids = stored(found.select("rid").distinct())
    lists = index.postings.join(rids, "rid", "left_semi")
    met = wanted.join(lists, ["rid", "pos", "term"])
    line = Window.partitionBy("rid", "iid", "shift")
    met = met.withColumn("run", F.col("ipos") - F.row_number().over(line.orderBy("ipos")))
    met = met.withColumn("long", F.count(F.lit(1)).over(Window.partitionBy("rid", "iid", "shift", "run")))
    return met.filter(F.col("long") >= F.col("size")).select("rid", "iid", "pos")


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, rarest: int = 3, part: int = 20, **names: str) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated if at least one in `part` of its words lies in an occurrence of a window.
    """
    index = Index(docs, items, **names)
    hits = stored(occurrences(index, window, rarest))
    words = hits.select("rid", "pos").distinct().groupBy("rid").agg(F.count(F.lit(1)).alias("n_hit"))
    named = hits.select("rid", "iid").distinct().join(index.items.select("iid", "item_id"), "iid")
    listed = named.groupBy("rid").agg(F.count(F.lit(1)).alias("n_items"), F.collect_list(F.col("item_id").cast("string")).alias("_ids"))
    rows = index.headers.join(words, "rid", "left").join(listed, "rid", "left").fillna(0, ["n_hit", "n_items"])
    ids = F.concat_ws(",", F.array_sort(F.coalesce("_ids", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id", "text_hash", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (part * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = contamination(docs, items, key=key, text=text, **options)
    bad = stored(found.filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    same = docs[key].eqNullSafe(bad["_id"]) & (F.xxhash64(docs[text]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
