"""Mixing sources to target weights: equal-token blocks are dealt to sources by highest quotients.

Targets. Every source has a weight and shares a token budget by it. A source gives its text out at most
`limit` times; what it cannot take is shared again by weight. That is water filling: with sources ordered by
limit per weight, one running sum finds the level at which the budget is used up.

Quotas. Blocks of `block` words are the seats of a Sainte-Laguë apportionment: the k-th seat of a party with
v votes has the quotient v / (2k + 1), and the highest quotients win. Only quotients near the ideal share can
be undecided (a divisor method stays within half a seat per party of it), so about four rows per party are
ranked, whatever the number of seats. The same step deals a source's blocks to groups of shards and then to
shards, so no step ranks more rows than there are sources, or groups or shards in one parent.

Selection. A shard is a seeded share of a source's documents of bounded size. Its documents stand in seeded order
as one stream of words, cut into blocks. A quota of several times the shard takes every block that often; the
rest is a seeded, evenly spaced choice of blocks, so what a document gives follows from its place in the
stream by arithmetic: no row per block is made.

A null text has no words; null is a source of its own, after all others. Ids may be null or repeated: a text is known by
its id, source and hash. Rows with all three equal stand side by side in the stream, as one entry with a number of copies.
An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorbook.llm.common import WORD, stored
from tenorbook.llm.placing import placed, with_position

#: Shards or groups under one parent, at most, beside the top level.
FAN = 512


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportion(parties: DataFrame, parent: Sequence[str], order: Sequence[str], votes: str, seats: str, out: str) -> DataFrame:
    """Adds `out`: each party's seats by highest quotients v / (2k + 1).

    `parent` columns name the election, `order` columns tell parties of one election apart and break ties.
    `seats` is the number to deal in the party's election.
    """
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    rows = parties.withColumns({"_n": F.count(F.lit(1)).over(whole), "_v": F.sum(votes).over(whole)})
    ideal = F.when(F.col("_v") > 0, F.col(votes) / F.col("_v") * F.col(seats)).otherwise(0.0)
    swing = F.when(F.col(seats) > 0, F.col("_n") / (2 * F.col(seats))).otherwise(0.0)
    rows = rows.withColumns(
        {
            "_low": F.greatest(F.floor(ideal * (1 - swing) - 1), F.lit(0)).cast("long"),
            "_high": F.when((F.col(seats) > 0) & (F.col(votes) > 0), F.ceil(ideal * (1 + swing) + 1)).otherwise(0).cast("long"),
        }
    )
    rows = rows.withColumn("_free", F.col(seats) - F.sum("_low").over(whole))
    seat = F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1)))
    tries = rows.select(*parent, *order, "_free", F.col(votes).alias("_votes"), "_low", seat.alias("_k"))
    quotient = F.col("_votes") / (2 * F.col("_k") + 1)
    ranked = F.row_number().over(whole.orderBy(quotient.desc_nulls_last(), *order, "_k"))
    won = F.sum(F.when(F.col("_k").isNotNull() & (F.col("_r") <= F.col("_free")), 1).otherwise(0))
    got = tries.withColumn("_r", ranked).groupBy(*parent, *order).agg((F.max("_low") + won).cast("long").alias(out))
    return parties.join(got, [*parent, *order])


def targets(sources: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Adds `rank` (from 0, null last) and `target` to one row per source with its `source_size`."""
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = sources.withColumn("rank", rank.cast("long")).withColumn("_w", weight)
    rows = rows.withColumns({"_cap": F.lit(float(limit)) * F.col("source_size"), "_all": F.sum("source_size").over(everything) * float(share)})
    by_ratio = everything.orderBy(F.col("_cap") / F.col("_w"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    rows = rows.withColumns({"_level": level, "_place": F.row_number().over(by_ratio)})
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct("_place", "_level"))
    rows = rows.withColumn("_level", F.min(fits).over(everything)["_level"])
    target = F.coalesce(F.least(F.col("_cap"), F.col("_level") * F.col("_w")), F.col("_cap"))
    return rows.select("source", "source_size", "rank", target.alias("target"))


def _entries(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    limit: int = 2,
    block: int = 16,
    shard_words: int = 1 << 18,
    seed: int = 20240229,
) -> DataFrame:
    """One row per entry, `copies` equal rows: doc_id, source, text_hash, size, source_size, target of its source, and what gives `_given`."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"), word_count(F.col(text)).alias("size"))
    sized = stored(rows.groupBy("doc_id", "source", "text_hash", "size").agg(F.count(F.lit(1)).alias("copies")))
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    dealt = targets(totals, weights, share, limit)
    budget = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block).cast("long")
    dealt = apportion(dealt.withColumn("_seats", budget), [], ["rank"], "target", "_seats", "blocks")
    many = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long")
    sources = stored(dealt.select("source", "source_size", "rank", "target", "blocks", many.alias("_many")))

    own = sized.withColumnRenamed("source", "_source").join(sources, F.col("_source").eqNullSafe(F.col("source")))
    own = own.select(
        "doc_id", "text_hash", "size", "copies", "source", "source_size", "target", "rank", "blocks",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), "_many").alias("shard"),
    )
    shards = own.groupBy("rank", "blocks", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    shards = shards.withColumn("part", F.floor(F.col("shard") / FAN))
    parts = shards.groupBy("rank", "blocks", "part").agg(F.sum("words").alias("words"))
    parts = apportion(parts, ["rank"], ["part"], "words", "blocks", "part_blocks").select("rank", "part", "part_blocks")
    shards = apportion(shards.join(parts, ["rank", "part"]), ["rank", "part"], ["shard"], "words", "part_blocks", "quota")
    count = F.greatest(F.ceil(F.col("words") / block), F.lit(1)).cast("long")
    quota = F.least(F.col("quota"), F.col("n") * limit)
    shards = shards.withColumn("n", count).select(
        F.col("rank").alias("_rank"), F.col("shard").alias("_shard"), "n",
        F.floor(quota / F.col("n")).cast("long").alias("times"), (quota % F.col("n")).alias("rest"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "rank", "shard"), "n").alias("turn"),
    )
    shards = stored(shards)

    stream = Window.partitionBy("rank", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "doc_id", "text_hash"), "doc_id", "text_hash", "size")
    placed = own.withColumn("_end", F.sum(F.col("size") * F.col("copies")).over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    placed = placed.join(shards, (F.col("rank") == F.col("_rank")) & (F.col("shard") == F.col("_shard")))

    return placed.withColumn("_begin", F.col("_end") - F.col("size") * F.col("copies")).withColumn("_block", F.lit(block))


def _given(begin: Column, end: Column) -> Column:
    """Words that the stretch from begin to end of an entry's stream gives."""
    n, rest, turn, block = (F.col(c) for c in ("n", "rest", "turn", "_block"))

    def chosen(j: Column) -> Column:  # blocks chosen before block j
        return F.floor((j + turn) * rest / n) - F.floor(turn * rest / n)

    def given(x: Column) -> Column:  # words in the chosen blocks before word x of the stream
        j = F.floor(x / block)
        return chosen(j) * block + (chosen(j + 1) - chosen(j)) * (x - j * block)

    return (F.col("times") * (end - begin) + given(end) - given(begin)).cast("long")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options: object) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target of its source, and `taken` words."""
    entries = stored(_entries(docs, key, text, source, **options))
    begin = F.col("_begin") + F.col("_copy") * F.col("size")
    return _copied(entries).select("doc_id", "size", "source", "source_size", "target", _given(begin, begin + F.col("size")).alias("taken"))


def _copied(entries: DataFrame, lot: int = 4096) -> DataFrame:
    """A row for each of `copies`, numbered from 0 in `_copy`. More than `lot` of them are dealt to tasks lot by lot."""
    one, copies = F.lit(1).cast("long"), F.col("copies")
    few = entries.filter(copies <= lot).withColumn("_copy", F.explode(F.sequence(one * 0, copies - 1)))
    lots = entries.filter(copies > lot).withColumn("_lot", F.explode(F.sequence(one * 0, F.call_function("div", copies - 1, F.lit(lot)))))
    dealt = lots.repartition("doc_id", "text_hash", "_lot")
    many = dealt.withColumn("_copy", F.explode(F.sequence(F.col("_lot") * lot, F.least(copies, (F.col("_lot") + 1) * lot) - 1))).drop("_lot")
    return few.unionByName(many)


def chosen(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options: object) -> DataFrame:
    """The documents in the mix with all their columns, and their `size` and `taken` words, called `mix_size` and `mix_taken` where the
    documents have columns of those names (and so on: `mix_mix_size`).

    Rows equal in id, source and text share the words of all of them; what does not divide goes, a word a row, to the first of them in the
    order of all their columns (as JSON), so reruns agree. They are numbered by ranges of that order: many copies never meet in one task.
    """
    entries = _entries(docs, key, text, source, **options).withColumn("_all", _given(F.col("_begin"), F.col("_end"))).filter("_all > 0")
    shares = stored(
        entries.select(
            F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), F.col("size").alias("_size"),
            F.floor(F.col("_all") / F.col("copies")).alias("_taken"), (F.col("_all") % F.col("copies")).alias("_over"),
        )
    )
    named = docs[key].eqNullSafe(shares["_id"]) & docs[source].eqNullSafe(shares["_source"]) & (F.xxhash64(docs[text]) == shares["_hash"])
    own, size, taken = [docs[c] for c in docs.columns], shares["_size"].alias("size"), shares["_taken"]
    names = [_fresh(n, docs.columns) for n in ("size", "taken")]
    joined = docs.join(shares, named)
    even = joined.filter((shares["_over"] == 0) & (taken > 0)).select(*own, size, taken.alias("taken"))
    if shares.filter("_over > 0").isEmpty():
        return even.toDF(*docs.columns, *names)
    mine = F.struct(shares["_id"].alias("id"), shares["_source"].alias("source"), shares["_hash"].alias("hash"))
    odd = joined.filter(shares["_over"] > 0).select(F.struct(*own).alias("row"), mine.alias("entry"), size, taken.alias("taken"), shares["_over"].alias("over"))
    numbered = with_position(placed(odd.withColumn("line", F.to_json("row")), "entry", [F.col("line")]), "entry")
    gets = F.col("taken") + F.when(F.col("position") <= F.col("over"), 1).otherwise(0)
    more = numbered.select("row", "size", gets.alias("gets")).filter("gets > 0")
    return even.union(more.select("row.*", "size", "gets")).toDF(*docs.columns, *names)


def _fresh(name: str, taken: list[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name = f"mix_{name}"
    return name
