"""Conversation prefix trie from vertical bitmaps.

Conversations are dealt in order of their id into shards of at most `shard` conversations, and turns into bands of 256 depths. A shard's
index holds for every (depth, turn) the bitset of its conversations with that turn there. Going depth first from a band's
first prefixes, the intersection of a node's bitset with the postings one level down gives its children, the popcount its
members, the lowest bit its smallest member, and the intersection with the conversations that end at that depth its end list.

Nodes of different shards are the same node if their names agree: the first 128 bits of a SHA-256 over the name at the band's begin and
the turns since. Shards are ranges of ids, so end lists of one node follow each other in the order of shards and are hashed as they stream. Leaves
and savings below a node need it only where two conversations share it (a node of one member is a chain: one leaf, nothing saved); there they are summed
by pointer doubling, in as many rounds as the logarithm of the deepest shared prefix.

Rows: conv_id (an integer), turn, role, text. Nulls in role and text are empty; rows are taken by turn (nulls first), equal turns by the SHA-256 of
role and text; equal rows are turns of their own. Rows without conv_id belong to no conversation and take no part. Very long
texts count through their hash and their words. An empty table has no node. Other columns are not looked at.
A task holds the turns of one shard in one band, at most shard * 256 names, whatever a conversation's length; a node with a third of all
conversations is one row per shard.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorbook.llm.common import WORD, stored
from tenorbook.llm.placing import placed, with_position
from tenorbook.llm.streams import by_key

BAND = 256
ROOT = bytes(16)


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id, position from 1, name (SHA-256 of the turn) and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    words = F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")
    named = rows.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", name.alias("name"), words.alias("words"))
    return with_position(placed(named, "conv_id", [F.asc_nulls_first("turn"), F.col("name")]), "conv_id").select("conv_id", "position", "name", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """For the query: every conversation c with the first h turns of c - c % group, h = crc32(c) % most, then its own beyond its first h.

    Returns (conversations, turns); a conversation may have no turns left.
    """
    convs = stored(turns.groupBy("conv_id").agg(F.max("position").alias("own")).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most))
    heads = (
        turns.filter((F.col("position") < most) & (F.col("conv_id") % group == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("position", "name", "words"))).alias("head"))  # fewer than `most`
    )
    first = F.slice(F.coalesce("head", F.array().cast("array<struct<position: long, name: binary, words: long>>")), F.lit(1), F.col("h").cast("int"))
    joined = stored(convs.join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left").select("conv_id", "h", first.alias("head")))
    lent = joined.select("conv_id", F.inline("head"))
    shifts = joined.select(F.col("conv_id").alias("_conv"), "h", F.size("head").alias("lent"))
    own = turns.join(shifts, F.col("conv_id") == F.col("_conv")).filter("position > h").select("conv_id", (F.col("position") - F.col("h") + F.col("lent")).alias("position"), "name", "words")
    return convs.select("conv_id"), lent.unionByName(own)


def _band_names(size: int, key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    hashed, n = sha256(), 0
    for row in members:
        hashed.update(row[3])
        n += 1
    if n == size:
        yield *key, hashed.digest()


def _named(start: bytes, inner: bytes) -> bytes:
    return sha256(start + inner).digest()[:16]


def _starts(key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    name = ROOT
    for _, band, inner in members:
        name = _named(name, inner)
        yield *key, band + 1, name


def _walk(size: int, key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of one shard in one band of `size` depths, from its index. Rows: shard, band, slot, position, conv_id, name, words, ends, start."""
    shard, band = key
    ids: dict[int, int] = {}
    postings: dict[int, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
    at: dict[int, dict[int, bytes]] = defaultdict(dict)
    words: dict[bytes, int] = {}
    ends: dict[int, int] = defaultdict(int)
    begins: dict[bytes, int] = defaultdict(int)
    for _, _, slot, position, conv, name, n, last, start in members:
        bit = 1 << slot
        ids[slot] = conv
        if last:
            ends[position] |= bit
        if name is None:  # a conversation without turns, in band 0
            begins[ROOT] |= bit
            continue
        postings[position][name] |= bit
        at[position][slot] = name
        words[name] = n
        if position == band * size + 1:
            begins[start or ROOT] |= bit

    def node(name: bytes, depth: int, parent: bytes | None, bits: int, turn: bytes | None) -> tuple:
        done, closing = bits & ends.get(depth, 0), []
        while done:
            low = done & -done
            closing.append(str(ids[low.bit_length() - 1]))
            done ^= low
        smallest = ids[(bits & -bits).bit_length() - 1]
        return shard, name, depth, parent, smallest, bits.bit_count(), words[turn] if turn else 0, ",".join(closing) if closing else None

    for start, whole in sorted(begins.items()):
        if band == 0:
            yield node(ROOT, 0, None, whole, None)
        todo = [(start, band * size, whole, sha256())]
        while todo:
            parent, depth, bits, hashed = todo.pop()
            level, names = postings.get(depth + 1), at.get(depth + 1)
            rest = bits & ~ends.get(depth, 0) if level else 0
            while rest:
                turn = names[(rest & -rest).bit_length() - 1]
                child = bits & level[turn]
                rest &= ~child
                inner = hashed.copy()
                inner.update(turn)
                name = _named(start, inner.digest())
                yield node(name, depth + 1, parent, child, turn)
                todo.append((name, depth + 1, child, inner))


def _merge(key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    """One node from its rows (name, shard, depth, parent, smallest, n, words, ends) in the order of shards, which is that of the ids."""
    first, total, hashed, some = None, 0, sha256(), False
    for row in members:
        first = first or row
        total += row[5]
        if row[7] is not None:
            hashed.update(f"{',' * some}{row[7]}".encode())
            some = True
    yield *key, first[2], first[3], first[4], total, first[6], hashed.hexdigest()


def _nodes(convs: DataFrame, turns: DataFrame, shard: int, size: int) -> DataFrame:
    bits = shard.bit_length() - 1
    dealt = placed(convs, "conv_id", []).select(F.col("conv_id").alias("_conv"), F.shiftright("at", bits).alias("shard"), F.col("at").bitwiseAND(F.lit((1 << bits) - 1)).alias("slot"))
    lengths = turns.groupBy("conv_id").agg(F.max("position").alias("length"))
    banded = turns.withColumn("band", F.call_function("div", F.col("position") - 1, F.lit(size)))
    long = lengths.filter(F.col("length") > size).select(F.col("conv_id").alias("_long"))
    full = banded.join(long, F.col("conv_id") == F.col("_long")).select("conv_id", "band", "position", "name")
    inner = by_key(full, ["conv_id", "band"], ["position"], partial(_band_names, size), "conv_id long, band long, inner binary")
    starts = by_key(inner, ["conv_id"], ["band"], _starts, "conv_id long, band long, start binary").select(F.col("conv_id").alias("_start_of"), F.col("band").alias("_band"), "start")
    begun = banded.join(starts, (F.col("conv_id") == F.col("_start_of")) & (F.col("band") == F.col("_band")), "left")
    known = dealt.join(lengths, F.col("_conv") == F.col("conv_id"), "left").select("_conv", "shard", "slot", "length")
    rows = begun.join(known, F.col("conv_id") == F.col("_conv")).select("shard", "band", "slot", "position", "conv_id", "name", "words", (F.col("position") == F.col("length")).alias("ends"), "start")
    bare = known.filter("length IS NULL").selectExpr("shard", "0L AS band", "slot", "0L AS position", "_conv AS conv_id", "cast(null AS binary) AS name", "0L AS words", "true AS ends", "cast(null AS binary) AS start")
    fields = "shard long, name binary, depth long, parent binary, smallest long, n long, words long, ends string"
    parts = by_key(rows.unionByName(bare), ["shard", "band"], ["slot", "position"], partial(_walk, size), fields)
    merged = "name binary, depth long, parent binary, conv_id long, n_convs long, words long, ends_sha256 string"
    return by_key(parts.select("name", "shard", "depth", "parent", "smallest", "n", "words", "ends"), ["name"], ["shard"], _merge, merged)


def _subtrees(nodes: DataFrame) -> DataFrame:
    """name, n_leaves and saved of nodes with two members or more, themselves included.

    Each round adds to a node the sums of those a step above which it is, then doubles the step, so sums of 1, 2, 4, ... levels join up.
    """
    shared = nodes.filter("n_convs > 1")
    single = nodes.filter("n_convs = 1").groupBy("parent").agg(F.count("*").alias("chains"))
    inner = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    own = shared.join(single.withColumnRenamed("parent", "_a"), F.col("name") == F.col("_a"), "left").join(inner.withColumnRenamed("parent", "_b"), F.col("name") == F.col("_b"), "left")
    leaves = F.coalesce("chains", F.lit(0)) + F.col("n_children").isNull().cast("long")
    step = stored(own.select("name", F.col("parent").alias("up"), leaves.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    while not step.filter("up IS NOT NULL").isEmpty():
        below = step.filter("up IS NOT NULL").groupBy(F.col("up").alias("_above")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        next_up = step.select(F.col("name").alias("_name"), F.col("up").alias("_next"))
        summed = step.join(below, F.col("name") == F.col("_above"), "left").select(
            "name", "up", (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved")
        )
        step = stored(summed.join(next_up, F.col("up") == F.col("_name"), "left").select("name", F.col("_next").alias("up"), "n_leaves", "saved"))
    return step.select("name", "n_leaves", "saved")


def trie(convs: DataFrame, turns: DataFrame, shard: int = 2048, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    convs: each conv_id once. turns: conv_id, position from 1 without gaps, name, words. shard: a power of two. band: depths a task walks; names of
    nodes, not the result, depend on it.
    """
    nodes = stored(_nodes(convs, turns, shard, band))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("_of")).agg(F.count("*").alias("n_children"))
    sums = _subtrees(nodes).select(F.col("name").alias("_sum_of"), "n_leaves", "saved")
    # A parent of several conversations meets its children here; the other nodes' parents are themselves one level up.
    above = nodes.filter("n_convs > 1").select(F.col("name").alias("_up"), F.col("conv_id").alias("up_conv"))
    name = F.col("name")
    joined = nodes.join(children, name == F.col("_of"), "left").join(sums, name == F.col("_sum_of"), "left").join(above, F.col("parent") == F.col("_up"), "left")
    parent: Column = F.when(F.col("parent").isNotNull(), F.coalesce("up_conv", "conv_id"))
    return joined.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"), "ends_sha256",
    )
