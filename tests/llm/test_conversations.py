"""Conversation repair and the prefix trie against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import cache

import pytest

from tenorbook.llm import placing, prefix_trie, repair
from tenorbook.ship import ship

SCHEMA = "conv_id long, turn long, role string, text string, at long, block long, name string, position int, state string, ends string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, turns, roles and texts, unknown roles, repeated rows, gaps, one long conversation, one long text, clashing extra columns."""
    ship(spark)
    rng = random.Random(3)
    texts = ["Yes.", "No!", "Why?", "well", "hm hm", "", " \t", None, "end. ", "a b c.", "same."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]
    rows = []
    for c in [*range(70), -7, -40, None]:
        for t in range(rng.randint(1, 7)):
            turn = None if rng.random() < 0.1 else t + (rng.random() < 0.1) * 3
            rows.append((c, turn, rng.choice(roles[:4] if rng.random() < 0.7 else roles), rng.choice(texts)))
    rows += [(100, k, ("user", "assistant")[k % 2], f"turn {k}." if k % 11 else "turn") for k in range(700)]
    rows += [(101, 0, "user", "word " * 30000 + "?"), (101, 1, "assistant", "ok."), (105, 1, "tool", "x"), (120, 0, "user", "only.")]
    rows += [(140 + k, t, r, x) for k in range(30) for t, (r, x) in enumerate([("user", "hi."), ("assistant", "hello."), ("user", "bye.")])]
    rows += [(200 + k, 0, "user", "alone.") for k in range(1, 9)] + rows[5:25]
    return spark.createDataFrame([(*r, 1, 2, "n", 3, "s", "e") for r in rows], SCHEMA).repartition(3)


def plain(frame):
    by = defaultdict(list)
    for r in frame.select("conv_id", "turn", "role", "text").collect():
        by[r.conv_id].append(tuple(r)[1:])
    return by


def hurt(conv, rows):
    out = []
    for turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        out += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def by_hand(rows):
    """Every edit sequence worth a look, by recursion over rows and turns said so far."""
    faults, seen = [], set()
    for _, role, text in rows:
        letters = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not letters else "d" if (role, text) in seen else "t" if letters[-1] not in ".!?" else "n")
        seen.add((role, text))
    sys.setrecursionlimit(20000)

    @cache
    def go(i, said, inserts):
        """said: "", "s", "u" or "a", the last turn said."""
        ways = [(0, "", ())] if i == len(rows) and said in ("", "a") else []
        may = {"": "su", "s": "u", "u": "a", "a": "u"}[said]
        full = {"u": "user", "a": "assistant"}

        def follow(cost, letter, turn, *state):
            rest = go(*state)
            if rest:
                ways.append((cost + rest[0], letter + rest[1], turn + rest[2]))

        if inserts < 2:
            for x in set(may) - {"s"}:
                follow(2, "I", ((full[x], ""),), i, x, inserts + 1)
        if i < len(rows):
            follow(3, "D", (), i + 1, said, 0)
            if faults[i] in "tn":
                for x in may:
                    if rows[i][1][:1] == x:
                        follow(int(faults[i] == "t"), "K", (rows[i][1:],), i + 1, x, 0)
                    if x != "s":
                        follow(2 + (faults[i] == "t"), "R", ((full[x], rows[i][2]),), i + 1, x, 0)
        return min(ways, default=None)

    cost, audit, turns = go(0, "", 0)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    whole = "\n".join(f"{r}:{x}" for r, x in turns)
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()), turns


@pytest.mark.parametrize("block", [8, 1])
def test_repair(odd, block, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", block)
    want = {c: by_hand(hurt(c, rows)) for c, rows in plain(odd).items()}
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damaged(odd), odd).collect()}
    assert got == {c: w for c, (w, _) in want.items()}
    assert len({w[6] for w, _ in want.values()}) > 20 and any(not w[6] for w, _ in want.values())
    turns = defaultdict(list)
    for r in sorted(repair.repaired(repair.damaged(odd)).collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.turn)):
        turns[r.conv_id].append((r.role, r.text))
    assert turns == {c: list(t) for c, (_, t) in want.items() if t}


def test_agenda_finalises_the_goal_first():
    """The least derivation through a hyperedge with two tails; items heavier than the goal are left alone."""
    edges = {"a": [("c", ("a", "b"), 5, "x"), ("d", ("a",), 1, "y")], "b": [("c", ("a", "b"), 5, "x")], "d": [("c", ("d", "b"), 4, "w"), ("e", ("d",), 9, "z")]}
    final = repair.lightest(["a", "b"], lambda x: edges.get(x, []), {"c"})
    assert final["c"] == (5, "x") and final["d"] == (1, "y") and "e" not in final


def test_stretches_chain_to_the_lightest_whole():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["s", "u", "a", "t", ""]), rng.choice("nnntbd")) for _ in range(rng.randint(1, 12))]
        whole = repair.transfers(rows)
        for size in (1, 3):
            parts = [repair.transfers(rows[k : k + size]) for k in range(0, len(rows), size)]
            tables = []
            for p in parts:
                order = {q: sorted(range(4), key=lambda r: p.get((q, r), (0, ""))[1]) for q in range(4)}
                ways = list(itertools.product(range(4), range(4)))
                tables.append(([p.get(w, (-1, ""))[0] for w in ways], [order[q].index(r) for q, r in ways]))
            states = repair.chain(tables)
            steps = [p[w] for p, w in zip(parts, zip(states[:-1], states[1:], strict=True), strict=True)]
            found = sum(c for c, _ in steps), "".join(a for _, a in steps)
            assert found == whole[0, states[-1]]


def by_prefix(built):
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    below, out = {}, []
    for k in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        below[k] = (sum(below[c][0] for c in kids[k]) or 1, (len(nodes[k]) - 1) * words + sum(below[c][1] for c in kids[k]))
        ends = ",".join(map(str, sorted(c for c in nodes[k] if len(built[c]) == len(k))))
        out.append((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(kids[k]), *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def in_order(rows):
    name = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    rows = [(turn, role or "", text or "") for turn, role, text in rows]
    return [r[1:] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, name(*r[1:])))]


@pytest.mark.parametrize("shard, band", [(2048, 256), (8, 2), (16, 1)])
def test_trie(odd, shard, band):
    own = {c: in_order(rows) for c, rows in plain(odd).items() if c is not None}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    assert any(not t for t in built.values()) and max(map(len, built.values())) >= 700
    found = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns_of(odd)), shard=shard, band=band)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_prefix(built)


def test_trie_of_conversations_as_they_are(odd):
    turns = prefix_trie.turns_of(odd)
    found = prefix_trie.trie(turns.select("conv_id").distinct(), turns)
    own = {c: in_order(rows) for c, rows in plain(odd).items() if c is not None}
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_prefix(own)


def test_a_large_conversation_spans_tasks(spark):
    """One conversation with most of the rows, a third of them equal: its rows are in many ranges, positions are right."""
    rows = spark.range(20000).selectExpr("if(id % 10 = 0, id, 7) as k", "if(id % 3 = 0, 0, id) as v").repartition(5)
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = placing.with_position(placing.placed(rows, "k", [F.col("v")]), "k")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = table.withColumn("part", F.shiftright("at", 33)).filter("k = 7").select("position", "v", "part").orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, len(got) + 1)) and [r.v for r in got] == sorted(r.v for r in got)
    assert len({r.part for r in got if r.v == 0}) > 1 and table.count() == 20000


def test_empty_tables(odd):
    none = odd.limit(0)
    assert repair.repair(repair.damaged(none), none).count() == 0 and repair.repaired(none).count() == 0
    assert prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns_of(none))).count() == 0
