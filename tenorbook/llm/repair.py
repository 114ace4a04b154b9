"""Conversation structure repair by Knuth's lightest derivations.

A repair turns the role initials of a conversation into `(s?(ua)+)?`: an optional system turn, then user and assistant in turn. Items
are prefixes of a stretch of rows in a state of that pattern, and rows; a deduction takes a prefix and a row to the next prefix by keeping, reroling or
deleting the row, or a prefix to itself by inserting a turn. Weights are (cost, audit), where the audit strings the
edits' initials together. Both parts only grow along a deduction and keep their order, so the functions are superior and monotone
and the agenda, which pops the least weight, finalises every item the first time it pops it, up to the goals.

A conversation is repaired in stretches of at most 256 rows, so that one of any length is no single task's work. Per
stretch the agenda runs from each state the stretch can be entered in (a conversation's first: nothing yet) and leaves, for each state it can be left in, cost and audit. A fold over the
stretches of a conversation then picks the lightest chain. It needs numbers only: an inserted turn belongs to the row that
follows, so audits of one prefix in different states never begin one another, and their order is settled by the first stretch in which they differ.
The edits go back to the rows, which stream by conversation in order into the repaired texts' hash, a batch at a time.

Rows: conv_id, turn, role, text; nulls in role and text count as one space. Rows are taken by turn (nulls first), equal turns by role, then text
(equal rows any way round). A row without a conv_id belongs to the conversation without an id. Repeated rows are rows: the second is a
duplicate. Roles that begin with none of s, u, a cannot be kept. Very long texts are hashed as they stream. Empty tables
give no rows. Other columns are not looked at. What a task holds is a stretch of codes, or of a conversation its
audit, which the result holds too, and 32 numbers per stretch; the hash of one conversation is one sequential SHA-256 by its definition.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenorbook.llm.common import stored
from tenorbook.llm.placing import placed
from tenorbook.llm.streams import Of, by_key

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. Where each initial leads.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NAMES = {"u": "user", "a": "assistant"}
RELABEL, DROP, INSERT, TRUNCATED = 2, 3, 2, 1

#: Rows of a stretch lie in one block of 2**8 numbers.
BLOCK = 8

Weight = tuple[int, str]
Item = tuple
Deduction = tuple[Item, tuple[Item, ...], int, str]


def lightest(axioms: Iterable[Item], deductions: Callable[[Item], Iterable[Deduction]], goals: set[Item] | None = None) -> dict[Item, Weight]:
    """Knuth's agenda: the least weight of every item that can be derived, or of the goals and what is lighter.

    axioms weigh (0, ""). `deductions` of an item lists (head, tails, cost, letters) in which it is a tail; a deduction fires when the last of its
    tails is final. Its weight is the sum of the tails' costs plus its own, and the tails' audits in a row plus its letters.
    """
    final: dict[Item, Weight] = dict.fromkeys(axioms, (0, ""))  # nothing weighs less
    agenda: list[tuple[int, str, Item]] = []
    left = None if goals is None else goals - final.keys()

    def fire(item: Item) -> None:
        for head, tails, more, letters in deductions(item):
            if head not in final and all(t in final for t in tails):
                weights = [final[t] for t in tails]
                heapq.heappush(agenda, (sum(w[0] for w in weights) + more, "".join(w[1] for w in weights) + letters, head))

    for item in list(final):
        fire(item)
    while agenda and (left is None or left):
        cost, audit, item = heapq.heappop(agenda)
        if item not in final:
            final[item] = (cost, audit)
            if left is not None:
                left.discard(item)
            fire(item)
    return final


def _deductions(rows: list[tuple[str, str]]) -> Callable[[Item], list[Deduction]]:
    """The deductions over a stretch of (initial, fault). Items: ("row", i); ("prefix", i, state, open), open after an insertion."""

    def of(item: Item) -> list[Deduction]:
        if item[0] == "row":  # an axiom, final before any prefix beyond the first
            return []
        _, i, state, _ = item
        if i == len(rows):
            return []
        initial, fault = rows[i]
        tails = (item, ("row", i))
        out = [(("prefix", i + 1, state, False), tails, DROP, "D")]
        for letter, to in STEPS[state].items():
            if fault in "tn":
                if letter == initial:
                    out.append((("prefix", i + 1, to, False), tails, TRUNCATED * (fault == "t"), "K"))
                if letter in NAMES:
                    out.append((("prefix", i + 1, to, False), tails, RELABEL + TRUNCATED * (fault == "t"), "R"))
            if letter in NAMES:
                out.append((("prefix", i, to, True), (item,), INSERT, "I"))
        return out

    return of


def transfers(rows: list[tuple[str, str]], entered: Iterable[int] = tuple(STEPS)) -> dict[tuple[int, int], Weight]:
    """(state before, state after) -> least (cost, audit) of a stretch of rows, for the states it may be entered in.

    fault: b blank, d duplicate, t truncated, n none.
    """
    deductions, axioms = _deductions(rows), [("row", i) for i in range(len(rows))]
    out = {}
    for before in entered:
        goals = {("prefix", len(rows), after, False) for after in STEPS if after == before or after > SYSTEM or (before, after) == (EMPTY, SYSTEM)}
        final = lightest([*axioms, ("prefix", 0, before, False)], deductions, goals)
        out |= {(before, g[2]): final[g] for g in goals if g in final}
    return out


#: Turns still missing where the rows end.
CLOSING = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def chain(stretches: Iterable[tuple[list[int], list[int]]]) -> list[int]:
    """The states of the lightest chain, one more than stretches.

    A stretch has by 4 * before + after the cost, -1 where there is no way, and the order of the audits from one state before.
    """
    alive, back = {EMPTY: (0, 0)}, []
    for costs, order in stretches:
        best: dict[int, tuple[int, int, int]] = {}
        for q, (cost, rank) in alive.items():
            for r in STEPS:
                if costs[4 * q + r] >= 0:
                    best[r] = min(best.get(r, (1 << 62, 0, 0)), (cost + costs[4 * q + r], rank, q))
        back.append({r: q for r, (_, _, q) in best.items()})
        ranked = sorted(best, key=lambda r: (best[r][1], order[4 * best[r][2] + r]))
        alive = {r: (best[r][0], ranked.index(r)) for r in best}
    state = min(alive, key=lambda r: (alive[r][0] + INSERT * len(CLOSING[r]), alive[r][1]))
    states = [state]
    for sources in reversed(back):
        states.append(state := sources[state])
    return states[::-1]


def _by_key(frame: DataFrame, keys: list[str], order: list[str], of: Of, fields: str) -> DataFrame:
    """by_key with rows of (conv_id, *fields)."""
    return by_key(frame, keys, order, of, T.StructType([frame.schema["conv_id"], *T.StructType.fromDDL(fields).fields]))


def damaged(rows: DataFrame) -> DataFrame:
    """Damages rows by crc32 of `conv_id:turn` (a null is one space) modulo 20, for the query.

    0 drops the row, 1 empties its text, 2 takes `.!?` out of it, 3 repeats it, 4 makes its role user.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    fault = F.col("_fault")
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_fault"))
        .filter(fault != 0)
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


def _coded(rows: DataFrame) -> DataFrame:
    """at, conv_id, initial, fault of placed rows, and whether a row opens its conversation.

    Equal role and text are found by SHA-256; the first of them per conversation, and the first row of all, are joined by their numbers.
    """
    worded = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    name = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    coded = rows.select("conv_id", "at", F.substring("role", 1, 1).alias("initial"), worded.alias("last"), F.unhex(name).alias("name"))
    firsts = coded.groupBy("conv_id", "name").agg(F.min("at").alias("first"))
    fault = F.when(F.col("last") == "", "b").when(F.col("first").isNull(), "d").when(~F.col("last").isin(".", "!", "?"), "t").otherwise("n")
    opening = firsts.groupBy("conv_id").agg(F.min("first").alias("opening")).select("opening")
    joined = coded.join(firsts.select("first"), F.col("at") == F.col("first"), "left").join(opening, F.col("at") == F.col("opening"), "left")
    return joined.select("conv_id", "at", "initial", fault.alias("fault"), F.col("opening").isNotNull().alias("opens"))


def _stretch(key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    rows = list(members)
    codes = [row[3:5] for row in rows]
    found = transfers(codes, (EMPTY,) if rows[0][5] else STEPS)
    ways = [(q, r) for q in STEPS for r in STEPS]
    order = {q: sorted(STEPS, key=lambda r: found.get((q, r), (0, ""))[1]) for q in STEPS}
    costs, audits = [found.get(w, (-1, ""))[0] for w in ways], [found.get(w, (-1, ""))[1] for w in ways]
    yield *key, "".join(fault for _, fault in codes), costs, audits, [order[q].index(r) for q, r in ways]


def _links(key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    blocks: list[int] = []

    def tables() -> Iterator[tuple[list[int], list[int]]]:
        for _, block, costs, ranks in members:
            blocks.append(block)
            yield costs, ranks

    states = chain(tables())
    for block, q, r in zip(blocks, states[:-1], states[1:], strict=True):
        yield *key, block, q, 4 * q + r


def _edits(rows: DataFrame) -> DataFrame:
    """Per stretch of placed rows: conv_id, at (its begin), the faults, the state before it and the audit on the lightest chain."""
    block = F.shiftright("at", BLOCK).alias("block")
    coded = _coded(rows).select("conv_id", block, "at", "initial", "fault", "opens")
    stretches = stored(_by_key(coded, ["conv_id", "block"], ["at"], _stretch, "block long, faults string, costs array<int>, audits array<string>, ranks array<int>"))
    links = _by_key(stretches.select("conv_id", "block", "costs", "ranks"), ["conv_id"], ["block"], _links, "block long, before int, way int")
    # A block holds the stretches of many conversations, each once.
    joined = stretches.join(links.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "before", "way"), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    return joined.select("conv_id", F.shiftleft("block", BLOCK).alias("at"), "faults", "before", F.expr("get(audits, way)").alias("audit"))


def _replay(members: Iterator[tuple], counts: Counter) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of a conversation's stretches and rows in order, the text turns only; deleted rows have no role. Fills the counts."""
    state, letters, faults = EMPTY, iter(()), iter(())
    before, turns = None, []

    def inserted() -> tuple[str, str, str]:
        nonlocal state
        ((name, state),) = [(n, to) for n, to in STEPS[state].items() if n in NAMES]
        counts["cost"] += INSERT
        return "I", NAMES[name], ""

    for _, _, kind, fault_string, audit, turn, role, text in members:
        if kind == 0:  # the conversation itself
            continue
        if kind == 1:
            letters, faults = iter(audit), iter(fault_string)
            continue
        initial, fault = role[:1], next(faults)
        counts[fault] += 1
        counts["illegal"] += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        if turn is not None and (not turns or turns[1] != turn):
            turns = [turns[0] if turns else turn, turn]
            counts["turns"] += 1
            counts["gaps"] = turns[1] - turns[0] + 1 - counts["turns"]
        while (edit := next(letters)) == "I":
            yield inserted()
        if edit == "D":
            counts["cost"] += DROP
            yield "D", "", ""
            continue
        counts["cost"] += TRUNCATED * (fault == "t") + RELABEL * (edit == "R")
        if edit == "K":
            state = STEPS[state][initial]
        else:
            ((name, state),) = [(n, to) for n, to in STEPS[state].items() if n in NAMES]
            role = NAMES[name]
        yield edit, role, text
    for _ in CLOSING[state]:
        yield inserted()


def _summary(key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    counts, audit, hashed, some = Counter(), [], sha256(), False
    for edit, role, text in _replay(members, counts):
        audit.append(edit)
        if edit != "D":
            hashed.update(f"{chr(10) * some}{role}:{text}".encode())
            some = True
    yield *key, counts["gaps"], counts["b"], counts["d"], counts["t"], counts["illegal"], counts["cost"], "".join(audit), hashed.hexdigest()


def _turns(key: tuple, members: Iterator[tuple]) -> Iterator[tuple]:
    kept = ((role, text) for edit, role, text in _replay(members, Counter()) if edit != "D")
    for n, (role, text) in enumerate(kept):
        yield *key, n, role, text


def _replayed(rows: DataFrame, of: Of, fields: str, conversations: DataFrame | None = None) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    t = placed(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *text), "conv_id", [F.asc_nulls_first("turn"), F.col("role"), F.col("text")])
    edits = _edits(t).select("conv_id", "at", F.lit(1).alias("kind"), "faults", "audit")
    parts = [t.select("conv_id", "at", F.lit(2).alias("kind"), "turn", "role", "text"), edits]
    if conversations is not None:
        parts.append(conversations.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind")))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select("conv_id", "at", "kind", "faults", "audit", "turn", "role", "text")
    return _by_key(whole, ["conv_id"], ["at", "kind"], of, fields)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations: further ids (conv_id) that get a row even if they have no rows left.
    """
    fields = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _replayed(rows, _summary, fields, conversations)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), role, text."""
    return _replayed(rows, _turns, "turn long, role string, text string")
