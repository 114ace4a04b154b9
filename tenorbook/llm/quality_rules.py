"""Quality rules: a decision list learned from labelled statistics and emitted as ordered Spark conditions.

Every text is reduced to counts (`statistics`). Sequential covering then looks for texts labelled 0: a rule is grown on two thirds
of the sample, threshold by threshold, each the one with the highest information gain, and pruned on the last third by
dropping its last thresholds while that does better there. A rule that is right often enough joins the list, the texts it covers leave the sample, and
the search goes on. `Rules.condition` is the list as one CASE over the counts, so scoring is a projection.

Learning uses labels of rows outside the held-out fifth only that pass the base rules, from a sample of at most `bound` rows (least hash of the key);
those rows' counts, not their texts, are what reaches the driver. All documents are counted and judged.

Null and empty texts have no words: all counts are 0 and the base rule (fewer than 10 words) rejects them. Repeated rows are
judged each, alike. Ids may be null (never learned from) or repeated; of several labels of one id the least counts. Without labels
no rule is learned and the base rules alone decide. Other columns are not looked at. Memory follows the longest single text, some
100 bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorbook.llm.common import Words, held_out, pieces, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_bars", "n_shouts", "n_stops")

#: What a rule may set a threshold on, over the counts.
MEASURES = {
    "words": "double(n_words)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "bars_per_word": "n_bars / greatest(n_words, 1)",
    "shouts_per_word": "n_shouts / greatest(n_words, 1)",
    "stops_per_word": "n_stops / greatest(n_words, 1)",
}

BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def _bytes(text: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(text.encode())] = True
    return table


_MARKS = {
    "n_symbols": _bytes("#*$%&|<>"), "n_upper": _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "n_digits": _bytes("0123456789"), "n_bars": _bytes("|"),
    "n_shouts": _bytes("!"), "n_stops": _bytes(".?!"),
}


def _per_text(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many are set between one offset and the next."""
    sums = np.zeros(len(found) + 1, np.int64)
    np.cumsum(found, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    return np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), return_inverse=True)[1]


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: lines with a word, and those among them that equal an earlier line."""
    split = pc.split_pattern(texts.fill_null(""), "\n")
    owner = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
    lines = split.flatten()
    worded = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    owner, codes = owner[worded], lines.dictionary_encode().indices.to_numpy()[worded]
    fresh = np.zeros(len(owner), bool)
    fresh[np.unique((owner.astype(np.uint64) << np.uint64(32)) | codes.astype(np.uint64), return_index=True)[1]] = True
    n = np.bincount(owner, minlength=len(split))
    return n, n - np.bincount(owner[fresh], minlength=len(split))


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """All COUNTS of each text. Windows are compared by exact numbers of words and pairs, not by hashes."""
    words = Words(texts)
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[words.begin] += 1
    edge[words.end] -= 1
    inside = np.cumsum(edge[:-1]).astype(bool)
    letters = words.data[inside]
    offsets = pa.py_buffer(np.r_[0, np.cumsum(words.end - words.begin)].astype(np.int64))
    spelled = pa.Array.from_buffers(pa.large_binary(), len(words.begin), [None, offsets, pa.py_buffer(letters.tobytes())])
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    name = _pair(owner, spelled.dictionary_encode().indices.to_numpy()) if len(owner) else owner
    out = {"n_words": words.counts}
    again = np.zeros(len(name) + 1, np.int64)
    if len(name) >= 5:  # names tell texts apart, so a window over the end of a text equals no other
        two = _pair(name[:-1], name[1:])
        five = _pair(_pair(two[:-2], two[2:])[: len(name) - 4], name[4:])
        many = np.flatnonzero(np.bincount(five)[five] > 1)
        again += np.bincount(many, minlength=len(again)) - np.bincount(many + 5, minlength=len(again))
    out["n_repeat_words"] = _per_text(np.cumsum(again)[:-1] > 0, words.upto)
    out["word_chars"] = _per_text(inside & ((words.data & 0xC0) != 0x80), words.offsets)
    out |= {n: _per_text(table[words.data], words.offsets) for n, table in _MARKS.items()}
    out["n_lines"], out["n_dup_lines"] = _lines(texts)
    return out


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the COUNTS of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = counts(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(found[n], pa.int64()) for n in COUNTS]], ["doc_id", *COUNTS])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in COUNTS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (measure, is at least, threshold)."""

    terms: tuple[tuple[str, bool, float], ...]

    def sql(self) -> str:
        return " AND ".join(f"{MEASURES[m]} {'>=' if up else '<'} double('{at!r}')" for m, up, at in self.terms)

    def __str__(self) -> str:
        return " and ".join(f"{m} {'>=' if up else '<'} {at:g}" for m, up, at in self.terms)


@dataclass(frozen=True)
class Rules:
    """An ordered list; the first rule that holds rejects a text."""

    rules: tuple[Rule, ...] = ()

    def condition(self) -> Column:
        """Number of the first rule that holds, from 1; 0 where none does."""
        cases = " ".join(f"WHEN {rule.sql()} THEN {n}" for n, rule in enumerate(self.rules, 1))
        return F.expr(f"CASE {cases} ELSE 0 END" if cases else "0")


def _cover(x: dict[str, np.ndarray], terms: list[tuple[str, bool, float]], rows: np.ndarray) -> np.ndarray:
    for m, up, at in terms:
        rows = rows[(x[m][rows] >= at) == up]
    return rows


def _best_term(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[float, tuple[str, bool, float] | None]:
    """The threshold with the highest gain: texts labelled 0 that stay, times the bits by which they get less rare."""
    best: tuple[float, tuple[str, bool, float] | None] = (1e-9, None)
    all_p, all_n = bad[rows].sum(), len(rows)
    for m in MEASURES:
        order = rows[np.argsort(x[m][rows], kind="stable")]
        value = x[m][order]
        cut = np.flatnonzero(value[1:] > value[:-1]) + 1  # rows below the cut
        if not len(cut):
            continue
        below = np.cumsum(bad[order])[cut - 1]
        for up, p, n in ((False, below, cut), (True, all_p - below, all_n - cut)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(all_p / all_n)), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                low, high = float(value[cut[k] - 1]), float(value[cut[k]])
                short = float(f"{(low + high) / 2:.4g}")
                best = (float(gain[k]), (m, up, short if low < short <= high else high))
    return best


def cover(x: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 24, most_terms: int = 4, least_right: float = 0.9, least_covered: int = 4) -> Rules:
    """Grows and prunes rules for rows marked bad until none passes. x: an array per measure.

    A pruned rule is kept if at least `least_right` of what it covers is bad, in both parts together and in the pruning part, and it covers
    `least_covered` bad rows. Each third row is for pruning.
    """
    left, rules = np.arange(len(bad)), []
    while len(rules) < most_rules and bad[left].any():
        grow, prune = left[left % 3 != 0], left[left % 3 == 0]
        terms: list[tuple[str, bool, float]] = []
        rows = grow
        while len(terms) < most_terms and len(rows) and not bad[rows].all():
            _, term = _best_term(x, bad, rows)
            if term is None:
                break
            terms.append(term)
            rows = _cover(x, [term], rows)

        def worth(n: int) -> tuple[float, int]:
            on = bad[_cover(x, terms[:n], prune)]
            return (2 * on.sum() - len(on)) / max(len(on), 1), -n

        if not terms:
            break
        terms = terms[: max(range(1, len(terms) + 1), key=worth)]
        covered = _cover(x, terms, left)
        checked = bad[covered[covered % 3 == 0]]
        if bad[covered].sum() < max(least_covered, least_right * len(covered)) or checked.sum() < least_right * len(checked):
            break
        # Of several thresholds on one side of a measure the last is the tightest.
        rules.append(Rule(tuple({(m, up): (m, up, at) for m, up, at in terms}.values())))
        left = np.setdiff1d(left, covered)
    return Rules(tuple(rules))


def learn(known: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", bound: int = 20_000) -> Rules:
    """Rules from at most `bound` labelled rows outside the held-out fifth; known: doc_id and counts."""
    marks = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("_key")).agg((F.min(label) <= 0).alias("_bad"))
    passed = known.filter(f"NOT ({BASE_FAILED})")
    rows = passed.join(marks, F.col("doc_id") == F.col("_key")).select(F.xxhash64("doc_id").alias("_hash"), "_bad", *[F.expr(e).alias(m) for m, e in MEASURES.items()])
    sample = rows.orderBy("_hash", "_bad", *MEASURES).limit(bound).toArrow()
    return cover({m: sample[m].to_numpy() for m in MEASURES}, sample["_bad"].to_numpy().astype(bool))


def judged(known: DataFrame, rules: Rules) -> DataFrame:
    """Rows with counts plus base_failed, kept and the number of the rule that rejects (0: none)."""
    rule = rules.condition()
    return known.select("*", F.expr(BASE_FAILED).alias("base_failed"), rule.alias("rule")).withColumn("kept", F.expr("NOT base_failed AND rule = 0"))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts every document, learns from the labelled ones and judges all."""
    known = stored(statistics(docs, key, text))
    return judged(known, learn(known, labels, key=key))
