"""Token counts of a unigram tokenizer without making tokens: count-only Viterbi.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character of a word; dynamic programming carries the
best score up to each character and how many pieces it took. Tie rules are the tokenizer's: of equal scores, the piece that
begins first wins; a character without a piece of its own may be unknown, at ten below the least score of the
vocabulary; a run of unknown characters is one unknown, spelled in bytes if the vocabulary has byte pieces.
As in the tokenizer, spaces become word marks and words are segmented apart, so a word's count is kept and used again.

Null and empty texts have 0 tokens. Keys may be null and rows repeated. The vocabulary's path is a parameter. A text of any length is counted
word by word; a worker's memory follows the longest stretch without a space, some 60 bytes per character, and is otherwise bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words remembered by a worker at most, then it forgets them all; longer words than so many characters are not remembered.
REMEMBERED, SHORT = 400_000, 48


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, in order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], unknown: str = "<unk>"):
        self.automaton = ahocorasick.Automaton()
        self.known = {piece for piece, _ in pieces}
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.penalty = min((s for _, s in pieces), default=0.0) - 10.0
        self.spelled = all(f"<0x{k:02X}>" in self.known for k in range(256))
        self.memory: dict[str, int] = {}

    def unknowns(self, run: str) -> int:
        return len(run.encode()) if self.spelled and run not in self.known else 1

    def word(self, word: str) -> int:
        n = len(word)
        score: list[float | None] = [None] * (n + 1)
        count, run = [0] * (n + 1), [-1] * (n + 1)  # run: where the unknown run that ends here begins
        score[0], at, single = 0.0, 0, False

        def close(end: int) -> None:  # all pieces that end here are seen; the unknown is the last to begin
            here = score[end - 1] + self.penalty
            if not single and (score[end] is None or here > score[end]):
                score[end], count[end] = here, count[end - 1]
                run[end] = run[end - 1] if run[end - 1] >= 0 else end - 1

        for last, (size, gain) in self.automaton.iter(word):
            end = last + 1
            while at < last:
                at += 1
                close(at)
                single = False
            begin = end - size
            single = single or size == 1
            here = score[begin] + gain
            if score[end] is None or here > score[end]:
                score[end] = here
                count[end] = count[begin] + 1 + (self.unknowns(word[run[begin] : begin]) if run[begin] >= 0 else 0)
                run[end] = -1
        while at < n:
            at += 1
            close(at)
            single = False
        return count[n] + (self.unknowns(word[run[n] :]) if run[n] >= 0 else 0)

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(" ", MARK).split(MARK)
        words = words[1:] if not words[0] else words
        memory = self.memory
        total = 0
        for word in words:
            known = memory.get(word)
            if known is None:
                known = self.word(MARK + word)
                if len(word) <= SHORT:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    memory[word] = known
            total += known
        return total


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and n_tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces)
        for batch in batches:
            counts = [counter.text(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long")
