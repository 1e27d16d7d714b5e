"""Token counts of a unigram vocabulary by a count-only Viterbi pass.

Text is cut in front of every blank, which becomes the mark U+2581; a mark is also put
before a text that does not begin with one. An Aho-Corasick automaton enumerates all
vocabulary matches of a word by their ends, and the best score and its number of tokens
are carried to each end; no path is kept. The tie rule is that of unigram tokenizers:
of equal scores the piece that begins first wins, which is the longer one. A character
that is no piece costs ten less than the least score and counts as its UTF-8 bytes if
the vocabulary has byte pieces, else a row of such characters counts as one.

Scores are added as 64-bit floats. Distinct words are worked out once and remembered,
up to a bound.

Defined results: null and empty texts have no tokens and score 0. Repeated rows are
counted each. Columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import schema_with, with_arrays

MARK = "▁"
UNKNOWN_PENALTY = 10.0


class UnigramCounter:
    """Counts tokens under ``(piece, score)`` pairs."""

    def __init__(self, pieces: list[tuple[str, float]], limit: int = 250_000) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for text, score in pieces:
            if text:
                self.automaton.add_word(text, (len(text), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in self.automaton for b in range(256))
        self.limit = limit
        self.seen: dict[str, tuple[int, float]] = {}

    def word(self, text: str) -> tuple[int, float]:
        """Tokens and score of the best segmentation of a word."""
        size = len(text)
        score, count, last_unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        matches = self.automaton.iter(text)
        end, (length, value) = next(matches, (size, (0, 0.0)))
        for at in range(size):  # the best way to at + 1
            best, n, unknown, single = None, 0, False, False
            while end == at:  # longest first
                begin = at + 1 - length
                total = score[begin] + value
                if best is None or total > best:
                    best, n = total, count[begin] + 1
                single = single or length == 1
                end, (length, value) = next(matches, (size, (0, 0.0)))
            if not single:
                total = score[at] + self.unknown
                if best is None or total > best:
                    cost = len(text[at].encode()) if self.bytes else 0 if last_unknown[at] else 1
                    best, n, unknown = total, count[at] + cost, True
            score[at + 1], count[at + 1], last_unknown[at + 1] = best, n, unknown
        return count[size], score[size]

    def _missed(self, word: str) -> tuple[int, float]:
        if len(self.seen) >= self.limit:
            self.seen.clear()
        self.seen[word] = found = self.word(MARK + word)
        return found

    def text(self, text: str) -> tuple[int, float]:
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:
            words = words[1:]  # no mark is added to a text that begins with one, nor to an empty one
        known, missed = self.seen.get, self._missed
        tokens, total = 0, 0.0
        for word in words:
            n, score = known(word) or missed(word)
            tokens += n
            total += score
        return tokens, total


@lru_cache(maxsize=2)
def counter(model_path: str) -> UnigramCounter:
    """A counter over the pieces and scores of a SentencePiece model file."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return UnigramCounter([(lib.id_to_piece(i), lib.get_score(i)) for i in range(lib.vocab_size())])


def count_tokens(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and the ``score`` of the best segmentation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = counter(model_path)
        for batch in batches:
            found = [work.text(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield with_arrays(batch, [("n_tokens", pa.array([n for n, _ in found], pa.int64())),
                                      ("score", pa.array([s for _, s in found], pa.float64()))])

    return docs.mapInArrow(run, schema_with(
        docs, T.StructField("n_tokens", T.LongType(), False), T.StructField("score", T.DoubleType(), False)))
