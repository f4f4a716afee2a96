"""Token counts of a unigram tokenizer without building its tokens.

An Aho-Corasick automaton over the vocabulary lists all pieces that end at each character of a
word; one pass of dynamic programming carries, for each character, the best score and the
number of pieces of the best split. Equal scores keep the split whose last piece is longest, a
character that no piece covers costs ten less than the worst piece and counts its bytes, as
the tokenizer does.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, text_bytes

KNOWN_WORDS = 400_000
MARK = "▁"          # stands before every word
UNKNOWN_PENALTY = 10.0   # fixed by the tokenizer


def vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces of a public model with log probabilities by Zipf's law of their rank: its own
    scores are merge ranks, which no unigram model has."""
    import math

    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    norm = math.log(sum(1 / (i + 2.7) for i in range(size)))
    return [(model.id_to_piece(i), -math.log(i + 2.7) - norm) for i in range(size)]


class Counter:
    """Counts pieces of words; words are remembered up to a fixed number."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known: dict[bytes, int] = {}

    def pieces(self, word: str) -> int:
        """Number of pieces of the best split of one word; marks of its own part it."""
        if MARK not in word:
            return self._split(MARK + word)
        parts = word.removeprefix(MARK).split(MARK)
        return sum(self._split(MARK + part) for part in parts)

    def _split(self, text: str) -> int:
        n = len(text)
        ending: list[list] = [[] for _ in range(n + 1)]   # longest first
        for last, match in self.automaton.iter(text):
            ending[last + 1].append(match)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top, pieces, covered = None, 0, False
            for length, score in ending[end]:
                covered = length == 1
                score += best[end - length]
                if top is None or score > top:
                    top, pieces = score, count[end - length] + 1
            if not covered:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    top, pieces = score, count[end - 1] + len(text[end - 1].encode())
            best[end], count[end] = top, pieces
        return count[n]

    def total(self, words: list[bytes]) -> int:
        try:
            return sum(map(self.known.__getitem__, words))
        except KeyError:
            pass
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        for word in words:
            if word not in known:
                known[word] = self.pieces(word.decode("utf-8", "replace"))
        return sum(map(known.__getitem__, words))


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) of whole texts: words between white space, each after a mark.

    Null and empty texts have no words and no tokens. Texts of any length are split as a whole.
    Repeated rows and ids give a row each; null ids are kept. Other columns are not read. An
    empty table gives an empty one.
    """
    def counted(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        counter = Counter(pieces)
        for frame in frames:
            texts = [text.split() for text in frame["text"]]
            yield pd.DataFrame({
                "key": frame["key"], "n_words": np.array([len(t) for t in texts], np.int64),
                "n_tokens": np.array([counter.total(t) for t in texts], np.int64)})

    kind = docs.schema[id_column].dataType.simpleString()
    given = small_batches(docs).select(F.col(id_column).alias("key"), text_bytes(text_column).alias("text"))
    return given.mapInPandas(counted, f"key {kind}, n_words long, n_tokens long").withColumnRenamed("key", id_column)
