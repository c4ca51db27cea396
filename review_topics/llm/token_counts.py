"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton of the vocabulary lists the pieces that end at each character; a dynamic program carries the best
score and its number of pieces. Ties follow the tokenizer: of equal scores at one place, the piece that starts first stays.
A character that is no piece of its own may be an unknown, scored UNKNOWN_PENALTY below the worst piece, and counts as its
UTF-8 bytes, or without byte fallback as one token together with the unknowns next to it. Where no piece holds a blank behind another character, every best path passes between words, so words are
counted one by one and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.llm import words

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000
CACHE_CHARS = 64
MAX_PIECES = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``byte_fallback`` counts an unknown character as its bytes, else a run of them is one token."""

    scores: dict[str, float]
    byte_fallback: bool = True

    def __post_init__(self):
        if len(self.scores) > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")


def read_sentencepiece(path: str) -> Vocabulary:
    """Ordinary pieces and scores of a sentencepiece file; control, unknown and byte pieces match no text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte)
    ordinary = [i for i in range(model.get_piece_size()) if not any(test(i) for test in special)]
    has_bytes = any(model.is_byte(i) for i in range(model.get_piece_size()))
    return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in ordinary}, has_bytes)


class Counter(dict):
    """Counts by word; a word not seen yet is counted by the dynamic program."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.fallback = vocabulary.byte_fallback
        self.unknown = min(vocabulary.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in vocabulary.scores if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.scores:
            self.automaton.make_automaton()
        # A run of unknowns may go on into the next word where a blank can be one of them and the run counts once.
        inner = any(BLANK in p.lstrip(BLANK) for p in vocabulary.scores) or (not self.fallback and BLANK not in self.single)
        self.cut = re.compile("(?s:.+)" if inner else f"{BLANK}+[^{BLANK}]*")

    def best(self, word: str) -> int:
        """Number of pieces on the best path through ``word``."""
        n = len(word)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list = [None] * n
        if len(self.automaton):
            for end, found in self.automaton.iter(word):
                if ends[end] is None:
                    ends[end] = []
                ends[end].append(found)
        for end in range(n):
            best, pieces, lost = None, 0, False
            for length, own in ends[end] or ():  # the longest, which starts first, comes first
                total = score[end + 1 - length] + own
                if best is None or total > best:
                    best, pieces = total, count[end + 1 - length] + 1
            if word[end] not in self.single:
                total = score[end] + self.unknown
                if best is None or total > best:
                    own = len(word[end].encode("utf-8", "replace")) if self.fallback else not unknown[end]
                    best, pieces, lost = total, count[end] + own, True
            score[end + 1], count[end + 1], unknown[end + 1] = best, pieces, lost
        return count[n]

    def __missing__(self, word: str) -> int:
        found = self.best(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.cut.findall(BLANK + text.replace(" ", BLANK))))


def count_tokens(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n_tokens)`` for each row: tokens of the whole text, with a blank before it, blanks kept as they are.

    A null or empty text has no tokens. Repeated rows are counted again, a null doc_id stays, other columns are ignored,
    and an empty table gives an empty result. Memory is bounded by CACHE_WORDS and by the longest word.
    """
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for batch in batches:
            for part in words.sub_batches(batch, "text", 4 << 20):
                counts = np.fromiter((counter.count(t) for t in part.column("text").to_pylist()), np.int64, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts)], names=["doc_id", "n_tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long")
