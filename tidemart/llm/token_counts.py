"""Token counts of a unigram tokenizer, without making the tokens.

Aho-Corasick enumerates the vocabulary's matches; dynamic programming over them carries the
best score and its number of pieces.  Ties follow the tokenizer: of equal scores the
path found first stays, and starts are tried from left to right, so the longest piece
that ends at a place wins.  A character without a piece of its own may be unknown; its
cost is the lowest score less ten, and it counts as its bytes (byte fallback) or, joined
with unknown neighbours, as one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemart.llm.shared import arrow_schema, record_batch, ship_package, text_of

SPACE = "▁"
#: What the tokenizer takes from the lowest score for an unknown character.
UNKNOWN_PENALTY = 10.0
#: Words whose result a worker remembers, and their length.
MEMORY, MEMORY_CHARS = 700_000, 40

_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*")


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool
    lowest: float  # score, over special pieces too

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Pieces and scores of a sentencepiece file, taken as a unigram vocabulary."""
        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        scores = [model.get_score(i) for i in ids]
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i)
                                        or model.is_unknown(i) or model.is_unused(i))]
        return cls(tuple((model.id_to_piece(i), scores[i]) for i in plain),
                   sum(map(model.is_byte, ids)) == 256, min(scores))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.unknown = vocabulary.lowest - UNKNOWN_PENALTY
        self.byte_fallback = vocabulary.byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # words are independent if no piece goes on after another character into a space, and
        # if scores add up without rounding: else a text's ties depend on all before them
        costs = [abs(x) for x in (self.unknown, *(score for _, score in vocabulary.pieces))]
        self.splits = all(x == int(x) for x in costs) and not any(
            re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in vocabulary.pieces)
        #: characters whose costs add up to less than 2 ** 53, so exactly
        self.exact_chars = int((1 << 53) / max(*costs, 1)) - 1
        self.memory: dict[str, tuple[float, int]] = {}

    def best(self, text: str) -> tuple[float, int]:
        """Best score of a normalised text and the number of its pieces."""
        n = len(text)
        scores, counts = [0.0] * (n + 1), [0] * (n + 1)
        unknown = [False] * (n + 1)
        found = self.automaton.iter(text)
        last, match = next(found, (n, None))
        for end in range(n):
            top, count, single = None, 0, False
            while last == end:  # the longest first
                size, score = match
                at = end + 1 - size
                if top is None or scores[at] + score > top:
                    top, count = scores[at] + score, counts[at] + 1
                single |= size == 1
                last, match = next(found, (n, None))
            if not single and (top is None or scores[end] + self.unknown > top):
                top = scores[end] + self.unknown
                if self.byte_fallback:
                    count = counts[end] + len(text[end].encode())
                else:
                    count = counts[end] + (not unknown[end])
                unknown[end + 1] = True
            scores[end + 1], counts[end + 1] = top, count
        return scores[n], counts[n]

    def count(self, text: str) -> tuple[float, int]:
        """Best score and number of pieces of a raw text."""
        if not text:
            return 0.0, 0
        if not self.splits or len(text) >= self.exact_chars:
            return self.best(SPACE + text.replace(" ", SPACE))
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            words = [u[1:] for u in _UNITS.findall(SPACE + text.replace(" ", SPACE))]
        else:
            words = text.split(" ")
        memory, score, n = self.memory, 0.0, 0
        for w in words:
            got = memory.get(w)
            if got is None:
                got = self.best(SPACE + w)
                if len(memory) < MEMORY and len(w) <= MEMORY_CHARS:
                    memory[w] = got
            score += got[0]
            n += got[1]
        return score, n


#: One counter in each worker process, kept from task to task.
_COUNTERS: dict[int, Counter] = {}


def counter(vocabulary: Vocabulary) -> Counter:
    key = zlib.crc32(repr(vocabulary).encode())
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(vocabulary)
    return _COUNTERS[key]


_COUNTS = "doc_id long, n_tokens long, best_score double"


def _count(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, made = arrow_schema(_COUNTS), counter(vocabulary.value)
        for batch in batches:
            found = [made.count(t) for t in batch.column(1).to_pylist()]
            yield record_batch(schema, batch.num_rows, doc_id=batch.column(0),
                               n_tokens=[n for _, n in found], best_score=[s for s, _ in found])
    return run


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, best_score for each row of ``docs`` (doc_id, text).  A text gets a
    space before it and spaces become the vocabulary's mark; null and empty texts have
    no tokens and score 0."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return (docs.select(F.col("doc_id").cast("long"), text_of(docs).alias("text"))
            .mapInArrow(_count(held), _COUNTS))
