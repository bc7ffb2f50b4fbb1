"""Token counts of a unigram tokenizer without building the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character; going
over them in order, a dynamic program keeps the best score that reaches the character and
the number of pieces on that path.  Nothing else is stored.

Ties are those of the public ``Unigram`` model: of equal scores the piece that starts
first wins, a character that is no piece by itself may also be passed as unknown, ten below
the lowest score, and that comes last.  Unknown stretches cost their UTF-8 bytes with byte
fallback, one piece otherwise.

A text is read as ``▁`` (for the start and for every space) and its other characters.  If
no piece holds ``▁`` after another character, no piece crosses the start of a run of
``▁``, and the text is counted run by run; tasks remember counts of short runs.

Null and empty texts have no tokens.  Null and repeated ids and extra columns change
nothing; a column called ``n_tokens`` is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tillstream.llm.common import append_arrow

SPACE = "▁"
# Fixed value: how far below the lowest score an unknown character lies.
UNKNOWN_PENALTY = 10.0
REMEMBERED = 1 << 19
REMEMBERED_CHARS = 64


@dataclass
class Vocabulary:
    """Pieces with scores, as a unigram tokenizer has them."""

    pieces: list[tuple[str, float]]
    unknown: str | None = None
    byte_fallback: bool = False

    @classmethod
    def from_sentencepiece(cls, path: str) -> "Vocabulary":
        """Pieces and scores of a model file."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
        bytes_there = all(f"<0x{b:02X}>" in dict(pieces) for b in range(256))
        return cls(pieces, model.id_to_piece(model.unk_id()), bytes_there)

    @cached_property
    def separable(self) -> bool:
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in self.pieces)
        return not crossing and any(p == SPACE for p, _ in self.pieces)

    @cached_property
    def automaton(self):
        from ahocorasick import Automaton

        found = Automaton()
        for piece, score in self.pieces:
            if piece:
                found.add_word(piece, (len(piece), score, piece == self.unknown))
        found.make_automaton()
        return found


class Counter:
    """Counts tokens of texts; one for each task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.seen: dict[str, int] = {}
        self.runs = re.compile(f"{SPACE}+[^{SPACE}]*")

    def viterbi(self, text: str) -> int:
        """Pieces on the best path through a text."""
        n, fallback = len(text), self.vocabulary.byte_fallback
        score = [0.0] * (n + 1)
        count = [0] * (n + 1)
        #: Of a path that ends in unknown pieces, which the model makes one stretch: the
        #: count before the stretch, its bytes, and whether it is the unknown piece itself.
        stretch: dict[int, tuple[int, int, bool]] = {}
        matches = self.vocabulary.automaton.iter(text)
        held = next(matches, None)
        for end in range(1, n + 1):
            best, start, unknown, single = None, end - 1, False, False
            while held is not None and held[0] == end - 1:
                size, value, is_unknown = held[1]
                candidate = score[end - size] + value
                single = single or size == 1
                if best is None or candidate > best:
                    best, start, unknown = candidate, end - size, is_unknown
                held = next(matches, None)
            named = unknown
            if not single:
                candidate = score[end - 1] + self.unknown
                if best is None or candidate > best:
                    best, start, unknown, named = candidate, end - 1, True, False
            score[end] = best
            if unknown:
                before, size, _ = stretch.get(start, (count[start], 0, True))
                size += len(text[start:end].encode())
                named = named and start not in stretch
                stretch[end] = before, size, named
                count[end] = before + (size if fallback and not named else 1)
            else:
                count[end] = count[start] + 1
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.vocabulary.separable or not self.vocabulary.byte_fallback:
            return self.viterbi(marked)
        seen, total = self.seen, 0
        for run in self.runs.findall(marked):
            known = seen.get(run)
            if known is None:
                known = self.viterbi(run)
                if len(run) <= REMEMBERED_CHARS:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[run] = known
            total += known
        return total


def token_counts(docs: DataFrame, vocabulary: Vocabulary, drop: tuple[str, ...] = ()) -> DataFrame:
    """Every document with ``n_tokens``."""
    # The automaton is built in the task; what is sent is the list of pieces.
    plain = Vocabulary(vocabulary.pieces, vocabulary.unknown, vocabulary.byte_fallback)
    sent = docs.sparkSession.sparkContext.broadcast(plain)

    def make():
        import pyarrow as pa

        counter = Counter(sent.value)

        def step(batch):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            return [pa.array([counter.count(t or "") for t in texts], pa.int64())]

        return step

    return append_arrow(docs, make, "n_tokens long", drop)
