"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character, longest
first; dynamic programming carries the best score and the number of pieces of the best path.
Tie rules are those of unigram tokenizers: a candidate replaces the best one only with a
strictly larger score, so of equal paths the one whose last piece starts earliest stays; a
character without a piece of its own costs the least score minus 10. Scores are summed in
double precision from the left.

Text is first cut as unigram tokenizers' word-start pre-tokenizer does: each space becomes
``▁``, one is put in front unless there is one, and words start at each ``▁``. A worker keeps the
counts of words it has met (at most ``CACHE`` words of ``CACHED_LENGTH`` characters, then it
starts anew). A word of any length is read once, keeping only as many positions as the longest
piece has characters.

Defined results: null and empty texts have 0 tokens; unknown characters count one token a
UTF-8 byte with byte fallback, else one for each unbroken run on the best path. Repeated
rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE = 500_000
CACHED_LENGTH = 64  # characters; longer words are counted anew each time
UNKNOWN_PENALTY = 10.0
NO_MATCH = (-1, None)


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Counts the pieces of the best unigram segmentation of a text."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.reach = max((len(piece) for piece, _ in vocabulary), default=1)
        self.unknown = min((score for _, score in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of one word, which starts with ``▁``."""
        size = self.reach + 1  # positions back to the start of the longest piece, in turn
        score, count = [0.0] * size, [0] * size
        loose = False  # the best path so far ends in an unknown character
        matches = self.automaton.iter(word)
        at, match = next(matches, NO_MATCH)
        here = 0
        for end, character in enumerate(word):
            best, pieces, open_end, single = None, 0, False, False
            while at == end:
                length, value = match
                start = (end + 1 - length) % size
                total = score[start] + value
                if best is None or total > best:
                    best, pieces = total, count[start] + 1
                single = single or length == 1
                at, match = next(matches, NO_MATCH)
            if not single:
                total = score[here] + self.unknown
                if best is None or total > best:
                    best, open_end = total, True
                    if self.byte_fallback:
                        pieces = count[here] + len(character.encode("utf-8", "replace"))
                    else:
                        pieces = count[here] + (not loose)
            here = (end + 1) % size
            score[here], count[here], loose = best, pieces, open_end
        return count[here]

    def text(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(" ", SPACE).split(SPACE)
        if len(words) > 1 and not words[0]:
            del words[0]
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = self.word(SPACE + w)
                if len(w) <= CACHED_LENGTH:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = n
            total += n
        return total


_COUNTERS: dict = {}


def _counter(path: str, byte_fallback: bool) -> UnigramCounter:
    """One automaton and cache per worker and vocabulary file."""
    if (path, byte_fallback) not in _COUNTERS:
        _COUNTERS[path, byte_fallback] = UnigramCounter(read_vocabulary(path), byte_fallback)
    return _COUNTERS[path, byte_fallback]


def count_tokens(
    docs: DataFrame, vocabulary: str, byte_fallback: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens) per row. ``vocabulary`` is the path of a SentencePiece model on every machine."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        counter = _counter(vocabulary, byte_fallback)
        out = [counter.text(bytes(x.as_buffer()).decode("utf-8", "replace")) if x.is_valid else 0 for x in column]
        return pa.array(out, pa.int64())

    return docs.select(F.col(id_col).alias("doc_id"), count(F.col(text_col).cast("binary")).alias("n_tokens"))
