"""Language identification of mixed-language text.

Words are runs of letters. A word's script (by code point range) narrows the languages to
those that wrote at least ``SCRIPT_SHARE`` of their training letters in it (all, if none did).
A word's score per language is the sum of its character trigrams' log-probabilities
(hashed into ``BUCKETS`` buckets). Viterbi over the words with a penalty for each change of
language labels every word; spans are runs of words with one label. A document's language is
the one that labels most of its letters (ties: first by code point) and its score the share of
those letters.

Scale: training sums trigram counts inside each task, then per (language, bucket); the
driver receives at most languages x (``BUCKETS`` + scripts) counts. Prediction is one
map-only pass; long texts are scored in pieces cut between words.

Defined results: null text, text without letters, or an empty training set give ``und``
with score 0 and no spans; rows with null text, null language or null id are never learned from. Repeated
rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
SWITCH_PENALTY = 16.0  # nats
SCRIPT_SHARE = 0.01
SMOOTHING = 0.2
PIECE = 1 << 20  # characters counted at a time; scored: as many with four languages, fewer with more
GROUP = 1 << 24  # characters labelled at a time, likewise, but for one longer text

# Script ranges, first and last code point.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}
N_SCRIPTS = len(SCRIPTS) + 1  # the last is any other script


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: script number + 1 for letters, 0 for others; lower-case letter."""
    script = np.full(0x110000, N_SCRIPTS, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            script[first : last + 1] = i + 1
    script[[not chr(c).isalpha() for c in range(0x110000)]] = 0
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(script).tolist():
        if len(small := chr(c).lower()) == 1:
            lower[c] = ord(small)
    return script, lower


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _trigrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket per letter; first letter, start, length and script of every word."""
    script, lower = _tables()
    kind = script[codes]
    c = np.zeros(len(codes) + 2, np.uint64)
    c[1:-1] = np.where(kind > 0, lower[codes], 0)
    at = np.flatnonzero(kind)
    h = c[at] * np.uint64(0x9E3779B97F4A7C15) + c[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[at + 2] * np.uint64(0x165667B19E3779F9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    length = np.diff(np.r_[first, len(at)])
    return (h >> np.uint64(48)).astype(np.int64), first, at[first], length, kind[at[first]] - 1


def _share(size: int, languages: int) -> int:
    """``size`` for up to four languages, less in proportion for more, so that score tables stay as large."""
    return max(1, size * 4 // max(4, languages))


def _pieces(codes: np.ndarray, size: int = PIECE):
    """(offset, piece) of a text, cut where no letter stands, ``size`` characters or a little more each."""
    script, _ = _tables()
    start = 0
    while len(codes) - start > size:
        end = start + size
        while end < len(codes) and script[codes[end]]:
            end += 1
        yield start, codes[start:end]
        start = end
    yield start, codes[start:]


def _decode(x) -> str:
    return bytes(x.as_buffer()).decode("utf-8", "replace") if x.is_valid else ""


def _count(batches):
    """(lang, slot, n): trigram counts by bucket, then letter counts by script."""
    totals: dict[str, np.ndarray] = {}

    def rows():
        for lang, total in totals.items():
            slot = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(total[slot])], ["lang", "slot", "n"]
            )
        totals.clear()

    for batch in batches:
        for x, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            if lang not in totals and len(totals) >= 64:
                yield from rows()
            total = totals.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
            for _, piece in _pieces(_codes(_decode(x))):
                bucket, _, _, length, script = _trigrams(piece)
                total[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(script, weights=length, minlength=N_SCRIPTS).astype(np.int64)
    yield from rows()


class LanguageModel:
    """Trigram log-probabilities [bucket, language] and the languages of each script."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)  # code point order
        n = np.array([counts[lang] for lang in self.langs], float).reshape(len(self.langs), BUCKETS + N_SCRIPTS)
        p = n[:, :BUCKETS] + SMOOTHING
        self.log_p = np.ascontiguousarray(np.log(p / p.sum(axis=1, keepdims=True)).T.astype(np.float32))
        letters = n[:, BUCKETS:]
        share = letters / np.maximum(1, letters.sum(axis=1, keepdims=True))
        allowed = (share >= SCRIPT_SHARE).T  # [script, language]
        allowed[~allowed.any(axis=1)] = True
        self.barred = np.where(allowed, 0, -1e6).astype(np.float32)

    def words(self, codes: np.ndarray):
        """Scores [word, language], start and length of each word of one text."""
        parts = []
        for offset, piece in _pieces(codes, _share(PIECE, len(self.langs))):
            bucket, first, start, length, script = _trigrams(piece)
            if len(first):
                scores = np.add.reduceat(self.log_p[bucket], first, axis=0) + self.barred[script]
                parts.append((scores, start + offset, length))
        if not parts:
            return np.empty((0, len(self.langs)), np.float32), np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def label(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Viterbi label of every word; ``scores`` holds texts of ``sizes`` words one after another.

        All texts advance together, a word at a time, the longest first.
        """
        order = np.argsort(-sizes, kind="stable")
        begin = (np.cumsum(sizes) - sizes)[order]
        ordered = sizes[order]
        steps = int(ordered[0]) if len(ordered) else 0
        active = np.searchsorted(-ordered, -np.arange(steps), side="left")  # texts longer than step t
        came = np.empty(scores.shape, np.int16)
        own = np.arange(len(self.langs))
        value = np.zeros((len(ordered), len(self.langs)))
        for t in range(steps):
            k = active[t]
            rows = begin[:k] + t
            v = value[:k]
            if t:
                best = v.argmax(axis=1)
                top = v[np.arange(k), best][:, None] - SWITCH_PENALTY
                stay = v >= top
                came[rows] = np.where(stay, own, best[:, None])
                v = np.where(stay, v, top)
            value[:k] = v + scores[rows]
        out = np.empty(len(scores), np.int16)
        state = value.argmax(axis=1) if len(ordered) else np.empty(0, np.int64)
        for t in range(steps - 1, -1, -1):
            rows = begin[: active[t]] + t
            s = state[: active[t]]
            out[rows] = s
            if t:
                state[: active[t]] = came[rows, s]
        return out


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from the rows of ``docs`` where ``learn`` holds and id, text and language are not null."""
    rows = docs.where(learn & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts: dict[str, np.ndarray] = {}
    found = (
        rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("binary").alias("text"))
        .mapInArrow(_count, "lang string, slot long, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
    )
    for r in found.toLocalIterator():
        counts.setdefault(r["lang"], np.zeros(BUCKETS + N_SCRIPTS))[r["slot"]] = r["n"]
    return LanguageModel(counts)


def _predict(model: LanguageModel, texts: list[str]):
    """(language, score, spans) of each text; spans are (start, end, language) in code points."""
    parts = [model.words(_codes(t)) for t in texts]
    sizes = np.array([len(p[0]) for p in parts], np.int64)
    scores, start, length = (np.concatenate([p[i] for p in parts]) for i in range(3))
    label = model.label(scores, sizes).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = len(model.langs)
    letters = np.bincount(owner * n + label, weights=length, minlength=len(texts) * n).reshape(len(texts), n)
    top = letters.argmax(axis=1)
    cut = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    last = np.r_[cut[1:], len(owner)] - 1 if len(cut) else cut
    spans: list[list[dict]] = [[] for _ in texts]
    for d, s, e, k in zip(owner[cut].tolist(), start[cut].tolist(), (start + length)[last].tolist(), label[cut].tolist()):
        spans[d].append({"start": s, "end": e, "lang": model.langs[k]})
    for d, row in enumerate(spans):
        total = letters[d].sum()
        yield (model.langs[top[d]], float(letters[d, top[d]] / total), row) if total else ("und", 0.0, row)


def label_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, spans (array of start, end, lang)."""
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x (buckets + scripts) numbers
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def predict(batches):
        m = shared.value
        group = _share(GROUP, len(m.langs))
        for batch in batches:
            ids, out, held, chars = batch.column("doc_id"), [], [], 0
            for x in batch.column("text"):
                held.append(_decode(x))
                chars += len(held[-1])
                if chars >= group:
                    out += _predict(m, held) if m.langs else [("und", 0.0, [])] * len(held)
                    held, chars = [], 0
            if held:
                out += _predict(m, held) if m.langs else [("und", 0.0, [])] * len(held)
            lang, score, spans = zip(*out) if out else ((), (), ())
            columns = [ids, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "spans"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"
    )
