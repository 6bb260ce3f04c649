"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick 5 of up to 8 neighbouring tokens and ignore the others; the hashes of a
document's and of a benchmark item's tokens under the same mask are joined, and each hit is
verified on its diagonal: the aligned tokens must hold a stretch of at least ``MIN_TOKENS``
tokens (or the whole item, if it has fewer) of which ``SIMILARITY`` or more are equal. A
stretch of 10 to 19 tokens, 80% or more equal, is hit by a mask wherever the substitutions are (tested
exhaustively); a longer one can be cut into two of which one is as equal. An item of one to four tokens, too
short for a mask, is looked up as a whole by a seed of its own length. Tokens are runs of letters and digits, lower-cased, so
punctuation and case don't matter; in scripts that set no spaces every character is a token.

Scale: one map-only pass over the documents. The items travel to the tasks in blocks of at
most ``BLOCK_TOKENS`` tokens (the proven bound of what is broadcast); a larger benchmark takes
one pass per block, and the results are united. Documents are never shuffled.

Defined results: null and empty texts never match; items without a token match nothing; repeated documents or items each
give their own rows; item ids of any type, null too, are kept. Of several stretches of one item that with the most equal tokens is
reported, then the longer one, then the first. An empty table on either side gives no rows. Very long texts are cut into
tokens a window of 1 MB at a time and hold four bytes a token. Extra columns are ignored or, in ``drop_leaks``, kept.
A one-word item matches every document with that word: leave such items out of the benchmark.
"""

from __future__ import annotations

import re
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import release, save, windows

# Places of the five tokens that each mask keeps.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
MIN_TOKENS = 10
SIMILARITY = 0.8
BLOCK_TOKENS = 1 << 21
# Thai, Lao, Myanmar, Khmer, Hiragana and Katakana, and the ideographs.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_TOKEN = re.compile(f"[{_UNSPACED}]|[^\\W_{_UNSPACED}]+")
_SPACED_TOKEN = re.compile(r"[^\W_]+")
_HIGH = re.compile(rb"[\xe0-\xff]")  # first byte of a character from U+0800 on
_CHUNK = 1 << 20  # tokens hashed, and hits held, at a time
_SHIFT, _MIDDLE = 40, 1 << 39  # an item and a diagonal in one number


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _tokens_of(part: bytes) -> list[str]:
    """``tokens`` of UTF-8; texts without a character of an unspaced script, by far the most, take a simpler pattern."""
    text = part.decode("utf-8", "replace")
    return tokens(text) if _HIGH.search(part) else _SPACED_TOKEN.findall(text.lower())


def _seed_hashes(ids: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the kept tokens at every start; 0 where one of them is unknown (id 0)."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    h, known = np.full(n, mask[-1] * 64 + len(mask), np.uint64), np.ones(n, bool)
    for place in mask:
        own = ids[place : place + n].astype(np.uint64)
        known &= own > 0
        h = (h ^ own) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    h[~known] = 0
    return h


def _distinct(held: list[np.ndarray]):
    """(item, diagonal) of every distinct number."""
    found = np.unique(np.concatenate(held)) if held else np.empty(0, np.int64)
    yield from zip((found >> _SHIFT).tolist(), ((found & (2 * _MIDDLE - 1)) - _MIDDLE).tolist())


class Benchmark:
    """Seed index of one block of items."""

    def __init__(self, items: list[tuple[object, str]], copies: list[int] | None = None):
        """Items as (id, text), each standing for so many equal rows."""
        texts = [tokens(t or "") for _, t in items]
        self.item_ids = [i for i, _ in items]
        self.copies = np.array(copies or [1] * len(items), np.int64)
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        self.items = [np.array([self.vocabulary[w] for w in t], np.uint32) for t in texts]
        self.seeds = []
        lengths = {len(t) for t in texts if 0 < len(t) < len(MASKS[0])}
        self.masks = [*(m for m in MASKS if any(len(t) >= len(MASKS[0]) for t in texts)), *(tuple(range(n)) for n in sorted(lengths))]
        for mask in self.masks:
            fits = [len(ids) >= len(mask) if len(mask) == len(MASKS[0]) else len(ids) == len(mask) for ids in self.items]
            hashes = [_seed_hashes(ids if fit else ids[:0], mask) for ids, fit in zip(self.items, fits)]
            key = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
            place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
            order = np.argsort(key, kind="stable")
            sieve = np.zeros(1 << 20, bool)
            sieve[(key >> np.uint64(44)).astype(np.int64)] = True
            self.seeds.append((key[order], item[order], place[order], sieve))

    def _hits(self, ids: np.ndarray):
        """(item, diagonal) of every seed shared by the document and an item.

        Pairs are gathered and made distinct ``_CHUNK`` at a time, so a passage that many items and
        many places of the document share takes bounded memory.
        """
        known = np.count_nonzero(ids)
        held: list[np.ndarray] = []
        for mask, (key, item, place, sieve) in zip(self.masks, self.seeds):
            if known < len(mask):
                continue
            for offset in range(0, len(ids), _CHUNK):
                h = _seed_hashes(ids[offset : offset + _CHUNK + mask[-1]], mask)
                at = np.flatnonzero(sieve[(h >> np.uint64(44)).astype(np.int64)] & (h != 0))
                low = np.searchsorted(key, h[at], "left")
                many = np.searchsorted(key, h[at], "right") - low
                cuts = np.searchsorted(np.cumsum(many), np.arange(_CHUNK, many.sum(), _CHUNK))
                for first, n, start in zip(np.split(low, cuts), np.split(many, cuts), np.split(at + offset, cuts)):
                    rows = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    held.append(np.unique((item[rows] << _SHIFT) + np.repeat(start, n) - place[rows] + _MIDDLE))
                    if sum(map(len, held)) > _CHUNK:
                        yield from _distinct(held)
                        held = []
        yield from _distinct(held)

    def overlaps(self, text: str | bytes) -> list[tuple[int, int, int, int]]:
        """(item number, first token, tokens, equal tokens) of the best stretch per item, where it is long enough."""
        get = self.vocabulary.get
        parts = map(_tokens_of, windows(text.encode() if isinstance(text, str) else text))
        ids = np.concatenate([np.fromiter(map(get, own, repeat(0)), np.uint32, len(own)) for own in parts])
        best: dict[int, tuple[int, int, int]] = {}
        for item, diagonal in self._hits(ids):
            own = self.items[item]
            low, high = max(0, -diagonal), min(len(own), len(ids) - diagonal)
            if high - low < min(MIN_TOKENS, len(own)):
                continue
            equal = own[low:high] == ids[low + diagonal : high + diagonal]
            start, n, same = best_stretch(equal)
            if same >= SIMILARITY * n:
                row = (same, n, -(start + low + diagonal))
                best[item] = max(best.get(item, row), row)
        return [(item, -at, n, same) for item, (same, n, at) in sorted(best.items())]


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, length, equals) of the best stretch of ``MIN_TOKENS`` tokens or more (all, if there are fewer).

    The best has the most equals minus four times the differences: 0 or more where any stretch is 80% equal.
    """
    least = min(MIN_TOKENS, len(equal))
    gain = np.r_[0, np.cumsum(np.where(equal, 1, -4))]
    floor = np.minimum.accumulate(gain[: len(gain) - least])
    last = int((gain[least:] - floor).argmax())
    start, end = int(gain[: last + 1].argmin()), last + least
    return start, end - start, int(equal[start:end].sum())


def benchmark_blocks(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS):
    """The items in blocks of about ``block_tokens`` tokens, dealt by hash, one on the driver at a time.

    Equal rows are one item with a count, so that they can't fill a block.
    """
    items = benchmark.groupBy(F.col("item_id"), F.col("text").cast("string").alias("text")).agg(F.count("*").alias("copies"))
    items = save(items, "benchmark")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / 2 / block_tokens))  # a token takes two characters at least, with its gap
    placed = items.withColumn("block", F.expr(f"pmod(xxhash64(item_id, text), {blocks})"))
    for k in range(blocks):
        rows = placed.where(F.col("block") == k).collect()
        yield Benchmark([(r["item_id"], r["text"]) for r in rows], [r["copies"] for r in rows])


def _bytes(x) -> bytes:
    return x.as_buffer().to_pybytes() if x.is_valid else b""


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, first_token, n_tokens, n_equal, similarity."""
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = ids.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType
    names = ["doc_id", "item_id", "first_token", "n_tokens", "n_equal", "similarity"]
    out = None
    for block in benchmark_blocks(benchmark, block_tokens):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def match(batches, shared=shared):
            b = shared.value
            for batch in batches:
                rows = [(d, *o) for d, x in enumerate(batch.column("text")) for o in b.overlaps(_bytes(x))]
                d, item, start, n, same = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 5
                columns = [
                    batch.column("doc_id").take(pa.array(d)),
                    pa.array([b.item_ids[i] for i in item.tolist()], to_arrow_type(item_type)),
                    *(pa.array(c) for c in (start, n, same)),
                    pa.array(same / np.maximum(n, 1)),
                    pa.array(b.copies[item]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*names, "copies"])

        rows = ids.mapInArrow(
            match,
            f"doc_id {kind}, item_id {item_type.simpleString()}, first_token long, n_tokens long, n_equal long, similarity double, copies long",
        )
        rows = rows.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select(*names)
        out = rows if out is None else out.union(rows)
    return out


def _leaks(block) -> Column:
    @F.arrow_udf("boolean")
    def leaks(column: pa.Array) -> pa.Array:
        found = pa.array([bool(block.value.overlaps(_bytes(x))) for x in column], pa.bool_())
        release()
        return found

    return leaks


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows of ``docs`` without a leaked item; columns are unchanged."""
    for block in benchmark_blocks(benchmark, block_tokens):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.where(~_leaks(shared)(F.col(text_col).cast("binary")))
    return docs
