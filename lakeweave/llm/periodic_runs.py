"""Periodic runs of words by online dyadic square catching.

Words are appended to a stream. For every power of two ``m`` a catcher stands at each multiple of
``m / 4``: it covers four completed blocks of ``m / 4`` words (``m`` words in all) and waits for them to
recur. A window of ``m`` words that ends at an appended word is compared with the (at most four) catchers that
began up to ``m`` words earlier. The first match, at distance ``d``, is a square: the catcher's words and
the next ``d`` have smallest period ``d``. A square with ``m / 2 < d <= m`` is extended word by word to both sides
(the others belong to a smaller ``m``); squares inside a known run of their period merge into it, and a run that
reaches the end of the stream grows with the next words.

Nothing is missed: a run of period ``q`` and four periods or more holds a catcher of
``q <= m < 2q`` words that ends a period before the run does, and its first match is at ``q``, as a
nearer one would give the run a smaller period.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null and empty texts have no words and no runs; repeated rows
each get a row, null ids too; an empty table gives no rows; extra columns are ignored. Words are compared by 64-bit
hashes. Very long texts: about 70 bytes a word are held (a period may span the whole text), words themselves
in windows of 1 MB.

Scale: a narrow job, each text is read in the task that scans it and nothing is shuffled. Short texts share one
stream, with a separator between them that equals no word, so that a text costs no calls of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release

MIN_LENGTH = 6
MIN_PERIODS = 4
_WINDOW = 1 << 20  # bytes of text cut into words at a time
_GROUP = 1 << 18  # words of short texts in one stream
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(32))) * _K1
    x += b
    x ^= x >> np.uint64(29)
    x *= _K2
    return x


class _Level:
    """Hashes of all windows of ``m`` words that catchers may still need."""

    def __init__(self, m: int):
        self.m, self.step = m, max(1, m // 4)
        self.lo = 0  # first window held
        self.h = np.empty(0, np.uint64)
        self.caught = np.empty(0, np.int64)  # catchers with a match, as far back as windows may still meet them

    @property
    def hi(self) -> int:
        return self.lo + len(self.h)

    def extend(self, new: np.ndarray) -> list[tuple[int, int]]:
        """Append window hashes; (catcher, distance) of the squares caught, one for each stretch of neighbours."""
        first = self.hi
        self.h = np.concatenate([self.h, new]) if len(self.h) else new
        if not len(new):
            return []
        step, lags = self.step, self.m // self.step
        c0 = max(0, (first - 1) // step - (lags - 1))
        own = np.repeat(self.h[c0 * step - self.lo :: step], step)  # own[t]: catcher that begins last before c0 * step + 1 + t
        xs, ys = [], []
        for lag in range(lags):
            a = max(0, first - (c0 + lag) * step - 1)
            y = (c0 + lag) * step + 1 + a
            here = self.h[y - self.lo :]
            t = np.flatnonzero(here == own[a : a + len(here)])
            xs.append(c0 * step + (a + t) // step * step)
            ys.append(y + t)
        x, y = np.concatenate(xs), np.concatenate(ys)
        if not len(x):
            return []
        x, at = np.unique(x, return_index=True)  # lags come in order of distance, so the first is the nearest
        d = y[at] - x
        fresh = ~np.isin(x, self.caught)
        x, d = x[fresh], d[fresh]
        self.caught = np.concatenate([self.caught, x])
        own_size = 2 * d > self.m
        x, d = x[own_size], d[own_size]
        inner = np.zeros(len(x), bool)
        inner[1:] = (x[1:] == x[:-1] + step) & (d[1:] == d[:-1])
        return list(zip(x[~inner].tolist(), d[~inner].tolist()))

    def forget(self, n: int) -> None:
        """Drop what no window that ends after word ``n`` needs, here or one level up."""
        keep = max(0, n - 2 * self.m - self.step)
        if keep > self.lo:
            self.h, self.lo = self.h[keep - self.lo :].copy(), keep
        self.caught = self.caught[self.caught >= keep]


class RunFinder:
    """Runs of at least ``min_length`` words and ``min_periods`` (4 or more) periods in a stream of word hashes."""

    def __init__(self, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, longest: int | None = None):
        if min_periods < 4:
            raise ValueError("catchers stand a quarter of their size apart: runs need four periods or more")
        self.min_length, self.min_periods, self.longest = min_length, min_periods, longest
        self.words = np.empty(0, np.uint64)
        self.levels: list[_Level] = []
        self.open: list[list[int]] = []  # [start, end, period] of runs that reach the end of the stream
        self.last: dict[int, list[int]] = {}  # period -> its latest run
        self.found: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate([self.words, words]) if len(self.words) else words
        n = len(self.words)
        for run in self.open:
            run[1] = self._right(run[1], run[2])
        self._settle(n)
        while (m := 1 << len(self.levels)) <= n and (self.longest is None or 2 * m <= max(2, self.longest)):
            self.levels.append(_Level(m))
        for k, level in enumerate(self.levels):
            first, end = level.hi, n - level.m + 1
            if k == 0:
                new = self.words[first:end]
            elif end <= first:
                new = self.words[:0]
            else:
                below, half = self.levels[k - 1], level.m // 2
                a, b = first - below.lo, end - below.lo
                new = _mix(below.h[a:b], below.h[a + half : b + half])
            for x, d in level.extend(new):
                self._catch(x, d)
        for level in self.levels:
            level.forget(n)

    def _catch(self, x: int, d: int) -> None:
        known = self.last.get(d)
        if known and known[0] <= x and x + d <= known[1]:
            return
        end = self._right(x + d, d)
        if end < x + 2 * d:
            return  # unequal windows with one hash
        run = [self._left(x, d), end, d]
        self.last[d] = run
        self.open.append(run)
        self._settle(len(self.words))

    def _settle(self, n: int) -> None:
        for start, end, d in (r for r in self.open if r[1] < n):
            if end - start >= max(self.min_length, self.min_periods * d):
                self.found.append((start, end - start, d))
        self.open = [r for r in self.open if r[1] >= n]

    def _right(self, at: int, d: int) -> int:
        """First position from ``at`` on whose word differs from the one ``d`` before it."""
        w, size = self.words, 64
        while at < len(w):
            differ = w[at : at + size] != w[at - d : min(at + size, len(w)) - d]
            if differ.any():
                return at + int(differ.argmax())
            at, size = min(at + size, len(w)), 2 * size
        return at

    def _left(self, at: int, d: int) -> int:
        """Smallest start so that all words from there to ``at`` equal the ones ``d`` after them."""
        w, size = self.words, 64
        while at > 0:
            a = max(0, at - size)
            differ = w[a:at] != w[a + d : at + d]
            if differ.any():
                return at - int(differ[::-1].argmax())
            at, size = a, 2 * size
        return at

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs by start, then period."""
        self._settle(len(self.words) + 1)
        return sorted(self.found, key=lambda r: (r[0], r[2]))


def runs_of(words: list, **limits: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of any hashable words."""
    finder = RunFinder(**limits)
    finder.append(np.array([hash(w) for w in words], np.int64).view(np.uint64))
    return finder.finish()


def _windows(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded window at a time."""
    if len(text) <= _WINDOW:
        yield text.split()
        return
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + _WINDOW)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def _hashes(text: bytes) -> np.ndarray:
    parts = [np.fromiter(map(hash, words), np.int64, len(words)) for words in _windows(text)]
    return (np.concatenate(parts) if len(parts) > 1 else parts[0]).view(np.uint64)


def _collapse(text: bytes, n: int, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text without those after the first period of a run, joined by a space."""
    if not runs:
        return b" ".join(b" ".join(words) for words in _windows(text) if words)
    depth = np.zeros(n + 1, np.int32)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept, at, out = np.cumsum(depth[:-1]) == 0, 0, []
    for words in _windows(text):
        part = [w for w, k in zip(words, kept[at : at + len(words)].tolist()) if k]
        if part:
            out.append(b" ".join(part))
        at += len(words)
    return b" ".join(out)


def _group_runs(hashes: list[np.ndarray], limits: dict[str, int]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text of a group, in one stream."""
    finder = RunFinder(**limits, longest=max(map(len, hashes)))
    if len(hashes) == 1:  # a long text is appended in pieces that double the stream
        at, size = 0, _GROUP
        while at < len(hashes[0]):
            finder.append(hashes[0][at : at + size])
            at, size = at + size, at + size
        return [finder.finish()]
    marks = _mix(np.arange(len(hashes), dtype=np.uint64), np.full(len(hashes), _K1))
    starts = np.cumsum([0, *(len(h) + 1 for h in hashes)])
    stream = np.empty(int(starts[-1]), np.uint64)
    for h, mark, a in zip(hashes, marks, starts.tolist()):
        stream[a : a + len(h)], stream[a + len(h)] = h, mark
    finder.append(stream)
    out: list[list[tuple[int, int, int]]] = [[] for _ in hashes]
    found = finder.finish()
    owner = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    for (start, length, period), i in zip(found, owner.tolist()):
        out[i].append((start - int(starts[i]), length, period))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` are (start, length, period) by start, then period; ``collapsed`` is the text without the words that
    a run holds after its first period.
    """
    limits = {"min_length": min_length, "min_periods": min_periods}

    def results(ids: list[pa.Array], texts: list[bytes], hashes: list[np.ndarray]) -> pa.RecordBatch:
        runs = _group_runs(hashes, limits)
        collapsed = [_collapse(*x) for x in zip(texts, map(len, hashes), runs)]
        columns = [
            pa.concat_arrays(ids),
            pa.array(list(map(len, hashes)), pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(_RUN)),
            pa.array(collapsed, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    def search(batches):
        for batch in batches:
            texts, hashes, held, at = [], [], 0, 0
            for i, x in enumerate(batch.column("text")):
                text = x.as_buffer().to_pybytes() if x.is_valid else b""
                own = _hashes(text)
                if texts and held + len(own) > _GROUP:
                    yield results([batch.column("id").slice(at, i - at)], texts, hashes)
                    texts, hashes, held, at = [], [], 0, i
                texts.append(text)
                hashes.append(own)
                held += len(own) + 1
            if texts:
                yield results([batch.column("id").slice(at)], texts, hashes)
            release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["id"]]).add("n_words", T.LongType())
    schema = schema.add("runs", T._parse_datatype_string(RUNS)).add("collapsed", T.BinaryType())
    found = rows.mapInArrow(search, schema)
    return found.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of ``docs`` where a tenth of the texts become periodic from some word on.

    With h the crc32 of the id as text and g = floor(h / 10): if h % 10 = 0, every word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Rows without id stay as they are.
    """

    @F.arrow_udf(returnType=T.BinaryType())
    def repeated(texts: pa.Array, draws: pa.Array) -> pa.Array:
        return pa.array([_repeat(t.as_py(), g.as_py()) if t.is_valid else None for t, g in zip(texts, draws)], pa.binary())

    h = F.crc32(F.col(id_col).cast("string"))
    chosen = F.when(h % 10 == 0, F.col(text_col).cast("binary"))
    planted = F.coalesce(repeated(chosen, F.floor(h / 10).cast("long")), F.col(text_col).cast("binary"))
    return docs.select(F.col(id_col), planted.alias(text_col))


def _span(text: bytes, first: int, last: int) -> bytes:
    """Words ``first`` to ``last`` (exclusive), joined by a space."""
    out, at = [], 0
    for words in _windows(text):
        part = words[max(0, first - at) : max(0, last - at)]
        if part:
            out.append(b" ".join(part))
        at += len(words)
    return b" ".join(out)


def _repeat(text: bytes, g: int) -> bytes:
    n = sum(map(len, _windows(text)))
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    parts = [_span(text, 0, a), *repeat(_span(text, a, a + p), times), _span(text, a, a + rest)]
    return b" ".join(part for part in parts if part)


def brute_force_runs(words: list, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """Every run by trying all periods, for tests."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // min_periods + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(min_length, min_periods * q) and (start, end) not in seen:
                seen.add((start, end))  # smaller periods come first
                out.append((start, end - start, q))
            start = end - q + 1
    return sorted(out, key=lambda r: (r[0], r[2]))
