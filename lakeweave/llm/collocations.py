"""Phrase collocations from count streams in suffix and prefix order.

Counting takes two passes over the texts, a bounded number of words at a time. The first counts one- and two-word
phrases by a 64-bit hash; a count is never too small, so the hashes that reach ``min_count``, kept as one bitmap of at
most ``BITMAP_BITS``, lose no frequent phrase. The second pass counts, by their text, the phrases
whose words and neighbouring pairs are all in the bitmap, and phrases under ``min_count`` go: a part of a frequent
phrase is at least as frequent, so all counts that a score needs are kept. The counts then pass two
streams. In suffix order (words reversed) a phrase comes after all its suffixes, in
prefix order after all its prefixes, so one stack of open phrases yields the counts of the right parts (first
stream), of the left parts (second stream) and the most frequent extension on either side: a
lockstep merge of sorted streams, without a hash table. The second stream takes the first one's rows along.

Streams are sorted by range over the whole phrase, so a word that starts very many phrases spans as many partitions
as it needs. What a partition lacks is only the chain of prefixes of its first phrase: it leaves a
gap row for each (at most ``max_words - 1`` a partition), which give and take their counts by a broadcast of those few rows.

Defined results: a null text has no words, a null language is ``und``; A-Z are lower-cased; pieces end at
``.,;:!?`` and line breaks, words are what spaces and tabs separate; repeated rows count again; an empty table gives no
rows; extra columns and ids are ignored. Very long texts are read in windows of 1 MB. Equal
scores and counts are ranked by the phrase's bytes, cuts with equal scores by the shorter first part.
The bitmap has 16 bits a frequent hash up to its bound; fuller, it lets more rare phrases into the second count and
changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import release, save

MAX_WORDS = 3
MIN_COUNT = 10
DROP_PERCENT = 50
TOP = 2000
BITMAP_BITS = 1 << 28  # 32 MB
_TOKENS = 1 << 20  # words counted at a time
_BYTES = 1 << 26
_ROWS = 1 << 16  # rows of an output batch
_END = b"\xff"  # stands for the end of a piece; no byte of UTF-8
_TABLE = bytes(0xFF if chr(i) in ".,;:!?\n\x0b\x0c\r" else i for i in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _windows(text: bytes, size: int) -> Iterator[list[bytes]]:
    """Words and piece ends of a text in bounded windows."""
    if _END in text:
        text = text.decode("utf-8", "replace").encode()
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().translate(_TABLE).replace(_END, b" \xff ").split()
        at = end
    yield [_END]


class _Names(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Counter:
    """Words of one language since the last flush. A text that is cut by a flush keeps its context."""

    def __init__(self, lang: str, max_words: int):
        self.max_words, self.bits = max_words, 63 // max_words
        self.seed = np.uint64(xxh64_intdigest(lang, 13))
        self.skip, self.context = 0, []
        self._clear()

    def _clear(self) -> None:
        self.names = _Names({_END: 0})
        self.parts: list[np.ndarray] = []
        self.size = self.bytes = 0

    def full(self, words: list[bytes]) -> bool:
        return len(self.names) + len(words) >= 1 << self.bits or self.size >= _TOKENS or self.bytes >= _BYTES

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.names.__getitem__, words), np.int64, len(words)))
        self.size += len(words)
        self.bytes += sum(map(len, words))
        self.context = (self.context + words)[1 - self.max_words :]

    def _phrases(self, ids: np.ndarray, m: int, wanted: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """(words' numbers, counts) of the phrases of ``m`` words at the wanted positions, but for those counted before."""
        a, n = max(0, self.skip - m + 1), len(ids) - m + 1
        if n <= a:
            return [np.empty(0, np.int64)] * m, np.empty(0, np.int64)
        keys = ids[a:n]
        for j in range(1, m):
            keys = keys << self.bits | ids[a + j : n + j]
        keys, counts = np.unique(keys[wanted[a:n]], return_counts=True)
        return [keys >> self.bits * (m - 1 - j) & (1 << self.bits) - 1 for j in range(m)], counts

    def hashes(self, words: np.ndarray, *more: np.ndarray) -> np.ndarray:
        """Hash of each phrase from its words' hashes."""
        h = _mix(words, np.full(1, self.seed))
        for own in more:
            h = _mix(h, own)
        return h

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids, hash of every word by id), and the words are forgotten but for the context."""
        ids = np.concatenate(self.parts) if self.parts else np.empty(0, np.int64)
        return ids, np.fromiter(map(xxh64_intdigest, self.names), np.uint64, len(self.names))

    def reset(self) -> None:
        context, self.context = self.context, []
        if _END in context:
            context = context[len(context) - context[::-1].index(_END) :]
        self._clear()
        self.add(context)
        self.skip = len(context)

    def hash_counts(self) -> Iterator[pa.RecordBatch]:
        """(h, n) of the words and pairs since the last flush."""
        ids, word = self.take()
        for m in (1, 2):
            inside = ids != 0
            if m == 2:
                inside = inside[:-1] & inside[1:]
            parts, counts = self._phrases(ids, m, inside)
            h = self.hashes(*(word[p] for p in parts))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(counts, pa.int64())], ["h", "n"])
        self.reset()

    def phrase_counts(self, lang: str, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, n) since the last flush of the phrases that the bitmap admits; the empty phrase stands for all words."""
        ids, word = self.take()
        vocabulary = pa.array(list(self.names), pa.binary())

        def known(h: np.ndarray) -> np.ndarray:
            at = h & np.uint64(8 * len(bitmap) - 1)
            return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        def rows(phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), phrases, pa.array(counts, pa.int64())], ["lang", "phrase", "n"])

        yield rows(pa.array([b""], pa.binary()), np.array([np.count_nonzero(ids[self.skip :])]))
        single = known(self.hashes(word))[ids] & (ids != 0)
        w = word[ids]
        pair = single[:-1] & single[1:] & known(self.hashes(w[:-1], w[1:]))
        wanted = single
        for m in range(1, self.max_words + 1):
            if m == 2:
                wanted = pair
            elif m > 2:
                wanted = wanted[:-1] & pair[m - 2 :]
            parts, counts = self._phrases(ids, m, wanted)
            for i in range(0, len(counts), _ROWS):
                words = [vocabulary.take(pa.array(p[i : i + _ROWS])) for p in parts]
                yield rows(words[0] if m == 1 else pc.binary_join_element_wise(*words, b" "), counts[i : i + _ROWS])
        self.reset()


def _count(docs: DataFrame, lang_col: str, text_col: str, max_words: int, flush, schema: str) -> DataFrame:
    """Rows that ``flush`` gives for every language's counter whenever the words held reach their bound."""

    def count(batches):
        counters: dict[str, _Counter] = {}
        size = min(1 << 20, 1 << 63 // max_words)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                own = counters.setdefault(lang, _Counter(lang, max_words))
                for words in _windows(text.as_buffer().to_pybytes(), size) if text.is_valid else ():
                    if own.full(words):
                        yield from flush(lang, own)
                    own.add(words)
            if sum(c.size for c in counters.values()) >= _TOKENS:  # the languages share the bound
                for lang, own in counters.items():
                    yield from flush(lang, own)
                counters.clear()
        for lang, own in counters.items():
            yield from flush(lang, own)
        release()

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(count, schema)


def frequent_bitmap(docs: DataFrame, lang_col: str, text_col: str, min_count: int) -> np.ndarray:
    """Bits of the hashes of all words and pairs that occur ``min_count`` times or more (and a few others)."""
    counts = _count(docs, lang_col, text_col, 2, lambda lang, own: own.hash_counts(), "h long, n long")
    frequent = save(counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("h"), "phrase-hashes")
    bits = min(BITMAP_BITS, 1 << max(15, (16 * frequent.count()).bit_length()))
    at = F.lit(1) + F.col("h").bitwiseAND(F.lit(bits - 1))
    blocks = frequent.groupBy(F.bitmap_bucket_number(at).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b"))
    out = np.zeros(bits // 8, np.uint8)
    for r in blocks.toLocalIterator():
        out[(r["block"] - 1) * len(r["b"]) : r["block"] * len(r["b"])] = np.frombuffer(r["b"], np.uint8)
    return out


def phrase_counts(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT
) -> DataFrame:
    """(lang, phrase, n): partial counts of the phrases of up to ``max_words`` words that may occur ``min_count`` times in all.

    The empty phrase counts all words.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words or more")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_bitmap(docs, lang_col, text_col, min_count))
    return _count(
        docs, lang_col, text_col, max_words, lambda lang, own: own.phrase_counts(lang, shared.value), "lang string, phrase binary, n long"
    )


_STREAM = "lang string, w array<string>, n long, carried array<long>, parts array<long>, ext long"


def _lockstep(batches):
    """Rows sorted by (lang, w), each with the counts of its proper prefixes and of its most frequent extension.

    A prefix before the partition's first row is unknown: its count is null, and a row without
    count (a gap) gives the extensions that this partition has seen of it.
    """
    stack: list[list] = []  # [lang, words, n, carried, ext], each one word longer than the one below
    out: list[list] = [[] for _ in range(6)]

    def close(depth: int) -> None:
        while len(stack) > depth:
            lang, words, n, carried, ext = stack.pop()
            for column, value in zip(out, (lang, words, n, carried, [x[2] for x in stack], ext)):
                column.append(value)
            if stack and n is not None:
                stack[-1][4] = max(stack[-1][4], n)

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], [c.split()[0] for c in _STREAM.split(", ")])
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "w", "n", "carried", "ext"))):
            lang, words = row[:2]
            depth = 0
            if stack and stack[0][0] == lang:
                path = stack[-1][1]
                while depth < min(len(path), len(words) - 1) and path[depth] == words[depth]:
                    depth += 1
            close(depth)
            for k in range(depth + 1, len(words)):
                stack.append([lang, words[:k], None, None, 0])
            stack.append(list(row))
            if len(out[0]) >= _ROWS:
                yield batch_of()
    close(0)
    yield batch_of()


def _stream(rows: DataFrame, max_words: int, purpose: str) -> DataFrame:
    """``rows`` (lang, w, n, carried, ext) with ``parts``, the counts of their proper prefixes, and ``ext`` raised."""
    ordered = rows.repartitionByRange("lang", "w").sortWithinPartitions("lang", "w")
    merged = save(ordered.mapInArrow(_lockstep, _STREAM), purpose)
    # at most max_words - 1 a partition
    gaps = F.broadcast(merged.where("n IS NULL").groupBy("lang", "w").agg(F.max("ext").alias("later")))
    known = merged.where("n IS NOT NULL")
    heads = known.join(gaps, ["lang", "w"]).select(F.col("lang").alias("head_lang"), F.col("w").alias("head"), F.col("n").alias("head_n"))
    for k in range(1, max_words):
        here = F.expr(f"lang = head_lang AND size(w) > {k} AND slice(w, 1, {k}) = head")
        filled = F.expr(f"transform(parts, (p, i) -> IF(i = {k - 1}, coalesce(p, head_n), p))")
        known = known.join(F.broadcast(heads), here, "left").select("lang", "w", "n", "carried", filled.alias("parts"), "ext")
    known = known.join(gaps, ["lang", "w"], "left")
    return known.select("lang", "w", "n", "carried", "parts", F.expr("greatest(ext, coalesce(later, 0))").alias("ext"))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    drop_percent: int = DROP_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``max_words`` words.

    a, l and r count the phrase and the two parts at its lowest-scoring cut, n all words; score is
    floor(10^6 a^2 / (l r)). A phrase within a longer one that has ``drop_percent`` % of its count is left out.
    """
    counts = phrase_counts(docs, lang_col, text_col, max_words, min_count).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    counts = counts.select("lang", F.col("phrase").cast("string").alias("phrase"), "n")
    counts = save(counts.where(f"n >= {min_count} OR phrase = ''"), "phrase-counts")
    totals = counts.where("phrase = ''").select("lang", F.col("n").alias("all_n"))
    none = F.array().cast("array<long>")
    rows = counts.where(f"phrase <> '' AND n >= {min_count}").select("lang", F.split("phrase", " ").alias("w"), "n")
    rows = rows.select("lang", F.reverse("w").alias("w"), "n", none.alias("carried"), F.lit(0).cast("long").alias("ext"))
    rights = _stream(rows, max_words, "phrase-suffixes")
    rows = rights.select("lang", F.reverse("w").alias("w"), "n", F.col("parts").alias("carried"), "ext")
    both = _stream(rows, max_words, "phrase-prefixes")  # carried: counts of the last 1, 2, ... words; parts: of the first
    big = "cast({} AS decimal(38, 0))".format
    l, r = "element_at(parts, k)", "element_at(carried, size(w) - k)"
    score = f"({big(1000000)} * {big('n')} * {big('n')}) div ({big(l)} * {big(r)})"
    cuts = f"transform(sequence(1, size(w) - 1), k -> named_struct('score', {score}, 'k', k, 'l', {l}, 'r', {r}))"
    found = (
        both.where("size(w) > 1")
        .where(f"{big(100)} * ext < {big(drop_percent)} * n")
        .select("lang", F.array_join("w", " ").alias("phrase"), F.col("n").alias("a"), F.expr(f"array_min({cuts})").alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    # best of each bucket first: a language's last step sees at most top rows of every bucket
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.withColumn("bucket", F.expr(f"pmod(xxhash64(phrase), {buckets})"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*best))
    found = found.withColumn("place", first).where(F.col("place") <= top).drop("place", "bucket")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("all_n").alias("n"), "score")
