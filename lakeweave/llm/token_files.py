"""Token-id files with directly addressable codes.

A shard stores its ids in chunk levels. Level 0 holds the low ``WIDTHS[0]`` bits of every id and
a bitmap of the ids that continue; level 1 holds the next bits of those only, and so on. A
rank directory (ones before each 512-bit block) turns a position in one level into the position
in the next, so any id is read with a few array look-ups and no block is decoded.

Shards are rows of a Parquet table (part, seq, doc_ids, ends, codes): ``part`` and ``seq`` order
them, ``ends`` are the documents' ends inside the shard, ``codes`` is the binary described in
``encode_codes``. Spark's commit protocol makes each shard appear once, whatever tasks are lost.

Defined results: null text is empty, so its document is the end id alone; null ids come
first; repeated rows each take their place next to each other (order among rows with one
id: by text hash); extra columns are ignored. An empty table writes no shard. A very long text is one document of one
shard and is held whole, with four bytes an id.

Scale: one range shuffle of (id, text) gives the order; starts need only per-shard totals. A hot
id is split over partitions by the text hash. A shard closes at ``SHARD_IDS`` ids or more,
at a document's end, so a task holds one shard and one batch of texts.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.session import fresh_dir

from .common import in_range_order, partition_offsets, release

WIDTHS = (8, 8, 16)  # bits a level; whole bytes, 32 together
SHARD_IDS = 1 << 20
CACHE = 200_000  # words in each of the two generations of a worker's cache
_MAGIC = b"DAC1"
_BLOCK = 512


# ---- codes ----------------------------------------------------------------------
def encode_codes(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """Magic, number of levels; per level: width, count, chunks, then (but for the last) bitmap words and rank directory."""
    rest = ids.astype(np.uint64)
    out = [_MAGIC, struct.pack("<I", len(widths))]
    for k, width in enumerate(widths):
        chunk = (rest & np.uint64((1 << width) - 1)).astype(f"<u{width // 8}")
        out += [struct.pack("<IQ", width, len(rest)), chunk.tobytes()]
        if k == len(widths) - 1:
            break
        rest = rest >> np.uint64(width)
        more = rest > 0
        bits = np.zeros(-(-max(1, len(more)) // _BLOCK) * _BLOCK, np.uint8)
        bits[: len(more)] = more
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).reshape(-1, _BLOCK // 64).sum(axis=1, dtype=np.uint64)
        rank = (np.cumsum(ones) - ones).astype("<u8")
        out += [words.tobytes(), rank.tobytes()]
        rest = rest[more]
    return b"".join(out)


class Codes:
    """Random access to the ids of one shard."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a token shard")
        (n_levels,), at = struct.unpack_from("<I", data, 4), 8
        self.levels = []
        for k in range(n_levels):
            width, n = struct.unpack_from("<IQ", data, at)
            at += 12
            chunks = np.frombuffer(data, f"<u{width // 8}", n, at)
            at += chunks.nbytes
            words = rank = None
            if k < n_levels - 1:
                blocks = -(-max(1, n) // _BLOCK)
                words = np.frombuffer(data, "<u8", blocks * (_BLOCK // 64), at)
                at += words.nbytes
                rank = np.frombuffer(data, "<u8", blocks, at)
                at += rank.nbytes
            self.levels.append((width, chunks, words, rank))
        self.size = len(self.levels[0][1])

    @staticmethod
    def _rank(words: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, word = at // _BLOCK, at // 64
        total = rank[block].astype(np.int64)
        for j in range(_BLOCK // 64):
            w = block * (_BLOCK // 64) + j
            total += np.where(w < word, np.bitwise_count(words[w]), 0).astype(np.int64)
        low = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return total + np.bitwise_count(words[word] & low).astype(np.int64)

    def get(self, positions) -> np.ndarray:
        """Ids at any positions."""
        at = np.asarray(positions, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("token position out of range")
        out, live, shift = np.zeros(len(at), np.uint64), np.arange(len(at)), 0
        for width, chunks, words, rank in self.levels:
            out[live] |= chunks[at].astype(np.uint64) << np.uint64(shift)
            if words is None:
                break
            on = ((words[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)
            live, at = live[on], at[on]
            at = self._rank(words, rank, at)
            shift += width
        return out.astype(np.uint32)

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids of a range: one rank look-up a level, then the ones inside the range in order."""
        out, live, shift = np.zeros(end - start, np.uint64), np.arange(end - start), 0
        for width, chunks, words, rank in self.levels:
            out[live] |= chunks[start:end].astype(np.uint64) << np.uint64(shift)
            if words is None or end == start:
                break
            first = start // 64 * 64
            bits = np.unpackbits(words[start // 64 : (end + 63) // 64].view(np.uint8), bitorder="little")
            on = bits[start - first : end - first].astype(bool)
            start = int(self._rank(words, rank, np.array([start]))[0])
            end = start + int(on.sum())
            live = live[on]
            shift += width
        return out.astype(np.uint32)


# ---- tokenizing -----------------------------------------------------------------
# The byte-level pre-tokenizer's split, written out for characters up to U+024F.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \u0085 "
_SPLIT = re.compile(  # alternatives that start with unlike characters come in order of frequency
    f" ?[{_LETTER}]+| ?[{_NUMBER}]+|'(?:[stmd]|re|ve|ll)| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_BEYOND = re.compile("[^\\x00-ɏ]")


# Printable bytes stand for themselves in the byte-level alphabet, the others follow from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_ALPHABET = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class _Words(dict):
    """Ids of pre-tokenized words, in two generations: words that are met again move to the new one."""

    def __init__(self, model):
        self.model, self.older = model, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word.isascii() and word.isprintable():
                own = word.replace(" ", _ALPHABET[0x20])
            else:
                own = word.encode().decode("latin-1").translate(_ALPHABET)
            ids = array("I", [t.id for t in self.model.tokenize(own)]).tobytes()
        self[word] = ids
        return ids

    def turn(self, most: int) -> None:
        if len(self) >= most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids by the ``tokenizers`` library, with a bounded cache of pre-tokenized words.

    A byte-level tokenizer encodes each word on its own, so its model needs to see a word only
    once. Texts with characters beyond U+024F or with an added token's string, and all texts of other
    tokenizers, are encoded whole.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        )
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.words = _Words(self.tokenizer.model)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        self.words.turn(self.cache)
        get, out = self.words.__getitem__, []
        for text in texts:
            if self.by_word and (text.isascii() or not _BEYOND.search(text)) and not any(a in text for a in self.added):
                out.append(b"".join(map(get, _SPLIT.findall(text))))
            else:
                out.append(self._whole(text))
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _groups(column: pa.Array, chars: int = 1 << 18):
    """Texts of one batch in runs of about ``chars`` bytes."""
    held, size = [], 0
    for x in column:
        held.append(bytes(x.as_buffer()).decode("utf-8", "replace") if x.is_valid else "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
    order: Sequence[str] | None = None,
) -> str:
    """Write the ids of every text, ``end_id`` after each; returns the path.

    Documents come in the order of the columns ``order`` (names or paths such as ``_metadata.row_index``), in ascending
    id order if none are given.
    """
    path = path or fresh_dir(docs.sparkSession, "tokens")
    by = [F.col(c).alias(f"_order{i}") for i, c in enumerate(order or ())]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *by)
    keys = [F.col(f"_order{i}") for i in range(len(by))] or [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = in_range_order(rows, keys, "tokens")
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches):
        encoder, seq, part = _encoder(tokenizer), 0, None
        doc_ids: list = []
        ends: list[int] = []
        held: list[bytes] = []

        def close():
            codes = encode_codes(np.frombuffer(b"".join(held), "<u4"))
            row = [[part], [seq], [ends[-1]], [doc_ids], [ends], [codes]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "seq", "n", "doc_ids", "ends", "codes"])

        for batch in batches:
            names, at = batch.column("doc_id").to_pylist(), 0
            if batch.num_rows:
                part = batch.column("_part")[0].as_py()
            for texts in _groups(batch.column("text")):
                for ids in encoder.encode(texts):
                    held.append(ids + end)
                    doc_ids.append(names[at])
                    ends.append((ends[-1] if ends else 0) + len(ids) // 4 + 1)
                    at += 1
                    if ends[-1] >= shard_ids:
                        yield close()
                        doc_ids, ends, held, seq = [], [], [], seq + 1
        if ends:
            yield close()
        release()

    ordered.mapInArrow(shards, _SHARD).write.parquet(path)
    return path


_SHARD = "part int, seq long, n long, doc_ids array<long>, ends array<long>, codes binary"


def shard_bases(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, n, base): ``base`` is the number of ids in all shards before this one."""
    sizes = spark.read.schema(_SHARD).parquet(path).select("part", "seq", "n")
    parts = partition_offsets(sizes.groupBy(F.col("part").alias("_part")).agg(F.sum("n").alias("total")), "total")
    inside = F.expr("sum(n) OVER (PARTITION BY part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    bases = sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, F.col("part") == F.col("_part"))
    return bases.select("part", "seq", "n", (F.col("base") + F.col("inside")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    Shards are decoded where they are read; only the documents' rows meet the shard bases.
    """

    def read(batches):
        for batch in batches:
            for part, seq, doc_ids, ends, data in zip(*(batch.column(c) for c in ("part", "seq", "doc_ids", "ends", "codes"))):
                codes, bounds = Codes(data.as_buffer().to_pybytes()), np.r_[0, np.array(ends.as_py(), np.int64)]
                ids = codes.slice(0, int(bounds[-1])).astype("<u4", copy=False)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * len(crc), pa.int32()),
                        pa.array([seq.as_py()] * len(crc), pa.int64()),
                        pa.array(doc_ids.as_py(), pa.int64()),
                        pa.array(bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(_SHARD).parquet(path).select("part", "seq", "doc_ids", "ends", "codes")
    rows = files.mapInArrow(read, "part int, seq long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    placed = rows.join(shard_bases(spark, path).drop("n"), ["part", "seq"])
    return placed.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(position, id) for every position in ``wanted`` (position long), by random access.

    Positions are grouped by shard through a range look-up on the shard bases in blocks of
    ``SHARD_IDS`` ids, an equi-join; a shard spans a few blocks.
    """
    block = f"cast(floor(position / {SHARD_IDS}) AS long)"
    spans = shard_bases(spark, path).withColumn(
        "block", F.explode(F.expr(f"sequence(cast(floor(base / {SHARD_IDS}) AS long), cast(floor((base + n - 1) / {SHARD_IDS}) AS long))"))
    )
    asked = wanted.select("position", F.expr(block).alias("block")).groupBy("block").agg(F.collect_set("position").alias("positions"))

    def read(batches):
        for batch in batches:
            for base, data, asked_for in zip(*(batch.column(c) for c in ("base", "codes", "positions"))):
                codes = Codes(data.as_buffer().to_pybytes())
                at = np.array(asked_for.as_py(), np.int64) - base.as_py()
                at = at[(at >= 0) & (at < codes.size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + base.as_py()), pa.array(codes.get(at).astype(np.int64))], ["position", "id"]
                )

    files = spark.read.schema(_SHARD).parquet(path).select("part", "seq", "codes")
    wanted = spans.join(asked, "block").select("part", "seq", "base", "positions")
    return files.join(wanted, ["part", "seq"]).select("base", "codes", "positions").mapInArrow(read, "position long, id long")
