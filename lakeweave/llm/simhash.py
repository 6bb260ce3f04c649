"""SimHash near-dedup by multi-index hashing.

A document's fingerprint holds the bitwise majority of its word-shingle hashes. Two
fingerprints are linked if they differ in at most ``MAX_BITS`` = 4 bits. The 64 bits are
cut into three segments of 21, 21 and 22 bits: if two fingerprints differ in at most 4 bits, then
they differ in at most one bit of the first or second segment or not at all in the third.
So each fingerprint is stored in three tables by its segment values and looks up the radius-1
balls of the first two segments; of two values that differ in one bit only the one with
that bit set looks the other up, so each ball costs half. Every table match is verified on
all 64 bits.

Scale: equal fingerprints are one entry, so exact copies cost nothing. A bucket shared by
many fingerprints is cut into blocks, every pair of blocks is one unit of work, and a unit
emits a spanning forest of its links, never all pairs.

Defined results: null text is empty; a text without words has fingerprint 0 and links like
any other; fewer than ``shingle`` words form one shingle. Repeated rows each get a row.
A null id never becomes a component id unless no member has an id. An empty table gives no rows. Extra columns are
ignored. The words of one text are held at a time: a very long text takes about 30 times its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, per_text, row_hash, runs, save

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # (shift, bits); the first two are searched with radius 1
BLOCK = 4096  # fingerprints of one bucket that meet in one unit of work, per side
_HASHES = 1 << 16  # hashes held at a time


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    ends = ends[-n:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _HASHES):
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[i : i + _HASHES], ends[i : i + _HASHES])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint column (the 64 bits as a signed long)."""
    return per_text(lambda t: _signed(fingerprint_of(t, shingle)), pa.int64())(text)


def _enumerate(batches):
    """Table entries and lookups of each fingerprint: (bucket, fp, stored)."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        buckets, fps, stored = [], [], []
        for k, (shift, bits) in enumerate(SEGMENTS):
            value = (fp >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            tag = np.uint64(k << 32)
            buckets.append(value | tag)
            fps.append(fp)
            stored.append(np.ones(len(fp), bool))
            for bit in range(bits) if k < 2 else ():
                flip = np.uint64(1 << bit)
                on = (value & flip) != 0
                buckets.append((value[on] ^ flip) | tag)
                fps.append(fp[on])
                stored.append(np.zeros(int(on.sum()), bool))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(buckets).view(np.int64)),
                pa.array(np.concatenate(fps).view(np.int64)),
                pa.array(np.concatenate(stored)),
            ],
            ["bucket", "fp", "stored"],
        )


def _forest(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among ``fp``: each fingerprint is compared once with those not yet reached."""
    links, rest = [], np.unique(fp)
    queue: list = []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        x = queue.pop()
        near = np.bitwise_count(rest ^ x) <= MAX_BITS
        if near.any():
            found = rest[near]
            links.append((np.full(len(found), x), found))
            queue.extend(found)
            rest = rest[~near]
    return links


def _verify(batches):
    for batch, starts in runs(batches, "unit"):
        fp = batch.column("fp").to_numpy().view(np.uint64)
        sizes = np.diff(np.r_[starts, len(fp)])
        pairs = starts[sizes == 2]  # most units
        near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= MAX_BITS
        links = [(fp[pairs[near]], fp[pairs[near] + 1])]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            links += _forest(fp[s : s + n])
        a, b = (np.concatenate([x[i] for x in links]).view(np.int64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect every two fingerprints (column fp, distinct) within ``MAX_BITS`` bits."""
    entries = distinct.select("fp").mapInArrow(_enumerate, "bucket long, fp long, stored boolean")
    sizes = (
        entries.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.max("stored").alias("hit"))
        .where("hit AND n > 1")
        .selectExpr("bucket", f"cast(ceil(n / {block}) AS int) AS blocks")
    )
    placed = entries.join(sizes, "bucket").select(
        "bucket", "fp", "blocks", F.expr("pmod(xxhash64(fp), blocks)").alias("own")
    )
    units = placed.select(
        "fp",
        "bucket",
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"),
        "own",
    ).select("fp", F.expr("xxhash64(bucket, least(own, other), greatest(own, other))").alias("unit"))
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_verify, "a long, b long").distinct()


def components(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``prints`` (id, fp)."""
    firsts = save(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-distinct")
    roots = connected_components(near_links(firsts, block)).withColumnRenamed("node", "fp")
    rooted = firsts.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``."""
    prints = save(
        docs.select(F.col(id_col).cast("long").alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")),
        "simhash-prints",
    )
    found = components(prints).select("fp", "component_id")
    return prints.join(found, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` with one document of each component left: the smallest id (null last).

    Of several rows with that id the one whose columns hash lowest stays, so reruns agree; rows
    equal to the kept one in all columns are dropped too. Columns are unchanged.
    """
    row = [row_hash(docs, 1).alias("__row"), row_hash(docs, 2).alias("__more")]
    prints = save(
        docs.select(F.col(id_col).cast("long").alias("id"), *row, fingerprint(F.col(text_col), shingle).alias("fp")), "simhash-prints"
    )
    found = components(prints).select("fp", "root")
    kept = (
        prints.join(found, "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__row", "__more")).alias("k"))
        .select("k.__row", "k.__more")
    )
    marked = docs.select(*row, F.struct("*").alias("__doc"))
    rows = marked.join(kept, ["__row", "__more"]).dropDuplicates(["__row", "__more"])
    return rows.select("__doc.*")
