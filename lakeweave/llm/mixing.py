"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's documents form a stream in the order of a seeded hash, a random permutation,
repeated once per pass (at most ``MAX_PASSES``). The mix takes the first ``target`` words of each
stream. Documents that start in the same ``block_words`` words of a stream form a block, so a
source's quota is an exact number of blocks. A binary tree over the output shards splits the
quotas: at each node the left half gets its exact share of blocks, drawn from the sources by
the multivariate hypergeometric law. A source's blocks are permuted once more and each shard
takes the next run of its quota, so blocks are disjoint; rows are shuffled inside a shard by hash.

Targets: sources by code point, null last, weigh ``WEIGHTS`` in turn and share ``SHARE`` of all words;
a target stops at ``MAX_PASSES`` times the source's words and the excess is shared again by weight.
Documents are taken whole but for the one at the end of each source's target, which is cut
after a word; so taken words equal the target rounded to a word.

Defined results: null text has no words; documents without words are never taken; a
null source is a source of its own; rows that repeat id, source and text are separate
documents, whether other columns differ or not. With no words at all nothing is taken; an empty table gives no
rows. Extra columns travel along. Of a very long text only the words are counted, in the task that reads it.

Scale: sizes and hashes are sorted by range, so a hot source spreads over all partitions;
running sums use per-partition totals, to which the per-source figures are joined before the stream meets
them. Fully equal rows are one entry for every ``CHUNK`` copies, so the draws of a row that is repeated very often are spread
too; its one text meets them in a join that adaptive execution splits.
The driver holds one row per source and the tree of sources x shards quotas, never documents; texts are
shuffled only to join the draws. Blocks are made larger where there would be more than 10^9 of them.
"""

from __future__ import annotations

from math import ceil, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_range_order, row_hash, save, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_PASSES = 2
SHARDS = 64
BLOCK_WORDS = 1 << 14
SEED = 20
CHUNK = 256  # copies of a row that travel together
_MOST_BLOCKS = 10**9  # the hypergeometric generator's limit


def source_targets(sizes: list[int]) -> list[float]:
    """Word targets of sources given in order: weighted shares, capped, the excess shared again."""
    targets = [0.0] * len(sizes)
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    left, open_ = SHARE * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] > MAX_PASSES * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(MAX_PASSES * sizes[i])
            left -= targets[i]
        open_ -= full
    return targets


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Leaf quotas [shard, source] of the splitting tree; rows sum to near-equal shares, columns to ``quotas``."""
    out = np.zeros((shards, len(quotas)), np.int64)
    edge = [round(int(quotas.sum()) * i / shards) for i in range(shards + 1)]

    def split(own: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = own
            return
        mid = (low + high) // 2
        rng = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = rng.multivariate_hypergeometric(own, edge[mid] - edge[low], method="marginals")
        split(left, low, mid)
        split(own - left, mid, high)

    if len(quotas):
        split(quotas, 0, shards)
    return out


def _step(n: int, seed: int) -> int:
    """A multiplier prime to ``n``: i -> (step * i + seed) mod n permutes 0..n-1."""
    step = max(1, int(n * 0.6180339887) + seed % 7)
    while n > 1 and gcd(step, n) > 1:
        step += 1
    return step


def _running(batches):
    """Words of the same source before each row, inside its partition."""
    source, total = None, 0
    for batch in batches:
        keys = batch.column("source_key").to_pylist()
        before = []
        for key, words in zip(keys, batch.column("words").to_pylist()):
            if key != source:
                source, total = key, 0
            before.append(total)
            total += words
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "before"])


_KEY = ["source_key", "place", "name", "row"]


def _keys(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """The columns of ``_KEY``: rows that agree in them are equal in all columns."""
    source = F.col(source_col).cast("string")
    return [
        F.coalesce(F.concat(F.lit("="), source), F.lit("~")).alias("source_key"),  # null sorts last
        F.xxhash64(F.lit(seed), F.col(id_col), source, F.col(text_col)).alias("place"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
        row_hash(docs, seed).alias("row"),
    ]


def _chunks(copies: str) -> Column:
    """The numbers of the chunks that so many copies make."""
    return F.explode(F.expr(f"sequence(0L, ({copies} - 1) div {CHUNK})"))


def draw(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document row: its keys, copy, size, source_size, target, taken and draws.

    ``draws`` is an array of (pass, shard, words): how many leading words of the document each pass
    takes, and the output shard they go to.
    """
    spark = docs.sparkSession
    keys = _keys(docs, id_col, text_col, source_col, seed)
    sized = docs.select(F.col(id_col).alias("doc_id"), *keys, word_count(F.col(text_col)).alias("size"))
    entries = sized.groupBy(*_KEY, "doc_id", "size").agg(F.count("*").alias("copies")).withColumn("chunk", _chunks("copies"))
    entries = entries.withColumn("copies", F.expr(f"least(copies - chunk * {CHUNK}, {CHUNK}L)"))
    entries = entries.withColumn("words", F.col("size") * F.col("copies"))
    entries = in_range_order(entries, [F.col(c) for c in (*_KEY, "chunk")], "mix")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema)
    stream = save(entries.mapInArrow(_running, f"{kinds}, before long"), "mix-stream")

    parts = stream.groupBy("source_key", "_part").agg(F.sum("words").alias("part_words"))
    earlier = Window.partitionBy("source_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = save(parts.withColumn("carry", F.coalesce(F.sum("part_words").over(earlier), F.lit(0))), "mix-parts")
    found = sorted((r[0], r[1]) for r in parts.groupBy("source_key").agg(F.sum("part_words")).collect())  # a row per source
    sizes = [n for _, n in found]
    targets = source_targets(sizes)
    goals = [round(t) for t in targets]
    while sum(ceil(g / block_words) for g in goals) >= _MOST_BLOCKS:
        block_words *= 2
    quotas = np.array([ceil(g / block_words) for g in goals], np.int64)
    bounds = np.cumsum(split_quotas(quotas, shards, seed), axis=0).T
    sources = [
        (key, n, t, g, int(q), _step(int(q), seed), b.tolist())
        for (key, n), t, g, q, b in zip(found, targets, goals, quotas, bounds)
    ]
    sources = spark.createDataFrame(
        sources, "source_key string, source_size long, target double, goal long, quota long, step long, bounds array<long>"
    )
    # a row per source and partition takes the source's figures, so that the stream meets no row per source
    figures = parts.select("source_key", "_part", "carry").join(sources, "source_key")
    placed = (
        stream.join(figures, ["source_key", "_part"])
        .withColumn("i", F.explode(F.expr("sequence(0L, copies - 1)")))
        .withColumn("copy", F.expr(f"chunk * {CHUNK} + i"))
        .withColumn("start", F.expr("carry + before + i * size"))
    )
    words = "least(size, goal - p * source_size - start)"
    block = f"((p * source_size + start) div {block_words} * step + {seed}) % quota"
    draws = F.expr(
        f"""transform(
          filter(sequence(0L, {MAX_PASSES - 1}L), p -> {words} > 0),
          p -> named_struct('pass', p, 'shard', size(filter(bounds, b -> b <= {block})), 'words', {words}))"""
    )
    placed = placed.withColumn("draws", draws)
    taken = F.expr("aggregate(draws, 0L, (n, d) -> n + d.words)")
    return placed.select("doc_id", *_KEY, "chunk", "copy", "size", "source_size", "target", taken.alias("taken"), "draws")


@F.arrow_udf(T.StringType())
def _leading(text: pa.Array, words: pa.Array) -> pa.Array:
    """The text up to the end of its n-th word."""
    out = []
    for t, n in zip(text.to_pylist(), words.to_pylist()):
        if t is not None:
            parts = t.split(None, n)
            rest = parts[n] if len(parts) > n else b""
            t = t[: len(t) - len(rest)].rstrip().decode("utf-8", "replace")
        out.append(t)
    return pa.array(out, pa.string())


def _shard_rows(docs: DataFrame, draws: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """The rows of the mix: shard, place in it, entry (key and copy), pass and doc. Texts are shuffled once, by key."""
    drawn = draws.where("taken > 0").select(*_KEY, "chunk", "copy", "size", F.explode("draws").alias("d"))
    drawn = drawn.groupBy(*_KEY, "chunk").agg(F.collect_list(F.struct("copy", "size", "d")).alias("takes"))  # CHUNK x MAX_PASSES at most
    rows = docs.select(*_keys(docs, id_col, text_col, source_col, seed), F.struct("*").alias("doc")).dropDuplicates(_KEY)
    rows = rows.join(drawn, _KEY).withColumn("take", F.explode("takes"))
    rows = rows.select(
        F.col("take.d.shard").alias("shard"),
        F.xxhash64(F.lit(seed + 1), "place", "name", "row", "take.copy", "take.d.pass").alias("place"),
        F.struct(*_KEY, "take.copy").alias("entry"),
        F.col("take.d.pass").alias("pass"),
        "doc",
        F.col("take.d.words").alias("words"),
        (F.col("take.d.words") < F.col("take.size")).alias("cut"),
    )
    text = F.col(f"doc.{text_col}")
    short = _leading(F.when(F.col("cut"), text.cast("binary")), "words")
    return rows.withColumn("doc", F.col("doc").withField(text_col, F.when(F.col("cut"), short).otherwise(text)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **options) -> DataFrame:
    """The mix itself: a row for each pass of each taken document, with ``_shard`` and ``_place`` in front.

    Sorted by (_shard, _place) over range partitions; a cut document's text ends with its
    last taken word. The other columns are those of ``docs``.
    """
    draws = draw(docs, id_col, text_col, source_col, seed=seed, **options)
    rows = _shard_rows(docs, draws, id_col, text_col, source_col, seed)
    rows = rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return rows.select(F.col("shard").alias("_shard"), F.col("place").alias("_place"), "doc.*")


def mixed_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
    **options,
) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (its words in the shards of the mix) and shards.

    ``shards`` lists where the mix puts it, as ``pass:shard`` in order of the passes, comma-joined; null where it isn't taken.
    """
    draws = draw(docs, id_col, text_col, source_col, shards, seed=seed, **options)
    rows = _shard_rows(docs, draws, id_col, text_col, source_col, seed)
    key = [*_KEY, "copy"]
    rows = rows.select("entry.*", "pass", "shard", word_count(F.col(f"doc.{text_col}")).alias("words"))
    where = F.sort_array(F.collect_list(F.struct("pass", "shard")))  # MAX_PASSES at most
    taken = rows.groupBy(*key).agg(F.sum("words").alias("taken"), where.alias("takes"))
    asked = draws.drop("taken", "draws")
    return asked.join(taken, key, "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        F.expr("array_join(transform(takes, t -> concat(t.pass, ':', t.shard)), ',')").alias("shards"),
    )
