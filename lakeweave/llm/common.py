"""Shared helpers: tables in the shared folder, row order, connected components."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.session import fresh_dir


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return a frame over the files.

    Cuts the lineage: a lost executor costs a re-read, never a re-run of what came before.
    """
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def release() -> None:
    """Give a worker's free memory back, so that what one stage used doesn't add to the next one's."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def windows(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut before a space or line break: words stay whole."""
    at = 0
    while len(text) - at > size and (cut := _SPACE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def per_text(fn: Callable[[bytes], object], out: pa.DataType) -> Callable[[Column], Column]:
    """A column function from text to one value per row; ``fn`` gets UTF-8 bytes, null as empty.

    Text travels as binary, so any byte sequence that Spark holds is accepted.
    """
    spark_type = T.LongType() if pa.types.is_integer(out) else T.DoubleType()

    @F.arrow_udf(returnType=spark_type)
    def run(column: pa.Array) -> pa.Array:
        values = pa.array([fn(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in column], out)
        release()
        return values

    return lambda text: run(text.cast("binary"))


@F.arrow_udf(returnType=T.LongType())
def _words(column: pa.Array) -> pa.Array:
    # bytes.split() cuts at exactly the characters \x20 and \x09-\x0D
    counts = pa.array([len(x.as_py().split()) if x.is_valid else 0 for x in column], pa.int64())
    release()
    return counts


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    return _words(text.cast("binary"))


def row_hash(df: DataFrame, seed: int) -> Column:
    """64-bit hash of all columns of a row: tells rows apart that share an id and a text."""
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])


def in_range_order(df: DataFrame, keys: list[Column], purpose: str) -> DataFrame:
    """``df`` globally sorted by ``keys`` and saved, with its partition number as ``_part``.

    Range partitions are numbered in key order, so (``_part``, place in the partition) is
    the global order. Equal keys stay in one partition: add a tie-breaking hash to ``keys``
    where one value may hold a large share of the rows.
    """
    parted = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return parted.withColumn("_part", F.spark_partition_id())


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Cut a stream of batches sorted by ``key`` so that no run of equal keys spans two.

    Yields each batch with the start of every run. Holds one batch and one run at a time.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = int(np.searchsorted(keys, keys[-1]))
        if at == 0 and (len(held) == 1 or held[0].column(key)[-1].as_py() == keys[0]):
            continue  # still inside one run
        whole = pa.Table.from_batches([*held[:-1], batch.slice(0, at)]).combine_chunks()
        held = [batch.slice(at)]
        yield from _with_starts(whole, key)
    if held:
        yield from _with_starts(pa.Table.from_batches(held).combine_chunks(), key)


def _with_starts(whole: pa.Table, key: str):
    for batch in whole.to_batches():
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        yield batch, np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long): root is the smallest node reachable.

    Alternating large-star and small-star steps, each a shuffle join or aggregate over the
    links. Every step is written to the shared folder; only a row count and a checksum
    reach the driver. A node in many links is summed with map-side partials and its join
    is an ordinary equi-join that adaptive execution can split.
    """
    links = save(
        links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "components"
    )
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        links = save(
            small.where("v <> m").selectExpr("v AS u", "m AS v").union(low.selectExpr("u", "m AS v")).distinct(),
            "components",
        )
        after = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def partition_offsets(totals: DataFrame, value: str) -> DataFrame:
    """``_part`` totals with the sum of all earlier partitions as ``base``.

    One row per partition of a sorted table (its number is the number of shuffle
    partitions, not of rows), so the one-task running sum is small at any input size.
    """
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("base", F.coalesce(F.sum(value).over(w), F.lit(0).cast("long")))
