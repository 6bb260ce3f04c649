"""A training corpus from ``documents``: five stages, each a Parquet table for the next.

quality classifier -> SimHash near-dedup -> benchmark decontamination -> mixing -> token files

Every stage reads the whole table its predecessor wrote and all but the last return the
columns of documents. A row is dropped by the quality classifier (score under 0.5), as a near copy
(the smallest doc_id of each group stays), for a leaked benchmark passage, or by the mix, which also
repeats rows and cuts the last document of each source's quota. The mix leaves its rows by shard, shuffled inside, and the
token files keep that order, so each holds the mix of sources. The last stage returns one row per mixed document from
the token files. Nulls, empty texts and empty tables are defined by the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm import decontaminate, mixing, quality, simhash, token_files
from lakeweave.llm.common import save, table
from lakeweave.llm.queries import END_ID, TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs).drop("_shard", "_place")
    if "n_chars" in docs.columns:  # a cut document is shorter
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's order is the order of its rows in the files that the mixing stage left."""
    order = ["_metadata.file_name", "_metadata.row_index"]
    try:
        docs.select(*order)
    except AnalysisException:  # rows that come from no files: ascending ids
        order = None
    path = token_files.write_token_files(docs, TOKENIZER, END_ID, order=order)
    return token_files.read_documents(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The classifier, fingerprints and tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
