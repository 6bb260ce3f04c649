"""Registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    collocations,
    decontaminate,
    embedding_dedup,
    language_id,
    mixing,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    token_count,
    token_files,
    warc,
)
from .common import table

#: The vocabulary folder is a parameter; nothing of it is kept here.
UNIGRAM_VOCABULARY = os.environ.get("LLM_UNIGRAM_VOCABULARY", public_tokenizers.path("piece_bpe_32k.model"))
TOKENIZER = os.environ.get("LLM_TOKENIZER", public_tokenizers.path("byte_bpe_50k.json"))
END_ID = 2


def remainder(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(name).cast("string")) % n


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), UNIGRAM_VOCABULARY)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.read_archive(spark, path).select(*columns)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, remainder("doc_id", 4) != 2)
    found = language_id.label_languages(docs, model)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER, END_ID)
    return token_files.read_documents(spark, path)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.classify(docs, labels, remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.plant(table(spark, sf_dir, "documents")))
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period)))")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_simhash,
        op2_token_count,
        op3_secret_scan,
        op4_warc,
        op5_language_id,
        op6_token_files,
        op7_mixing,
        op8_quality,
        op9_ann,
        op10_decontaminate,
        op11_periodic_runs,
        op12_embedding_dedup,
        op13_collocations,
    ]
    return {f.__name__: f for f in found}
