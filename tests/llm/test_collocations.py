import re
from collections import Counter

import numpy as np
import pytest

from lakeweave.llm import collocations, queries
from lakeweave.llm.collocations import phrase_counts

from .conftest import SF, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, max_words=3, min_count=10, top=2000):
    """The contract of op13 with dictionaries and Python integers."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                own.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, own in f.items():
        frequent = {p: a for p, a in own.items() if a >= min_count and len(p) > 1}
        inside = Counter()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        found = []
        for p, a in frequent.items():
            if 100 * inside[p] >= 50 * a:
                continue
            cuts = [(10**6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for i, (score, a, phrase, l, r) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()
    want = brute_force(docs)
    assert rows_of(queries.op13_collocations(spark, SF)) == want
    assert len(want) > 100


@pytest.mark.parametrize("max_words", [2, 4])
def test_partitions_that_cut_a_hot_word(spark, monkeypatch, max_words):
    texts = [("en", " ".join(f"the w{(i * k) % 23} the v{i % 7}. of the, a" for i in range(40))) for k in range(1, 30)]
    texts += [(None, "Q q q q Q q, Zz\tz " * 9), ("und", "q Q " * 30), ("x", None), ("y", "")]
    docs = spark.createDataFrame(texts, "lang string, text string")
    monkeypatch.setattr(collocations, "_TOKENS", 50)  # many flushes, also inside a text
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(collocations.collocations(docs, max_words=max_words, top=50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = brute_force(texts, max_words=max_words, top=50)
    assert got == want
    assert {r[0] for r in got} == {"en", "und"}


def test_counts_do_not_depend_on_flushes(monkeypatch):
    text = b"a b c, A b. c\nc c c c " * 50
    everything = np.full(64, 255, np.uint8)

    def count(tokens, size, fn):
        monkeypatch.setattr(collocations, "_TOKENS", tokens)
        counter, total = collocations._Counter("en", 3), Counter()
        for _ in range(3):
            for part in collocations._windows(text, size):
                if counter.full(part):
                    fn(counter, total)
                counter.add(part)
        fn(counter, total)
        return total

    def phrases(counter, total):
        for batch in counter.phrase_counts("en", everything):
            for _, phrase, n in zip(*(c.to_pylist() for c in batch.columns)):
                total[phrase] += n

    def hashes(counter, total):
        for batch in counter.hash_counts():
            for h, n in zip(*(c.to_pylist() for c in batch.columns)):
                total[h] += n

    for fn in (phrases, hashes):
        assert count(1 << 22, 1 << 20, fn) == count(3, 5, fn) == count(1, 1, fn)


def test_the_bitmap_loses_no_frequent_phrase(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bitmap = collocations.frequent_bitmap(docs, "lang", "text", 10)
    rows = docs.select("lang", "text").collect()
    set_bits = int(np.unpackbits(bitmap).sum())
    assert 0 < set_bits < 0.2 * 8 * len(bitmap)
    got = phrase_counts(docs).groupBy("lang", "phrase").agg({"n": "sum"}).collect()
    pairs = {(r.lang, bytes(r.phrase).decode()): r["sum(n)"] for r in got}
    for lang in {r.lang for r in rows}:
        every = Counter()
        for r in rows:
            if r.lang == lang:
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r.text or "").translate(LOWER)):
                    w = re.findall(r"[^\x20\x09]+", piece)
                    every.update(" ".join(p) for p in zip(w, w[1:]))
        for phrase, n in every.items():
            assert pairs.get((lang, phrase), n if n < 10 else None) == n


def test_scores_are_exact_beyond_64_bits(spark):
    counts = [("a", 3 * 10**12 + 1), ("b", 2 * 10**12 + 3), ("a b", 10**12 + 7), ("", 10**13)]
    made = spark.createDataFrame([("en", p.encode(), n) for p, n in counts], "lang string, phrase binary, n long")
    docs = spark.createDataFrame([], "lang string, text string")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(collocations, "phrase_counts", lambda *a: made)
        got = rows_of(collocations.collocations(docs))
    a, l, r = 10**12 + 7, 3 * 10**12 + 1, 2 * 10**12 + 3
    assert got == [("en", 1, "a b", a, l, r, 10**13, 10**6 * a * a // (l * r))]


def test_edges(spark, edge_docs, no_docs):
    assert rows_of(collocations.collocations(no_docs)) == []
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    assert rows_of(collocations.collocations(edge_docs)) == brute_force(rows)
    odd = spark.createDataFrame([("en", bytearray(b"x \xff y " * 12))], "lang string, text binary")
    odd = odd.selectExpr("lang", "cast(text AS string) AS text")
    assert rows_of(collocations.collocations(odd)) == brute_force([("en", "x \ufffd y " * 12)])
    assert phrase_counts(edge_docs.where("doc_id = 4")).where("phrase = cast('' AS binary)").first().n == len(words(200_000).split())
