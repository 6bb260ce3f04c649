import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import mixing
from lakeweave.llm.queries import op7_mixing

from .conftest import SF_CHECK


def plain_targets(sizes):
    """Water level by bisection: sum of min(2 size, level * weight) is 1.5 times all sizes."""
    w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(2 * s, mid * k) for s, k in zip(sizes, w)) < 1.5 * sum(sizes):
            low = mid
        else:
            high = mid
    return [min(2 * s, high * k) for s, k in zip(sizes, w)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 3, 5, 0, 70], [5], [0, 0], [], [1, 100, 1, 1, 50]])
def test_targets(sizes):
    assert mixing.source_targets(sizes) == pytest.approx(plain_targets(sizes), abs=1e-6)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").toPandas()
    docs["size"] = [len((t or "").encode().split()) for t in docs["text"]]
    per = docs.groupby("source")["size"].sum().sort_index()
    target = dict(zip(per.index, plain_targets(per.tolist())))
    rows = op7_mixing(spark, SF_CHECK)
    got = rows.toPandas().merge(docs[["doc_id", "source", "size"]], on="doc_id", suffixes=("", "_own"))
    assert len(got) == len(docs) and (got["size"] == got["size_own"]).all()
    assert (got["source_size"] == got["source"].map(per)).all()
    assert np.allclose(got["target"], got["source"].map(target))
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] >= 0).all()
    taken = got.groupby("source")["taken"].sum()
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, op7_mixing(spark, SF_CHECK).collect()))


def test_splitting_tree_keeps_quotas():
    quotas = np.array([17, 0, 400, 3, 80])
    leaves = mixing.split_quotas(quotas, 7, 1)
    assert (leaves.sum(axis=0) == quotas).all()
    assert leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 1
    assert (leaves == mixing.split_quotas(quotas, 7, 1)).all() and (leaves >= 0).all()
    draws = np.array([mixing.split_quotas(np.array([30, 70]), 2, s)[0] for s in range(400)])
    assert abs(draws[:, 0].mean() - 15) < 0.6 and draws[:, 0].std() > 1  # hypergeometric, not a fixed split


def test_mix_rows_follow_the_draws(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    draws = mixing.draw(docs, block_words=500, shards=5)
    mixed = mixing.mix(docs, block_words=500, shards=5).toPandas()
    mixed["words"] = [len(t.encode().split()) for t in mixed["text"]]
    taken = {r["doc_id"]: r["taken"] for r in draws.where("taken > 0").collect()}
    assert mixed.groupby("doc_id")["words"].sum().to_dict() == taken
    assert sorted(mixed["_shard"].unique()) == [0, 1, 2, 3, 4]
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(whole[d].startswith(t) for d, t in zip(mixed["doc_id"], mixed["text"]))
    blocks = draws.select("source_size", F.explode("draws").alias("d")).groupBy("d.shard").count().toPandas()
    assert blocks["count"].min() > 0


def test_edge_rows(spark, edge_docs, no_docs):
    rows = mixing.draw(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["size"] == by[2][0]["size"] == by[3][0]["size"] == by[1][0]["taken"] == 0
    assert [r["copy"] for r in sorted(by[5], key=lambda r: r["copy"])] == [0, 1]
    assert by[4][0]["size"] == 200_000
    sources = {r["source_key"]: r for r in rows}
    assert set(sources) == {"=a", "=b", "=c", "~"}
    for key in sources:
        assert abs(sum(r["taken"] for r in rows if r["source_key"] == key) - sources[key]["target"]) <= 1
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == ["_shard", "_place", *edge_docs.columns]
    assert mixing.draw(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = edge_docs.where("doc_id IN (1, 2, 3)")
    assert mixing.mix(blank).count() == 0 and mixing.draw(blank).count() == 3


def plain_taken(docs):
    """(doc_id -> words) taken from each source's stream in hash order, one document after another."""
    out, per = {}, {}
    for r in sorted(docs, key=lambda r: (r["source"], r["place"])):
        per.setdefault(r["source"], []).append((r["doc_id"], len((r["text"] or "").encode().split())))
    names = sorted(per)
    sizes = [sum(n for _, n in per[s]) for s in names]
    for source, target in zip(names, plain_targets(sizes)):
        left = round(target)
        for _ in range(2):
            for doc, n in per[source]:
                out[doc] = out.get(doc, 0) + min(n, left)
                left -= min(n, left)
    return out


def test_query_counts_the_words_of_the_mixed_shards(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    place = F.xxhash64(F.lit(mixing.SEED), "doc_id", "source", "text").alias("place")
    want = plain_taken(docs.select("doc_id", "source", "text", place).collect())
    assert {r["doc_id"]: r["taken"] for r in op7_mixing(spark, SF_CHECK).collect()} == want


def test_another_tree_gives_other_shards_and_the_same_words(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = mixing.mixed_words(docs, block_words=300).collect()
    where = {(r["doc_id"], take) for r in rows for take in (r["shards"] or "").split(",") if take}
    mixed = mixing.mix(docs, block_words=300).groupBy("_shard").count().collect()
    assert {int(take.split(":")[1]) for _, take in where} == {r["_shard"] for r in mixed} and len(mixed) > 50
    assert len(where) == sum(r["count"] for r in mixed)
    real = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda quotas, shards, seed: real(quotas, shards, seed + 5))
    other = mixing.mixed_words(docs, block_words=300).collect()
    assert {r["doc_id"]: r["taken"] for r in other} == {r["doc_id"]: r["taken"] for r in rows}
    assert {r["doc_id"]: r["shards"] for r in other} != {r["doc_id"]: r["shards"] for r in rows}


def test_rows_that_differ_in_other_columns_are_separate(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 4)
    rows = [(1, "a b c", "s", lang) for lang in ("en", "de")] + [(2, "x y", "s", "fr")] * 11 + [(3, "q " * 90, "t", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = mixing.mix(docs)
    got = sorted((r.doc_id, r.lang) for r in mixed.collect())
    words = {r.doc_id: (r.taken, r["size"]) for r in mixing.mixed_words(docs).collect()}
    assert got.count((1, "en")) == got.count((1, "de")) == 2 and got.count((2, "fr")) == 22
    assert words[1] == (6, 3) and words[2] == (4, 2)
    draws = mixing.draw(docs).where("doc_id = 2").collect()
    assert sorted(r["copy"] for r in draws) == list(range(11)) and {r["chunk"] for r in draws} == {0, 1, 2}


def test_mixed_words_of_edge_rows(spark, edge_docs, no_docs):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    drawn = mixing.draw(edge_docs).select(*columns).collect()
    assert sorted(map(str, mixing.mixed_words(edge_docs).select(*columns).collect())) == sorted(map(str, drawn))
    assert mixing.mixed_words(no_docs).count() == 0
