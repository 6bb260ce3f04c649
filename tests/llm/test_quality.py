import numpy as np
from pyspark.sql import functions as F

from lakeweave.llm import quality
from lakeweave.llm.queries import op8_quality

from .conftest import SF_CHECK


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable")) + 1.0
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = op8_quality(spark, SF_CHECK)
    assert rows.count() == 1000
    got = rows.join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) >= 0.9
    assert (held["predicted"] == held["quality"]).mean() >= 0.9
    clean = held[held["quality"] == 1]
    assert clean["predicted"].mean() >= 0.95
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()


def test_scores_equal_the_plain_formula():
    rnd = np.random.default_rng(2)
    x = [rnd.normal(0, 1, (60, 4)) @ rnd.normal(0, 1, (4, 4)), rnd.normal(1, 2, (90, 4))]
    model = quality.QuadraticDiscriminant(
        np.array([60.0, 90.0]), np.array([v.sum(axis=0) for v in x]), np.array([v.T @ v for v in x])
    )
    pooled = sum(len(v) * np.cov(v.T, bias=True) for v in x) / 150
    p, d = quality.SHRINK_POOLED, quality.SHRINK_DIAGONAL
    log = []
    for v in x:
        cov = (1 - d) * ((1 - p) * np.cov(v.T, bias=True) + p * pooled) + d * np.diag(np.diag(pooled)) + 1e-6 * np.eye(4)
        diff = x[1] - v.mean(axis=0)
        maha = (diff @ np.linalg.inv(cov) * diff).sum(axis=1)
        log.append(np.log(len(v) / 150) - 0.5 * (maha + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.score(x[1]), 1 / (1 + np.exp(log[0] - log[1])))


def test_sums_over_tasks(spark):
    rnd = np.random.default_rng(3)
    d = len(quality.FEATURES)
    data = [(int(k), rnd.normal(k, 1, d).tolist()) for k in rnd.integers(0, 2, 300)]
    model = quality.fit(spark.createDataFrame(data, "label int, x array<double>").repartition(7))
    x = np.array([v for k, v in data if k == 1])
    assert np.allclose(model.classes[1][0], x.mean(axis=0)) and model.n[1] == len(x)


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 1, 0), (6, 0, 0), (6, 0, 0), (4, 1, 1), (7, 0, 0), (8, 7, 0), (None, 1, 0), (3, None, 0), (99, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    for learn in (F.lit(True), F.lit(False)):
        rows = quality.classify(edge_docs, labels, learn).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows} == {0.5}
    assert quality.classify(no_docs, labels, F.lit(True)).count() == 0
    kept = quality.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert quality.keep_good(no_docs, labels).count() == 0
    assert quality.keep_good(edge_docs, labels.limit(0)).count() == edge_docs.count()
    assert len(quality.statistics(b"")) == len(quality.FEATURES)
