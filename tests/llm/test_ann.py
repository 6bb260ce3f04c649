import numpy as np
from pyspark.sql import functions as F

from lakeweave.llm import ann
from lakeweave.llm.queries import op9_ann

from .conftest import SF_CHECK


def brute_force(rows, query_ids, k=20):
    """Per query id: (vec_id, score) of the nearest others, ties to the smaller id."""
    out = {}
    for q, v in rows:
        if q in query_ids:
            near = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_query_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in table]
    exact = brute_force(rows, {i for i, _ in rows if i % 20 == 0})
    got = op9_ann(spark, SF_CHECK).toPandas().sort_values(["query_id", "rank"])
    assert got.groupby("query_id")["rank"].apply(list).map(lambda x: x == list(range(1, 21))).all()
    by, vectors = got.groupby("query_id")["vec_id"].apply(list).to_dict(), dict(rows)
    assert set(by) == set(exact)
    assert np.mean([len(set(by[q]) & {i for i, _ in exact[q]}) / 20 for q in exact]) >= 0.97
    assert all(abs(s - vectors[q] @ vectors[v]) < 1e-12 for q, v, s in got[["query_id", "vec_id", "score"]].itertuples(index=False))


def test_many_shards_and_unequal_norms(spark):
    rnd = np.random.default_rng(5)
    v = rnd.normal(0, 1, (3000, 24)) * rnd.uniform(0.3, 3, (3000, 1))
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, F.col("vec_id") % 60 == 0, shard_nodes=700).collect()
    exact = brute_force([(i, np.array(x)) for i, x in rows], set(range(0, 3000, 60)))
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(found[q] & {i for i, _ in exact[q]}) / 20 for q in exact]) >= 0.95


def test_copies_ties_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 200)] + [(20, [1.0, 0.0])] + [(300, [0.5, 0.0]), (320, [0.0, 1.0])]
    rows += [(400, None), (420, [0.0, 0.0]), (440, [nan, 1.0]), (460, [inf, 1.0]), (480, [None, 1.0]), (None, [1.0, 1.0]), (500, []), (520, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS dim", "2 AS v", "3 AS id")
    got = ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 200, 20)) | {300, 320}
    for q in range(0, 200, 20):
        assert by[q] == [(i, 1.0) for i in range(21) if i != q][:20]
    assert by[300] == [(i, 0.5) for i in range(20)]
    assert by[320] == [(i, 0.0) for i in range(20)]
    few = ann.nearest(frame.where("vec_id >= 195"), F.col("vec_id") % 20 == 0).where("query_id = 300").collect()
    assert [r["vec_id"] for r in few] == [195, 196, 197, 198, 199, 320]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(frame, F.col("vec_id") % 20 == 0).count() == 0


def test_a_few_very_long_vectors(spark):
    rnd = np.random.default_rng(8)
    v = rnd.normal(0, 1, (3000, 64))
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    v[[30, 601, 1202, 1803]] *= [[1e3], [1e4], [1e5], [1e6]]
    v[[31, 602]] *= [[1e-3], [1e-6]]
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, F.col("vec_id") % 30 == 0).collect()
    exact = brute_force([(i, np.array(x)) for i, x in rows], set(range(0, 3000, 30)))
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(found[q] & {i for i, _ in exact[q]}) / 20 for q in exact]) >= 0.95


def test_norms_beyond_the_squares_of_doubles(spark):
    rows = [(i, [f, f * i / 100]) for i, f in enumerate([1e300, 1e160, 1.0, 1e-160, 1e-170, 1e-300])] + [(20, [1.0, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(ann.nearest(frame, F.col("vec_id") == 20).collect(), key=lambda r: r["rank"])
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4, 5]
    assert len(ann.nearest(frame, F.col("vec_id") == 4).collect()) == 6
