import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import embedding_dedup, queries
from lakeweave.llm.embedding_dedup import audited_recall, build_graph, distinct_vectors, exact_links, near_duplicates, robust_prune, search_links

from .conftest import SF, SF_CHECK


def brute_force(rows, cosine=0.9):
    """(id, n_links, component_id, kept) by all pairs."""
    usable = [
        i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    count, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for dim in {len(rows[i][1]) for i in usable}:
        own = [i for i in usable if len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in own], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(np.triu(x @ x.T >= cosine, 1))
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = own[i], own[j]
            count[i] += 1
            count[j] += 1
            root[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            ids[top(i)] = min(name, ids.get(top(i), name))
    out = []
    for i, (name, _) in enumerate(rows):
        component = ids.get(top(i))
        out.append((name, count[i], component, name == component))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def clustered(spark):
    """Groups of near copies of all sizes, chains, exact copies and vectors on their own."""
    rng = np.random.default_rng(5)
    rows = [rng.normal(size=24) * rng.choice([1e-3, 1, 1e4]) for _ in range(1500)]
    for size in (2, 3, 5, 40, 700):
        center = rng.normal(size=24)
        rows += [center + rng.normal(size=24) * np.linalg.norm(center) * 0.05 for _ in range(size)]
    x = rng.normal(size=24)
    for _ in range(60):  # a chain: neighbours are linked, ends are not
        x = x / np.linalg.norm(x) + rng.normal(size=24) * 0.06
        rows.append(x)
    rows += [rows[3]] * 50 + [2 * rows[7]]
    data = [(i, [float(c) for c in v]) for i, v in enumerate(rows)]
    rng.shuffle(data)
    return data


def test_links_equal_brute_force_in_one_and_many_shards(spark, clustered):
    df = spark.createDataFrame(clustered, "vec_id long, embedding array<double>")
    want = brute_force(clustered)
    assert rows_of(near_duplicates(df)) == want
    assert rows_of(near_duplicates(df, shard_nodes=300)) == want


def test_probes_double_until_the_audit_is_content(spark, clustered, monkeypatch):
    df = spark.createDataFrame(clustered, "vec_id long, embedding array<double>")
    seen = []
    real = audited_recall

    def audit(*args, **kwargs):
        seen.append(real(*args, **kwargs))
        return 0.0

    monkeypatch.setattr(embedding_dedup, "audited_recall", audit)
    got = rows_of(near_duplicates(df, probes=2, shard_nodes=200))
    assert got == brute_force(clustered)  # every cluster was searched in the end
    assert len(seen) >= 2 and seen == sorted(seen) and seen[-1] > 0.97


def test_audit_counts_exactly(spark, clustered):
    df = spark.createDataFrame(clustered, "id long, v array<double>")
    nodes = distinct_vectors(df.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v")))
    exact = {r.node: r.exact for r in exact_links(nodes, nodes).collect()}
    got = {r.first_id: exact.get(r.node, 0) + r.n - 1 for r in nodes.collect()}
    want = {name: n for name, n, _, _ in brute_force(clustered)}
    assert got == {name: want[name] for name in got}


def test_search_finds_links_without_the_exact_step(clustered):
    x = np.array([v for _, v in clustered])
    x = np.unique(x / np.linalg.norm(x, axis=1, keepdims=True), axis=0)
    _, links = build_graph(x.astype(np.float32))
    a, b = search_links(x, np.ones(len(x), bool), links, 0.9)
    found = np.zeros((len(x), len(x)), bool)
    found[a, b] = True
    every = x @ x.T >= 0.9
    np.fill_diagonal(every, False)
    small = every & (every.sum(axis=1) < 100)[:, None]  # a beam has room for their links
    assert not (found & ~every).any() and (found & small).sum() >= 0.99 * small.sum()


def test_robust_prune_keeps_no_stand_in():
    x = np.array([[1, 0], [0.99, 0.141], [0.985, 0.17], [0, 1]], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = robust_prune(x, np.array([[1, 2, 3, -1]]), np.array([x[[1, 2, 3, 0]] @ x[0]]))
    assert kept[0, :3].tolist() == [1, 3, -1]


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.op12_embedding_dedup(spark, SF_CHECK)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows_of(got.withColumnRenamed("vec_id", "id")) == brute_force([(r[0], list(r[1])) for r in rows])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [1.0, 0.1]), (None, [0.0, 1.0]), (None, None),
        (8, [1.0, 0.0, 0.0]), (9, [1e200, 1e199, 0.0]), (10, [-0.0, 3.0, 0.0]), (11, [0.0, 3.0, 0.0]), (12, [1e-300, 1e-300, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS node", "'a' AS root", "2 AS n", "3 AS id", "'b' AS v", "4 AS shard"
    )
    got, want = rows_of(near_duplicates(df)), brute_force(rows)
    assert [(a, b, c) for a, b, c, _ in got] == [(a, b, c) for a, b, c, _ in want]
    assert all(kept == (a == c) for a, _, c, kept in got)
    assert rows_of(near_duplicates(df.limit(0))) == []
    assert len(rows_of(near_duplicates(spark.read.parquet(f"{SF}/embeddings.parquet")))) == 500
