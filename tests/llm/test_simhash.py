import random

import xxhash
from pyspark.sql import functions as F

from lakeweave.llm import simhash
from lakeweave.llm.common import connected_components, table
from lakeweave.llm.queries import op1_simhash

from .conftest import SF_CHECK, words


def plain_print(text, k=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """doc_id -> smallest linked doc_id, by comparing all pairs."""
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[find(a)] = find(b)
    low = {}
    for d, v in prints.items():
        low[find(v)] = min(d, low.get(find(v), d))
    return {d: low[find(v)] for d, v in prints.items()}


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_CHECK, "documents").collect()}
    prints = {d: plain_print(t) for d, t in docs.items()}
    got = {r["doc_id"]: r for r in op1_simhash(spark, SF_CHECK).collect()}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{v:016x}" for d, v in prints.items()}
    assert {d: r["component_id"] for d, r in got.items()} == plain_components(prints)


def test_every_link_is_found_and_blocks_lose_none(spark):
    rnd = random.Random(3)
    centre = [rnd.getrandbits(64) for _ in range(6)]
    values = set(centre)
    for c in centre:
        for _ in range(60):
            values.add(c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 6))))
    values |= {centre[0] ^ 0b1111, centre[1] ^ (0b11 << 20) ^ (0b11 << 41)}
    prints = dict(enumerate(sorted(values)))
    expected = plain_components(prints)
    rows = spark.createDataFrame([(d, simhash._signed(v)) for d, v in prints.items()], "id long, fp long")
    for block in (simhash.BLOCK, 5):
        found = rows.join(simhash.components(rows, block), "fp").collect()
        assert {r["id"]: r["component_id"] for r in found} == expected
    links = simhash.near_links(rows.select("fp"))
    assert links.count() < len(values) * 3 * 24  # a forest per bucket, not all pairs
    assert all((r["a"] ^ r["b"]).bit_count() <= 4 for r in links.selectExpr("a & 9223372036854775807 a", "b & 9223372036854775807 b").collect())


def test_components_of_a_random_graph(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {n: n for p in pairs for n in p}
    for _ in range(500):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n in got}
    assert set(got) == {n for a, b in pairs if a != b for n in (a, b)}


def test_edge_rows(spark, edge_docs, no_docs):
    rows = simhash.simhash_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = {}
    for r in rows:
        got.setdefault(r["id"], set()).add((r["fp"], r["component_id"]))
    assert got[1] == got[2] == got[3] == {(0, 1)}
    assert got[5] == {(simhash._signed(plain_print(words(60))), 5)} and {c for _, c in got[6]} == {5}
    assert (0, 1) in got[None] and (simhash._signed(plain_print(words(60, 5))), None) in got[None]
    assert got[4] == {(simhash._signed(plain_print(words(200_000))), 4)}
    assert simhash.simhash_groups(no_docs).count() == 0


def test_keep_one(spark, edge_docs, no_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda d: (d is None, d))
    assert ids == [1, 4, 5, 7, 8, None]
    assert simhash.keep_one(no_docs).count() == 0
    null_ids = edge_docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.keep_one(null_ids).count() == 6


def test_keep_one_keeps_the_same_row_every_time(spark):
    rows = [(1, "a b c d e", lang, i) for i, lang in enumerate(("en", "de", "fr", "es"))] * 2 + [(2, "a b c d e", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra int")
    kept = {tuple(r) for p in (1, 3, 8) for r in simhash.keep_one(docs.repartition(p)).collect()}
    assert len(kept) == 1 and kept.pop() in set(rows[:4])
