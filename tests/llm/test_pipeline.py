import corpus_pipeline
from lakeweave.llm import decontaminate, mixing, simhash
from lakeweave.llm.common import save

from .conftest import SF
from .test_simhash import plain_components, plain_print
from .test_token_files import expected_rows


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(save(stage(spark, seen[-1], SF), name))
    start, good, distinct, clean, mixed, tokens = seen
    assert all(x.columns == columns for x in seen[:-1])
    bad = {r["doc_id"] for r in start.join(good, "doc_id", "left_anti").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    right = sum((r["doc_id"] in bad) == (r["quality"] == 0) for r in labels)
    assert right / len(labels) > 0.9
    prints = {r["doc_id"]: plain_print(r["text"]) for r in good.collect()}
    assert {r["doc_id"] for r in distinct.collect()} == set(plain_components(prints).values())
    leaks = {r["doc_id"] for r in decontaminate.find_leaks(distinct, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in distinct.collect()} - leaks
    taken = {r["doc_id"]: r["taken"] for r in mixing.draw(clean).where("taken > 0").collect()}
    words = {}
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"])
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert words == taken
    rows = sorted(map(tuple, tokens.collect()), key=lambda r: r[1])
    texts = {}
    for r in mixed.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    landed = mixed.select("_metadata.file_name", "_metadata.row_index", "doc_id").collect()
    order = sorted((r["file_name"], r["row_index"], r["doc_id"]) for r in landed)
    assert [r[0] for r in rows] == [r[2] for r in order]  # the mix's shards and their shuffle
    plain = sorted((d, n, c) for d, _, n, c in expected_rows([(d, t) for d in texts for t in texts[d]]))
    assert sorted((d, n, c) for d, _, n, c in rows) == plain
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(rows)


def test_stages_take_edge_rows_and_empty_tables(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        n = docs.count()
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < 4:
                assert out.columns == docs.columns
            assert out.count() <= 2 * n


def test_entry_registers_the_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", "op1_simhash", "op10_decontaminate"} <= names
    assert "op4_warc" in entry.oracle_sql()
