import itertools
import random

import numpy as np

from lakeweave.llm import decontaminate as dc
from lakeweave.llm.queries import op10_decontaminate

from .conftest import SF_CHECK


def plain_overlaps(doc, items):
    """Items with a long enough stretch on any diagonal, by trying all of them."""
    out = set()
    for k, item in enumerate(items):
        for diagonal in range(-len(item) + 1, len(doc)):
            low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
            equal = np.array([item[i] == doc[i + diagonal] for i in range(low, high)], bool)
            start, n, same = dc.best_stretch(equal)
            if n >= min(dc.MIN_TOKENS, len(item)) and n and same >= dc.SIMILARITY * n:
                out.add(k)
    return out


def test_masks_hit_every_stretch_with_two_substitutions():
    n = dc.MIN_TOKENS
    for holes in itertools.chain.from_iterable(itertools.combinations(range(n), k) for k in range(3)):
        assert any(all(start + p not in holes for p in mask) for mask in dc.MASKS for start in range(n - mask[-1]))


def test_query_finds_every_whole_item_and_only_leaks(spark):
    docs = {r["doc_id"]: dc.tokens(r["text"] or "") for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    items = {r["item_id"]: dc.tokens(r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()}
    lines = {d: f" {' '.join(t)} " for d, t in docs.items()}
    planted = {(d, i) for d, line in lines.items() for i, t in items.items() if f" {' '.join(t)} " in line}
    rows = op10_decontaminate(spark, SF_CHECK).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == planted and planted
    for r in rows:
        text, item = docs[r["doc_id"]], items[r["item_id"]]
        assert text[r["first_token"] : r["first_token"] + r["n_tokens"]] == item and r["similarity"] == 1


def test_substituted_passages(spark):
    rnd = random.Random(6)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [[rnd.choice(vocabulary) for _ in range(n)] for n in (30, 12, 7, 3, 0)]
    texts = []
    for trial in range(120):
        item = items[trial % 4]
        part = list(item)
        for at in rnd.sample(range(len(part)), min(len(part), rnd.choice([0, 1, 2, 6, 9]))):
            part[at] = rnd.choice(vocabulary + ["new"])
        texts.append([rnd.choice(vocabulary) for _ in range(20)] + part + [rnd.choice(vocabulary) for _ in range(rnd.randrange(20))])
    block = dc.Benchmark([(i, " ".join(t)) for i, t in enumerate(items)])
    for text in texts:
        found = {o[0] for o in block.overlaps("! ".join(text).upper())}
        exact = plain_overlaps(text, items)
        assert found <= exact
        assert {k for k in exact if len(items[k]) >= dc.MIN_TOKENS} <= found


def test_blocks_give_the_same_rows(spark):
    docs, items = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(tuple, dc.find_leaks(docs, items).collect()))
    assert sorted(map(tuple, dc.find_leaks(docs, items, block_tokens=2500).collect())) == one
    kept = dc.drop_leaks(docs, items, block_tokens=2500)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({r[0] for r in one})


def test_edge_rows(spark, edge_docs, no_docs):
    from .conftest import words

    rows = [(1, words(60)), (2, None), (3, ""), (None, words(12, 5)), (1, words(60)), (4, "x")]
    items = spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 AS block", "2 AS doc_id")
    found = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in dc.find_leaks(edge_docs, items).collect())
    # document 8 is a copy of item 4, a single word
    assert found == [(0, 0), (4, 1), (4, 1)] + [(5, 1)] * 4 + [(6, 1)] * 2 + [(8, 4)]
    kept = [r["doc_id"] for r in dc.drop_leaks(edge_docs, items).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 7, None], key=str)
    assert dc.find_leaks(no_docs, items).count() == dc.find_leaks(edge_docs, items.limit(0)).count() == 0
    assert dc.drop_leaks(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_hits_held_in_small_parts_give_the_same_rows(monkeypatch):
    rnd = random.Random(8)
    items = [["a"] * 25, [rnd.choice("ab") for _ in range(40)], [rnd.choice("abc") for _ in range(30)]]
    texts = [" ".join(rnd.choice("abx") for _ in range(300)) for _ in range(10)] + ["a " * 500]
    block = dc.Benchmark([(i, " ".join(t)) for i, t in enumerate(items)])
    whole = [block.overlaps(t) for t in texts]
    monkeypatch.setattr(dc, "_CHUNK", 64)
    assert [block.overlaps(t) for t in texts] == whole and any(whole)


def test_repeated_items_are_one_item_with_a_count(spark):
    text = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(7, text)] * 300 + [(8, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"see {text} here"), (2, "clean")], "doc_id long, text string")
    assert [len(b.items) for b in dc.benchmark_blocks(items)] == [2]
    rows = dc.find_leaks(docs, items).groupBy("doc_id", "item_id").count().collect()
    assert sorted(map(tuple, rows)) == [(1, 7, 300), (1, 8, 1)]


def every_stretch(doc, item):
    """Whether any stretch of any diagonal, of 10 tokens or the whole item at least, is 80% equal: all starts and lengths."""
    least = min(10, len(item))
    for diagonal in range(-len(item) + 1, len(doc)):
        low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
        equal = [item[i] == doc[i + diagonal] for i in range(low, high)]
        for start in range(len(equal)):
            for n in range(least, len(equal) - start + 1):
                if 5 * sum(equal[start : start + n]) >= 4 * n:
                    return True
    return False


def test_masks_hit_every_stretch_the_rule_admits():
    for n in range(10, 20):  # a longer stretch falls into two of 10 or more, one of them as equal
        for k in range(n // 5 + 1):
            for holes in itertools.combinations(range(n), k):
                assert any(all(s + p not in holes for p in mask) for mask in dc.MASKS for s in range(n - mask[-1])), (n, holes)


def test_the_whole_rule_by_brute_force():
    rnd = random.Random(12)
    copies = [(50, range(4, 50, 5)), (50, range(2, 50, 5)), (10, [5]), (13, [3]), (10, [0, 9]), (10, [1, 4, 8]), (15, [4, 9, 14])]
    copies += [(n, rnd.sample(range(n), rnd.randint(0, n // 4 + 1))) for n in rnd.choices(range(10, 45), k=150)]
    some = 0
    for n, changed in copies:
        item = [f"t{i}" for i in range(n)]
        part = [f"new{i}" if i in set(changed) else w for i, w in enumerate(item)]
        text = ["a", "b", *part[rnd.choice([0, 0, 3]) :], "c"]
        found = dc.Benchmark([(1, " ".join(item))]).overlaps(" ".join(text))
        assert bool(found) == every_stretch(text, item), (n, sorted(changed))
        for _, start, tokens, same in found:
            shift = next(i - int(w[1:]) for i, w in enumerate(text) if w[0] == "t")
            equal = [text[i] == f"t{i - shift}" for i in range(start, start + tokens)]
            assert tokens >= 10 and same == sum(equal) and 5 * same >= 4 * tokens
        some += bool(found)
    assert 20 < some < len(copies)


def test_leaked_rows_at_the_edge_of_the_rule(spark):
    item = [f"w{i}" for i in range(50)]
    fifth = " ".join(f"x{i}" if i % 5 == 4 else w for i, w in enumerate(item))
    docs = spark.createDataFrame([(1, fifth), (2, fifth.replace("w1 ", "y ").replace("w48", "y"))], "doc_id long, text string")
    docs = docs.union(spark.createDataFrame([(3, " ".join(f"z{i}" for i in range(60)))], "doc_id long, text string"))
    items = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    rows = {r["doc_id"]: r for r in dc.find_leaks(docs, items).collect()}
    assert set(rows) == {1, 2} and all(r["similarity"] >= 0.8 and r["n_tokens"] >= 10 for r in rows.values())
    assert [r["doc_id"] for r in dc.drop_leaks(docs, items).collect()] == [3]


def test_short_items_are_found_whole(spark):
    items = [("a", "one two three four"), ("b", "Blue whale"), ("c", "\u6771\u4eac\u306f\u5927\u304d\u3044\u90fd\u5e02\u3067\u3059\u3002"), ("d", "zebra"), (None, "?!"), ("e", None)]
    docs = [
        (1, "Well: one, two; THREE four five"),
        (2, "one two four three blue zebras whale"),
        (3, "a blue whale, a blue whale"),
        (4, "\u6628\u65e5\u6771\u4eac\u306f\u5927\u304d\u3044\u90fd\u5e02\u3067\u3059\u304b"),
        (5, "\u6771\u4eac\u306f\u5c0f\u3055\u3044"),
        (6, "zebra"),
        (7, None),
    ]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = dc.find_leaks(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.first_token, r.n_tokens, r.n_equal) for r in rows) == [
        (1, "a", 1, 4, 4), (3, "b", 1, 2, 2), (4, "c", 2, 10, 10), (6, "d", 0, 1, 1)
    ]
    assert sorted(r.doc_id for r in dc.drop_leaks(docs, bench).collect()) == [2, 5, 7]


def test_windows_of_a_long_text_give_the_same_overlaps(monkeypatch):
    item = [f"t{i}" for i in range(40)]
    text = " ".join(f"f{i % 91}" for i in range(5000)) + " " + " ".join(item) + " " + " ".join(f"g{i}" for i in range(3000))
    block = dc.Benchmark([(1, " ".join(item))])
    assert block.overlaps(text) == [(0, 5000, 40, 40)]
    real = dc.windows
    monkeypatch.setattr(dc, "windows", lambda t: real(t, 50))
    assert block.overlaps(text) == [(0, 5000, 40, 40)]
