import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeweave.llm import queries
from lakeweave.llm.periodic_runs import RunFinder, _repeat, brute_force_runs, find_runs, runs_of

from .conftest import SF_CHECK


@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 8)), max_size=8))
@settings(max_examples=400, deadline=None)
def test_runs_equal_brute_force(pieces):
    words = [w for unit, times in pieces for w in unit * times]
    assert runs_of(words) == brute_force_runs(words)
    assert runs_of(words, min_length=13) == brute_force_runs(words, 13)
    assert runs_of(words, min_periods=6) == brute_force_runs(words, min_periods=6)


@given(st.lists(st.sampled_from("ab"), max_size=80), st.lists(st.integers(1, 9), min_size=1, max_size=9))
@settings(max_examples=200, deadline=None)
def test_appending_in_any_pieces_gives_the_same_runs(words, sizes):
    hashes = np.array([hash(w) for w in words], np.int64).view(np.uint64)
    finder, at, k = RunFinder(), 0, 0
    while at < len(words):
        finder.append(hashes[at : at + sizes[k % len(sizes)]])
        at, k = at + sizes[k % len(sizes)], k + 1
    assert finder.finish() == brute_force_runs(words)


def test_long_periods_in_a_long_text():
    rng = np.random.default_rng(1)
    for period in (700, 1024, 1025, 3001):
        unit = rng.integers(0, 1 << 40, period).tolist()
        words = [*rng.integers(0, 1 << 40, 501).tolist(), *(unit * 5)[: 4 * period + 17], *rng.integers(0, 1 << 40, 900).tolist()]
        assert runs_of(words) == [(501, 4 * period + 17, period)]
        assert runs_of([*words[: 501 + 4 * period - 1], -1]) == []


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        RunFinder(min_periods=3)


def _plain(doc_id, text):
    """The contract of op11, row by row."""
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len((text or "").encode().split())
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = best[1] * 1000 // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    docs = [r for r in docs if r.text is None or len(r.text) < 6000]  # brute force tries every period
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_periodic_runs(spark, SF_CHECK).collect()}
    want = [_plain(*r) for r in docs]
    assert [got[w[0]] for w in want] == want
    assert sum(w[1] > 0 for w in want) > 40


def test_edges(spark, edge_docs, no_docs):
    rows = find_runs(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edge_docs.collect())
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i].n_words, by_id[i].runs, by_id[i].collapsed) == (0, [], "")
    assert by_id[4].n_words == 200_000
    assert find_runs(no_docs).collect() == []
    made = find_runs(spark.createDataFrame([("x", "a b " * 4 + "c"), (None, "z " * 6)], "doc_id string, text string"))
    found = {r.doc_id: (r.runs, r.collapsed) for r in made.collect()}
    assert found == {"x": ([(0, 8, 2)], "a b c"), None: ([(0, 6, 1)], "z")}


def test_windows_of_a_long_text(monkeypatch):
    from lakeweave.llm import periodic_runs

    text = b" ".join(b"w%d" % (i * i % 977) for i in range(5000))
    want = _repeat(text, 12345)
    whole = [w for part in periodic_runs._windows(want) for w in part]
    monkeypatch.setattr(periodic_runs, "_WINDOW", 100)
    assert _repeat(text, 12345) == want
    assert [w for part in periodic_runs._windows(want) for w in part] == whole
    hashes = periodic_runs._hashes(want)
    runs = periodic_runs._group_runs([hashes], {})[0]
    monkeypatch.setattr(periodic_runs, "_GROUP", 64)
    assert periodic_runs._group_runs([hashes], {})[0] == runs == brute_force_runs(whole)
