import functools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeweave.llm import token_count
from lakeweave.llm.queries import UNIGRAM_VOCABULARY, op2_token_count

from .conftest import SF


def library(vocabulary, byte_fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


@functools.cache
def _pair():
    return token_count.UnigramCounter(VOCABULARY), library(VOCABULARY, True)


VOCABULARY = token_count.read_vocabulary(UNIGRAM_VOCABULARY)


def test_query_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    reference = library(VOCABULARY, True)
    got = {r["doc_id"]: r["n_tokens"] for r in op2_token_count(spark, SF).collect()}
    assert got == {d: len(reference.encode(t).ids) for d, t in texts.items()}


SMALL = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.5), ("b", -1.5), ("ab", -3.0), ("ba", -3.0), ("aba", -4.5), ("▁a", -2.5), ("bb", -2.0)]


@pytest.mark.parametrize("fallback", [False])
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="ab ▁cé\n", max_size=24))
def test_ties_and_unknown_runs(fallback, text):
    counter = token_count.UnigramCounter(SMALL, fallback)
    assert counter.text(text) == len(library(SMALL, fallback).encode(text).ids)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text_with_byte_fallback(text):
    counter, reference = _pair()
    assert counter.text(text) == len(reference.encode(text).ids)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(token_count, "CACHE", 3)
    counter = token_count.UnigramCounter(SMALL)
    assert counter.text("a b ab ba aba bb a b") == token_count.UnigramCounter(SMALL).text("a b ab ba aba bb a b")
    assert len(counter.known) <= 3


def test_long_words_are_whole_and_not_cached():
    for word in ("ab" * 5000, "é" * 3000 + "aba" * 1000):
        counter = token_count.UnigramCounter(SMALL, False)
        assert counter.text(word) == len(library(SMALL, False).encode(word).ids)
        assert not counter.known


def test_edge_rows(spark, edge_docs, no_docs):
    rows = token_count.count_tokens(edge_docs, UNIGRAM_VOCABULARY).collect()
    assert len(rows) == edge_docs.count()
    got = {r["doc_id"]: r["n_tokens"] for r in rows if r["doc_id"] is not None}
    reference = library(VOCABULARY, True)
    assert got[1] == got[2] == 0
    assert got[4] == len(reference.encode(edge_docs.where("doc_id = 4").first()["text"]).ids)
    assert token_count.count_tokens(no_docs, UNIGRAM_VOCABULARY).count() == 0
