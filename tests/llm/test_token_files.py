import functools
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeweave.llm import token_files as tf
from lakeweave.llm.queries import END_ID, TOKENIZER, op6_token_files

from .conftest import SF


@functools.cache
def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


@functools.cache
def _encoder():
    return tf.Encoder(TOKENIZER)


def library(text):
    return _library().encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), data=st.data())
def test_codes_round_trip_and_random_access(ids, data):
    codes = tf.Codes(tf.encode_codes(np.array(ids, np.uint32)))
    assert codes.slice(0, len(ids)).tolist() == ids
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert codes.slice(a, b).tolist() == ids[a:b]
    at = data.draw(st.lists(st.integers(0, max(0, len(ids) - 1)), max_size=40)) if ids else []
    assert codes.get(at).tolist() == [ids[i] for i in at]


def test_large_shard_access():
    rnd = np.random.default_rng(0)
    ids = rnd.integers(0, 50_257, 70_000).astype(np.uint32)
    codes = tf.Codes(tf.encode_codes(ids))
    at = rnd.integers(0, len(ids), 5000)
    assert (codes.get(at) == ids[at]).all()
    assert (codes.slice(12_345, 65_432) == ids[12_345:65_432]).all()


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t\u0085 ab'sÉ²½x!?_-0\x1c\x0b", max_size=60)))
def test_words_encode_as_the_whole_text(text):
    assert np.frombuffer(_encoder().encode([text])[0], "<u4").tolist() == library(text)


def test_every_short_character_and_added_token():
    encoder = tf.Encoder(TOKENIZER)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(0x260)] + ["x <|endoftext|> y", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [library(t) for t in texts]


def expected_rows(pairs):
    start, out = 0, []
    for d, text in pairs:
        ids = np.array([*library(text or ""), END_ID], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(map(tuple, op6_token_files(spark, SF).collect())) == expected_rows(sorted(texts.items()))


def test_edge_rows_shards_and_positions(spark, edge_docs, no_docs):
    path = tf.write_token_files(edge_docs, TOKENIZER, END_ID, shard_ids=50)
    got = sorted(map(tuple, tf.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    ends = [0, *np.cumsum([r[2] for r in got]).tolist()]
    assert [r[1] for r in got] == ends[:-1]
    text = {r["doc_id"]: r["text"] for r in edge_docs.collect() if r["doc_id"] is not None}
    for d, _, n, crc in got[2:]:
        assert (n, crc) == expected_rows([(d, text[d])])[0][2:]
    all_ids = np.concatenate([[*library(t or ""), END_ID] for t in [text[d] for d in (1, 2, 3, 4, 5, 5, 6, 7, 8)]])
    base = got[2][1]
    wanted = [0, 1, 1, 5, len(all_ids) // 2, len(all_ids) - 1, -3, 10**9]
    positions = spark.createDataFrame([(base + p,) for p in wanted], "position long")
    found = {r["position"] - base: r["id"] for r in tf.tokens_at(spark, path, positions).collect()}
    assert found == {p: int(all_ids[p]) for p in wanted if 0 <= p < len(all_ids)} | ({-3: found[-3]} if -3 in found else {})
    assert tf.read_documents(spark, tf.write_token_files(no_docs, TOKENIZER, END_ID)).count() == 0
