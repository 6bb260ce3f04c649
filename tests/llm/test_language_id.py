import itertools

import numpy as np
from pyspark.sql import functions as F

from lakeweave.llm import language_id as li
from lakeweave.llm.queries import op5_language_id

from .conftest import SF_CHECK


def test_held_out_accuracy(spark):
    rows = op5_language_id(spark, SF_CHECK).join(spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out")
    assert 150 < held.count() < 350
    assert held.where("lang_pred = lang").count() / held.count() >= 0.97
    assert rows.where("score < 0 OR score > 1").count() == 0
    wrong = rows.where("held_out <> (crc32(cast(doc_id AS string)) % 4 = 2)").count()
    assert wrong == 0


def model(texts):
    counts = {}
    for lang, text in texts.items():
        total = counts.setdefault(lang, np.zeros(li.BUCKETS + li.N_SCRIPTS))
        bucket, _, _, length, script = li._trigrams(li._codes(text))
        total[: li.BUCKETS] += np.bincount(bucket, minlength=li.BUCKETS)
        total[li.BUCKETS :] += np.bincount(script, weights=length, minlength=li.N_SCRIPTS)
    return li.LanguageModel(counts)


MODEL = model(
    {
        "en": "the quick brown fox jumps over the lazy dog and the cat with this that there where " * 5,
        "es": "el perro corre por la calle con los niños que están en el parque y la niña también " * 5,
        "ru": "быстрая коричневая лиса прыгает через ленивую собаку и кошку " * 5,
    }
)


def test_spans_of_mixed_text():
    text = "the quick dog and the cat that jumps el perro corre con los niños en la calle быстрая лиса и собака"
    (lang, score, spans), = li._predict(MODEL, [text])
    assert [s["lang"] for s in spans] == ["en", "es", "ru"]
    assert [text[s["start"] : s["end"]].split()[0] for s in spans] == ["the", "el", "быстрая"]
    assert spans[-1]["end"] == len(text) and 0 < score < 1 and lang in ("en", "es")


def test_scripts_narrow_candidates():
    scores, _, _ = MODEL.words(li._codes("собака dog 漢字"))
    assert scores[0].argmax() == 2 and scores[0, 2] - scores[0, :2].max() > 1e5
    assert scores[1, 2] < scores[1, :2].min() - 1e5
    assert abs(scores[2]).max() < 1e5  # no language wrote this script: all stay


def test_viterbi_equals_brute_force():
    rnd = np.random.default_rng(4)
    scores = rnd.normal(0, 12, (13, 3)).astype(np.float32)
    sizes = np.array([0, 6, 1, 5, 0, 1])
    got = MODEL.label(scores, sizes)
    at = 0
    for n in sizes:
        own = scores[at : at + n].astype(float)
        best = max(
            itertools.product(range(3), repeat=int(n)),
            key=lambda p: sum(own[i, s] for i, s in enumerate(p)) - li.SWITCH_PENALTY * sum(a != b for a, b in zip(p, p[1:])),
        )
        assert tuple(got[at : at + n]) == best
        at += n


def test_long_texts_are_scored_in_pieces(monkeypatch):
    text = "the quick dog and el perro corre. " * 40
    whole = MODEL.words(li._codes(text))
    monkeypatch.setattr(li, "PIECE", 17)
    for a, b in zip(whole, MODEL.words(li._codes(text))):
        assert np.allclose(a, b, atol=1e-3)


def test_edge_rows(spark, edge_docs, no_docs):
    trained = li.train(edge_docs, F.col("doc_id") > 3)
    assert trained.langs == ["de", "en", "xx"]
    rows = li.label_languages(edge_docs, trained).collect()
    assert len(rows) == edge_docs.count()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [got[d]["lang_pred"] for d in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0
    assert got[4]["lang_pred"] in trained.langs
    assert li.label_languages(no_docs, trained).count() == 0
    untrained = li.train(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in li.label_languages(edge_docs, untrained).collect()} == {"und"}


def test_many_languages_are_scored_in_smaller_pieces_alike(monkeypatch):
    assert li._share(1 << 20, 3) == 1 << 20 and li._share(1 << 20, 64) == 1 << 16
    rnd = np.random.default_rng(4)
    counts = {f"l{i}": rnd.integers(0, 50, li.BUCKETS + li.N_SCRIPTS).astype(float) for i in range(9)}
    model = li.LanguageModel(counts)
    text = " ".join("".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(400))
    whole = list(li._predict(model, [text]))
    monkeypatch.setattr(li, "PIECE", 64)
    assert list(li._predict(model, [text])) == whole
