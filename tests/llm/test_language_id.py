from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import adlift.llm.language_id as module
from adlift.llm.language_id import counts, has_letter, identify, predict, train, vector
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures

SYLLABLES = {"aa": ["ka", "to", "mi", "ru", "sho"], "bb": ["ung", "ich", "der", "sch", "ein"], "cc": ["é", "eau", "ou", "que", "ai"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(spark, n=300):
    rng = random.Random(1)
    rows = [(i, text(rng, lang := rng.choice(sorted(SYLLABLES)), rng.randint(15, 80)), lang) for i in range(n)]
    rows += [(n, None, "aa"), (n + 1, "", "aa"), (n + 2, "12 !? 34", "bb"), (n + 3, rows[0][1], None), (None, rows[1][1], "x")]
    return rows, spark.createDataFrame([(*r, 1.0, "k") for r in rows], "doc_id long, text string, lang string, score double, held_out string")


def test_held_out_accuracy_and_unknown(spark):
    rows, docs = corpus(spark)
    got = {r.doc_id: r for r in identify(docs.repartition(3)).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2 and r[0] < 300]
    assert all(got[i].held_out for i, _, _ in held) and len(held) > 40
    assert sum(got[i].lang_pred == lang for i, _, lang in held) / len(held) > 0.97
    assert [got[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3
    assert got[303].lang_pred == rows[0][2]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_languages_of_repeated_rows_are_learned(spark):
    for k in range(6):
        rng = random.Random(k)
        rows = [(i, text(rng, "aa", 40), "aa") for i in range(100)]
        rows += [(1000 + k, one := text(rng, "bb", 40), "bb")] * 3000 + [(2000 + k, two := text(rng, "cc", 40), "cc")] * 900
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        model = train(docs, sample=20)
        assert set(model["langs"]) == {"aa", "bb", "cc"}
        asked = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
        assert {r.doc_id: r.lang_pred for r in predict(asked, model).collect()} == {1: "bb", 2: "cc"}
        if k == 1:
            break


def test_model_and_prediction_by_brute_force(spark):
    rows, docs = corpus(spark, 120)
    usable = [(i, t, lang) for i, t, lang in rows if t and lang and has_letter(t)]
    model = train(docs)
    df = sum((counts(t) > 0).astype(np.int64) for _, t, _ in usable)
    idf = np.log((1 + len(usable)) / (1 + df)) + 1
    assert np.allclose(model["idf"], idf)
    for lang in {lang for _, _, lang in usable}:
        own = np.stack([vector(counts(t), idf) for _, t, k in usable if k == lang])
        centres = model["centres"][[k == lang for k in model["langs"]]]
        nearest = (own @ centres.T).argmax(axis=1)
        for k in set(nearest):  # a fixed point of k-means: each centroid is the direction of its documents' sum
            mean = own[nearest == k].sum(axis=0)
            assert np.allclose(centres[k], mean / np.linalg.norm(mean), atol=0.05)
    found = {r.doc_id: r for r in predict(docs.where("doc_id IS NOT NULL"), model).collect()}
    for i, t, _ in usable:
        if i is not None:
            cosine = model["centres"] @ vector(counts(t), idf)
            best = int(cosine.argmax())
            assert found[i].lang_pred == model["langs"][best] and abs(found[i].score - min(1, cosine[best])) < 1e-5
            assert found[i].rejected == (1 - found[i].score > model["reach"][best])


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(module, "LANGS", 2)
    with pytest.raises(ValueError, match="languages"):
        train(corpus(spark, 50)[1])


def test_far_texts_are_rejected(spark):
    _, docs = corpus(spark)
    model = train(docs.where("lang in ('aa', 'bb', 'cc')"))
    odd = spark.createDataFrame([(1, "日本語のテキスト" * 9), (2, text(random.Random(9), "aa", 60))], "doc_id long, text string")
    got = {r.doc_id: r.rejected for r in predict(odd, model).collect()}
    assert got == {1: True, 2: False}


def test_nothing_to_learn(spark, no_docs):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:4] for r in identify(docs).collect()] == [("und", 0.0)]
    assert identify(no_docs).collect() == []


def test_pieces_count_alike(monkeypatch):
    import adlift.llm.language_id as module

    whole = "Some téxt, again and again! " * 50
    before = counts(whole)
    monkeypatch.setattr(module, "PIECE", 64)
    assert (counts(whole) == before).all()
    assert has_letter("é1") and not has_letter("1²½ !") and not has_letter(None)
