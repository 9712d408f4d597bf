from __future__ import annotations

import numpy as np
import pytest
from llm_helpers import SCHEMA, clashing, documents
from pyspark.sql import functions as F

from floorline.llm.language import WINDOW, Model, fit_language, predict_language, some_windows, train, windows_of
from floorline.llm.quality import held_out

ALPHABETS = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwé"}


def text(lang, seed, n):
    rng = np.random.default_rng(seed)
    return "".join(rng.choice(list(ALPHABETS[lang] + " "), n))


def rows(n, size=120):
    return [(k, text(lang, k, size + k % 70), lang, "s", None) for k in range(n) for lang in [list(ALPHABETS)[k % 3]]]


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    model = Model.fresh(["a", "b", "c"], 5, rng)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    data, filled, _ = windows_of([bytes(rng.integers(1, 6, n, dtype=np.uint8)) for n in (150, 30, 64, 1)])
    labels = rng.integers(0, 3, len(data))
    _, slopes = model.gradients(data, filled, labels)
    for name, weight in model.weights.items():
        places = rng.integers(0, weight.size, 4) if name[1:] != "E" else rng.integers(15, 15 * 6, 6)
        for k in places:
            moved = []
            for step in (1e-6, -1e-6):
                model.weights[name] = weight.copy()
                model.weights[name].flat[k] += step
                moved.append(model.gradients(data, filled, labels)[0])
            model.weights[name] = weight
            assert abs((moved[0] - moved[1]) / 2e-6 - slopes[name].flat[k]) < 1e-7


def test_windows_cover_the_whole_text():
    data, filled, owner = windows_of([b"", b"x" * 64, b"y" * 130, b"z"])
    assert filled.tolist() == [64, 64, 64, 2, 1] and owner.tolist() == [1, 2, 2, 2, 3]
    assert [bytes(d[:n])[:1] for d, n in zip(data, filled)] == [b"x", b"y", b"y", b"y", b"z"] and not data[3][2:].any()
    long = bytes(range(1, 200)) * 20
    some = some_windows(long, 4)
    assert len(some) == 4 * WINDOW and all(some[k:k + WINDOW] in long for k in range(0, len(some), WINDOW)) and some_windows(b"short", 4) == b"short"


def test_every_position_counts():
    """A text's probabilities are the mean over all of its bytes, wherever they are and whatever lies beside it."""
    rng = np.random.default_rng(1)
    model = Model.fresh(["a", "b"], 4, rng)
    texts = [bytes(rng.integers(1, 255, n, dtype=np.uint8)) for n in (300, 5, 64, 1000)]
    together = model.text_probabilities(texts)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-5)
    for k, t in enumerate(texts):
        assert np.allclose(together[k], model.text_probabilities([t])[0], atol=1e-5)
    parts = [model.text_probabilities([texts[3][a:a + WINDOW]])[0] * len(texts[3][a:a + WINDOW]) for a in range(0, 1000, WINDOW)]
    assert np.allclose(sum(parts) / 1000, together[3], atol=1e-5)
    assert model.text_probabilities([b""]).tolist() == [[0, 0]]
    # What labels texts computes what is trained.
    model.weights = {k: v * 4 for k, v in model.weights.items()}
    data, filled, _ = windows_of(texts)
    slow = model.position_probabilities(data, filled) * (np.arange(WINDOW)[:, None] < filled)[:, :, None]
    assert np.allclose(model.labelled(data, filled), slow.sum(axis=0), atol=1e-4)


def test_training_tells_alphabets_apart():
    found = rows(90)
    data, filled, owner = windows_of([r[1].encode() for r in found])
    model = train(data, filled, np.array([list(ALPHABETS).index(found[k][2]) for k in owner]), list(ALPHABETS), steps=60)
    fresh = [(lang, text(lang, 1000 + k, 90)) for k in range(20) for lang in ALPHABETS]
    assert [list(ALPHABETS)[k] for k in model.text_probabilities([t.encode() for _, t in fresh]).argmax(axis=1)] == [lang for lang, _ in fresh]


def test_odd_rows_and_clashing_columns(spark):
    odd = [(500, None, "aa", "s", 0), (501, "", "aa", "s", 0), (502, "12 !? 3", "bb", "s", 7), (None, text("bb", 7, 200), "bb", "s", 0),
           (3, text("cc", 8, 50), None, "s", 0), (503, text("cc", 9, 300_000), "cc", "s", 0)]
    frame = clashing(spark.createDataFrame(rows(120) + odd, SCHEMA))
    model = fit_language(frame, steps=80)
    assert model.languages == list(ALPHABETS)
    found = predict_language(frame, model)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 126
    by = {}
    for r in found.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[k][0]["lang_pred"] == list(ALPHABETS)[k % 3] for k in range(120) if k != 3)
    assert {r["lang_pred"] for r in by[3]} == {"aa", "cc"} and by[None][0]["lang_pred"] == "bb" and by[None][0]["held_out"] is False
    assert [(by[k][0]["lang_pred"], by[k][0]["score"]) for k in (500, 501, 502)] == [("und", 0.0)] * 3 and by[503][0]["lang_pred"] == "cc"
    # Only the text enters a prediction, and held-out languages are not learned from.
    again = predict_language(frame.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 1000).repartition(3), model)
    assert sorted(round(r["score"], 4) for r in again.collect()) == sorted(round(r["score"], 4) for r in found.collect())
    turned = fit_language(frame.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("aa")).otherwise(F.col("lang"))), steps=80)
    assert all(np.array_equal(turned.weights[k], v) for k, v in model.weights.items())


def test_without_languages_or_rows(spark):
    nothing = documents(spark, (1, None), (2, "12"))
    assert fit_language(nothing) is None and fit_language(documents(spark)) is None
    assert [(r["lang_pred"], r["score"]) for r in predict_language(documents(spark, (1, "abc"), (2, None)), None).collect()] == [("und", 0.0)] * 2
    assert predict_language(documents(spark), None).count() == 0
    with pytest.raises(ValueError):
        fit_language(nothing, steps=0)


def test_the_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("floorline.llm.language.train", lambda data, filled, labels, languages, *_: seen.append((data, labels, languages)))
    frame = spark.createDataFrame(rows(300, 2000), SCHEMA)
    fit_language(frame.union(frame), sample_languages=2, sample_rows=5, sample_windows=3)
    data, labels, languages = seen[0]
    assert len(languages) == 2 and max(np.bincount(labels)) <= 15 and len(data) <= 30 and min(np.bincount(labels)) > 3
