from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from llm_helpers import clashing, documents, words
from pyspark.sql import functions as F

from floorline.llm import quality
from floorline.llm.quality import N_FEATURES, fit, fit_quality, held_out, passage_features, score_quality, score_rows

LABELS = "doc_id long, quality int, toxic int"


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, N_FEATURES)) for n in (1, 3, 5, 2)]
    labels = np.array([0.0, 1.0, 1.0, 0.0])
    model = fit(bags, labels)
    model.weights = {k: rng.normal(0, 0.3, np.shape(v)) for k, v in model.weights.items()}
    every, counts = np.concatenate(bags), np.array([1, 3, 5, 2])

    def loss():
        y = model.forward(every, counts)["y"]
        return -np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y))

    slopes = model.gradients(every, counts, labels)
    for name, weight in model.weights.items():
        flat = np.atleast_1d(weight.reshape(-1))
        for k in rng.integers(0, flat.size, 3):
            moved = []
            for step in (1e-6, -1e-6):
                changed = flat.copy()
                changed[k] += step
                model.weights[name] = changed.reshape(np.shape(weight))
                moved.append(loss())
            model.weights[name] = weight
            assert abs((moved[0] - moved[1]) / 2e-6 - np.atleast_1d(slopes[name].reshape(-1))[k]) < 1e-5


def test_passages_cover_the_whole_text():
    texts = pa.array([" ".join(words(1, 1000)), "", None, "one", " ".join(["a"] * 129)])
    features, counts = passage_features(texts)
    assert counts.tolist() == [16, 1, 1, 1, 3] and len(features) == 22
    assert not features[16].any() and not features[17].any() and features[18].any()
    alone, _ = passage_features(texts[4:5])
    assert np.allclose(alone, features[19:])


def test_rows_with_nulls_repeats_and_clashing_columns(spark):
    good = [(k, " ".join(words(k, 80, 5000))) for k in range(60)]
    bad = [(100 + k, " ".join(w.upper() + "!!" for w in words(k, 80, 5000))) for k in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good + bad] + [(None, 1, 0), (1, None, 0), (2, 7, 0), (5, 1, 1)], LABELS)
    odd = [(200, None), (201, ""), (None, good[0][1]), (3, good[3][1]), (202, " ".join(words(9, 40_000)))]
    frame = clashing(documents(spark, *good, *bad, *odd))
    model = fit_quality(frame, labels)
    found = score_quality(frame, model)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 125
    rows = {r["doc_id"]: r for r in found.collect()}
    assert all(rows[i]["predicted"] == int(i < 100) for i, _ in good + bad)
    assert all(0 <= r["score"] <= 1 for r in rows.values()) and rows[None]["held_out"] is False
    # The score is the text's alone: labels, ids and order do not enter.
    again = score_rows(frame.withColumn("doc_id", -F.col("doc_id")).withColumn("lang", F.lit("?")).repartition(3), model, "s__")
    assert again.columns == [*frame.columns, "s__"]
    assert {r["doc_id"]: round(r["s__"], 9) for r in again.collect() if r["doc_id"] is not None} == {
        -i: round(r["score"], 9) for i, r in rows.items() if i is not None}
    # Held-out labels are not learned from, so turning them round changes nothing.
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = {r["doc_id"]: r["score"] for r in score_quality(frame, fit_quality(frame, turned)).collect()}
    assert all(abs(other[i] - r["score"]) < 1e-12 for i, r in rows.items())


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], LABELS)
    docs = documents(spark, (1, "a b"), (2, None))
    assert fit_quality(docs, none) is None
    assert [(r["score"], r["predicted"]) for r in score_quality(docs, None).collect()] == [(0.5, 0), (0.5, 0)]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert fit_quality(documents(spark), labels) is None
    assert score_quality(documents(spark), None).count() == 0


def test_long_documents_are_fitted_on(spark, monkeypatch):
    bags = []
    monkeypatch.setattr(quality, "fit", lambda found, labels: bags.extend(found) or fit(found, labels))
    long = lambda k: words(k, 4097 + 64 * k, 5000)
    rows = [(k, " ".join(long(k))) for k in range(16)] + [(k, " ".join(w.upper() + "!!" for w in long(k))) for k in range(16, 32)]
    labels = spark.createDataFrame([(k, int(k < 16), 0) for k, _ in rows], LABELS)
    frame = documents(spark, *rows)
    model = fit_quality(frame, labels)
    assert model is not None and {len(b) for b in bags} == {quality.SAMPLE_PASSAGES}
    assert all(r["predicted"] == int(r["doc_id"] < 16) for r in score_quality(frame, model).collect())
    # The passages are the document's own, from all over it.
    own, _ = passage_features(pa.array([rows[0][1]]))
    assert sum(any((p == q).all() for q in own) for p in bags[0]) == len(bags[0])
    assert quality.some_passages(1000, 8).max() > 500 and quality.some_passages(3, 8).tolist() == [0, 1, 2]
    bags.clear()
    assert fit_quality(frame, labels, sample_passages=5) is not None and {len(b) for b in bags} == {5}


def test_labels_that_the_sample_misses_are_an_error(spark):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(400)], LABELS)
    ordered = [r["doc_id"] for r in labels.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()]
    with pytest.raises(ValueError):
        fit_quality(documents(spark, (ordered[-1], "a b")), labels, sample_rows=3)
    assert fit_quality(documents(spark, (1000, "a b")), labels, sample_rows=3) is None


def test_rows_that_repeat_an_id_are_one_bag(spark, monkeypatch):
    bags = []
    monkeypatch.setattr(quality, "fit", lambda found, labels: bags.append(found) or fit(found, labels))
    rows = [(k, " ".join(words(k, 80, 5000))) for k in (0, 1, 3, 5, 7)]
    copies = [(1, " ".join(words(100 + k % 20, 80, 5000))) for k in range(200)] + [(1, None)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k, _ in rows], LABELS)
    kept = [k for k, _ in rows if not spark.range(1).select(held_out(F.lit(k))).first()[0]]
    assert 1 in kept
    for order in (rows + copies, copies[::-1] + rows):
        assert fit_quality(documents(spark, *order).repartition(4), labels, sample_rows=5) is not None
    assert [len(b) for b in bags] == [len(kept)] * 2
    assert all((p == q).all() for p, q in zip(*bags))
