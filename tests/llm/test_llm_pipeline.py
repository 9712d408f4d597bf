from __future__ import annotations

import collections

import pyarrow as pa
import pytest
from conftest import SMALL
from llm_helpers import documents, words
from pyspark.sql import functions as F
from test_llm_decontamination import brute as brute_hits
from test_llm_minhash import brute as brute_groups
from test_llm_substrings import brute as brute_spans

import corpus_pipeline
from floorline.llm.common import stored
from floorline.llm.quality import fit_quality, passage_features
from floorline.llm.segmentations import decode_pieces


@pytest.fixture(scope="module")
def steps(spark):
    """The documents and each stage's result, written and read again."""
    frames = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SMALL), name))
    return frames


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_order_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substrings", "decontaminate", "segment"]
    assert all(f.dtypes == steps[0].dtypes for f in steps[1:5])


def test_quality_keeps_what_the_model_accepts(spark, steps):
    model = fit_quality(steps[0], spark.read.parquet(f"{SMALL}/labels.parquet"))
    expected = {i for i, t in texts(steps[0]) if model.forward(*passage_features(pa.array([t])))["y"][0] >= 0.7}
    assert {i for i, _ in texts(steps[1])} == expected and 0 < len(expected) < steps[0].count()


def test_one_document_of_each_group_stays(steps):
    groups = brute_groups(texts(steps[1]), 5, 80)
    assert sorted(texts(steps[2])) == sorted((i, t) for i, t in texts(steps[1]) if groups[i] == i)


def test_repeated_passages_go(steps):
    before = dict(texts(steps[2]))
    expected = {i: kept if gone else before[i] for i, _, gone, kept in brute_spans(list(before.items()), 50)}
    assert dict(texts(steps[3])) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in steps[3].collect())


def test_contaminated_documents_go(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    dirty = {i for i, _, _, _, hit in brute_hits(texts(steps[3]), items) if hit}
    assert sorted(texts(steps[4])) == sorted((i, t) for i, t in texts(steps[3]) if i not in dirty)


def test_segmentations_are_those_of_the_texts(steps):
    found = collections.defaultdict(set)
    for r in decode_pieces(steps[5]).collect():
        found[r["doc_id"]].add((r["decoded"], tuple(r["ids"])))
    for i, text in texts(steps[4]):
        assert {t for t, _ in found[i]} == {text} and len(found.pop(i)) == (3 if text else 1)
    assert not found


def test_segmentations_come_decoded(steps):
    by_id = dict(texts(steps[4]))
    found = steps[5].collect()
    assert found and all(r["decoded"] == (by_id[r["doc_id"]] or "") for r in found)


def test_run_is_the_stages(spark, steps):
    key = lambda r: (r["doc_id"], r["sample"], tuple(r["ids"]))
    assert sorted(map(key, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(key, steps[5].collect()))


def test_stages_take_odd_rows_and_empty_tables(spark):
    passage = " ".join(words(5, 80, 10 ** 6))
    odd = [(1, passage), (2, f"start {passage} end"), (3, None), (4, ""), (None, passage), (None, None), (1, passage), (5, "a")]
    frame = documents(spark, *odd).withColumn("kept", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        for rows in (frame, frame.limit(0)):
            found = stage(spark, rows, SMALL)
            assert found.count() <= 3 * rows.count()
            assert name == "segment" or found.dtypes == rows.dtypes
