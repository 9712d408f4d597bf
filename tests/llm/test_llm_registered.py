from __future__ import annotations

import binascii

import public_tokenizers
import pytest
from conftest import SMALL
from llm_helpers import connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from floorline.llm.oracle import oracle
from floorline.llm.queries import registered


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registered())
    assert numbers == list(range(1, 14))
    assert registered().keys() <= contract.queries().keys()
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", oracle())
def test_query_matches_its_sql(spark, name):
    found = registered()[name](spark, SMALL)
    expected = connect(SMALL).sql(oracle()[name])
    columns = expected.columns
    left = sorted(repr(tuple(r[c] for c in columns)) for r in found.collect())
    assert left == sorted(map(repr, expected.fetchall()))


def test_quality_on_held_out_rows(spark):
    """Accuracy on labels that the fit has not seen, on more rows than the other tests."""
    folder = "/root/testdata/sf0.01"
    found = registered()["op3_quality_attention"](spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert all(r["held_out"] == (binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found.collect())


def test_language_on_held_out_rows(spark):
    """Accuracy on documents that the fit has not seen, on more rows than the other tests."""
    folder = "/root/testdata/sf0.01"
    found = registered()["op13_byte_language"](spark, folder)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = found.collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert len(unseen) > 150 and sum(r["lang_pred"] == docs[r["doc_id"]] for r in unseen) / len(unseen) > 0.97


def test_token_files_match_the_tokenizer(spark):
    found = {r["doc_id"]: r for r in registered()["op4_wavelet_token_files"](spark, SMALL).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        own = found.pop(r["doc_id"])
        assert (own["start"], own["n_tokens"]) == (start, len(ids))
        assert own["ids_crc32"] == binascii.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        start += len(ids)
    assert not found


def test_segmentations_decode_to_their_texts(spark):
    found = registered()["op5_sampled_segmentations"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.crc32(F.col("text").cast("binary")).alias("own"))
    counts = found.join(docs, "doc_id").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.countDistinct("ids_hash").alias("distinct"), F.min(F.col("own") == F.col("text_crc32")).alias("same"))
    rows = counts.collect()
    assert len(rows) == docs.count() and all(r["n"] == r["distinct"] == 3 and r["same"] for r in rows)
