from __future__ import annotations

import random
import re

from llm_helpers import clashing, documents, rows, words
from pyspark.sql import functions as F

from floorline.llm.substring_dedup import group_of, substring_dedup


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts, window):
    split = [(i, words_of(t)) for i, t in texts]
    least = {}
    for i, own in split:
        for s in range(len(own) - window + 1):
            key, rank = tuple(own[s:s + window]), (i is None, i or 0)
            least[key] = min(least.get(key, rank), rank)
    out = []
    for i, own in split:
        gone = set()
        for s in range(len(own) - window + 1):
            if least[tuple(own[s:s + window])] < (i is None, i or 0):
                gone |= set(range(s, s + window))
        out.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return sorted(out, key=repr)


def test_matches_brute_force_over_several_groups(spark):
    """Passages shared by many, overlapping and at the ends, with groups and buckets small enough to have several."""
    rng = random.Random(1)
    shared = [words(k, rng.randrange(8, 30), 10 ** 6) for k in range(6)]
    texts = []
    for i in range(120):
        own = words(1000 + i, rng.randrange(0, 40), 10 ** 6)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(own) + 1)
            own[at:at] = rng.choice(shared)
        texts.append((rng.randrange(100), " ".join(own)))
    texts += [(500 + k, texts[k][1]) for k in range(20)]
    found = substring_dedup(documents(spark, *texts), window=8, group_bytes=2000, bucket_windows=100)
    assert rows(found, "doc_id", "n_words", "n_removed", "kept") == brute(texts, 8)
    for r in found.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_nulls_empties_repeats_long_texts_and_clashes(spark):
    passage = " ".join(words(1, 60, 10 ** 6))
    long = " ".join(words(2, 50_000, 10 ** 6))
    texts = [(1, passage), (2, f"x {passage} y"), (2, f"x {passage} y"), (None, passage), (None, passage), (3, None), (4, ""),
             (5, " \t\n"), (6, long), (7, f"{long} {passage}"), (8, "a\u00a0b c")]
    frame = clashing(documents(spark, *texts))
    found = substring_dedup(frame)
    left = [(0, passage), (60, "x y"), (60, "x y"), (60, ""), (60, ""), (0, ""), (0, ""), (0, ""), (0, long), (50_060, ""), (0, "a\u00a0b c")]
    expected = [(i, len(words_of(t)), gone, kept) for (i, t), (gone, kept) in zip(texts, left)]
    assert rows(found, "doc_id", "n_words", "n_removed", "kept") == sorted(expected, key=repr)
    whole = substring_dedup(frame, keep_columns=True)
    assert rows(whole.select("row.doc_id", "row.kept", "row.grp", whole["kept"].alias("text")), "doc_id", "kept", "grp") == sorted(
        [(i, "x", "x") for i, _ in texts], key=repr)
    assert {r["row"]["doc_id"]: r["kept"] for r in whole.collect()}[5] == " \t\n"
    assert substring_dedup(documents(spark)).count() == 0


def test_rows_of_one_id_or_none_spread_over_groups(spark):
    shared = words(3, 12, 10 ** 6)
    texts = [(i, " ".join(words(k, 20, 10 ** 6) + shared + words(500 + k, 5, 10 ** 6))) for k, i in enumerate([None] * 60 + [7] * 60 + [9, 8, 3])]
    frame = documents(spark, *texts)
    most = frame.groupBy(F.col("doc_id"), group_of(F.col("doc_id"), F.col("text"), 10).alias("g")).count().agg(F.max("count")).first()[0]
    assert most < 30
    found = substring_dedup(frame, window=8, group_bytes=2000, bucket_windows=100)
    assert rows(found, "doc_id", "n_words", "n_removed", "kept") == brute(texts, 8)
