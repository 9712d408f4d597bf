from __future__ import annotations

import collections
import itertools
import math

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import clashing, documents, words
from pyspark.sql import functions as F

from floorline.llm.common import mix
from floorline.llm.segmentations import KEPT_WORDS, MODEL, Beginnings, Lattices, Sampler, Vocabulary, decode_pieces, inclusion, sample_segmentations


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(public_tokenizers.path(MODEL))


def every_path(lattices, node=0):
    if node < 0:
        yield (), 1.0
        return
    for edge in range(lattices.low[node], lattices.low[node + 1]):
        for rest, share in every_path(lattices, int(lattices.target[edge])):
            yield (edge, *rest), float(lattices.share[edge]) * share


def test_shares_are_those_of_all_segmentations(vocabulary):
    """Each path's product is its weight over the weight of all."""
    for word in ("▁the", "thoner", "▁日a", "é\u0007x"):
        lattices = Lattices(vocabulary)
        lattices.numbers([word])
        found = dict(every_path(lattices))
        weigh = lambda p: vocabulary.weight[p] if p < vocabulary.size else len(lattices.spelt[p - vocabulary.size]) * vocabulary.byte_weight
        heavy = {path: math.exp(sum(weigh(int(lattices.piece[e])) for e in path)) for path in found}
        total = sum(heavy.values())
        assert all(abs(found[p] - heavy[p] / total) < 1e-6 for p in found)
        assert len({tuple(lattices.piece[list(p)]) for p in found}) == len(found)


def test_samples_are_drawn_without_replacement(vocabulary):
    """First samples follow the shares, pairs follow successive drawing, all distinct."""
    lattices = Lattices(vocabulary)
    lattices.numbers(["ing", "▁th"])
    words_, n = lattices.numbers(["ing"]), 6000
    exact = dict(every_path(lattices))
    sampler = Sampler(lattices, np.repeat(words_, n), np.ones(n, np.int64), mix(np.arange(n).astype(np.uint64)), 3)
    first, pairs = collections.Counter(), collections.Counter()
    for k in range(n):
        found = sampler.text(k)
        paths = [tuple(edges.tolist()) for edges, *_ in found]
        assert len(set(paths)) == len(paths) == min(3, len(exact))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:]))
        first[paths[0]] += 1
        pairs[paths[0], paths[1]] += 1
    for path, share in exact.items():
        assert abs(first[path] / n - share) < 4 * math.sqrt(share / n) + 1e-3
    for (a, b), count in pairs.items():
        share = exact[a] * exact[b] / (1 - exact[a])
        assert abs(count / n - share) < 4 * math.sqrt(share / n) + 2e-3


def test_inclusion_scores_are_unbiased(vocabulary):
    """The mean of share / inclusion over the samples estimates 1."""
    lattices = Lattices(vocabulary)
    words_ = lattices.numbers(["▁thoner"])
    n, total = 4000, 0.0
    sampler = Sampler(lattices, np.repeat(words_, n), np.ones(n, np.int64), mix(np.arange(n).astype(np.uint64)), 3)
    for k in range(n):
        total += sum(math.exp(log - chance) for _, log, _, chance in sampler.text(k))
    assert abs(total / n - 1) < 0.05
    assert inclusion(-100) == -100 and inclusion(50) == 0 and abs(inclusion(0) - math.log(1 - math.exp(-1))) < 1e-12


TEXTS = [(1, "Hello  world,\n\nthis is\ta test. "), (2, "日本語 \u0007 ünï"), (3, None), (4, ""), (5, " "), (6, "a"), (6, "a"), (None, "no id"),
         (7, "x" * 3000), (8, " ".join(words(1, 5000, 10 ** 6)))]


def test_round_trip_seeds_and_odd_rows(spark):
    frame = clashing(documents(spark, *TEXTS))
    found = decode_pieces(sample_segmentations(frame, top=4)).collect()
    texts = collections.defaultdict(set)
    for r in found:
        texts[r["doc_id"]].add(r["decoded"])
    assert texts == {i: {t or ""} for i, t in TEXTS}
    per_row = collections.Counter(r["doc_id"] for r in found)
    assert per_row[3] == per_row[4] == 1 and per_row[1] == 4 and per_row[6] == 2 * len({tuple(r["ids"]) for r in found if r["doc_id"] == 6})
    assert all(len({tuple(r["ids"]) for r in found if r["doc_id"] == i}) == 4 for i in (1, 7, 8))
    assert per_row[2] == len({tuple(r["ids"]) for r in found if r["doc_id"] == 2})
    together = sample_segmentations(frame, top=4, decode=True).collect()
    assert sorted((str(r["doc_id"]), r["sample"], r["decoded"]) for r in together) == sorted(
        (str(r["doc_id"]), r["sample"], r["decoded"]) for r in found)
    again = decode_pieces(sample_segmentations(documents(spark, *TEXTS).repartition(5), top=4)).collect()
    key = lambda r: (str(r["doc_id"]), r["sample"], r["ids"], round(r["log_prob"], 9))
    assert sorted(map(key, found)) == sorted(map(key, again))
    other = sample_segmentations(documents(spark, TEXTS[-2]), seed=1).first()["ids"]
    assert other != next(r["ids"] for r in found if r["doc_id"] == 7 and r["sample"] == 1)


def test_empty_table_and_null_lists(spark):
    assert sample_segmentations(documents(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert decode_pieces(nothing).select(F.col("decoded")).collect() == [(None,), ("",)]


def test_kept_lattices_stay_small(vocabulary):
    """All that a task may keep takes less than 100 MB, with the room to grow."""
    lattices, n = Lattices(vocabulary), 20_000
    parts = ["tion", "er", "shth", "an", "in", "edly", "re", "ou", "th", "ere", "on", "ent", "ing"]
    made = list(dict.fromkeys("▁" + "".join(p) for p in itertools.product(parts, repeat=4)))[:n]
    for k in range(0, n, 1000):
        lattices.numbers(made[k:k + 1000])
    assert len(lattices.number) == n
    assert sum(room.nbytes for room in lattices.room.values()) * KEPT_WORDS / n < 100e6


def test_first_steps_and_all_steps_give_the_same_samples(vocabulary):
    """Looking at a few steps first, then at all where those do not settle it, changes no sample."""
    texts = [["▁" + w for w in words(k, n, 10 ** 6)] for k, n in enumerate((1, 3, 40, 400))]
    lattices, found = Lattices(vocabulary), []
    numbers = lattices.numbers([w for own in texts for w in own])
    for near in (1, 100, 10 ** 6):
        sampler = type("Narrow", (Sampler,), {"NEAR": near})(lattices, numbers, np.array([len(t) for t in texts]), mix(np.arange(4).astype(np.uint64)), 4)
        found.append([[(edges.tolist(), *rest) for edges, *rest in sampler.text(k)] for k in range(4)])
    assert found[0] == found[1] == found[2] and len(found[0][3]) == 4


def test_beginnings_are_found_by_their_hashes():
    """Also those that share a place with others; what is not in the table is nowhere."""
    hashes = np.r_[np.arange(1, 50), mix(np.arange(1, 3000))].astype(np.uint64)
    table, pieces = Beginnings(hashes, np.arange(len(hashes), dtype=np.int32) - 1), np.arange(len(hashes)) - 1
    assert (table.find(hashes) == pieces).all()
    assert (table.find(mix(np.arange(5000, 9000))) == Beginnings.NOWHERE).all()
