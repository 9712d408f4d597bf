from __future__ import annotations

import random

import numpy as np
from llm_helpers import clashing, documents, rows, words

from floorline.llm.components import components
from floorline.llm.minhash import BINS, near_duplicates, shingle_sets, signature


def brute(texts, size, percent):
    """Components by comparing all pairs."""
    table = {chr(c): chr(c + 32) for c in range(65, 91)}
    sets = {}
    for i, text in texts:
        if i is None:
            continue
        own = "".join(table.get(c, c) for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
        own = [w for w in own if w]
        grams = {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if len(own) >= size else ({tuple(own)} if own else set())
        sets.setdefault(i, []).append(grams)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


def edited(rng, base, share):
    return [w if rng.random() > share else f"e{rng.randrange(10 ** 6)}" for w in base]


def test_groups_of_edited_copies_match_all_pairs(spark):
    """Many near copies around the threshold, so that stars alone would miss links."""
    rng = random.Random(3)
    texts = []
    for group in range(4):
        base = words(group, 120, 5000)
        texts += [edited(rng, base, rng.choice((0.0, 0.02, 0.05, 0.07, 0.1))) for _ in range(25)]
    texts += [words(100 + k, rng.randrange(1, 40), 5000) for k in range(30)]
    rng.shuffle(texts)
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    for size, percent in ((2, 80), (5, 80), (1, 60)):
        expected = brute(data, size, percent)
        found = {r["doc_id"]: r for r in near_duplicates(documents(spark, *data), size=size, percent=percent).collect()}
        assert {i: r["component_id"] for i, r in found.items()} == expected
        assert all(r["kept"] == (i == expected[i]) for i, r in found.items())


def test_nulls_empties_repeats_and_clashes(spark):
    long = " ".join(words(1, 30_000, 10 ** 6))
    data = [(5, "A b c"), (3, "a  B\tc"), (7, None), (8, ""), (9, " \n "), (None, "a b c"), (3, "a  B\tc"), (11, "one"), (10, "ONE"),
            (20, long), (19, long), (21, long + " tail")]
    found = near_duplicates(clashing(documents(spark, *data)), size=2)
    assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == sorted([
        (5, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (None, 2, None, True),
        (11, 1, 10, False), (10, 1, 10, True), (20, 29999, 19, False), (19, 29999, 19, True), (21, 30000, 19, False)], key=repr)


def test_empty_table(spark):
    assert near_duplicates(documents(spark)).count() == 0


def test_densified_bins_agree_as_often_as_the_sets(spark):
    rng = np.random.default_rng(0)
    for n in (5, 40, 1000):
        shared = []
        for _ in range(60):
            every = rng.integers(0, 2 ** 64, n + n // 4, dtype=np.uint64)
            a, b = np.sort(every[:n]), np.sort(every[n // 4:])
            shared.append((signature(a) == signature(b)).mean())
        true = (n - n // 4) / (n + n // 4)
        assert abs(np.mean(shared) - true) < 0.06
    assert len(signature(np.array([7], np.uint64))) == BINS


def test_shingles_are_distinct_and_lower_case():
    import pyarrow as pa

    one, two, short, none = shingle_sets(pa.array(["A b a b", "a B", "é", None]), 2)
    assert len(one) == 2 and len(two) == 1 and two[0] in one and len(short) == 1 and len(none) == 0


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (100, 102), (7, 7), (None, 3), (200, 50), (50, 60)]
    found = rows(components(spark.createDataFrame(links, "a long, b long")), "node", "label")
    expected = [(i, 0) for i in range(41)] + [(100, 100), (101, 100), (102, 100), (50, 50), (60, 50), (200, 50)]
    assert found == sorted(expected, key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
