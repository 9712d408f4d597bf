from __future__ import annotations

import hashlib

import pytest
from llm_helpers import SCHEMA, clashing, documents
from pyspark.sql import functions as F

from floorline.llm.merkle import folded, leaf_digest, merkle_manifest, proof_digest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*fields):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def levels_of(nodes, fan):
    """A tree's digest and, for every node, its (left, right) siblings level by level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            run = nodes[at[k] // fan * fan:at[k] // fan * fan + fan]
            path.append(("".join(run[:at[k] % fan]), "".join(run[at[k] % fan + 1:])))
        nodes = [h(*nodes[a:a + fan]) for a in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return nodes[0], paths


def brute(rows, fan):
    """{row: (leaf, path, subroot, root)} by the definition; null ids and sources first."""
    first = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((first(r[0]), leaf_of(r[0], r[3], r[2], r[4], r[1]), r))
    names = sorted(groups, key=first)
    tops = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:2])
        tops[name] = levels_of([leaf for _, leaf, _ in groups[name]], fan)
    root, above = levels_of([tops[name][0] for name in names], fan)
    out = []
    for name, top_path in zip(names, above):
        for (_, leaf, r), path in zip(groups[name], tops[name][1]):
            out.append((r[0], leaf, path + top_path, tops[name][0], root))
    return sorted(out, key=repr)


def found(frame, fan):
    rows = merkle_manifest(frame, fan=fan).collect()
    return sorted(((r["doc_id"], r["leaf"], [(s["left"], s["right"]) for s in r["path"]], r["subroot"], r["root"]) for r in rows), key=repr)


@pytest.mark.parametrize("fan, sizes", [(2, [1, 2, 3, 4, 5, 17]), (3, [9, 10, 28, 1]), (16, [300, 16, 17, 1]), (2, [1]), (2, [33])])
def test_proofs_match_the_definition(spark, fan, sizes):
    """Groups of one node, of whole runs, of one more, and of more than one, two and three rounds of blocks."""
    rows = [(100 * k + i, f"text {k} {i} é", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(frame, fan) == brute(rows, fan)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", None, "s", None), (None, None, None, None, None), (None, "", "en", None, 0),
            (3, "x" * 200_000, "en", "é", 200_000), (2, None, "en", "Z", 0), (4, "long", "fr", "é", 4), (None, "", "en", None, 0)]
    frame = clashing(spark.createDataFrame(rows, SCHEMA)).withColumn("path", F.lit(1)).withColumn("digest", F.lit(2)).withColumn("own", F.lit(3))
    assert found(frame, 2) == brute(rows, 2)
    assert merkle_manifest(documents(spark)).count() == 0
    with pytest.raises(ValueError):
        merkle_manifest(frame, fan=1)


def test_only_true_leaves_fold_to_the_root(spark):
    frame = documents(spark, *[(i, f"Text {i}") for i in range(40)])
    other = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text"))
    rows = merkle_manifest(frame, keep={"other": other}).select(
        "root", "path", folded(F.col("leaf"), F.col("path")).alias("own"), folded(F.col("other"), F.col("path")).alias("changed"),
        proof_digest(F.col("path")).alias("proof")).collect()
    assert len(rows) == 40 and all(r["own"] == r["root"] != r["changed"] for r in rows)
    assert all(r["proof"] == h(*(s["left"] + s["right"] for s in r["path"])) for r in rows)


def test_a_hot_group_spreads(spark):
    """One group of many rows is ranked by several tasks and rolled up in blocks."""
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
                                     F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    rows = merkle_manifest(frame.repartition(8)).select(folded(F.col("leaf"), F.col("path")).alias("own"), "root", F.size("path").alias("n")).collect()
    assert len(rows) == 5000 and {r["n"] for r in rows} == {4} and all(r["own"] == r["root"] for r in rows)
