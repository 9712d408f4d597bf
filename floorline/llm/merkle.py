"""A Merkle manifest of a table: a root over all rows, and for every row the proof that it belongs to it.

Rows are ranked within their group without gathering a group: sorted into ranges,
numbered within a range, and moved up by the counts of the ranges before.  The
digits of a rank in base ``fan`` are then grouped away one after another, each
step hashing a run of up to ``fan`` nodes and nesting them as an array of structs.
A nested row is bounded: it holds ``fan * fan`` nodes, and the digests of these
blocks are the nodes of the next round, so a group of any size takes a few rounds.
On the way down every block meets the path above it by an aggregation over block
numbers, and a transform and an explode give its nodes their proofs; no join takes part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.llm.common import ranked, stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"


def digest_of(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row's fields: each ``-`` if null, otherwise its length in UTF-8 bytes, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return digest_of(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest_of(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of a proof's siblings, from the leaf's level up and from left to right."""
    return digest_of(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def rolled(nodes: DataFrame, fan: int) -> DataFrame:
    """Blocks of ``fan * fan`` nodes (``grp``, ``rank``, ``n``, ``digest``, ``own``), nested, with the digest of each block.

    A group's levels end once it has one node, so a group of one node keeps its digest and one of up to ``fan`` nodes has one level.
    """
    digits = nodes.select(
        "grp", "n", F.expr(f"rank div {fan * fan}").alias("block"), F.expr(f"rank div {fan} % {fan}").alias("high"),
        F.expr(f"rank % {fan}").alias("low"), "digest", "own",
    ).repartition("grp", "block")  # the one shuffle; both groupings below are within it
    runs = digits.groupBy("grp", "block", "n", "high").agg(
        F.array_sort(F.collect_list(F.struct("low", "digest", "own"))).alias("nodes"))
    hashed = lambda children, more: F.when(more, digest_of(F.array_join(children["digest"], ""))).otherwise(children[0]["digest"])
    runs = runs.withColumn("digest", hashed(F.col("nodes"), F.col("n") > 1))
    blocks = runs.groupBy("grp", "block", "n").agg(F.array_sort(F.collect_list(F.struct("high", "digest", "nodes"))).alias("runs"))
    return blocks.withColumn("digest", hashed(F.col("runs"), F.col("n") > fan))


def climbed(nodes: DataFrame, fan: int) -> list[DataFrame]:
    """The blocks of every round up to one block per group."""
    rounds = []
    while True:
        rounds.append(stored(rolled(nodes, fan), "merkle-blocks"))
        if rounds[-1].filter(F.col("n") > fan * fan).isEmpty():
            return rounds
        nodes = rounds[-1].select("grp", F.col("block").alias("rank"), F.ceil(F.col("n") / (fan * fan)).alias("n"), "digest",
                                  F.lit(None).cast("string").alias("own"))


def lowered(blocks: DataFrame, above: DataFrame, fan: int) -> DataFrame:
    """The nodes of all blocks with their path to the root, from each block's own (``grp``, ``block``, ``path`` and what else ``above`` has)."""
    carried = [c for c in above.columns if c not in ("grp", "block")]
    trees = blocks.select("grp", "block", "n", "runs", *(F.lit(None).cast(above.schema[c].dataType).alias(c) for c in carried))
    paths = above.select("grp", "block", F.lit(None).cast("long").alias("n"),
                         F.lit(None).cast(blocks.schema["runs"].dataType).alias("runs"), *carried)
    met = trees.unionByName(paths).groupBy("grp", "block").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in ("n", "runs", *carried)))

    def step(digests: Column, at: Column, more: Column) -> Column:
        beside = F.struct(F.array_join(F.slice(digests, F.lit(1), at), "").alias("left"),
                          F.array_join(F.slice(digests, at + 2, F.lit(fan)), "").alias("right"))
        return F.when(more, F.array(beside)).otherwise(F.array().cast(f"array<{STEP}>"))

    def proofs(run: Column, i: Column) -> Column:
        return F.transform(run["nodes"], lambda node, j: F.struct(
            (F.col("block") * fan * fan + i * fan + j).alias("rank"), node["digest"].alias("digest"), node["own"].alias("own"),
            F.concat(step(run["nodes"]["digest"], j, F.col("n") > 1), step(F.col("runs")["digest"], i, F.col("n") > fan), "path").alias("path")))

    each = F.explode(F.flatten(F.transform("runs", proofs))).alias("node")
    return met.select("grp", *(c for c in carried if c != "path"), each).select("grp", *(c for c in carried if c != "path"), "node.*")


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id",
                    keep: Mapping[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """Per row: ``order``, ``leaf``, ``path`` (``left`` and ``right`` siblings of each level), ``subroot``, ``root``, and the columns of ``keep``.

    Leaves of a group ascend by ``order``; every ``fan`` consecutive nodes become
    their digest until one, the subroot, remains.  Subroots ascend by group and
    give the root likewise.  Null groups and null order values come first, rows
    that repeat an order value by their leaves; equal rows are told apart by place
    alone.  Null fields and empty texts have digests of their own.  An empty table
    gives no row.  Other columns are not read.  A text is hashed by one task but
    not kept, so it may be as long as a row may be.
    """
    if fan < 2:
        raise ValueError("a node has at least two children")
    kept = {"key": F.col(order), **(keep or {})}
    leaves = stored(docs.select(F.col(group).alias("grp"), leaf_digest(*map(F.col, fields)).alias("digest"),
                                F.struct(*(c.alias(name) for name, c in kept.items())).alias("own"), F.col(order).alias("at")), "merkle-leaves")
    rounds = climbed(ranked(leaves, ["at", "digest"]).drop("at"), fan)
    tops = rounds[-1].select(F.lit(0).alias("grp"), "digest", F.struct(F.col("grp").alias("group")).alias("own"), F.col("grp").alias("at"))
    top_rounds = climbed(ranked(tops, ["at"]).drop("at"), fan)
    above = top_rounds[-1].select("grp", "block", F.array().cast(f"array<{STEP}>").alias("path"), F.col("digest").alias("root"))
    for blocks in reversed(top_rounds):
        nodes = lowered(blocks, above, fan)
        above = nodes.select("grp", F.col("rank").alias("block"), "path", "root")
    above = nodes.select(F.col("own.group").alias("grp"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"), "root")
    for blocks in reversed(rounds):
        nodes = lowered(blocks, above, fan)
        above = nodes.select("grp", F.col("rank").alias("block"), "path", "subroot", "root")
    return nodes.select(F.col("own.key").alias(order), F.col("digest").alias("leaf"), "path", "subroot", "root",
                        *(F.col("own")[name].alias(name) for name in (keep or {})))
