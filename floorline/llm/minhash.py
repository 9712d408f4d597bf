"""Groups of near-duplicate documents by one-permutation MinHash.

Every distinct word shingle is hashed once; its upper bits choose one of 256
bins and each bin keeps its smallest value.  An empty bin copies the bin that
comes first in a fixed random order of its own among those that hold a value
(optimal densification).  64 bands of four bins are the buckets: at a similarity
of 0.8 two documents share none with a chance of (1 - 0.8**4)**64, about 2e-15.

Documents with the same shingles are one vertex from the start.  A bucket joins
its members to its smallest and its largest member only, two stars, and each
such edge is confirmed on the full shingle sets.  Where a bucket of more than
three still holds several components, not all of its pairs have been compared;
the documents of those buckets go through an exact prefix-filtered join (shingles
ordered by rarity, bounds on length and position), for pairs of different
components.  So no link is lost to the stars and no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorline.llm.common import Words, mix, runs, shuffle_partitions, slices, stored
from floorline.llm.components import components

BINS, BAND = 256, 4
BANDS = BINS // BAND
SHINGLE, PERCENT = 5, 80
STEP = np.uint64(0x9FB21C651E98DF25)
BAND_STEPS = mix(np.arange(1, BAND + 1, dtype=np.uint64)) | np.uint64(1)
BAND_SALTS = mix(np.arange(1001, 1001 + BANDS, dtype=np.uint64))
# Each bin's order of the bins it may copy.
ORDER = np.random.Generator(np.random.PCG64(20240229)).permuted(np.tile(np.arange(BINS, dtype=np.uint16), (BINS, 1)), axis=1)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as hashes in order; a text of fewer words is one shingle, one without words none."""
    words = Words(texts, lower=True)
    found = words.hashes()
    n = len(found)
    chain = found.copy()
    for step in range(1, size):
        chain[: n - step] = mix(chain[: n - step] * STEP + found[step:]) if n > step else chain[: n - step]
    sets = []
    for first, count in zip(words.first.tolist(), words.count.tolist()):
        if count >= size:
            own = np.sort(chain[first:first + count - size + 1])
            sets.append(own[runs(own)])
        elif count:
            value = found[first:first + 1]
            for word in found[first + 1:first + count]:
                value = mix(value * STEP + word)
            sets.append(value)
        else:
            sets.append(found[:0])
    return sets


def signature(ordered: np.ndarray) -> np.ndarray:
    """The bins of a non-empty set of hashes in order."""
    bins = (ordered >> np.uint64(56)).astype(np.int64)
    first = runs(bins)
    held = bins[first]
    out = np.zeros(BINS, np.uint64)
    out[held] = ordered[first]
    if len(held) < BINS:
        empty = np.ones(BINS, bool)
        empty[held] = False
        empty = np.flatnonzero(empty)
        out[empty] = out[held[ORDER[empty][:, held].argmin(axis=1)]]
    return out


def bands_of(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(len(signatures), BANDS, BAND) * BAND_STEPS
    return mix(parts.sum(axis=2, dtype=np.uint64) + BAND_SALTS).view(np.int64)


SIGNED = "id long, n long, k1 long, k2 long, bands array<long>"


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` (``id``, ``text``) as set size, a 128-bit key of the set, and the buckets of its bands (none for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                sets = shingle_sets(batch["text"][a:b], size)
                counts = np.array([len(x) for x in sets])
                full = counts > 0
                keys = np.zeros((2, b - a), np.int64)
                bands = np.zeros((0, BANDS), np.int64)
                if full.any():
                    every = np.concatenate(sets)
                    begins = np.r_[0, np.cumsum(counts[full])[:-1]]
                    for k in (0, 1):
                        keys[k, full] = np.add.reduceat(mix(every ^ BAND_SALTS[k]), begins).view(np.int64)
                    bands = bands_of(np.stack([signature(x) for x in sets if len(x)]))
                ends = np.r_[0, np.cumsum(full * BANDS)]
                yield pa.RecordBatch.from_arrays([
                    batch["id"][a:b], pa.array(counts, pa.int64()), pa.array(keys[0]), pa.array(keys[1]),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.ravel())),
                ], names=["id", "n", "k1", "k2", "bands"])

    return docs.mapInArrow(sign, SIGNED)


def confirmed(edges: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The edges (``a``, ``b``) whose full shingle sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch["right"]):
                part = batch.slice(first, last - first)
                ids, at = np.unique(np.asarray(part["a"]), return_index=True)
                left = dict(zip(ids.tolist(), shingle_sets(part["left"].take(pa.array(at)), size)))
                good = []
                for a, right in zip(part["a"].to_pylist(), shingle_sets(part["right"], size)):
                    own = left[a]
                    both = np.count_nonzero(own[np.minimum(np.searchsorted(own, right), len(own) - 1)] == right)
                    good.append(100 * both >= percent * (len(own) + len(right) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    return edges.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def missed_pairs(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Candidate pairs across components in buckets whose pairs were not all compared; None if there is no such bucket."""
    labelled = members.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "label", F.coalesce("label", "doc"))
    mixed = labelled.groupBy("band").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
    ).filter("n > 3 AND low < high").select("band")
    open_docs = stored(labelled.join(mixed, "band").select(F.col("doc").alias("id"), "label").distinct(), "open")
    if open_docs.isEmpty():
        return None

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                sets = shingle_sets(batch["text"][a:b], size)
                counts = np.array([len(x) for x in sets])
                which = pa.array(np.repeat(np.arange(a, b), counts))
                yield pa.RecordBatch.from_arrays([
                    batch["id"].take(which), batch["label"].take(which), pa.array(np.repeat(counts, counts), pa.int64()),
                    pa.array(np.concatenate(sets).view(np.int64) if counts.sum() else [], pa.int64()),
                ], names=["id", "label", "n", "shingle"])

    shingles = texts.join(open_docs, "id").select("id", "label", "text").mapInArrow(
        spread, "id long, label long, n long, shingle long")
    shingles = stored(shingles, "shingles")
    rarity = shingles.groupBy("shingle").agg(F.count("*").alias("held"))
    ranked = shingles.join(rarity, "shingle").withColumn(
        "at", F.row_number().over(Window.partitionBy("id", "n").orderBy("held", "shingle")))
    prefix = stored(ranked.filter(
        (F.col("held") > 1) & (F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)), "prefixes")
    x, y = (prefix.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "label", "n", "at"))) for s in "xy")
    # The overlap that the similarity needs, and the most that is left after both positions.
    needed = F.ceil((F.col("n_x") + F.col("n_y")) * percent / (100 + percent))
    left = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) + 1
    return x.join(y, (x["shingle"] == y["shingle"]) & (F.col("label_x") < F.col("label_y")) & (left >= needed)).select(
        F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept`` (the id is that one).

    Documents are linked whose sets of distinct ``size``-word shingles have a
    Jaccard similarity of at least ``percent`` / 100, letters A-Z in lower case.
    A text of fewer words is one shingle.  Null texts and texts without words
    are linked with nothing.  Rows with a null id are linked with nothing
    either; their component is null and they are kept.  Rows that repeat an id
    are one vertex and each gets a row.  Other columns are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    signed = stored(signatures(plain, size), "signatures")
    sets = stored(signed.filter("id IS NOT NULL AND n > 0").groupBy("k1", "k2").agg(F.min("id").alias("doc")), "sets")

    one_each = signed.join(sets, (signed["id"] == sets["doc"]) & (signed["k1"] == sets["k1"]) & (signed["k2"] == sets["k2"]))
    # One exchange serves the bounds of each bucket and the join with them.
    buckets = one_each.select("doc", F.explode("bands").alias("band")).repartition(shuffle_partitions(spark), "band")
    bounds = buckets.groupBy("band").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    members = stored(buckets.join(bounds, "band"), "members")

    chosen = members.select(F.col("doc").alias("id")).distinct()
    texts = stored(plain.join(chosen, "id"), "texts")
    edges = stored(members.select("doc", F.explode(F.array("low", "high")).alias("hub")).filter("doc <> hub").select(
        F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct(), "edges")
    links = stored(confirmed(edges, texts, size, percent), "confirmed")
    labels = components(links)
    pairs = missed_pairs(members, labels, texts, size, percent)
    if pairs is not None:
        more = confirmed(pairs.join(edges, ["a", "b"], "left_anti"), texts, size, percent)
        labels = components(links.union(more))

    found = sets.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(
        "k1", "k2", F.coalesce("label", "doc").alias("component_id"))
    joined = signed.drop("bands").join(found, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))
