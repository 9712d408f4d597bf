"""Exact top-k by inner product on a bit-sliced index.

A vector's components become integers.  A block of rows keeps, per dimension, a
bitmap for each bit of the component above the block's smallest one.  A query adds
the slices, each as often and as high as its own component's bits say, with
bitmap arithmetic (carry-save adders), so the scores of a block are bitmaps too.
The best rows come out from the most significant slice downward; rows that tie at
the boundary are told apart by their id.

Index blocks and groups of queries both have fixed sizes; each meets each once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorline.llm.common import stored

SCALE, TOP = 64, 20
BLOCK_ROWS, GROUP_QUERIES = 1 << 16, 256
# Components are 64-bit integers.
LARGEST = 1 << 63


def quantised(vector: Column) -> Column:
    """Integer components; null if the vector, or one of them, is null, not finite or beyond 64 bits."""
    values = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * SCALE))
    fits = F.forall(vector.cast("array<double>"), lambda x: F.coalesce(
        (x * SCALE >= F.lit(-float(LARGEST))) & (x * SCALE < F.lit(float(LARGEST))), F.lit(False)))
    return F.when(fits, values.cast("array<bigint>"))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = [np.asarray(chunk.flatten()) for chunk in column.chunks]
    return np.concatenate(flat).reshape(rows, -1).astype(np.int64) if rows else np.zeros((0, 0), np.int64)


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Flags as 64-bit words, the last one filled up with zeros."""
    bits = np.packbits(flags, bitorder="little")
    return np.frombuffer(bits.tobytes() + bytes(-len(bits) % 8), np.uint64)


def positions(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


class Block:
    """Rows in the order of their ids, as slices ``[dimension, bit, word]`` above ``base``."""

    def __init__(self, ids: np.ndarray, base: np.ndarray, slices: np.ndarray):
        self.ids, self.base, self.slices = ids, base, slices
        # Bits that a dimension uses; one outlier does not widen the others.
        self.widths = [int(np.flatnonzero(own.any(axis=1)).max(initial=0)) + 1 for own in slices]

    @classmethod
    def of(cls, ids: np.ndarray, values: np.ndarray) -> Block:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        base = values.min(axis=0)
        above = values.view(np.uint64) - base.view(np.uint64)  # right for any two 64-bit integers
        bits = max(1, int(above.max(initial=0)).bit_length())
        return cls(ids, base, np.array([[bitmap((above[:, d] >> np.uint64(b)) & np.uint64(1)) for b in range(bits)]
                                        for d in range(values.shape[1])]))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score, least significant first, and the constant that is to be added."""
        constant = sum(a * b for a, b in zip(query.tolist(), self.base.tolist()))
        levels: list[list[np.ndarray]] = []

        def put(level: int, slice_: np.ndarray) -> None:
            while len(levels) <= level:
                levels.append([])
            levels[level].append(slice_)

        for d, q in enumerate(query.tolist()):
            # A negative factor counts down from the largest value: q * x = |q| * (most - x) - |q| * most.
            bits = self.widths[d]
            most = (1 << bits) - 1
            own = self.slices[d][:bits] if q > 0 else ~self.slices[d][:bits]
            constant -= abs(q) * most if q < 0 else 0
            for shift in range(abs(q).bit_length()):
                if abs(q) >> shift & 1:
                    for b in range(bits):
                        put(shift + b, own[b])
        out, level = [], 0
        while level < len(levels):
            here = levels[level]
            while len(here) > 2:
                a, b, c = here.pop(), here.pop(), here.pop()
                either = a ^ b
                put(level + 1, (a & b) | (either & c))
                here.append(either ^ c)
            if len(here) == 2:
                a, b = here
                put(level + 1, a & b)
                here = [a ^ b]
            out.append(here[0] if here else np.zeros(self.slices.shape[2], np.uint64))
            level += 1
        return out, constant

    def top(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows with another id."""
        slices, constant = self.scores(query)
        wanted = np.ones(len(self.ids), bool)
        wanted[np.searchsorted(self.ids, own_id, "left"):np.searchsorted(self.ids, own_id, "right")] = False
        open_ = bitmap(wanted)
        sure = np.zeros_like(open_)
        for plane in reversed(slices):
            with_it = sure | (open_ & plane)
            n = int(np.bitwise_count(with_it).sum())
            if n > k:
                open_ = open_ & plane
            else:
                sure, open_ = with_it, open_ & ~plane
                if n == k:
                    open_[:] = 0
                    break
        rows = positions(sure)
        # All that is still open has one score; ids are in order.
        rows = np.r_[rows, positions(open_)[:k - len(rows)]]
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        # Python integers where sums may leave 64 bits.
        wide = len(slices) > 62 or abs(constant) >= 1 << 62
        score = np.full(len(rows), constant, object if wide else np.int64)
        for level, plane in enumerate(slices):
            score += ((plane[word] >> bit) & np.uint64(1)).astype(np.int64).astype(score.dtype) << level
        if wide and any(not -LARGEST <= x < LARGEST for x in score):
            raise OverflowError(f"a score of query {own_id} does not fit 64 bits")
        return self.ids[rows], score.astype(np.int64)


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id``, ``q`` (integers) as blocks: ``block``, ``dims``, ``ids``, ``base`` and ``slices``, written to the shared folder."""
    blocks = max(1, -(-vectors.count() // block_rows))

    def build(key, table):
        block = Block.of(np.asarray(table["id"]), matrix(table["q"], table.num_rows))
        return pa.table({
            "block": [key[0].as_py()], "dims": [key[1].as_py()], "ids": [block.ids.tobytes()],
            "base": [block.base.tobytes()], "slices": [block.slices.tobytes()],
        })

    dealt = vectors.select("id", "q", F.size("q").cast("long").alias("dims"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    return stored(dealt.groupBy("block", "dims").applyInArrow(
        build, "block long, dims long, ids binary, base binary, slices binary"), "bit-slices")


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, id_column: str = "vec_id", vector_column: str = "embedding",
          block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id``, ``rank`` (from 1), id, ``score``; all if there are fewer.

    Components are floor(64 x).  Rows whose vector is null, or holds a null, a
    component that is not finite or that 64 bits do not hold, take no part; nor do
    rows with a null id or no component.  A score that 64 bits do not hold stops
    the query, as it does in SQL.  Only vectors of one length meet.  A
    query does not meet rows with its own id.  Rows that repeat an id and vector
    are one query but remain separate candidates; repeats of an id with another
    vector are further queries.  Equal scores are ranked by the smaller id.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), quantised(F.col(vector_column)).alias("q"),
                          is_query.alias("ask")).filter("id IS NOT NULL AND size(q) > 0")
    rows = stored(rows, "quantised")
    index = build_index(rows, block_rows)
    asked = rows.filter("ask").select("id", "q", F.size("q").cast("long").alias("dims"), F.xxhash64("q").alias("tag")).distinct()
    groups = max(1, -(-asked.count() // group_queries))
    asked = asked.withColumn("grp", F.pmod(F.xxhash64("id", "tag"), F.lit(groups)))
    met = index.select(F.col("block").alias("at_block"), F.col("dims").alias("at_dims")).distinct()
    queries = asked.join(met, F.col("dims") == F.col("at_dims"))
    spread = index.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def search(key, blocks, queries):
        ids, tags, found, scores = [], [], [], []
        if blocks.num_rows and queries.num_rows:
            own = np.frombuffer(blocks["ids"][0].as_py(), np.int64)
            base = np.frombuffer(blocks["base"][0].as_py(), np.int64)
            words = -(-len(own) // 64)
            block = Block(own, base, np.frombuffer(blocks["slices"][0].as_py(), np.uint64).reshape(len(base), -1, words))
            for query, tag, values in zip(queries["id"].to_pylist(), queries["tag"].to_pylist(), matrix(queries["q"], queries.num_rows)):
                near, score = block.top(values, query, k)
                ids += [query] * len(near)
                tags += [tag] * len(near)
                found.append(near)
                scores.append(score)
        return pa.table({
            "query_id": pa.array(ids, pa.int64()), "tag": pa.array(tags, pa.int64()),
            "id": pa.array(np.concatenate(found) if found else [], pa.int64()),
            "score": pa.array(np.concatenate(scores) if scores else [], pa.int64()),
        })

    best = spread.groupBy("block", "dims", "grp").cogroup(queries.groupBy("at_block", "at_dims", "grp")).applyInArrow(search, "query_id long, tag long, id long, score long")
    order = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_column), "score")
