"""What several operators share: the work folder, batches of bounded size, words and their hashes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floorline.streaming.workspace import shared_folder

# Bytes of text that a task turns into arrays at once.
SLICE_BYTES = 1 << 20
# White space of the word rules `[^\x20\x09-\x0D]+`.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def stored(frame: DataFrame, purpose: str, parts: int | None = None) -> DataFrame:
    """``frame`` written to the shared work folder and read back: it cuts the lineage and outlives executors."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    writer = (frame if parts is None else frame.repartition(parts)).write
    writer.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def total_bytes(frame: DataFrame, column: str) -> int:
    """Bytes of a text column; one number, from which numbers of groups are derived."""
    return frame.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and name for a path as Spark gives it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) within ``grp`` by ``order``, nulls first, and ``n``, the rows of the group.

    Rows equal in all of ``order`` come in any order; they too are spread over ranges.
    """
    keys = ["grp", *order, "tie"]
    sorted_rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Written, so that a range and a row's place in it are the same for all that follows.
    placed = stored(sorted_rows.drop("tie").withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "ranks")
    # A range holds whole groups but for its ends, so these are about as many rows as there are ranges and groups.
    counts = placed.groupBy("grp", "part").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    whole, before = Window.partitionBy("grp"), Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("grp").alias("of"), F.col("part").alias("within"), F.sum("rows").over(whole).alias("n"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("move"))
    same = (F.col("part") == F.col("within")) & F.col("grp").eqNullSafe(F.col("of"))
    return placed.join(starts, same).select(*rows.columns, (F.col("place") + F.col("move")).alias("rank"), "n")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer text is a range of its own."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    ends = np.cumsum(lengths, dtype=np.int64)
    begin = 0
    while begin < len(texts):
        base = ends[begin] - lengths[begin]
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield begin, end
        begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as many as needed so far."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", inverse(self.base))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BYTE_POWERS = Powers(0x2545F4914F6CDD1D)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


class Words:
    """The words of some texts as arrays: where each starts and ends, its text's number, a 64-bit hash.

    ``data`` holds the texts one after another, each followed by one space, so
    the byte after a word is always a space.  Null texts have no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        parts = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
        self.data = np.frombuffer(b" ".join(parts) + b" ", np.uint8) if parts else np.zeros(0, np.uint8)
        if lower:
            self.data = LOWER[self.data]
        self.text_ends = np.cumsum([len(x) + 1 for x in parts], dtype=np.int64)
        space = IS_SPACE[self.data]
        before = np.r_[True, space[:-1]]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        self.text = np.searchsorted(self.text_ends, self.start, side="right")
        self.count = np.bincount(self.text, minlength=len(parts))
        # Number of each text's first word.
        self.first = np.r_[0, np.cumsum(self.count)[:-1]] if parts else np.zeros(0, np.int64)

    def hashes(self) -> np.ndarray:
        up, down = BYTE_POWERS.to(len(self.data))
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[self.data] * up, dtype=np.uint64)]
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + np.uint64(1))

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """Each text's kept words joined by one space."""
        flags = np.zeros(len(self.data) + 1, np.int8)
        flags[self.start[keep]] += 1
        flags[self.end[keep] + 1] -= 1
        inside = np.cumsum(flags[:-1], dtype=np.int8).astype(bool)
        data = np.where(IS_SPACE[self.data], np.uint8(32), self.data)[inside].tobytes()
        sizes = np.bincount(self.text[keep], weights=(self.end - self.start + 1)[keep], minlength=len(self.count))
        ends = np.cumsum(sizes).astype(np.int64)
        return [data[a:max(a, b - 1)] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]


class Numbers(defaultdict):
    """Numbers given to words as they are asked for; ``fresh`` are those since ``settle``, in order."""

    def __init__(self):
        super().__init__(count().__next__)
        self.settled = 0

    def fresh(self) -> list:
        return list(islice(reversed(self), len(self) - self.settled))[::-1]

    def settle(self) -> None:
        self.settled = len(self)
