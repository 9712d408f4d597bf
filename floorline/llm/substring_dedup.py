"""Removal of word sequences that an earlier document already has.

Every window of ``window`` consecutive words gets a Rabin-Karp hash, rolled over
the words' hashes.  Spark counts the windows in two rounds: the first finds, by
a short fingerprint, the windows that occur in more than one group of documents;
the second takes those alone, with a longer and independent hash and the
smallest document id, and finds the ones that start in an earlier document.
Covered words merge into maximal intervals.

Rows are dealt into groups by the hash of id and text, so rows that share an id,
or have none, spread over groups; ids are compared across them.  A group sends each distinct
window once, however many of its documents hold it, packed by bucket, and gets
back one bit per window it sent, so hot passages cost a few bytes per group and
no join carries a row per occurrence.  Groups and buckets follow from the size of
the input; both have a fixed expected size, at any scale.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorline.llm.common import Powers, Words, mix, runs, shuffle_partitions, slices, total_bytes

WINDOW = 50
# Expected bytes of text in a group of documents, and windows in a bucket.
GROUP_BYTES = 4 << 20
BUCKET_WINDOWS = 1 << 20
BYTES_PER_WORD = 6
LAST = np.iinfo(np.int64).max
ROUNDS = (Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95))
SALTS = (0x0, 0xA0761D6478BD642F)


def window_hashes(words: Words, hashes: np.ndarray, window: int, which: int) -> np.ndarray:
    """The hash of the window at each word; those that would leave their text are masked by ``whole``."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.uint64)
    up, down = ROUNDS[which].to(n)
    salted = mix(hashes ^ np.uint64(SALTS[which]))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(salted * up, dtype=np.uint64)]
    return mix((sums[window:] - sums[:-window]) * down[: n - window + 1])


def whole(words: Words, window: int) -> np.ndarray:
    """Which windows lie in one text."""
    n = len(words.text)
    return words.text[: n - window + 1] == words.text[window - 1:] if n >= window else np.zeros(0, bool)


class Group:
    """A group of documents, in the order of their ids, and its windows."""

    def __init__(self, table: pa.Table, window: int):
        ids = np.asarray(pc.fill_null(table["id"], LAST).combine_chunks() if table.num_rows else [], np.int64)
        order = np.argsort(ids, kind="stable")
        self.rows = table.take(pa.array(order))
        self.ids = ids[order]
        self.window = window
        text = self.rows["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
        self.text = text if isinstance(text, pa.Array) else pa.chunked_array(text).combine_chunks()
        self.parts = list(slices(self.text))

    def windows(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document id of each window, text by text."""
        found, owners = [], []
        for a, b in self.parts:
            words = Words(self.text[a:b])
            fits = whole(words, self.window)
            found.append(window_hashes(words, words.hashes(), self.window, which)[fits])
            owners.append(self.ids[a:b][words.text[: len(fits)][fits]])
        return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket by a hash's upper bits, so hashes in order are also in the order of their buckets."""
    return (((hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)


def cuts(ordered: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets met, and where each begins (and the last ends)."""
    bucket = bucket_of(ordered, buckets)
    begins = runs(bucket)
    return bucket[begins], np.r_[begins, len(ordered)]


def first_round(group: Group, buckets: int):
    """What a group sends: per bucket its distinct windows' short fingerprints, in the order of the hashes."""
    hashes, owners = group.windows(0)
    distinct = np.sort(hashes)
    distinct = distinct[runs(distinct)]
    return hashes, owners, distinct, *cuts(distinct, buckets)


def survivors(hashes, owners, distinct, met, begins, bits: dict[int, bytes]) -> np.ndarray:
    """Which of a group's windows occur in another group or in several documents of this one."""
    if not len(hashes):
        return np.zeros(0, bool)
    flagged = np.zeros(len(distinct), bool)
    for k, b in enumerate(met.tolist()):
        if b in bits:
            n = begins[k + 1] - begins[k]
            flagged[begins[k]:begins[k + 1]] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=n).astype(bool)
    order = np.argsort(hashes, kind="stable")
    begins_at = runs(hashes[order])
    number = np.zeros(len(hashes), np.int64)
    number[begins_at[1:]] = 1
    number = np.cumsum(number)
    # Documents are in the order of their ids, so a value's first and last owner differ if it has several.
    owner = owners[order]
    ends_at = np.r_[begins_at[1:], len(hashes)] - 1
    flagged |= owner[begins_at] != owner[ends_at]
    out = np.zeros(len(hashes), bool)
    out[order] = flagged[number]
    return out


def second_round(group: Group, keep: np.ndarray, buckets: int):
    """The surviving windows' long hashes by bucket, with the smallest document id of each."""
    hashes, owners = group.windows(1)
    hashes, owners = hashes[keep], owners[keep]
    order = np.argsort(hashes, kind="stable")
    begins = runs(hashes[order])
    distinct = hashes[order][begins]
    return hashes, owners, distinct, owners[order][begins], *cuts(distinct, buckets)


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def bits_of(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table["bucket"].to_pylist(), table["bits"].to_pylist())) if table.num_rows else {}


KEYS = "bucket long, grp long, keys binary, ids binary"
REMOVED = "n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
BITS = "grp long, bucket long, bits binary"


def group_of(ids: Column, text: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(ids.cast("long"), text.cast("string")), F.lit(groups))


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    window: int = WINDOW, group_bytes: int = GROUP_BYTES, bucket_windows: int = BUCKET_WINDOWS,
                    keep_columns: bool = False) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``spans`` (start and end of each removed interval, in words) and ``kept``.

    A word goes if a window that covers it also starts in a document with a
    smaller id; windows are judged on the input.  Rows with one id are one
    document for this.  A null text has no words; a null id comes after every
    other.  Without any removal ``kept`` still is the words joined by one space.
    An empty table gives an empty result.  Other columns are read only with
    ``keep_columns``: then a row has ``row``, all the columns it came with but the
    text, instead of its id, so their names clash with nothing, and ``kept`` is the
    text as it was where nothing is removed.
    """
    size = total_bytes(docs, text_column)
    groups = max(1, -(-size // group_bytes))
    buckets = max(1, -(-size // (BYTES_PER_WORD * bucket_windows)))
    dealt = docs.select(
        group_of(F.col(id_column), F.col(text_column), groups).alias("grp"),
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"),
        *([F.struct(*(docs[c] for c in docs.columns if c != text_column)).alias("row")] if keep_columns else []),
    ).repartition(max(groups, shuffle_partitions(docs.sparkSession)), "grp")

    carried = "row" if keep_columns else "id"

    def send_first(key, table):
        _, _, distinct, met, begins = first_round(Group(table, window), buckets)
        short = distinct.astype(np.uint32)
        return pa.table({
            "bucket": pa.array(met, pa.int64()), "grp": pa.array([key[0].as_py()] * len(met), pa.int64()),
            "keys": pa.array([short[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])], pa.binary()),
            "ids": pa.nulls(len(met), pa.binary()),
        })

    def several_groups(key, table):
        parts = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        every = np.sort(np.concatenate(parts))
        begins = runs(every)
        repeated = every[begins][np.diff(np.r_[begins, len(every)]) > 1]
        return answer(key, table, [among(x, repeated) for x in parts])

    def answer(key, table, flags):
        told = [(g, np.packbits(f).tobytes()) for g, f in zip(table["grp"].to_pylist(), flags) if f.any()]
        return pa.table({
            "grp": pa.array([g for g, _ in told], pa.int64()), "bucket": pa.array([key[0].as_py()] * len(told), pa.int64()),
            "bits": pa.array([x for _, x in told], pa.binary()),
        })

    def send_second(key, table, answers):
        group = Group(table, window)
        first = first_round(group, buckets)
        _, _, distinct, smallest, met, begins = second_round(group, survivors(*first, bits_of(answers)), buckets)
        cut = list(zip(begins[:-1], begins[1:]))
        return pa.table({
            "bucket": pa.array(met, pa.int64()), "grp": pa.array([key[0].as_py()] * len(met), pa.int64()),
            "keys": pa.array([distinct[a:b].tobytes() for a, b in cut], pa.binary()),
            "ids": pa.array([smallest[a:b].tobytes() for a, b in cut], pa.binary()),
        })

    def earlier_elsewhere(key, table):
        parts = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
        ids = [np.frombuffer(x, np.int64) for x in table["ids"].to_pylist()]
        every, owner = np.concatenate(parts), np.concatenate(ids)
        order = np.argsort(every, kind="stable")
        begins = runs(every[order])
        value, smallest = every[order][begins], np.minimum.reduceat(owner[order], begins)
        return answer(key, table, [smallest[np.searchsorted(value, x)] < i for x, i in zip(parts, ids)])

    def remove(key, table, first_bits, second_bits):
        group = Group(table, window)
        first = first_round(group, buckets)
        keep = survivors(*first, bits_of(first_bits))
        hashes, owners, distinct, smallest, met, begins = second_round(group, keep, buckets)
        bits = bits_of(second_bits)
        earlier = np.zeros(len(distinct), bool)
        for k, b in enumerate(met.tolist()):
            if b in bits:
                n = begins[k + 1] - begins[k]
                earlier[begins[k]:begins[k + 1]] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=n).astype(bool)
        covered = np.zeros(len(keep), bool)
        if len(distinct):
            at = np.searchsorted(distinct, hashes)
            covered[keep] = earlier[at] | (smallest[at] < owners)
        return removed_rows(group, covered, window, carried)

    keys = dealt.groupBy("grp").applyInArrow(send_first, KEYS)
    first_bits = keys.groupBy("bucket").applyInArrow(several_groups, BITS)
    long_keys = dealt.groupBy("grp").cogroup(first_bits.groupBy("grp")).applyInArrow(send_second, KEYS)
    second_bits = long_keys.groupBy("bucket").applyInArrow(earlier_elsewhere, BITS)
    both = first_bits.withColumn("round", F.lit(1)).union(second_bits.withColumn("round", F.lit(2)))

    def remove_marked(key, table, answers):
        number = np.asarray(answers["round"]) if answers.num_rows else np.zeros(0, int)
        return remove(key, table, answers.filter(pa.array(number == 1)), answers.filter(pa.array(number == 2)))

    # The column itself, not its text, says which of its fields may be null.
    schema = T.StructType([T.StructField(carried, dealt.schema[carried].dataType), *T.StructType.fromDDL(REMOVED)])
    found = dealt.groupBy("grp").cogroup(both.groupBy("grp")).applyInArrow(remove_marked, schema)
    return found if keep_columns else found.withColumnRenamed("id", id_column)


def removed_rows(group: Group, covered: np.ndarray, window: int, carried: str) -> pa.Table:
    """Rows of a group, from which of its windows start elsewhere earlier."""
    n_words, n_removed, spans, kept = [], [], [], []
    done = 0
    for a, b in group.parts:
        words = Words(group.text[a:b])
        fits = whole(words, window)
        steps = np.zeros(len(words.text) + 1, np.int32)
        starts = np.flatnonzero(fits)
        hit = starts[covered[done:done + len(starts)]]
        done += len(starts)
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + window, -1)
        gone = np.cumsum(steps[:-1]) > 0
        texts = words.joined(~gone)
        # Intervals begin where a removed word follows a kept one or another text's word.
        same = np.r_[False, words.text[1:] == words.text[:-1]] if len(words.text) else np.zeros(0, bool)
        before = np.r_[False, gone[:-1]] & same if len(gone) else gone
        after = np.r_[(gone & np.r_[False, same[1:]])[1:], False] if len(gone) else gone
        begin, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
        owner = words.text[begin]
        removed = np.bincount(words.text[gone], minlength=b - a)
        at = np.searchsorted(owner, np.arange(b - a + 1))
        for i in range(b - a):
            base = words.first[i]
            spans.append([{"start": int(x - base), "end": int(y - base + 1)}
                          for x, y in zip(begin[at[i]:at[i + 1]], end[at[i]:at[i + 1]])])
        n_words += words.count.tolist()
        n_removed += removed.tolist()
        kept += texts
    kept = pa.array(kept, pa.binary()).cast(pa.string())
    if carried == "row":
        kept = pc.if_else(pa.array(np.array(n_removed) > 0), kept, group.text)
    return pa.table({
        carried: group.rows[carried], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "kept": kept,
    })
