"""Collocations: phrases whose words occur together more than their parts' counts suggest.

Every run of one to four words is named by a Rabin-Karp fingerprint, taken from
prefix polynomials over the bytes of the words and over the words themselves, so
that a run of any length costs two subtractions.  Three passes over the texts:

1. fingerprints of one and two words are counted, in batches first and then by a shuffle;
2. those of three and four words likewise, of runs alone whose every pair is frequent;
3. each batch takes its runs with a frequent fingerprint together with a pointer to
   an occurrence, compares every occurrence with the text at the pointer, and sends
   the text there; the shuffle groups by text, so the counts are those of phrases
   and not of fingerprints, whatever collides.

Which fingerprints are frequent reaches the tasks as a bitmap of fixed size, a
file in the shared folder: its size does not follow the data, and where two
fingerprints share a bit a run is counted that need not be, and dropped later.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import dataset
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.llm.common import BYTE_POWERS, BYTE_VALUES, LOWER, Powers, mix, opened, ranked, slices, stored
from floorline.llm.common import runs as runs_of
from floorline.streaming.workspace import shared_folder

LEAST, LONGEST, FIRST, COVER = 30, 4, 2000, 80
UNKNOWN = "und"
# Bits of the bitmap as a power of two: 16 MB.
FILTER_BITS = 27
# Bytes of text that a task counts at once; what is frequent in them is combined before it is sent.
PART_BYTES = 1 << 20
# Fingerprints of a task that are combined at once.
COMBINED = 1 << 20

PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
GAP = re.compile(rb"[.,;:!?\x0a-\x0d\x20\x09]")
TAIL = re.compile(rb"(?:[\x20\x09]+[^.,;:!?\x0a-\x0d\x20\x09]+){0,%d}" % (LONGEST - 1))
IS_PIECE_END, IS_GAP = np.zeros(256, bool), np.zeros(256, bool)
IS_PIECE_END[list(PIECE_ENDS)] = True
IS_GAP[list(PIECE_ENDS + BLANKS)] = True
WORD_POWERS = Powers(0x9E6C63D0876A9A8B)
FINGERPRINT = "fingerprint long, found long"
PHRASES = "lang string, words int, phrase binary, found long, doc_id long, at long"


def parted(text: bytes, limit: int = PART_BYTES) -> Iterator[tuple[int, bytes, int]]:
    """Parts of a text: where each begins, its bytes, and how many of these are its own.

    A text longer than ``limit`` is cut after a word; a part then also has the
    next words of the piece, as runs that begin in it may end there.
    """
    begin = 0
    while len(text) - begin > limit:
        cut = GAP.search(text, begin + limit)
        if cut is None:
            break
        end = TAIL.match(text, cut.start()).end()
        yield begin, text[begin:end], cut.start() - begin
        begin = cut.start()
    yield begin, text[begin:], len(text) - begin


@lru_cache(maxsize=4096)
def language_seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Runs:
    """The words of some parts and the fingerprints of their runs."""

    def __init__(self, parts: list[bytes], own: list[int], langs: list[str]):
        self.data = LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        self.begins = np.cumsum(sizes) - sizes
        gap = IS_GAP[self.data]
        self.start = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
        self.end = np.flatnonzero(gap & np.r_[False, ~gap[:-1]])
        self.part = np.searchsorted(self.begins, self.start, side="right") - 1
        self.owned = self.start - self.begins[self.part] < np.array(own, np.int64)[self.part]
        self.piece = np.cumsum(IS_PIECE_END[self.data], dtype=np.int32)[self.start]
        seeds = np.array([language_seed(x) for x in langs], np.uint64)
        self.seed = seeds[self.part]
        up, down = BYTE_POWERS.to(len(self.data))
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[self.data] * up, dtype=np.uint64)]
        self.word = mix((sums[self.end] - sums[self.start]) * down[self.start] + np.uint64(1))
        up, self.down = WORD_POWERS.to(len(self.word))
        self.sums = np.r_[np.zeros(1, np.uint64), np.cumsum(self.word * up, dtype=np.uint64)]

    def places(self, n: int) -> np.ndarray:
        """Where a run of ``n`` words within a piece begins, in this part's own bytes."""
        last = len(self.start) - n + 1
        return np.flatnonzero(self.owned[:max(last, 0)] & (self.piece[:max(last, 0)] == self.piece[n - 1:])) if last > 0 else np.zeros(0, np.int64)

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix((self.sums[at + n] - self.sums[at]) * self.down[at] + self.seed[at] + np.uint64(n))

    def exact_words(self) -> np.ndarray:
        """A number per word, the same for two words only if their bytes are; a word whose hash another has gets its own."""
        _, first, number = np.unique(self.word, return_index=True, return_inverse=True)
        size, like = self.end - self.start, first[number]
        same = size == size[like]
        checked = np.flatnonzero(same)
        lengths = size[checked]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        differs = self.data[np.repeat(self.start[checked], lengths) + inside] != self.data[np.repeat(self.start[like[checked]], lengths) + inside]
        if differs.any():
            same[np.repeat(checked, lengths)[differs]] = False
        return np.where(same, number, len(first) + np.arange(len(number)))

    def spaced(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words, each followed by one space, and where each begins and ends there."""
        flags = np.zeros(len(self.data) + 1, np.int8)
        flags[self.start] += 1
        flags[self.end + 1] -= 1  # the byte after a word is a gap
        inside = np.cumsum(flags[:-1], dtype=np.int8).astype(bool)
        size = self.end - self.start + 1
        ends = np.cumsum(size)
        return np.where(IS_GAP[self.data], np.uint8(32), self.data)[inside].tobytes(), ends - size, ends - 1


@lru_cache(maxsize=1)
def bitmap(path: str, bits: int) -> np.ndarray:
    """The bitmap that is stored as 64-bit words, read piece by piece; kept by the worker process for its next tasks."""
    system, name = opened(path)
    out = np.zeros(1 << (bits - 6), np.uint64)
    for batch in dataset.dataset(name, filesystem=system, format="parquet").to_batches(batch_readahead=1, fragment_readahead=1, use_threads=False):
        out[np.asarray(batch["word"])] = np.asarray(batch["bits"]).view(np.uint64)
    return out


def marked(path: str, bits: int, fingerprints: np.ndarray) -> np.ndarray:
    bit = fingerprints >> np.uint64(64 - bits)
    return (bitmap(path, bits)[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def stored_bitmap(frequent: DataFrame, bits: int) -> str:
    """A file of at most ``2 ** (bits - 6)`` rows that marks the fingerprints' leading bits."""
    path = shared_folder(frequent.sparkSession, "phrase-bits")
    bit = F.shiftrightunsigned("fingerprint", 64 - bits)
    words = frequent.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
    words.repartition(4, "word").write.parquet(path)
    return path


def over_parts(texts: DataFrame, kernel: Callable[[Runs, list[tuple]], Iterator[pa.RecordBatch]], schema: str,
               combine: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter) -> DataFrame:
    """``kernel`` over parts of about ``PART_BYTES``; it gets their runs and (id, offset, language) of each part.

    ``combine`` gets all batches that a task makes, one after another.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"], PART_BYTES):
                some = batch.slice(a, b - a)
                rows = zip(some["id"].to_pylist(), some["lang"].to_pylist(), some["text"].cast(pa.binary()).to_pylist())
                whole = [(i, lang, part) for i, lang, text in rows for part in parted(text)]
                # Short texts go together; parts of a long one by themselves.
                for group in ([whole] if sum(len(p[1]) for _, _, p in whole) <= 2 * PART_BYTES else [[w] for w in whole]):
                    runs = Runs([p[1] for _, _, p in group], [p[2] for _, _, p in group], [lang for _, lang, _ in group])
                    if len(runs.start):
                        yield from kernel(runs, [(i, p[0], lang) for i, lang, p in group])

    return texts.mapInArrow(lambda batches: combine(work(batches)), schema)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the same fingerprint added up, over as many batches as hold ``COMBINED`` of them."""
    waiting, size = [], 0

    def flush() -> pa.RecordBatch:
        prints, found = (np.concatenate([np.asarray(b[name]) for b in waiting]) for name in ("fingerprint", "found"))
        order = np.argsort(prints)
        prints, found = prints[order], found[order]
        begins = runs_of(prints)
        return pa.RecordBatch.from_arrays([pa.array(prints[begins]), pa.array(np.add.reduceat(found, begins))], names=["fingerprint", "found"])

    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.num_rows
        if size >= COMBINED:
            yield flush()
            waiting, size = [], 0
    if waiting:
        yield flush()


def fingerprint_counts(texts: DataFrame, lengths: tuple[int, ...], pairs: str | None, bits: int) -> DataFrame:
    """Occurrences of each fingerprint of runs of these lengths; with ``pairs``, of those alone whose every pair of words is marked."""

    def count(runs: Runs, _: list[tuple]) -> Iterator[pa.RecordBatch]:
        if pairs is not None:
            at = runs.places(2)
            good = np.zeros(len(runs.start) + LONGEST, bool)
            good[at] = marked(pairs, bits, runs.fingerprints(at, 2))
            # A pair that begins beyond the part's own bytes is judged where it begins; here it passes.
            good[:len(runs.start)] |= ~runs.owned
        for n in lengths:
            at = runs.places(n)
            if pairs is not None:
                for k in range(n - 1):
                    at = at[good[at + k]]
            found, times = np.unique(runs.fingerprints(at, n), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times, pa.int64())], names=["fingerprint", "found"])

    # Tasks have combined what they send, so a frequent run is a row per million of a task's; Spark need not hold a task's runs once more.
    return over_parts(texts, count, FINGERPRINT, merged).repartition("fingerprint").groupBy("fingerprint").agg(F.sum("found").alias("found"))


def exact_counts(texts: DataFrame, path: str, bits: int, longest: int) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and its exact count ``f`` for runs that are marked, with a pointer (``doc_id``, ``at``) to one.

    ``words`` 0 and an empty phrase stand for all words of the language.
    """

    def look(runs: Runs, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        number, (text, begins, ends) = runs.exact_words(), runs.spaced()
        ids, offsets, langs = (pa.array(x, t) for x, t in zip(zip(*parts), (pa.int64(), pa.int64(), pa.string())))
        owned = np.bincount(runs.part[runs.owned], minlength=len(parts))
        none = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays([langs, pa.array(np.zeros(len(parts), np.int32)), pa.array([b""] * len(parts), pa.binary()),
                                          pa.array(owned, pa.int64()), none, none], names=["lang", "words", "phrase", "found", "doc_id", "at"])
        for n in range(1, longest + 1):
            at = runs.places(n)
            prints = runs.fingerprints(at, n)
            kept = marked(path, bits, prints)
            at, prints = at[kept], prints[kept]
            if not len(at):
                continue
            _, first, group = np.unique(prints, return_index=True, return_inverse=True)
            pointer = at[first]
            same = np.ones(len(at), bool)
            for k in range(n):
                same &= number[at + k] == number[pointer[group] + k]
            same &= runs.seed[at] == runs.seed[pointer[group]]
            # An occurrence that is not what the pointer shows is sent by itself.
            shown = np.r_[pointer, at[~same]]
            times = np.r_[np.bincount(group[same], minlength=len(pointer)), np.ones((~same).sum(), np.int64)]
            part = runs.part[shown]
            phrases = [text[a:b] for a, b in zip(begins[shown].tolist(), ends[shown + n - 1].tolist())]
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(part)), pa.array(np.full(len(shown), n, np.int32)), pa.array(phrases, pa.binary()), pa.array(times, pa.int64()),
                ids.take(pa.array(part)), pa.array(np.asarray(offsets)[part] + runs.start[shown] - runs.begins[part]),
            ], names=["lang", "words", "phrase", "found", "doc_id", "at"])

    rows = over_parts(texts, look, PHRASES).withColumn("phrase", F.col("phrase").cast("string"))
    return rows.groupBy("lang", "words", "phrase").agg(
        F.sum("found").alias("f"), F.first("doc_id").alias("doc_id"), F.first("at").alias("at"))


def joined(words: Column, begin: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, begin, size), " ")


def scored(counted: DataFrame, cover: int) -> DataFrame:
    """Candidates with their lowest-scoring cut, without those that a longer candidate covers."""
    split = counted.filter("words >= 2").withColumn("w", F.split("phrase", " "))
    part = counted.filter("words >= 1").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("f").alias("times"))
    cuts = split.select("lang", "phrase", "words", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", joined(F.col("w"), F.lit(1), F.col("k")).alias("front"),
                       joined(F.col("w"), F.col("k") + 1, F.col("words")).alias("back"))
    for side, name in (("front", "l"), ("back", "r")):
        cuts = cuts.join(part, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part").withColumnRenamed("times", name)
    # In decimals of 38 digits: the product may pass 64 bits.
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0))) AS BIGINT)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every shorter run of two or more words inside a candidate: its length and where it begins.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: joined(F.col("w"), i, m))))
    covers = split.filter("words >= 3").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = best.join(covers, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    return left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", id_column: str = "doc_id", least: int = LEAST,
                 longest: int = LONGEST, first: int = FIRST, cover: int = COVER, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Each language's best phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``, and an occurrence (``doc_id``, byte ``at``).

    A-Z is lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks.  A
    phrase has 2 to ``longest`` (at most 4) words and ``least`` occurrences or
    more; overlapping ones count.  Null texts and texts without words give
    nothing, a null language is ``und``, rows that repeat an id or a text each
    count, and a null id gives a null pointer.  Equal scores and counts are
    ordered by the phrase's bytes.  An empty table gives no row.  Other columns are
    not read.  Texts are read in parts of about 1 MB; a single word longer than
    that is held whole.
    """
    if not 2 <= longest <= LONGEST or least < 1:
        raise ValueError(f"phrases have 2 to {LONGEST} words and occur at least once")
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    frequent = F.col("found") >= least
    short = stored(fingerprint_counts(texts, (1, 2), None, filter_bits).filter(frequent).select("fingerprint"), "phrase-prints")
    every = short
    if longest > 2:
        pairs = stored_bitmap(short, filter_bits)
        every = short.union(fingerprint_counts(texts, tuple(range(3, longest + 1)), pairs, filter_bits).filter(frequent).select("fingerprint"))
    counts = exact_counts(texts, stored_bitmap(every, filter_bits), filter_bits, longest)
    counted = stored(counts.filter((F.col("words") == 0) | (F.col("f") >= least)), "phrases")
    best = scored(counted, cover).select(
        F.col("lang").alias("grp"), (-F.col("score")).alias("falling_score"), (-F.col("a")).alias("falling_a"), "phrase", "a", "l", "r", "score")
    top = ranked(best, ["falling_score", "falling_a", "phrase"]).filter(F.col("rank") < first).select(
        F.col("grp").alias("lang"), (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", "score")
    total = counted.filter("words = 0").select("lang", F.col("f").alias("n"))
    shown = counted.filter("words >= 2").select("lang", "phrase", "doc_id", "at")
    return top.join(total, "lang").join(shown, ["lang", "phrase"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id", "at")
