"""Token ids of documents in wavelet-matrix files, one per shard, and the way back."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floorline.llm import wavelet
from floorline.llm.common import Numbers, opened, shuffle_partitions, slices, total_bytes

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Text in a shard, about; and words whose ids a task remembers before it starts anew.
SHARD_BYTES, KEPT_WORDS = 8 << 20, 600_000
SUFFIX = ".wavelet"
# Letters a-z and those of Latin-1, then marks: two pre-tokens of the tokenizer, whose model takes each as it is.
PLAIN = rb"((?:[A-Za-z]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)([.,;:!?|%&#$*\"()]*+)"
# Words in a line each: the two parts of a plain one, or another one whole.
LINES = re.compile(rb"^(?:" + PLAIN + rb"|([^\n]+))$", re.M)
# Byte-level models spell a byte as a visible character: itself if it is one, else the next free one from U+0100 on.
VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
SPELLED = {b: chr(b) for b in VISIBLE} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(VISIBLE)))}
# The same by the byte's number, but for the line's end between parts.
SPELLING = "".join("\n" if b == 10 else SPELLED[b] for b in range(256))

TOKEN_ID = attrgetter("id")


class WordEncoder:
    """Ids of texts by the ids of their words.

    The tokenizer drops white space before it forms pre-tokens, and none spans it,
    so a text's ids are its words' ids; each distinct word is encoded once.  A word
    is one or two parts; each distinct part goes through the tokenizer once.  The
    ids of all words lie one after another, and so do those of all parts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.number, self.part_number = Numbers(), Numbers()
        for numbers in (self.number, self.part_number):
            numbers[b""]  # number 0, of no ids
            numbers.settle()
        self.part_ids, self.part_ends = np.zeros(0, np.uint32), np.zeros(2, np.int64)
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def learn_parts(self, parts: list[bytes]) -> None:
        """Letters or marks of plain words, and, after a space, other words."""
        ids: list[int] = []
        ends = []
        plain = [p for p in parts if p[0] != 32]
        lowered = b"\n".join(plain).decode().lower().encode().decode("latin-1").translate(SPELLING).split("\n")
        odd = [p[1:].decode() for p in parts if p[0] == 32]
        encoded = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False) if odd else ())
        tokenize, spelled = self.model.tokenize, iter(lowered)
        for part in parts:
            ids += next(encoded).ids if part[0] == 32 else map(TOKEN_ID, tokenize(next(spelled)))
            ends.append(len(ids))
        self.part_ends = np.r_[self.part_ends, np.array(ends, np.int64) + len(self.part_ids)]
        self.part_ids = np.r_[self.part_ids, np.array(ids, np.uint32)]

    def learn(self, words: list[bytes]) -> None:
        split = LINES.findall(b"\n".join(words))
        # No plain part begins with a space, so the names of other words are apart.
        pairs = [part for a, b, other in split for part in ((b" " + other, b"") if other else (a, b))]
        at = np.fromiter(map(self.part_number.__getitem__, pairs), np.int64, len(pairs))
        if len(self.part_number) > self.part_number.settled:
            self.learn_parts(self.part_number.fresh())
            self.part_number.settle()
        ids, size = gathered(self.part_ids, self.part_ends, at)
        self.ends = np.r_[self.ends, np.cumsum(size)[1::2] + len(self.ids)]
        self.ids = np.r_[self.ids, ids]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each closed by the end id, and how many each has."""
        if len(self.number) > KEPT_WORDS:
            self.clear()
        split = pc.ascii_split_whitespace(texts)
        counts = np.asarray(split.value_lengths())
        # Arrow tells the words of these texts apart, so that only distinct ones are looked up.
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        number = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        if len(self.number) > self.number.settled:
            self.learn(self.number.fresh())
            self.number.settle()
        ids, size = gathered(self.ids, self.ends, number[np.asarray(words.indices)])
        upto = np.r_[0, np.cumsum(size)][np.cumsum(counts)]
        return np.insert(ids, upto, END_ID), np.diff(np.r_[0, upto]) + 1


def gathered(ids: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some of the lists that lie one after another, and how many each has."""
    starts = ends[at]
    size = ends[at + 1] - starts
    total = np.cumsum(size)
    return ids[np.repeat(starts - total + size, size) + np.arange(total[-1] if len(total) else 0)], size


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One encoder per worker process; its memory is bounded and later tasks find it warm."""
    return WordEncoder(path)


def write_token_files(docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text",
                      tokenizer_path: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write shards of ids below ``folder`` in ascending order of the documents' ids; returns shard, path, documents, ids.

    A null or empty text is the end id alone.  Rows with a null id come first.
    Rows that repeat an id lie together, in the order of their texts' hashes, in
    as many shards as they fill.  A file is written under
    another name and then moved, so a task that runs again replaces its own.  An
    empty table writes no file.
    """
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    shards = max(1, -(-total_bytes(plain, "text") // shard_bytes))
    spread = plain.withColumn("hash", F.xxhash64("text"))
    dealt = spread.repartitionByRange(shards, "id", "hash").sortWithinPartitions("id", "hash").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        bits = max(1, (encoder.tokenizer.get_vocab_size() - 1).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        ids, counts, tokens, missing = [], [], [], []
        for batch in batches:
            for a, b in slices(batch["text"]):
                own, count = encoder.encode(batch["text"][a:b].fill_null(""))
                tokens.append(own.astype(kind))
                counts.append(count)
                missing.append(np.asarray(batch["id"][a:b].is_null()))
                ids.append(np.asarray(batch["id"][a:b].fill_null(0)))
        if not ids:
            return
        shard = TaskContext.get().partitionId()
        matrix = wavelet.WaveletMatrix.of(np.concatenate(tokens), bits)
        name = f"shard-{shard:08d}{SUFFIX}"
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        draft = f"{base}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft, compression=None) as out:
            out.write(wavelet.to_bytes(np.concatenate(ids), np.cumsum(np.concatenate(counts)), matrix, np.concatenate(missing)))
        system.move(draft, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "path": [f"{folder}/{name}"], "documents": [sum(map(len, ids))], "tokens": [matrix.size]})

    return dealt.mapInArrow(write, "shard long, path string, documents long, tokens long")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian 32-bit).

    A file's number of ids is in its first bytes; what goes before a shard is a
    running sum over the shards, one row each.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path").withColumn(
        "shard", F.regexp_extract("path", r"shard-(\d+)\.", 1).cast("long"))
    files = files.repartition(shuffle_partitions(spark), "shard")  # a number, or the few small rows end in one task

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch["path"].to_pylist():
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    found.append(wavelet.header(file.read(wavelet.HEADER))[1])
            yield pa.RecordBatch.from_arrays([batch["shard"], pa.array(found, pa.int64())], names=["number", "tokens"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, shard in zip(batch["path"].to_pylist(), batch["shard"].to_pylist()):
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    ids, ends, matrix, missing = wavelet.from_bytes(file.read())
                tokens = matrix.all(np.uint16 if matrix.bits <= 16 else np.uint32).astype("<u4")
                begins = np.r_[0, ends[:-1]]
                for at in range(0, len(ids), 1000):
                    some = slice(at, at + 1000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(ids[some]), shard), pa.int64()), pa.array(ids[some], mask=missing[some]),
                        pa.array(begins[some], pa.int64()), pa.array(ends[some] - begins[some], pa.int64()),
                        pa.array([tokens[a:b].tobytes() for a, b in zip(begins[some], ends[some])], pa.binary()),
                    ], names=["shard", "doc_id", "inside", "n_tokens", "ids"])

    before = files.mapInArrow(sizes, "number long, tokens long").withColumn(
        "before", F.sum("tokens").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens"))
    body = files.mapInArrow(documents, "shard long, doc_id long, inside long, n_tokens long, ids binary")
    return body.join(before.select("number", "before"), F.col("shard") == F.col("number")).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids")


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """How often, and where, a token occurs in each shard, from the shard's file alone: ``shard``, ``n``, ``places``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path").withColumn(
        "shard", F.regexp_extract("path", r"shard-(\d+)\.", 1).cast("long"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, shard in zip(batch["path"].to_pylist(), batch["shard"].to_pylist()):
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    matrix = wavelet.from_bytes(file.read())[2]
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard]), pa.array([matrix.count(token)], pa.int64()), pa.array([matrix.find(token)], pa.list_(pa.int64())),
                ], names=["shard", "n", "places"])

    return files.repartition(shuffle_partitions(spark), "shard").mapInArrow(look, "shard long, n long, places array<long>")
