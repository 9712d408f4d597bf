"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words.  Every passage of the whole text is
encoded by one hidden layer over its character and word statistics; gated
attention, learned from document labels alone, weighs the passages, and the
weighted mean of their codes gives the document's score.

The model is fitted with numpy on a bounded sample of labelled rows; Spark makes
the features of the sample and scores all documents, in batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.llm.common import Words, mix, runs, slices

PASSAGE_WORDS = 64
# Labelled documents in the fit at most, those of the smallest hashed ids, and passages of one of them, those of the smallest hashed places.
SAMPLE_ROWS, SAMPLE_PASSAGES = 6000, 64
HIDDEN, GATE = 32, 16
EPOCHS, BATCH_DOCS, RATE, DECAY = 60, 64, 3e-3, 1e-4
THRESHOLD = 0.7

# Classes of bytes: lower case, upper case, digits, space, line ends, beyond ASCII, other control, then each ASCII mark.
CLASSES = np.full(256, 6, np.int64)
CLASSES[ord("a"):ord("z") + 1] = 0
CLASSES[ord("A"):ord("Z") + 1] = 1
CLASSES[ord("0"):ord("9") + 1] = 2
CLASSES[32] = 3
CLASSES[[10, 13]] = 4
CLASSES[128:] = 5
MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
CLASSES[MARKS] = 7 + np.arange(len(MARKS))
N_CLASSES = 7 + len(MARKS)
REPEATS = (1, 2, 3, 4, 8)
N_FEATURES = 2 * N_CLASSES + len(REPEATS) + 6


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of statistics per passage, and each text's number of passages; a text without words has one, of zeros."""
    words = Words(texts)
    per_text = np.maximum(1, -(-words.count // PASSAGE_WORDS))
    first = np.r_[0, np.cumsum(per_text)[:-1]] if len(per_text) else np.zeros(0, np.int64)
    n = int(per_text.sum())
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(words.start):
        return out, per_text
    inside = np.arange(len(words.text)) - words.first[words.text]
    passage = first[words.text] + inside // PASSAGE_WORDS
    size = np.bincount(passage, minlength=n).astype(np.float64)
    full = np.maximum(size, 1)

    # Bytes from a word's start to the next word's, or to its text's end, belong to its passage.
    follows = np.r_[words.text[1:] == words.text[:-1], False]
    width = np.where(follows, np.r_[words.start[1:], 0], words.text_ends[words.text] - 1) - words.start
    kinds = CLASSES[words.data[np.repeat(words.start - np.cumsum(width) + width, width) + np.arange(width.sum())]]
    owner = np.repeat(passage, width)
    counts = np.bincount(owner * N_CLASSES + kinds, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, :N_CLASSES] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    last = CLASSES[words.data[words.end - 1]]
    ends = np.bincount(passage * N_CLASSES + last, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, N_CLASSES:2 * N_CLASSES] = ends / full[:, None]

    hashes = words.hashes()
    at = 2 * N_CLASSES
    for k, back in enumerate(REPEATS):
        same = np.zeros(len(hashes), bool)
        same[back:] = (hashes[back:] == hashes[:-back]) & (passage[back:] == passage[:-back])
        out[:, at + k] = np.bincount(passage, weights=same, minlength=n) / full
    at += len(REPEATS)
    keyed = np.sort((passage.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    distinct = np.bincount((keyed[runs(keyed)] >> np.uint64(44)).astype(np.int64), minlength=n)
    length = (words.end - words.start).astype(np.float64)
    mean = np.bincount(passage, weights=length, minlength=n) / full
    out[:, at] = distinct / full
    out[:, at + 1] = np.log1p(mean)
    out[:, at + 2] = np.log1p(np.maximum(0, np.bincount(passage, weights=length ** 2, minlength=n) / full - mean ** 2))
    out[:, at + 3] = np.bincount(passage, weights=CLASSES[words.data[words.start]] == 1, minlength=n) / full
    out[:, at + 4] = np.bincount(passage, weights=length == 1, minlength=n) / full
    out[:, at + 5] = np.log1p(size)
    return out, per_text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Scaling of the features and the layers' weights."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Bags lie one after another; ``counts`` are their sizes, each at least one."""
        w = self.weights
        begins = np.r_[0, np.cumsum(counts)[:-1]]
        bag = np.repeat(np.arange(len(counts)), counts)
        x = (features - self.mean) / self.scale
        h = np.tanh(x @ w["W"] + w["wb"])
        t, s = np.tanh(h @ w["V"] + w["vb"]), sigmoid(h @ w["U"] + w["ub"])
        energy = (t * s) @ w["g"]
        rise = np.exp(energy - np.maximum.reduceat(energy, begins)[bag])
        a = rise / np.add.reduceat(rise, begins)[bag]
        z = np.add.reduceat(a[:, None] * h, begins, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "bag": bag, "begins": begins, "y": sigmoid(z @ w["c"] + w["d"])}

    def gradients(self, features: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(features, counts)
        wrong = (f["y"] - labels) / len(labels)
        back = wrong[:, None] * w["c"]
        of = back[f["bag"]]
        along = (of * f["h"]).sum(axis=1)
        energy = f["a"] * (along - np.add.reduceat(f["a"] * along, f["begins"])[f["bag"]])
        gate = energy[:, None] * w["g"]
        t = gate * f["s"] * (1 - f["t"] ** 2)
        s = gate * f["t"] * f["s"] * (1 - f["s"])
        h = (f["a"][:, None] * of + t @ w["V"].T + s @ w["U"].T) * (1 - f["h"] ** 2)
        return {"c": f["z"].T @ wrong, "d": wrong.sum(), "g": (f["t"] * f["s"]).T @ energy, "V": f["h"].T @ t, "vb": t.sum(axis=0),
                "U": f["h"].T @ s, "ub": s.sum(axis=0), "W": f["x"].T @ h, "wb": h.sum(axis=0)}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Adam on the cross-entropy of the bags' labels."""
    every = np.concatenate(bags)
    rng = np.random.default_rng(seed)
    start = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    model = Model(every.mean(axis=0), every.std(axis=0) + 0.02, {
        "W": start(N_FEATURES, HIDDEN), "wb": np.zeros(HIDDEN), "V": start(HIDDEN, GATE), "vb": np.zeros(GATE),
        "U": start(HIDDEN, GATE), "ub": np.zeros(GATE), "g": start(GATE), "c": start(HIDDEN), "d": np.zeros(()),
    })
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH_DOCS):
            some = order[at:at + BATCH_DOCS]
            step += 1
            slopes = model.gradients(np.concatenate([bags[i] for i in some]), np.array([len(bags[i]) for i in some]), labels[some])
            for k, slope in slopes.items():
                slope = slope + DECAY * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope ** 2
                model.weights[k] = model.weights[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def held_out(id_column: Column) -> Column:
    """Whether a row's label is kept from the fit; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def some_passages(count: int, most: int) -> np.ndarray:
    """Places of at most ``most`` of ``count`` passages, in order; those of the smallest hashes if there are more."""
    if count <= most:
        return np.arange(count)
    return np.sort(np.argsort(mix(np.arange(1, count + 1, dtype=np.uint64)), kind="stable")[:most])


def fit_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                label_column: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_passages: int = SAMPLE_PASSAGES) -> Model | None:
    """A model from labelled rows that are not held out; None without any.

    Labels other than 0 and 1 are ignored, and so are null ids; a document with
    several labels counts as its lowest, an id with several texts as that of the
    smallest hash.  The sample is the documents whose hashed ids are smallest,
    ``sample_rows`` of them, so its size does not follow the input and sending its
    ids to every task is bounded too.  A document of more than ``sample_passages``
    passages gives so many, spread over its whole text.  If none of the sampled
    ids has a document but other labelled ones do, that is an error.
    """
    if sample_rows < 1 or sample_passages < 1:
        raise ValueError("sample_rows and sample_passages are at least 1")
    known = labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1) & ~held_out(F.col(id_column)))
    sample = known.groupBy(F.col(id_column).cast("long").alias("id")).agg(F.min(label_column).cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                features, counts = passage_features(batch["text"][a:b])
                ends = np.cumsum(counts)
                packed = [features[e - c + some_passages(c, sample_passages)].tobytes() for e, c in zip(ends.tolist(), counts.tolist())]
                part = batch.select(["id", "label"]).slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(packed, pa.binary())], names=["id", "label", "bag"])

    # Of rows that repeat an id one is taken, by its text alone; each task sends at most one of them on.
    chosen = plain.join(F.broadcast(sample), "id").groupBy("id", "label").agg(
        F.min(F.struct(F.col("text").isNull().alias("empty"), F.xxhash64("text").alias("hash"), "text")).alias("one"))
    rows = chosen.select("id", "label", "one.text").mapInArrow(
        encode, "id long, label int, bag binary").collect()  # at most sample_rows bags of sample_passages rows
    if not rows:
        if not plain.join(known.select(F.col(id_column).cast("long").alias("id")), "id", "left_semi").isEmpty():
            raise ValueError(f"no document has one of the {sample_rows} sampled labels, but others are labelled")
        return None
    rows.sort(key=lambda r: (r["id"], bytes(r["bag"])))
    bags = [np.frombuffer(bytes(r["bag"]), np.float32).reshape(-1, N_FEATURES) for r in rows]
    return fit(bags, np.array([r["label"] for r in rows], np.float64))


def score_rows(docs: DataFrame, model: Model | None, into: str, text_column: str = "text") -> DataFrame:
    """``docs``, all columns, with the score of each row's text in ``into``; without a model every score is 0.5."""
    shaped = docs.withColumn(into, F.lit(0.5))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch[text_column].cast(pa.string())
            for a, b in slices(texts):
                part = batch.slice(a, b - a)
                if model is not None:
                    value = model.forward(*passage_features(texts[a:b]))["y"]
                    part = part.set_column(batch.schema.get_field_index(into), into, pa.array(value, pa.float64()))
                yield part

    return shaped.mapInArrow(score, shaped.schema)


def score_quality(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on).

    The score depends on the text alone.  Null and empty texts are one passage of
    zeros.  Without a model every score is 0.5.  Rows that repeat an id each get
    theirs.  Other columns are not read.
    """
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return score_rows(plain, model, "score").select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
