"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is read in windows of consecutive bytes.  Within a window one recurrent
layer runs forwards and one backwards; both states together label every byte with
probabilities of the languages, and a text's probabilities are the mean over all
its bytes.  Windows of many texts run side by side, so a step of the recurrence is
one matrix product for thousands of them.

The network is trained with numpy by backpropagation through time on a bounded,
stratified sample; Spark chooses the sample and labels all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorline.llm.common import mix, slices
from floorline.llm.quality import held_out

UNKNOWN = "und"
# Bytes of a window, states of a direction, windows that are labelled side by side.
WINDOW, HIDDEN, SIDE_BY_SIDE = 64, 12, 1024
# The sample: languages at most, those with most rows, documents of one and windows of one document, those of the smallest hashes.
SAMPLE_LANGUAGES, SAMPLE_ROWS, SAMPLE_WINDOWS = 200, 400, 8
STEPS, BATCH, RATE = 200, 192, 1e-2
DIRECTIONS = ("f", "b")


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts (rows of bytes, zeros behind the last), the bytes in each, and its text's number."""
    sizes = np.array([len(t) for t in texts], np.int64)
    per_text = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), per_text)
    filled = np.full(per_text.sum(), WINDOW, np.int64)
    ends = np.cumsum(per_text)
    some = per_text > 0
    filled[ends[some] - 1] = (sizes - (per_text - 1) * WINDOW)[some]
    out = np.zeros((len(filled), WINDOW), np.uint8)
    out[np.arange(WINDOW) < filled[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
    return out, filled, owner


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; by the exponential, which numpy computes faster than the hyperbolic tangent."""
    np.negative(x, out=x)
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def tanh(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 2
    sigmoid(x)
    x *= 2
    x -= 1
    return x


@dataclass
class Model:
    """Languages and weights: of each direction ``E`` (a row per byte: update, reset, candidate), ``U`` (update, reset), ``C``; then ``W``, ``b``."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Model:
        draw = lambda *shape: rng.normal(0, hidden ** -0.5, shape).astype(np.float32)
        weights = {}
        for d in DIRECTIONS:
            weights |= {f"{d}E": draw(256, 3 * hidden), f"{d}U": draw(hidden, 2 * hidden), f"{d}C": draw(hidden, hidden)}
        return cls(languages, weights | {"W": draw(2 * hidden, len(languages)), "b": np.zeros(len(languages), np.float32)})

    def states(self, direction: str, data: np.ndarray, filled: np.ndarray, kept: list | None = None) -> np.ndarray:
        """States of a direction, step by window; beyond a window's bytes a state stays as it was.

        ``kept`` collects what the way back needs.
        """
        w, hidden = self.weights, self.weights["fC"].shape[0]
        h = np.zeros((len(data), hidden), self.weights["fC"].dtype)
        out = np.empty((WINDOW, len(data), hidden), h.dtype)
        ragged = filled.min() < WINDOW if len(filled) else False
        for t in range(WINDOW) if direction == "f" else reversed(range(WINDOW)):
            given = np.take(w[f"{direction}E"], data[:, t], axis=0)
            gates = sigmoid(given[:, :2 * hidden] + h @ w[f"{direction}U"])
            update, reset = gates[:, :hidden], gates[:, hidden:]
            again = reset * h
            fresh = tanh(given[:, 2 * hidden:] + again @ w[f"{direction}C"])
            if ragged:
                update = update * (t < filled)[:, None]
            if kept is not None:
                kept.append((t, h, update, reset, again, fresh))
            h = h + update * (fresh - h)
            out[t] = h
        return out

    def position_probabilities(self, data: np.ndarray, filled: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Probabilities of the languages for every position (step by window) from both directions' states."""
        found = [self.states(d, data, filled, None if kept is None else kept.setdefault(d, [])) for d in DIRECTIONS]
        both = np.concatenate(found, axis=2)
        scores = both @ self.weights["W"] + self.weights["b"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        if kept is not None:
            kept["both"] = both
        return scores

    def gradients(self, data: np.ndarray, filled: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its slopes, by backpropagation through time."""
        w, hidden, kept = self.weights, self.weights["fC"].shape[0], {}
        p = self.position_probabilities(data, filled, kept)
        inside = (np.arange(WINDOW)[:, None] < filled).astype(p.dtype) / filled.sum()
        own = p[:, np.arange(len(labels)), labels]
        loss = float(-(np.log(own + 1e-30) * inside).sum())
        wrong = p * inside[:, :, None]
        wrong[:, np.arange(len(labels)), labels] -= inside
        slopes = {k: np.zeros_like(v) for k, v in w.items()}
        slopes["W"] = kept["both"].reshape(-1, 2 * hidden).T @ wrong.reshape(-1, wrong.shape[2])
        slopes["b"] = wrong.sum(axis=(0, 1))
        back = wrong @ w["W"].T
        for k, d in enumerate(DIRECTIONS):
            later = np.zeros((len(data), hidden), p.dtype)
            given = np.empty((WINDOW, len(data), 3 * hidden), p.dtype)
            for t, h, update, reset, again, fresh in reversed(kept[d]):
                g = later + back[t][:, k * hidden:(k + 1) * hidden]
                fresh_in = g * update * (1 - fresh * fresh)
                again_in = fresh_in @ w[f"{d}C"].T
                update_in = g * (fresh - h) * update * (1 - update)
                reset_in = again_in * h * reset * (1 - reset)
                gates_in = np.concatenate([update_in, reset_in], axis=1)
                slopes[f"{d}C"] += again.T @ fresh_in
                slopes[f"{d}U"] += h.T @ gates_in
                given[t, :, :2 * hidden], given[t, :, 2 * hidden:] = gates_in, fresh_in
                later = g * (1 - update) + again_in * reset + gates_in @ w[f"{d}U"].T
            # One row per byte value: all positions' slopes summed by the byte that stood there.
            flat, order = data.T.ravel(), np.argsort(data.T.ravel(), kind="stable")
            begins = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
            slopes[f"{d}E"][flat[order][begins]] = np.add.reduceat(given.reshape(-1, 3 * hidden)[order], begins, axis=0)
        return loss, slopes

    def labelled(self, data: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """Each window's sum of its positions' probabilities; the same numbers as ``position_probabilities`` in fewer passes over memory.

        Gates are 1 / (1 + exp(-x)) and tanh(x) is twice the gate of 2 x less 1, so weights are negated and doubled once.
        """
        w, hidden, n = self.weights, self.weights["fC"].shape[0], len(data)
        columns, ragged = np.ascontiguousarray(data.T), filled.min() < WINDOW
        scores = np.zeros((WINDOW, n, len(self.languages)), np.float32)
        update, reset, fresh, product = (np.empty((n, hidden), np.float32) for _ in range(4))

        def gate(x: np.ndarray) -> None:
            np.exp(x, out=x)
            np.add(x, 1, out=x)
            np.reciprocal(x, out=x)

        with np.errstate(over="ignore"):  # a gate whose exponential is infinite is 0
            for k, d in enumerate(DIRECTIONS):
                tables = [np.ascontiguousarray(factor * w[f"{d}E"][:, a * hidden:(a + 1) * hidden]) for a, factor in enumerate((-1, -1, -2))]
                to_update, to_reset = (np.ascontiguousarray(-w[f"{d}U"][:, a * hidden:(a + 1) * hidden]) for a in (0, 1))
                to_fresh, out = -2 * w[f"{d}C"], np.ascontiguousarray(w["W"][k * hidden:(k + 1) * hidden])
                h = np.zeros((n, hidden), np.float32)
                for t in range(WINDOW) if d == "f" else reversed(range(WINDOW)):
                    for x, table, to in ((update, tables[0], to_update), (reset, tables[1], to_reset)):
                        np.take(table, columns[t], axis=0, out=x, mode="clip")
                        np.matmul(h, to, out=product)
                        np.add(x, product, out=x)
                        gate(x)
                    np.multiply(reset, h, out=reset)
                    np.take(tables[2], columns[t], axis=0, out=fresh, mode="clip")
                    np.matmul(reset, to_fresh, out=product)
                    np.add(fresh, product, out=fresh)
                    gate(fresh)
                    np.add(fresh, fresh, out=fresh)
                    np.subtract(fresh, 1, out=fresh)
                    np.subtract(fresh, h, out=fresh)
                    np.multiply(fresh, update, out=fresh)
                    if ragged:
                        fresh[t >= filled] = 0
                    np.add(h, fresh, out=h)
                    scores[t] += h @ out
        scores += w["b"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        if ragged:
            scores *= (np.arange(WINDOW)[:, None] < filled)[:, :, None]
        return scores.sum(axis=0)

    def text_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """A row per text: the mean of its positions' probabilities; an empty text has none and gives zeros."""
        data, filled, owner = windows_of(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(data), SIDE_BY_SIDE):
            b = a + SIDE_BY_SIDE
            np.add.at(sums, owner[a:b], self.labelled(data[a:b], filled[a:b]))
        return sums / np.maximum([[len(t)] for t in texts], 1)


def train(data: np.ndarray, filled: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS,
          seed: int = 5) -> Model:
    """Adam on windows drawn evenly from the languages."""
    rng = np.random.default_rng(seed)
    model = Model.fresh(languages, hidden, rng)
    places = [np.flatnonzero(labels == k) for k in range(len(languages))]
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, steps + 1):
        lang = rng.integers(len(languages), size=BATCH)
        some = np.array([places[k][rng.integers(len(places[k]))] for k in lang])
        _, slopes = model.gradients(data[some], filled[some], labels[some])
        norm = np.sqrt(sum(float((s * s).sum()) for s in slopes.values()))
        rate = RATE * min(1, step / 20) * 0.5 * (1 + np.cos(np.pi * step / steps))
        for k, slope in slopes.items():
            slope = slope / max(1.0, norm)
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope * slope
            move = rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
            model.weights[k] = (model.weights[k] - move).astype(np.float32)
    return model


def some_windows(text: bytes, most: int) -> bytes:
    """At most ``most`` windows of a text, spread over it by hash, in order; shorter texts whole."""
    count = -(-len(text) // WINDOW)
    if count <= most:
        return text
    chosen = np.sort(np.argsort(mix(np.arange(1, count, dtype=np.uint64)), kind="stable")[:most])  # the last one may be short
    return b"".join(text[k * WINDOW:(k + 1) * WINDOW] for k in chosen.tolist())


def fit_language(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", hidden: int = HIDDEN,
                 steps: int = STEPS, sample_languages: int = SAMPLE_LANGUAGES, sample_rows: int = SAMPLE_ROWS,
                 sample_windows: int = SAMPLE_WINDOWS) -> Model | None:
    """A model from rows with a language, a letter and an id that is not held out; None without any.

    The sample is bounded whatever the input: of the ``sample_languages`` languages
    with most rows, ``sample_rows`` rows each, chosen by hashes of id and
    text, and ``sample_windows`` windows of each.  Rows that repeat an id and
    text count once.  A null id is not held out.
    """
    if min(hidden, steps, sample_languages, sample_rows, sample_windows) < 1:
        raise ValueError("sizes of the model and the sample are at least 1")
    known = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"),
                        F.col(id_column).cast("string").alias("id"), held_out(F.col(id_column)).alias("out")).filter(
        "lang IS NOT NULL AND NOT out").filter(F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("id", "text"))
    chosen = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(sample_languages)
    # Of a language, about twice the rows wanted have hashes below this share of all hashes; no task sees more of it.
    share = 2.0 * sample_rows / F.col("rows")
    below = known.join(F.broadcast(chosen), "lang").filter(F.pmod("hash", F.lit(1 << 32)) / float(1 << 32) < share).select("lang", "hash", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [some_windows(t, sample_windows) for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["hash"], pa.array(texts, pa.binary())], names=["lang", "hash", "some"])

    # Rows of one hash are counted as one before the shuffle.
    short = below.mapInArrow(cut, "lang string, hash long, some binary").dropDuplicates(["lang", "hash"])
    short = short.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).filter(
        F.col("place") <= sample_rows).drop("place")
    rows = short.collect()  # at most sample_languages * sample_rows texts of sample_windows windows
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["hash"]))
    languages = sorted({r["lang"] for r in rows})
    data, filled, owner = windows_of([bytes(r["some"]) for r in rows])
    labels = np.array([languages.index(r["lang"]) for r in rows])[owner]
    return train(data, filled, labels, languages, hidden, steps)


def predict_language(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred`` and ``score``, the text's probability of that language.

    The whole text is read, window by window; only the text enters.  Texts that
    are null, empty or without a letter are ``und`` with score 0, and so is every
    text without a model.  Equal probabilities go to the language first in order.
    Rows that repeat an id each get theirs; an empty table gives no row.  Other
    columns are not read.
    """
    lettered = F.coalesce(F.col(text_column).cast("string").rlike(r"\p{L}"), F.lit(False))
    plain = docs.select(F.col(id_column).alias("id"), F.when(lettered, F.col(text_column).cast("string")).alias("text"),
                        F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = None if model is None else np.array(model.languages)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            for a, b in slices(batch["text"]):
                texts = batch["text"][a:b].cast(pa.binary()).to_pylist()
                at = [k for k, t in enumerate(texts) if t is not None]
                if at and model is not None:
                    p = model.text_probabilities([texts[k] for k in at])
                    best = p.argmax(axis=1)
                    found[np.array(at) + a], scores[np.array(at) + a] = names[best], np.clip(p[np.arange(len(at)), best], 0, 1)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"])

    shape = plain.select("id", "lang_pred", "score").schema
    return plain.select("id", "text").mapInArrow(label, shape).select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
