"""Document quality by a byte-level convolutional network, trained in numpy.

The input of each byte is its value and whether the four bytes from it on occurred within the 24
bytes before. Filters of six bytes slide over the whole text; a chunk of 256 bytes, which overlaps
the chunks before and behind it by half, keeps the strongest answer of each filter. The chunks of a
document, all of them, are combined into the mean and the maximum of what they kept, and a logistic
layer makes one probability of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.learning import Adam, labelled_sample, platt, sample_features, sigmoid, text_column, with_last
from tallyworks.llm.shared import ship
from tallyworks.llm.words import chunks, text_bytes

WIDTH = 6
FILTERS = 12
HALF_CHUNK = 128
REACH = 24
SAMPLE_ROWS = 6_000
LONGEST_SAMPLE = 400_000
LEAK = 0.1
LEAST_STEPS = 400
_PART_BYTES = 1 << 16


def byte_inputs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Input numbers below 512 (byte, repeated or not) of all texts, each with ``WIDTH`` zero bytes behind; and where each begins and the last ends."""
    data = np.frombuffer(b"".join((t or b"") + b"\0" * WIDTH for t in texts), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(t or b"") + WIDTH for t in texts], dtype=np.int64)])
    repeated = np.zeros(len(data), dtype=bool)
    if len(data) > REACH + 4:
        four = np.zeros(len(data), dtype=np.uint32)
        for j in range(4):
            four[: len(data) - 3] |= data[j : len(data) - 3 + j].astype(np.uint32) << np.uint32(8 * j)
        for lag in range(2, REACH + 1):
            repeated[lag:] |= four[lag:] == four[:-lag]
        for j in range(REACH):  # near its start a text looks back to its own bytes only
            at = begins[:-1] + j
            at = at[at < begins[1:]]
            repeated[at] = False
            for lag in range(2, j + 1):
                repeated[at] |= four[at] == four[at - lag]
        repeated &= data != 0
    return data.astype(np.uint16) + repeated.astype(np.uint16) * np.uint16(256), begins


def _blocks(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the half chunks of all texts begin, and how many each text has."""
    lengths = np.diff(begins)
    n = np.maximum(1, -(-(lengths - WIDTH) // HALF_CHUNK))
    first = np.cumsum(n) - n
    inner = np.arange(int(n.sum())) - np.repeat(first, n)
    return np.repeat(begins[:-1], n) + inner * HALF_CHUNK, n


@dataclass
class QualityModel:
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    offset: float = 0.0

    def answers(self, inputs: np.ndarray) -> np.ndarray:
        """Each filter's answer at each place; places past the end see zero bytes."""
        padded = np.concatenate([inputs, np.zeros(WIDTH, np.uint16)])
        n = len(inputs)
        out = self.weights["t"][0][padded[:n]]
        for j in range(1, WIDTH):
            out += self.weights["t"][j][padded[j : n + j]]
        return out

    def half_chunks(self, inputs: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strongest answers of every half chunk; worked through in parts of bounded size."""
        starts, n = _blocks(begins)
        ends = np.append(starts[1:], begins[-1])
        ends[np.cumsum(n) - 1] -= WIDTH - 1  # from there on a filter would see the next text
        out, at = [], 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _PART_BYTES, side="right")))
            low, high = int(starts[at]), int(ends[stop - 1])
            part = self.answers(inputs[low : high + WIDTH])
            bounds = np.stack([starts[at:stop], ends[at:stop]], axis=1).ravel() - low
            out.append(np.maximum.reduceat(part, bounds, axis=0)[::2])
            at = stop
        return np.concatenate(out) if out else np.zeros((0, FILTERS), np.float32), n

    def features(self, inputs: np.ndarray, begins: np.ndarray) -> np.ndarray:
        halves, n = self.half_chunks(inputs, begins)
        first = np.cumsum(n) - n
        chunk = halves.copy()
        inner = np.ones(len(halves), dtype=bool)
        inner[first + n - 1] = False
        at = np.flatnonzero(inner)
        chunk[at] = np.maximum(halves[at], halves[at + 1])
        # The last half chunk closes the chunk before it; alone it counts only in texts that have no other.
        weight = np.where(inner | np.repeat(n == 1, n), 1.0, 0.0).astype(np.float32)
        hidden = _leaky(chunk + self.weights["b"])
        mean = np.add.reduceat(hidden * weight[:, None], first, axis=0) / np.maximum(n - 1, 1)[:, None]
        most = np.maximum.reduceat(np.where(weight[:, None] > 0, hidden, np.float32(-1e9)), first, axis=0)
        return np.concatenate([mean, most], axis=1).astype(np.float32)

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.features(*byte_inputs(texts)) @ self.weights["v"] + self.weights["c"][0]

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        return sigmoid(self.slope * self.logits(texts).astype(np.float64) + self.offset)


def _leaky(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x, x * np.float32(LEAK))


def _gradient(model: QualityModel, text: bytes, label: int, scale: float, sums: dict[str, np.ndarray]) -> None:
    """Add one document's gradient to ``sums``: it runs back through the place each chunk's answer came from."""
    inputs, begins = byte_inputs([text])
    answers = model.answers(inputs)
    starts = np.arange(max(1, int(_blocks(begins)[1][0]) - 1)) * HALF_CHUNK
    size = 2 * HALF_CHUNK
    reach = np.minimum(starts[:, None] + np.arange(size), len(answers) - 1)
    inside = answers[reach]
    at = inside.argmax(axis=1)
    best = np.take_along_axis(inside, at[:, None, :], axis=1)[:, 0]
    place = np.take_along_axis(np.broadcast_to(reach[:, :, None], inside.shape), at[:, None, :], axis=1)[:, 0]
    raw = best + model.weights["b"]
    hidden, slope = _leaky(raw), np.where(raw > 0, 1, LEAK).astype(np.float32)
    top = hidden.argmax(axis=0)
    feature = np.concatenate([hidden.mean(axis=0), hidden[top, np.arange(FILTERS)]])
    error = np.float32((sigmoid(feature @ model.weights["v"] + model.weights["c"][0]) - label) * scale)
    sums["v"] += error * feature
    sums["c"] += error
    back = np.tile(error * model.weights["v"][:FILTERS] / len(starts), (len(starts), 1))
    back[top, np.arange(FILTERS)] += error * model.weights["v"][FILTERS:]
    back *= slope
    sums["b"] += back.sum(axis=0)
    padded = np.concatenate([inputs, np.zeros(WIDTH, np.uint16)])
    columns = np.broadcast_to(np.arange(FILTERS), place.shape)
    for j in range(WIDTH):
        np.add.at(sums["t"][j], (padded[place + j], columns), back)


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 3, seed: int = 3, batch: int = 16) -> QualityModel:
    """Fit on four fifths, calibrate on the rest. Small samples are gone through until 400 steps are made."""
    rng = np.random.default_rng(seed)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    weights = {
        "t": rng.normal(0, 0.3, (WIDTH, 512, FILTERS)).astype(np.float32),
        "b": np.zeros(FILTERS, np.float32),
        "v": (rng.normal(0, 0.1, 2 * FILTERS)).astype(np.float32),
        "c": np.array([np.log(rate / (1 - rate))], np.float32),
    }
    model, adam = QualityModel(weights), Adam(weights, 0.02)
    held = np.arange(len(texts)) % 5 == 4
    fit = np.flatnonzero(~held)
    epochs = max(epochs, -(-LEAST_STEPS * batch // max(1, len(fit)))) if len(fit) else 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for begin in range(0, len(order), batch):
            chosen = order[begin : begin + batch]
            sums = {k: np.zeros_like(v) for k, v in weights.items()}
            for i in chosen:
                _gradient(model, texts[i], int(labels[i]), 1 / len(chosen), sums)
            sums["v"] += 1e-4 * weights["v"]
            adam.step(sums)
    kept = np.flatnonzero(held)
    if len(kept):
        logits = np.concatenate([model.logits([texts[i]]) for i in kept])
        model.slope, model.offset = platt(logits, labels[kept])
    return model


def _raw_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            values = [t or b"" for t in text_bytes(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(values, pa.binary())], names=["sample_id", "label", "lang", "feature"])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, text: str = "text", doc_id: str = "doc_id") -> QualityModel:
    """Train on at most ``sample_rows`` labelled documents, whole texts; longer ones than 400,000 bytes are not trained on.

    Without a single labelled document the model gives every text a score of about one half.
    """
    ship(docs.sparkSession)
    sample = labelled_sample(labels, label, sample_rows)
    rows = sample_features(docs.filter(F.coalesce(F.octet_length(text), F.lit(0)) <= LONGEST_SAMPLE), sample, _raw_bytes, text, doc_id, None)
    return train([r[3] for r in rows], np.array([r[1] for r in rows], dtype=np.int64))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``quality_score``, the probability from 0 to 1 that a document is good.

    Whole texts are scored; null and empty texts are one chunk of nothing and get the score of that. An
    input column named ``quality_score`` gives way; all others stay. An empty table gives an empty table.
    """
    ship(docs.sparkSession)
    def score(texts: list[bytes | None]) -> pa.Array:
        return pa.array(model.scores(texts), pa.float64())

    return with_last(docs, quality_score=text_column(score, "double", text))
