"""What both trained classifiers share: a bounded labelled sample, optimisers, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import release
from tallyworks.llm.words import chunks, text_bytes


def labelled_sample(labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled documents, ``sample_id, label``, chosen by a hash of the id; the same every time.

    Rows without an id or a label are left out; of several labels of one id the largest counts. Only
    ids and labels are looked at to choose.
    """
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("sample_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = known.orderBy(F.xxhash64("sample_id"), "sample_id").limit(rows).collect()
    return labels.sparkSession.createDataFrame([(r["sample_id"], r["label"]) for r in chosen], "sample_id long, label int")


def sample_features(docs: DataFrame, sample: DataFrame, feature: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], text: str, doc_id: str, lang: str | None) -> list[tuple]:
    """``(id, label, language, feature bytes)`` of the sampled documents in id order; the sample bounds the join and the result."""
    language = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    known = docs.select(F.col(doc_id).alias("sample_id"), language.alias("lang"), F.col(text).alias("text"))
    rows = known.join(F.broadcast(sample), "sample_id").select("sample_id", "label", "lang", "text")
    made = rows.mapInArrow(afresh(feature), "sample_id long, label int, lang string, feature binary")
    return sorted(((r[0], r[1], r[2], bytes(r[3])) for r in made.collect()), key=lambda r: (r[0], r[3]))


def afresh(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``step``, but its worker first gives up what it kept for other steps."""

    def run(batches: Iterator) -> Iterator:
        release()
        yield from step(batches)

    return run


def text_column(answer: Callable[[list[bytes | None]], pa.Array], kind: str, text: str) -> Column:
    """A column made from whole texts by ``answer``; only it comes back from Python, a part of bounded size at a time."""

    @F.arrow_udf(kind)
    def answered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            parts = [answer(text_bytes(part.column(0))) for part in chunks(pa.record_batch([batch], names=["text"]), "text")]
            yield pa.concat_arrays(parts) if parts else answer([])
            release()

    return answered(F.col(text).cast("string"))


def with_last(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with new columns behind the others; input columns of their names give way."""
    new = {name.lower() for name in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new], *[c.alias(n) for n, c in columns.items()])


class Adam:
    """Adam over a dict of arrays, changed in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.turn = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for name, g in gradients.items():
            self.mean[name] = 0.9 * self.mean[name] + 0.1 * g
            self.square[name] = 0.999 * self.square[name] + 0.001 * g * g
            scale = np.sqrt(self.square[name] / (1 - 0.999**self.turn)) + 1e-8
            self.weights[name] -= (self.rate * (self.mean[name] / (1 - 0.9**self.turn)) / scale).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (0.1 to 4) and offset that make the logits probabilities: damped Newton steps with a prior on (1, 0)."""
    a, b = 1.0, 0.0
    if len(set(labels.tolist())) < 2:
        return a, b
    x = np.stack([logits, np.ones_like(logits)], axis=1).astype(np.float64)
    for _ in range(100):
        p = sigmoid(x @ np.array([a, b]))
        gradient = x.T @ (p - labels) + np.array([a - 1.0, b])
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.clip(np.linalg.solve(curve, gradient), -0.25, 0.25)
        a, b = float(np.clip(a - step[0], 0.1, 4.0)), float(np.clip(b - step[1], -10, 10))
        if np.abs(step).max() < 1e-6:
            break
    return a, b


def best_threshold(scores: np.ndarray, labels: np.ndarray, otherwise: float) -> float:
    """The threshold with the highest F1, halfway to the next lower score; ``otherwise`` without both labels."""
    if labels.sum() < 3 or labels.sum() == len(labels):
        return otherwise
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(labels) + 1) + labels.sum())
    ordered = scores[order]
    at = int(np.argmax(f1))
    below = ordered[at + 1] if at + 1 < len(ordered) else 0.0
    return float((ordered[at] + below) / 2)


def held_out(doc_id: str, parts: int, left: int) -> Column:
    """Whether crc32 of the id as text leaves ``left`` when divided by ``parts``."""
    return F.crc32(F.col(doc_id).cast("string")) % parts == left
