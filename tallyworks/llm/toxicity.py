"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (letters and digits, lower case in A-Z) are hashed into 2^22 buckets. Buckets seen in three or
more training documents have an embedding, all others share one that stays zero, so single documents
are not learned by heart and a rare word seldom passes for another. Filters of one,
two and three words slide over the whole text; the strongest answer of each filter anywhere in it is
kept, and a logistic layer makes one probability of them. Embeddings start from how much more often
a word occurs in toxic training documents. A part of the sample is held back from training: on it
the probabilities are calibrated, and a threshold is set for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.learning import Adam, best_threshold, labelled_sample, platt, sample_features, sigmoid, text_column, with_last
from tallyworks.llm.shared import ship
from tallyworks.llm.words import chunks, text_bytes, words_of

BUCKET_BITS = 22
MOST_ROWS = 1 << 16
DIMENSIONS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
SAMPLE_ROWS = 12_000
LONGEST_SAMPLE = 50_000
THRESHOLD = 0.5
LEAK = 0.1
LEAST_STEPS = 300
_NEVER = np.float32(-1e9)

_PLAIN = bytearray(range(256))
for _b in range(128):
    _c = chr(_b)
    _PLAIN[_b] = ord(_c.lower()) if _c.isalnum() else 32
_PLAIN = bytes(_PLAIN)


def buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all words end to end, and the number of words of each text."""
    words = words_of([(t or b"").translate(_PLAIN) for t in texts])
    return (words.hash >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32), words.counts


@dataclass
class ToxicityModel:
    weights: dict[str, np.ndarray]
    row_of: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = THRESHOLD
    by_language: dict[str, float] = field(default_factory=dict)
    _tables: list[list[np.ndarray]] | None = None

    def tables(self) -> list[list[np.ndarray]]:
        """What each embedding row adds to each filter, by width and place in the filter."""
        if self._tables is None:
            self._tables = [[self.weights["e"] @ self.weights[f"w{w}"][j] for j in range(w)] for w in WIDTHS]
        return self._tables

    def pooled(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The strongest answer of each filter in each text; texts too short for a filter have none."""
        rows = self.row_of[words]
        out = np.full((len(counts), len(WIDTHS) * FILTERS), _NEVER, dtype=np.float32)
        ends = np.cumsum(counts)
        for k, (width, tables) in enumerate(zip(WIDTHS, self.tables(), strict=True)):
            some = np.flatnonzero(counts >= width)
            if not len(some):
                continue
            n = len(rows) - width + 1
            answers = tables[0][rows[:n]]
            for j in range(1, width):
                answers += tables[j][rows[j : n + j]]
            starts = ends - counts
            bounds = np.stack([starts[some], ends[some] - width + 1], axis=1).ravel()
            best = np.maximum.reduceat(np.concatenate([answers, np.full((1, FILTERS), _NEVER, np.float32)]), np.minimum(bounds, n), axis=0)
            out[some, k * FILTERS : (k + 1) * FILTERS] = best[::2]
        return out

    def logits(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _hidden(self.pooled(words, counts), self.weights["b"])[0] @ self.weights["v"] + self.weights["c"][0]

    def scores(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.logits(words, counts).astype(np.float64) + self.offset)

    def limit(self, language: str | None) -> float:
        return self.by_language.get(language or "", self.threshold)


def _hidden(pooled: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaky rectifier over the pooled answers, and its slope; filters with no answer give nothing."""
    raw = pooled + bias
    slope = np.where(pooled <= _NEVER / 2, 0, np.where(raw > 0, 1, LEAK)).astype(np.float32)
    return raw * slope, slope


def _vocabulary(docs: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedding row of each bucket (0: none of its own), and the start of each row's first dimension."""
    seen = np.zeros((2, 1 << BUCKET_BITS), dtype=np.int32)
    for words, label in zip(docs, labels, strict=True):
        seen[label][np.unique(words)] += 1
    often = seen.sum(axis=0)
    known = np.flatnonzero(often >= 3)
    known = np.sort(known[np.argsort(-often[known], kind="stable")][: MOST_ROWS - 1])
    row_of = np.zeros(1 << BUCKET_BITS, dtype=np.uint16)
    row_of[known] = np.arange(1, len(known) + 1)
    total = np.bincount(labels, minlength=2)
    odds = np.log((seen[1][known] + 0.5) / (total[1] + 1)) - np.log((seen[0][known] + 0.5) / (total[0] + 1))
    return row_of, np.concatenate([[0.0], odds * often[known] / (often[known] + 4) / 2])


def _initial(starts: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    total = np.bincount(labels, minlength=2)
    embedding = rng.normal(0, 0.1, (len(starts), DIMENSIONS)).astype(np.float32)
    embedding[:, 0] = starts
    embedding[0] = 0
    weights = {"e": embedding, "b": np.zeros(len(WIDTHS) * FILTERS, np.float32), "v": np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)}
    weights["c"] = np.array([np.log((total[1] + 1) / (total[0] + 1))], np.float32)
    for w in WIDTHS:
        weights[f"w{w}"] = rng.normal(0, 0.2, (w, DIMENSIONS, FILTERS)).astype(np.float32)
        weights[f"w{w}"][:, 0, :2] += 1.0 / w
    return weights


def _batch_gradient(weights: dict[str, np.ndarray], docs: list[np.ndarray], labels: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Gradients of the dense arrays, and of the embedding rows that some filter answered to most."""
    n = len(docs)
    pooled = np.full((n, len(WIDTHS) * FILTERS), _NEVER, np.float32)
    place = np.zeros((n, len(WIDTHS) * FILTERS), np.int64)
    for i, rows in enumerate(docs):
        vectors = weights["e"][rows]
        for k, w in enumerate(WIDTHS):
            m = len(rows) - w + 1
            if m < 1:
                continue
            answers = sum(vectors[j : m + j] @ weights[f"w{w}"][j] for j in range(w))
            at = answers.argmax(axis=0)
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            place[i, part], pooled[i, part] = at, answers[at, np.arange(FILTERS)]
    hidden, slope = _hidden(pooled, weights["b"])
    error = ((sigmoid(hidden @ weights["v"] + weights["c"][0]) - labels) / n).astype(np.float32)
    back = error[:, None] * weights["v"] * slope
    gradients = {"v": hidden.T @ error + 1e-4 * weights["v"], "c": np.array([error.sum()]), "b": back.sum(axis=0)}
    touched, pulls = [], []
    for k, w in enumerate(WIDTHS):
        gradients[f"w{w}"] = np.zeros_like(weights[f"w{w}"])
        part = slice(k * FILTERS, (k + 1) * FILTERS)
        doc, fil = np.nonzero(back[:, part])
        if not len(doc):
            continue
        pull, at = back[:, part][doc, fil], place[:, part][doc, fil]
        for j in range(w):
            rows = np.array([docs[d][a + j] for d, a in zip(doc, at, strict=True)], dtype=np.int64)
            np.add.at(gradients[f"w{w}"][j].T, fil, pull[:, None] * weights["e"][rows])
            touched.append(rows)
            pulls.append(pull[:, None] * weights[f"w{w}"][j].T[fil])
    none = np.zeros(0, np.int64), np.zeros((0, DIMENSIONS), np.float32)
    return gradients, np.concatenate(touched) if touched else none[0], np.concatenate(pulls) if pulls else none[1]


def train(docs: list[np.ndarray], labels: np.ndarray, languages: list[str | None], epochs: int = 4, seed: int = 5, batch: int = 32) -> ToxicityModel:
    """Fit, calibrate and set thresholds. Every fifth document is kept for the last two.

    Small samples are gone through until 300 steps are made.
    """
    labels = labels.astype(np.int64)
    held = np.arange(len(docs)) % 5 == 4
    rng = np.random.default_rng(seed)
    fit = np.flatnonzero(~held)
    row_of, starts = _vocabulary([docs[i] for i in fit], labels[fit])
    weights = _initial(starts, labels[fit], rng)
    rows_of = {int(i): row_of[docs[i]] for i in fit}
    dense = {k: v for k, v in weights.items() if k != "e"}
    adam, squares = Adam(dense, 0.003), np.full(len(starts), 1e-8, np.float32)
    epochs = max(epochs, -(-LEAST_STEPS * batch // max(1, len(fit)))) if len(fit) else 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            gradients, rows, pulls = _batch_gradient(weights, [rows_of[int(i)] for i in chosen], labels[chosen])
            adam.step(gradients)
            one, inverse = np.unique(rows, return_inverse=True)
            summed = np.zeros((len(one), DIMENSIONS), np.float32)
            np.add.at(summed, inverse, pulls)
            squares[one] += (summed**2).mean(axis=1)
            weights["e"][one] -= (one > 0)[:, None] * 0.05 * summed / np.sqrt(squares[one])[:, None]
    model = ToxicityModel(weights, row_of)
    kept = np.flatnonzero(held)
    if len(kept):
        words = np.concatenate([docs[i] for i in kept])
        counts = np.array([len(docs[i]) for i in kept])
        model.slope, model.offset = platt(model.logits(words, counts), labels[kept])
        scores = model.scores(words, counts)
        model.threshold = best_threshold(scores, labels[kept], THRESHOLD)
        names = np.array([languages[i] or "" for i in kept])
        for name in np.unique(names):
            own = names == name
            model.by_language[str(name)] = best_threshold(scores[own], labels[kept][own], model.threshold)
    model._tables = None  # half of what the model weighs, and made anew where texts are scored
    return model


def _word_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            words, counts = buckets(text_bytes(part.column("text")))
            values = [p.tobytes() for p in np.split(words, np.cumsum(counts)[:-1])] if len(counts) else []
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(values, pa.binary())], names=["sample_id", "label", "lang", "feature"])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str | None = "lang",
) -> ToxicityModel:
    """Train on at most ``sample_rows`` labelled documents, whole texts; longer ones than 50,000 words are not trained on.

    The language is used for the thresholds only. Without a single labelled document the model gives
    every text the same score.
    """
    ship(docs.sparkSession)
    sample = labelled_sample(labels, label, sample_rows)
    rows = sample_features(docs, sample, _word_buckets, text, doc_id, lang)
    rows = [r for r in rows if len(r[3]) <= 4 * LONGEST_SAMPLE]
    return train([np.frombuffer(r[3], dtype=np.uint32) for r in rows], np.array([r[1] for r in rows], dtype=np.int64), [r[2] for r in rows])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic`` (at the threshold of its language).

    Whole texts are scored, whatever their length; null and empty texts have no words and get the score
    of that. Rows without a language, or with one not seen in training, use the overall threshold. Input
    columns named like the new ones give way; all others stay. An empty table gives an empty table.
    """
    ship(docs.sparkSession)
    def score(texts: list[bytes | None]) -> pa.Array:
        return pa.array(model.scores(*buckets(texts)), pa.float64())

    scored = with_last(docs, toxicity=text_column(score, "double", text))
    limit = F.lit(model.threshold)
    if lang and model.by_language:
        limits = F.create_map(*[F.lit(x) for pair in sorted(model.by_language.items()) for x in pair])
        limit = F.coalesce(limits[F.coalesce(F.col(lang).cast("string"), F.lit(""))], limit)
    return with_last(scored, toxic=F.col("toxicity") >= limit)
