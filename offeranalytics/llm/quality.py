"""Quality scores by positive-unlabelled learning with the non-negative risk estimator.

A linear model on whole-text features is fitted to trusted positives and unlabelled web text. Its risk is
``prior * R+(P) + max(0, R-(U) - prior * R-(P))``: the risk on negatives is what the unlabelled risk leaves after the
positives' share, held at zero or above. The class prior is estimated from the same two samples. With the logistic
loss the model's sigmoid is the chance of label 1; its constant is then set so that the decision threshold splits
the unlabelled rows as the prior says.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut
from .langid import split_number

BUCKETS = 1024
SCALARS = 13
#: The bound of the training sample: rows drawn from the positives and from the unlabelled.
POSITIVES = 3000
UNLABELLED = 6000
BLOCK = 1 << 20
THRESHOLD = 0.3
#: Log-odds given to the benefit of the doubt, so that rare kinds of clean text stay.
MARGIN = 0.5


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs, and a few ratios; zeros for a null or empty text."""
    row = np.zeros(BUCKETS + SCALARS, np.float32)
    if not text:
        return row
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    pairs, single = np.zeros(BUCKETS), np.zeros(256)
    for at in range(0, len(raw), BLOCK):
        part = raw[at:at + BLOCK + 1].astype(np.uint32)
        pairs += np.bincount((((part[:-1] << 8 | part[1:]) * np.uint32(2654435761)) >> np.uint32(22)).astype(np.int64), minlength=BUCKETS)
        single += np.bincount(raw[at:at + BLOCK], minlength=256)
    n = len(raw)
    total = repeated = distinct = marked = 0
    for at in range(0, len(text), BLOCK):
        words = text[at:at + BLOCK].split()
        total += len(words)
        repeated += sum(map(str.__eq__, words, words[1:]))
        distinct += len(set(words))
        marked += sum(not w[-1].isalnum() for w in words)
    row[:BUCKETS] = np.sqrt(pairs / max(1, n - 1))
    share = lambda a, b: single[a:b].sum() / n
    words, lines = single[[9, 10, 13, 32]].sum() + 1, text.split("\n")
    row[BUCKETS:] = [share(65, 91), share(97, 123), share(48, 58), share(128, 256), single[[46, 44, 59, 58, 33, 63]].sum() / n,
                     share(33, 48) + share(58, 65) + share(91, 97) + share(123, 127), single[32] / n, n / words / 10,
                     len(set(lines)) / len(lines), min(1.0, np.log1p(n) / 15),
                     repeated / max(1, total), distinct / max(1, total), marked / max(1, total)]
    return row


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Adam:
    def __init__(self, size: int, rate: float):
        self.first, self.second, self.step, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def change(self, grad: np.ndarray) -> np.ndarray:
        self.step += 1
        self.first = 0.9 * self.first + 0.1 * grad
        self.second = 0.99 * self.second + 0.01 * grad * grad
        return self.rate * (self.first / (1 - 0.9**self.step)) / (np.sqrt(self.second / (1 - 0.99**self.step)) + 1e-8)


def risk(weights: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """prior * R+(P), R-(U) - prior * R-(P), and the gradient of each."""
    p, u = positive @ weights, unlabelled @ weights
    on_positive = prior * np.logaddexp(0, -p).mean()
    on_negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
    grad_positive = positive.T @ (-prior * sigmoid(-p)) / len(p)
    grad_negative = unlabelled.T @ sigmoid(u) / len(u) - prior * (positive.T @ sigmoid(p)) / len(p)
    return on_positive, on_negative, grad_positive, grad_negative


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights that minimise the non-negative risk; while the negative part is below zero a step undoes it instead."""
    weights = np.zeros(positive.shape[1])
    adam = Adam(len(weights), rate)
    for _ in range(steps):
        _, on_negative, grad_positive, grad_negative = risk(weights, positive, unlabelled, prior)
        grad = grad_positive + grad_negative if on_negative >= 0 else -grad_negative
        weights -= adam.change(grad + decay * weights)
    return weights


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.2) -> float:
    """Share of positives among the unlabelled: the smallest ratio U(S) / P(S) over sets S of high scores that
    hold at least ``least`` of the positives. Scores come from a model fitted to the other half of the rows."""
    ratios = []
    for half in (0, 1):
        p, u = positive[half::2], unlabelled[half::2]
        fit_p, fit_u = positive[1 - half::2], unlabelled[1 - half::2]
        rows, target = np.concatenate((fit_p, fit_u)), np.repeat([1.0, 0.0], [len(fit_p), len(fit_u)])
        weight = np.repeat([0.5 / max(1, len(fit_p)), 0.5 / max(1, len(fit_u))], [len(fit_p), len(fit_u)])
        weights, adam = np.zeros(rows.shape[1]), Adam(rows.shape[1], 0.05)
        for _ in range(100):
            weights -= adam.change(rows.T @ (weight * (sigmoid(rows @ weights) - target)) + 1e-3 * weights)
        a, b = np.sort(p @ weights), np.sort(u @ weights)
        cuts = np.quantile(a, np.linspace(0, 1 - least, 50))
        in_p, in_u = 1 - np.searchsorted(a, cuts) / len(a), 1 - np.searchsorted(b, cuts) / len(b)
        ratios.append(float((in_u / in_p).min()))
    return float(np.clip(np.mean(ratios), 0.02, 0.98))


class QualityModel:
    """Standardised linear score; without positives or unlabelled rows it answers 0.5 everywhere."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None):
        self.fitted = len(positive) > 3 and len(unlabelled) > 3
        if not self.fitted:
            return
        both = np.concatenate((positive, unlabelled))
        self.mean, self.scale = both.mean(axis=0), both.std(axis=0) + 0.01
        ready_p, ready_u = self._ready(positive), self._ready(unlabelled)
        self.prior = estimated_prior(ready_p, ready_u) if prior is None else prior
        self.weights = fit(ready_p, ready_u, self.prior)
        self.weights[-1] += self._shift(ready_p, ready_u)

    def _shift(self, positive: np.ndarray, unlabelled: np.ndarray) -> float:
        """Put ``THRESHOLD`` where rows the model has not seen split by the prior, but below all but 0.5 % of the
        positives: each half of the rows is scored by a model of the other half."""
        places = []
        for half in (0, 1):
            weights = fit(positive[1 - half::2], unlabelled[1 - half::2], self.prior)
            places.append(min(np.quantile(unlabelled[half::2] @ weights, 1 - self.prior), np.quantile(positive[half::2] @ weights, 0.005)))
        return float(np.log(THRESHOLD / (1 - THRESHOLD)) - np.mean(places)) + MARGIN

    def _ready(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.scale, -4, 4) * (10 / np.sqrt(rows.shape[1]))
        return np.concatenate((scaled, np.ones((len(rows), 1))), axis=1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(texts), 0.5)
        return sigmoid(self._ready(np.stack([features(t) for t in texts])) @ self.weights)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a bounded sample of trusted positives (every label of the id is 1) and of unlabelled rows.

    The sample is drawn by a hash of the id from ids alone; ids that repeat or are null are not learned from.
    """
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).count().where("count = 1").select("id")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).alias("low"), F.count(F.lit(1)).alias("n"))
    kinds = cut(ids.join(marks, "id", "left").select("id", F.when(F.col("n").isNull(), "U").when(F.col("low") == 1, "P").alias("kind")).where("kind is not null"))
    counts = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    share = lambda kind, bound: int((1 << 30) * min(1.0, bound / max(1, counts.get(kind, 0))))
    draw = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 30))
    drawn = kinds.where(draw < F.when(F.col("kind") == "P", share("P", POSITIVES)).otherwise(share("U", UNLABELLED)))
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(drawn), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["kind", "row"])

    got = sorted((r["kind"], bytes(r["row"])) for r in picked.select("kind", "text").mapInArrow(run, "kind string, row binary").collect())
    of = lambda kind: np.array([np.frombuffer(r, np.float32) for k, r in got if k == kind]).reshape(-1, BUCKETS + SCALARS)
    return of("P"), of("U")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    return QualityModel(*training_rows(docs, labels, id_col, text_col, label_col))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text", passed: tuple[str, ...] = ()) -> DataFrame:
    """The ``passed`` columns of each row with score and predicted (1 from ``threshold``). Null scores as empty."""
    kinds = dict(docs.select(*passed).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.scores(batch.column(0).slice(at, 64).to_pylist()) for at in range(0, batch.num_rows, 64)]
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))],
                                             names=[*passed, "score", "predicted"])

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in passed], "score double", "predicted int"])
    return docs.select(F.col(text_col).cast("string").alias("__text"), *passed).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, threshold: float = THRESHOLD, id_col: str = "doc_id",
            text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted. Rows of split ``held`` are never learned from."""
    model = train(docs.where(split_number(id_col, parts) != held), labels.where(split_number(id_col, parts) != held), id_col, text_col, label_col)
    rows = docs.select(F.col(id_col), F.col(text_col), (split_number(id_col, parts) == held).alias("held_out"))
    return score_quality(rows, model, threshold, text_col, (id_col, "held_out"))
