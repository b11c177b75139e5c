"""Quality classifier (op6): a factorisation machine.

Inputs of a text: its distinct words, hashed to ``BUCKETS``; structure
statistics (lengths, shares of marks, capitals, digits, repeated words and
lines), each as one of ``STEPS`` steps of its range; and as metadata the
length in characters and bytes. Each input i has a weight and a vector of
``RANK`` numbers, and pairs add the product of their vectors; the sum over
all pairs comes in linear time from the square of the sum less the sum of
squares. A text's words share a total weight of one, so long and short texts
are on one scale. Labels, lang, source and doc_id are no inputs.

Trained in numpy on at most ``fit_rows`` labelled rows outside the held-out
fold; the model is 2^14 vectors, whatever the corpus.

Defined cases: null and empty texts have no words and lowest statistics, and
are scored like any other; without training rows every score is 0.5; repeated
rows are scored alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .base import Memo, fold, held, in_small_batches, pieces, texts, utf8
from .labelled import collect, sample

FOLDS, HELD = 3, 1
FIT_ROWS, BUCKETS, STEPS, RANK = 8000, 1 << 14, 12, 8
STATISTICS = 14


def structure(text: bytes, words: Counter) -> np.ndarray:
    """Statistics of a text, each between 0 and 1."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    size, total = max(1, len(text)), sum(words.values())
    letters = max(1, int(n[65:91].sum() + n[97:123].sum()))
    chars = int(n.sum() - n[128:192].sum())
    lines = text.split(b"\n")
    marks = int(n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum())
    top = max(words.values(), default=0)
    scale = lambda x, most: min(1.0, np.log1p(x) / np.log(most))
    return np.array([
        scale(chars, 1e6), scale(len(text), 1e6), scale(total, 1e5), scale(chars / max(1, total), 100),
        marks / size, int(n[35:39].sum() + n[42]) / size, int(n[124]) / size, int(n[33]) / size,
        int(n[65:91].sum()) / letters, int(n[48:58].sum()) / size, len(words) / max(1, total), top / max(1, total),
        1 - len(set(lines)) / len(lines), scale(len(text) / len(lines), 1e5)])


def inputs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, their values) of a text."""
    words: Counter = Counter()
    for p in pieces(text):
        words.update(p.lower().split())
    at = np.unique(np.fromiter(map(held("buckets", lambda: Memo(lambda w: xxh32_intdigest(w) % BUCKETS, longest=64)).__getitem__, words), np.int64, len(words)))
    steps = np.minimum((np.sqrt(structure(text, words)) * STEPS).astype(np.int64), STEPS - 1)
    return (np.concatenate((at, BUCKETS + STEPS * np.arange(STATISTICS) + steps)),
            np.concatenate((np.full(len(at), 1 / max(1, len(at)) ** 0.5), np.ones(STATISTICS))))


class FactorisationMachine:
    def __init__(self, size: int = BUCKETS + STATISTICS * STEPS, rank: int = RANK, seed: int = 6):
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (size, rank))

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        vx = self.v[at] * x[:, None]
        total = vx.sum(0)
        return self.bias + self.w[at] @ x + 0.5 * (total @ total - (vx * vx).sum()), total

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*inputs(text))[0], -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, passes: int = 4, rate: float = 0.1,
            penalty: float = 1e-5, seed: int = 6) -> "FactorisationMachine":
        """Stochastic gradient steps, each weight's scaled by its own history;
        both labels weigh the same in total."""
        if not len(rows):
            return self
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3)).clip(0, 5)
        past_w, past_v, past_b = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        order = np.random.default_rng(seed)
        for _ in range(passes):
            for i in order.permutation(len(rows)).tolist():
                at, x = rows[i]
                z, total = self.raw(at, x)
                error = weight[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i])
                gw = error * x + penalty * self.w[at]
                gv = error * (x[:, None] * total - self.v[at] * (x * x)[:, None]) + penalty * self.v[at]
                past_w[at] += gw * gw
                past_v[at] += gv * gv
                past_b += error * error
                self.w[at] -= rate * gw / np.sqrt(past_w[at])
                self.v[at] -= rate * gv / np.sqrt(past_v[at])
                self.bias -= rate * error / past_b ** 0.5
        return self


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [inputs(t) for t in utf8(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([a.astype(np.int32).tobytes() for a, _ in rows], pa.binary())], names=["doc_id", "y", "at"])


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> FactorisationMachine:
    in_small_batches(documents.sparkSession)
    got = collect(sample(documents, labels, "quality", FOLDS, HELD, fit_rows), _features, "doc_id long, y int, at binary")
    rows = []
    for at in got["at"]:
        at = np.frombuffer(at, np.int32).astype(np.int64)
        n = len(at) - STATISTICS
        rows.append((at, np.concatenate((np.full(n, 1 / max(1, n) ** 0.5), np.ones(STATISTICS)))))
    return FactorisationMachine().fit(rows, got["y"].to_numpy(np.int64).clip(0, 1))


def quality(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, fit_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([shared.value.score(t) for t in utf8(b.column("text"))], pa.float64())], names=["doc_id", "score"])

    out = texts(documents).mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
