"""Toxicity (op1) by weak supervision.

Voters say toxic (1), clean (-1) or nothing (0) of a text: lexicons (a general
one, and terms mined from labelled training rows, dealt to ``LEXICONS``
voters), patterns (shouting, repeated marks, address in the second person next
to a lexicon term) and counts. Terms are words and word beginnings, so that
inflected and compounded forms of a stem are met. The training labels are one
more voter, right most of the time.

A generative model explains all votes by one hidden label: each voter has a
table of votes given the label (its accuracy and how often it abstains), and
correlated voters are tied by a tree of conditional mutual information, so
that a pair that always votes together counts about once. EM fits it; its
posteriors train a linear classifier on votes and term presence, which scores
every document. Neither labels nor lang, source or doc_id is an input.

Bounds: ``fit_rows`` labelled rows and ``TERMS`` terms, whatever the corpus.

Defined cases: null and empty texts have no term and get the score of a text
that nobody calls toxic; without positive training labels, mined lexicons are
empty and the general lexicon decides; repeated rows are scored alike; an
empty table gives no row; other columns are ignored (``filter_toxic`` keeps them).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .base import Memo, fold, in_small_batches, let_go, pieces, texts, tidy, utf8
from .labelled import collect, sample

#: A general lexicon of insults.
GENERAL = ("asshole bastard bitch clown cretin disgusting dumbass filth fool freak garbage idiot imbecile "
           "jerk loser moron pathetic pig scum stupid trash vermin worthless").split()
FOLDS, HELD = 5, 0
FIT_ROWS, TERMS, LEXICONS = 8000, 1500, 12
_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")
_YOU = re.compile(rb"\b(you|your|du|dein|tu|vous|usted|eres)\b", re.I)
_MARKS = re.compile(rb"[!?]{2,}")


def terms(word: bytes) -> list[bytes]:
    """The word and its beginnings of 4 to 8 characters."""
    w = word.decode("utf-8", "ignore")
    return [word, *(w[:k].encode() + b"*" for k in range(4, 9) if len(w) >= k)]


def distinct_words(text: bytes) -> set[bytes]:
    found: set[bytes] = set()
    for p in pieces(text):
        found.update(_WORD.findall(p.lower()))
    return found


def signs(text: bytes) -> tuple[float, float, float]:
    """(share of capitals among ASCII letters, repeated marks a word, second person)."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=128) if text else np.zeros(128, np.int64)
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    marks = len(_MARKS.findall(text)) if n[33] + n[63] > 1 else 0
    return upper / max(1, upper + lower), marks / max(1, int(n[32]) + 1), float(bool(_YOU.search(text)))


def shares(rows: list[bytes]) -> list[float]:
    """A row's weight among its near copies: one over the number of rows whose
    least word hash is the same, so that a family of copies counts as one."""
    least = [min(map(xxh64_intdigest, r.split()), default=-1) for r in rows]
    many = Counter(least)
    return [1 / many[x] for x in least]


def mine(rows: list[bytes], y: np.ndarray, most: int = TERMS) -> list[tuple[bytes, float]]:
    """Terms that toxic training rows (distinct words, space-joined) have far
    more often than others, counted by families: in ``least`` toxic ones and,
    smoothed, at 20 times the rate of clean ones. Clean rows are only asked
    about the terms that toxic ones have often enough."""
    weight, n, seen = shares(rows), [0.0, 0.0], (Counter(), Counter())
    for label in (1, 0):
        least = max(2.5, 0.01 * n[1])
        asked = {t for t, c in seen[1].items() if c >= least}
        of = Memo(lambda w: tuple(t for t in terms(w) if t in asked), 50_000)
        for words, own, x in zip(rows, y.tolist(), weight):
            if own == label:
                n[label] += x
                for t in {t for w in words.split() for t in (terms(w) if label else of[w])}:
                    seen[label][t] += x
    rate = {t: np.log(((seen[1][t] + 0.5) / (n[1] + 1)) / ((seen[0][t] + 0.5) / (n[0] + 1))) for t in asked}
    good = [(t, float(r)) for t, r in rate.items() if r > np.log(20) and seen[0][t] <= 0.1 * seen[1][t]]
    return sorted(good, key=lambda x: (-seen[1][x[0]] * x[1], x[0]))[:most]


class Voters:
    """Votes of a text from its distinct words and signs."""

    NAMES = ["general", *(f"lexicon{k}" for k in range(LEXICONS)), "several", "many", "dense", "none", "addressed", "shouting", "marks"]

    def __init__(self, mined: list[tuple[bytes, float]]):
        self.index = {t: k for k, (t, _) in enumerate(mined)}
        self.general = {w.encode() for w in GENERAL}
        # a word's mined terms, and whether the general lexicon has it
        self.of = Memo(lambda w: (tuple(self.index[t] for t in terms(w) if t in self.index), w in self.general), 100_000, longest=64)

    def __getstate__(self):
        return {"index": self.index, "general": self.general}

    def __setstate__(self, state):
        self.__init__([(t, 0.0) for t in state["index"]])

    def __call__(self, words: set[bytes], sign: tuple[float, float, float]) -> tuple[list[int], np.ndarray]:
        hits, hit_words, general = set(), 0, 0
        for found, known in map(self.of.__getitem__, words):
            if found or known:
                hits.update(found)
                hit_words += 1
                general += known
        votes = [1 if general else 0] + [0] * LEXICONS
        for t in hits:
            votes[1 + t % LEXICONS] = 1
        votes += [1 if hit_words >= 2 else 0, 1 if hit_words >= 4 else 0, 1 if hit_words >= 0.01 * len(words) > 0 else 0, 0 if hit_words else -1,
                  1 if hit_words and sign[2] else 0, 1 if sign[0] > 0.5 else 0, 1 if sign[1] > 0.1 else 0]
        return votes, np.fromiter(hits, np.int64, len(hits))


class LabelModel:
    """P(votes | label) as a tree over voters for each label, fitted by EM."""

    def __init__(self, rounds: int = 30, smooth: float = 0.5, backing: float = 5.0):
        self.rounds, self.smooth, self.backing = rounds, smooth, backing

    @staticmethod
    def _tree(v: np.ndarray, q: np.ndarray) -> list[int]:
        """Parent of each voter in the maximum spanning tree of mutual
        information given the label (Prim's algorithm)."""
        j = v.shape[1]
        info = np.zeros((j, j))
        for weight in (q, 1 - q):
            total = weight.sum() + 1e-9
            one = np.stack([((v == a) * weight[:, None]).sum(0) / total for a in (-1, 0, 1)])
            for a in range(3):
                for b in range(3):
                    both = ((v == a - 1) * weight[:, None]).T @ (v == b - 1) / total
                    info += total * both * np.log((both + 1e-12) / (one[a][:, None] * one[b][None, :] + 1e-12))
        parent, best, via = [-1] * j, np.full(j, -np.inf), np.zeros(j, int)
        left = set(range(1, j))
        best, via = info[0].copy(), np.zeros(j, int)
        while left:
            k = max(left, key=lambda i: (best[i], -i))
            left.remove(k)
            parent[k] = int(via[k])
            closer = info[k] > best
            best[closer], via[closer] = info[k][closer], k
        return parent

    def _log(self, v: np.ndarray) -> np.ndarray:
        out = np.tile(np.log(self.prior), (len(v), 1))
        for k, p in enumerate(self.parent):
            out += self.table[k][:, (v[:, p] + 1) if p >= 0 else 0, v[:, k] + 1].T
        return out

    def fit(self, v: np.ndarray, start: np.ndarray) -> "LabelModel":
        """``start``: first guess of P(toxic). The last voter, the training
        labels, stands outside the tree. A voter's table given its parent backs
        off to its table alone where a parent's vote is rare."""
        q = start.astype(float)
        for r in range(self.rounds):
            if r in (0, 5):
                self.parent = [*self._tree(v[:, :-1], q), -1]
            self.prior = np.array([1 - q.mean(), q.mean()]).clip(1e-4, 1)
            self.table = np.zeros((v.shape[1], 2, 3, 3))
            for k, p in enumerate(self.parent):
                for label, weight in enumerate((1 - q, q)):
                    flat = 3 * ((v[:, p] + 1) if p >= 0 else 0) + v[:, k] + 1
                    count = np.bincount(flat, weight, 9).reshape(3, 3)
                    alone = count.sum(0) + self.smooth
                    count = count + (self.backing * alone / alone.sum() if p >= 0 else self.smooth)
                    self.table[k, label] = np.log(count / count.sum(1, keepdims=True))
            q = self.posterior(v)
        return self

    def posterior(self, v: np.ndarray) -> np.ndarray:
        log = self._log(v)
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))

    def accuracies(self, v: np.ndarray) -> np.ndarray:
        """Of each voter, how often a vote agrees with the label."""
        q = self.posterior(v)
        right = ((v == 1) * q[:, None] + (v == -1) * (1 - q)[:, None]).sum(0)
        return right / np.maximum((v != 0).sum(0), 1)


def train_linear(x: list[np.ndarray], dim: int, q: np.ndarray, passes: int = 400, rate: float = 0.05,
                 penalty: float = 1e-4) -> np.ndarray:
    """Logistic regression on sparse 0/1 rows with soft labels, by full-batch
    steps with momentum, scaled by the gradients' running size. The last
    weight is the bias."""
    row = np.repeat(np.arange(len(x)), [len(r) for r in x])
    col = np.concatenate(x) if x else np.zeros(0, np.int64)
    w, mean, square = np.zeros(dim + 1), np.zeros(dim + 1), np.zeros(dim + 1)
    for k in range(1, passes + 1):
        z = np.bincount(row, w[col], len(x)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q) / max(1, len(x))
        g = np.append(np.bincount(col, error[row], dim), error.sum())
        g[:-1] += penalty * w[:-1]
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        w -= rate * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)
    return w


class ToxicityModel:
    """Voters and the linear classifier's weights: all that scoring needs."""

    def __init__(self, voters: Voters, weights: np.ndarray):
        self.voters, self.weights = voters, weights

    @staticmethod
    def columns(votes: list[int], hits: np.ndarray) -> np.ndarray:
        """Columns of a row: two for each voter (toxic, clean), one for each term."""
        v = np.array(votes)
        return np.concatenate((2 * np.flatnonzero(v == 1), 2 * np.flatnonzero(v == -1) + 1, 2 * len(v) + hits))

    def score(self, text: bytes) -> float:
        votes, hits = self.voters(distinct_words(text), signs(text))
        z = self.weights[self.columns(votes, hits)].sum() + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for b in tidy(batches):
        t = utf8(b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("y"), pa.array([b" ".join(sorted(distinct_words(x))) for x in t], pa.binary()),
             pa.array([list(signs(x)) for x in t], pa.list_(pa.float64()))], names=["doc_id", "y", "words", "signs"])


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    in_small_batches(documents.sparkSession)
    rows = collect(sample(documents, labels, "toxic", FOLDS, HELD, fit_rows), _features,
                   "doc_id long, y int, words binary, signs array<double>")
    y = rows["y"].to_numpy(np.int64).clip(0, 1)
    words = [bytes(w) for w in rows["words"]]
    mined = mine(words, y) if y.any() else []
    voters = Voters(mined)
    votes, hits = [], []
    for row, sign in zip(words, rows["signs"]):
        v, h = voters(set(row.split()), tuple(sign))
        votes.append(v)
        hits.append(h)
    if not len(y):  # nothing to learn from: one clean row, one that the general lexicon calls toxic
        votes = [voters(set(), (0, 0, 0))[0], voters({GENERAL[0].encode()}, (0, 0, 0))[0]]
        hits, y = [np.zeros(0, np.int64)] * 2, np.array([0, 1])
    v = np.array(votes)
    labelled = np.column_stack((v, np.where(y == 1, 1, -1)))
    start = np.where(y == 1, 0.9, 0.1)
    q = LabelModel().fit(labelled, start).posterior(labelled)
    x = [ToxicityModel.columns(a, h) for a, h in zip(votes, hits)]
    return ToxicityModel(voters, train_linear(x, 2 * v.shape[1] + len(mined), q))


def scored(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every document; the model's size is bounded, so it is broadcast."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in tidy(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([shared.value.score(t) for t in utf8(b.column("text"))], pa.float64())], names=["doc_id", "score"])

    return texts(documents).mapInArrow(score, "doc_id long, score double")


def toxicity(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    out = scored(documents, fit(documents, labels, fit_rows))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def filter_toxic(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents scored below 0.5, all columns kept, in one pass without a shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, fit_rows))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in tidy(batches):
            keep = [shared.value.score(t) < 0.5 for t in utf8(b.column("text").cast(pa.string()))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(clean, documents.schema)
