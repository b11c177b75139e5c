"""LM scoring (op9): a hashed maximum-entropy model over words.

A word's hash gives one of CLASSES classes and one of MEMBERS members of it.
The model is P(class | history) * P(member | class, history) * P(word | bucket):
two softmax layers over hashed features of the history (the words one, two and
three back, the last two together; the second layer's are hashed with the
class), and in a bucket add-one counts of its words. All layers start at the
corpus counts, so the untrained model is the unigram one.

Counts and training cover every position of every training document. Training
makes ``rounds`` passes; in a pass each task takes gradient steps over its own
documents (every ``rounds``-th position of each, from a hash of its doc_id on,
another residue each round: all rounds together take each position once), and
the tasks' updates, weighted by their positions, are averaged block by block into
the next model. The model's size is fixed. Scoring is one pass in numpy
batches; counts of the most frequent ``HOT`` words (each ``HOT_BYTES`` at most)
are broadcast with the model, the others are joined by word.

Defined cases: a null text is the empty text, which is one end token; with no
training document N = V = 0 and all words are unknown; a null doc_id's fold is
that of the empty text; repeated rows count and are scored each; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import fold, in_small_batches, pieces, stage, texts, utf8

FOLDS, HELD = 7, 2
CLASSES, MEMBERS = 32, 32
CLASS_ROWS, MEMBER_ROWS, FEATURES = 1 << 11, 1 << 12, 4
HOT, HOT_BYTES = 1 << 16, 64
ROUNDS = 2
END = b"\n"  # no word holds a line end
BLOCKS = 16
DEEP = 64


def tokens(text: bytes) -> list[bytes]:
    out: list[bytes] = []
    for p in pieces(text):
        out += p.lower().split()
    out.append(END)
    return out


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def history(h: np.ndarray, first: int = 0, every: int = 1) -> np.ndarray:
    """(FEATURES, tokens) hashes of what stands before each token, or every
    ``every``-th, of a document."""
    return histories(h, [len(h)], np.arange(first, len(h), every))


def histories(h: np.ndarray, sizes: list[int], at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The features of the tokens ``at`` of documents of ``sizes`` tokens each,
    whose hashes stand one after another in ``h``."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    back = []
    for k in (1, 2, 3):
        x = np.concatenate((np.zeros(min(k, len(h)), np.uint64), h[:-k]))
        for j in range(k):  # the first k tokens of each document have nothing k back
            x[(starts + j)[starts + j < ends]] = 0
        back.append(x[at])
    one, two, three = back
    return np.stack((_mix(one, 1), _mix(two, 2), _mix(three, 3), _mix(one ^ _mix(two, 5), 4)))


def _exps(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(z, exp(z), their sums by row) for logits, which only lose each row's
    largest first where exponentials could run over or under."""
    if not (z.max(initial=0) < 60 and z.min(initial=0) > -60):
        z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return z, e, np.einsum("ij->i", e)


def _by_row(place: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, sums): the errors of the tokens added up by the row each feature
    has its place in; the first of every row, the second of those that have
    one and so on, and what few rows hold beyond ``DEEP`` in one go."""
    flat = place.ravel().astype(np.uint16)  # there are fewer rows than 2^16
    order = np.argsort(flat, kind="stable")  # a radix sort
    counts = np.bincount(flat)
    rows = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
    begin = (np.cumsum(counts) - counts)[rows]
    counts, order = counts[rows], order % len(error)
    having = len(rows) - np.cumsum(np.bincount(counts, minlength=DEEP + 1))  # rows of more than k
    sums = error.take(order[begin], axis=0)
    for k in range(1, min(DEEP, counts[0])):
        sums[:having[k]] += error.take(order[begin[:having[k]] + k], axis=0)
    for r in range(having[DEEP]):
        sums[r] += error.take(order[begin[r] + DEEP:begin[r] + counts[r]], axis=0).sum(axis=0)
    return rows, sums


class MaxEnt:
    """The two softmax layers; ``bucket`` = hash mod CLASSES * MEMBERS."""

    def __init__(self, bucket_counts: np.ndarray):
        c = bucket_counts.reshape(CLASSES, MEMBERS) + 0.5
        self.bias = np.log(c.sum(1) / c.sum()).astype(np.float32)
        self.inner = np.log(c / c.sum(1, keepdims=True)).astype(np.float32)
        self.a = np.zeros((CLASS_ROWS, CLASSES), np.float32)
        self.b = np.zeros((MEMBER_ROWS, MEMBERS), np.float32)

    def _places(self, f: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = (f & np.uint64(CLASS_ROWS - 1)).view(np.int64)  # the sizes are powers of two
        inner = _mix(f ^ (cls.astype(np.uint64) << np.uint64(40)), 9) & np.uint64(MEMBER_ROWS - 1)
        return rows, inner.view(np.int64)

    def _layers(self, rows, inner, cls):
        p, q = self.bias + self.a.take(rows[0], axis=0), self.inner.take(cls, axis=0)
        for k in range(FEATURES):
            if k:
                p += self.a.take(rows[k], axis=0)
            q += self.b.take(inner[k], axis=0)
        return _exps(p), _exps(q)

    def log_p(self, f: np.ndarray, bucket: np.ndarray, size: int = 2048) -> np.ndarray:
        """Natural log of P(bucket | history) for each token."""
        out = np.empty(len(bucket))
        for k in range(0, len(bucket), size):
            cls, member = bucket[k:k + size] // MEMBERS, bucket[k:k + size] % MEMBERS
            at = np.arange(len(cls))
            (p, _, p_sum), (q, _, q_sum) = self._layers(*self._places(f[:, k:k + size], cls), cls)
            out[k:k + size] = p[at, cls] - np.log(p_sum) + q[at, member] - np.log(q_sum)
        return out

    def train(self, f: np.ndarray, bucket: np.ndarray, past: list[np.ndarray], rate: float = 0.1, size: int = 2048) -> None:
        """Gradient steps over the tokens; ``past`` scales each weight's step
        by its own gradients so far. Only rows that hold a feature of the step move."""
        for k in range(0, len(bucket), size):
            cls, member = bucket[k:k + size] // MEMBERS, bucket[k:k + size] % MEMBERS
            at = np.arange(len(cls))
            rows, inner = self._places(f[:, k:k + size], cls)
            p, q = self._layers(rows, inner, cls)
            for w, g, place, (_, error, total), hit in ((self.a, past[0], rows, p, cls), (self.b, past[1], inner, q, member)):
                error /= total[:, None]
                error[at, hit] -= 1
                moved, step = _by_row(place, error)
                squares = g.take(moved, axis=0)
                squares += step * step
                g[moved] = squares
                step *= rate
                step /= np.sqrt(squares, out=squares)
                w[moved] -= step


def _training_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the training documents, the end token included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return out
        for b in batches:
            for t in utf8(b.column("text")):
                for p in pieces(t):
                    seen.update(p.lower().split())
                    if len(seen) > 300_000:
                        yield flush()
                seen[END] += 1
        if seen:
            yield flush()

    train = docs.filter("not held_out").select("text")
    return train.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def share(text: bytes, doc_id: int | None, turn: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, buckets) of the positions of a document that a round trains on."""
    return shares([text], [doc_id], turn, rounds)


def shares(texts: list[bytes], doc_ids: list[int | None], turn: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of several documents, one after another."""
    parts = [hashes(tokens(t)) for t in texts]
    h, sizes = np.concatenate(parts), [len(p) for p in parts]
    first = [(turn + zlib.crc32(str(i).encode())) % rounds for i in doc_ids]
    starts = np.cumsum(sizes) - sizes
    at = np.flatnonzero((np.arange(len(h)) - np.repeat(starts + first, sizes)) % rounds == 0)
    return histories(h, sizes, at), (h[at] % np.uint64(CLASSES * MEMBERS)).astype(np.int64)


def _round(docs: DataFrame, model: MaxEnt, turn: int, rounds: int) -> MaxEnt:
    """One pass of distributed gradient updates."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    sizes = np.array([model.a.size, model.b.size])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = MaxEnt(np.zeros(CLASSES * MEMBERS))
        own.__dict__ |= {k: v.copy() for k, v in shared.value.__dict__.items()}
        past, n = [np.ones(own.a.shape, np.float32), np.ones(own.b.shape, np.float32)], 0
        for b in batches:
            if b.num_rows:
                features, bucket = shares(utf8(b.column("text")), b.column("doc_id").to_pylist(), turn, rounds)
                own.train(features, bucket, past)
                n += len(bucket)
        if n:
            moved = np.concatenate(((own.a - shared.value.a).ravel(), (own.b - shared.value.b).ravel()))
            cut = np.array_split(moved, BLOCKS)
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([n] * BLOCKS, pa.int64()),
                                              pa.array([zlib.compress(c.astype(np.float16).tobytes(), 1) for c in cut], pa.binary())], names=["block", "n", "moved"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            for k, n, c in zip(*(b.column(x).to_pylist() for x in ("block", "n", "moved"))):
                now = total.setdefault(k, [0, 0.0])
                now[0] += n
                now[1] = now[1] + n * np.frombuffer(zlib.decompress(c), np.float16).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([(s / n).tobytes() for n, s in total.values()], pa.binary())], names=["block", "moved"])

    rows = (docs.filter("not held_out").select("doc_id", "text").mapInArrow(learn, "block int, n long, moved binary")
            .repartition(BLOCKS, "block").mapInArrow(average, "block int, moved binary").collect())
    if rows:
        moved = np.concatenate([np.frombuffer(r.moved) for r in sorted(rows, key=lambda r: r.block)]).astype(np.float32)
        model.a = model.a + moved[:sizes[0]].reshape(model.a.shape)
        model.b = model.b + moved[sizes[0]:].reshape(model.b.shape)
    return model


def scores(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = documents.sparkSession
    in_small_batches(spark)
    docs = texts(documents).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD)
    counts = stage(_training_counts(docs), "lm-counts")
    bucket = F.pmod(F.crc32("word"), F.lit(CLASSES * MEMBERS)).cast("int")
    rows = counts.groupBy(bucket.alias("bucket")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    c, v = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    for r in rows:
        c[r.bucket], v[r.bucket] = r.c, r.v
    n, distinct = int(c.sum()), int(v.sum())
    model = MaxEnt(c)
    for turn in range(rounds):
        model = _round(docs, model, turn, rounds)
    hot = {bytes(r.word): r.c for r in counts.filter(F.octet_length("word") <= HOT_BYTES).orderBy(F.desc("c"), "word").limit(HOT).collect()}
    shared = spark.sparkContext.broadcast((model, np.log10(c + v + 1), {w: k for k, w in enumerate(hot)}, np.log10(np.array([*hot.values(), 0]) + 1)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, within, hot, log_c = shared.value
        names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "counted", "bucket_score", "words", "times"]
        rid = TaskContext.get().partitionId() << 33
        for b in batches:
            sizes, known, counted, hashed, words, times = [], [], [], [], [], []
            for t in utf8(b.column("text")):
                w = tokens(t)
                h = hashes(w)
                sizes.append(len(w))
                hashed.append(h)
                at = np.fromiter(map(hot.get, w, repeat(-1)), np.int64, len(w))
                rare = Counter(map(w.__getitem__, np.flatnonzero(at < 0).tolist()))
                known.append(len(w) - rare.total())
                counted.append(float(log_c[at[at >= 0]].sum()))
                words.append(list(rare))
                times.append(list(rare.values()))
            if not sizes:
                continue
            h = np.concatenate(hashed)
            bucket = (h % np.uint64(CLASSES * MEMBERS)).astype(np.int64)
            each = model.log_p(histories(h, sizes), bucket) / np.log(10) - within[bucket]
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(rid, rid + len(sizes)), pa.int64()), b.column("doc_id"), b.column("held_out"), pa.array(sizes, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(counted, pa.float64()), pa.array(np.add.reduceat(each, first), pa.float64()),
                 pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))], names=names)
            rid += len(sizes)

    # staged: a row's id is made in the task that writes it, with its words
    rows = stage(docs.mapInArrow(score, "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, counted double, "
                                        "bucket_score double, words array<binary>, times array<long>"), "lm-scored")
    rare = (rows.select("rid", F.explode(F.arrays_zip("words", "times")).alias("x"))
            .select("rid", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
            .join(counts, "word")
            .groupBy("rid").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more")))
    more, known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return rows.drop("words", "times").join(rare, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * float(np.log10(n + distinct + 1))).alias("base_score"),
        (F.col("counted") + more + F.col("bucket_score")).alias("score"))
