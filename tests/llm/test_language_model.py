"""Language model: exact counts and base scores, a proper distribution, and a gain on held-out text."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import language_model as L

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(A_Z)) + ["\n"] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
            for (i, _), ws, h in zip(docs, words, held)]


def shape(rows):
    return [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]


@pytest.mark.parametrize("hot", [4, 1 << 16])
def test_base(spark, monkeypatch, hot):
    monkeypatch.setattr(L, "HOT", hot)
    r = random.Random(1)
    docs = [(i, " ".join(r.choice(["a", "B", "c", "Éa", "word", f"n{r.randrange(60)}"]) for _ in range(r.randrange(60)))) for i in range(60)]
    docs += [(70, None), (71, " \n"), (None, "null id"), docs[3], docs[3], (72, "x" * 5000 + " y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rid", "'a' as word")
    assert sorted(shape(L.scores(df).collect()), key=repr) == sorted(brute(docs), key=repr)


def test_no_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r = L.scores(df).collect()[0]
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score)
    assert L.scores(df.limit(0)).collect() == []


def test_layers_are_a_distribution_and_learn():
    r = np.random.default_rng(0)
    h = r.integers(0, 1 << 32, 50).astype(np.uint64)
    seq = h[(np.arange(6000) * 7) % 50]
    bucket = (seq % np.uint64(L.CLASSES * L.MEMBERS)).astype(np.int64)
    m = L.MaxEnt(np.bincount(bucket, minlength=L.CLASSES * L.MEMBERS).astype(float))
    f = L.history(seq)
    before = m.log_p(f, bucket).mean()
    m.train(f, bucket, [np.ones(m.a.shape), np.ones(m.b.shape)])
    assert m.log_p(f, bucket).mean() > before + 0.5
    every = np.arange(L.CLASSES * L.MEMBERS)
    assert abs(np.exp(m.log_p(np.repeat(f[:, 10:11], len(every), axis=1), every)).sum() - 1) < 1e-4


def test_on_the_tables(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["op9_language_model"](spark, sf).collect()
    docs = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(shape(rows)) == sorted(brute(docs))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_rounds_train_on_every_position_once(rounds):
    for i, text in enumerate([b"", b"one", b"same start here", b"same start " * 50]):
        h = L.hashes(L.tokens(text))
        parts = [L.share(text, i or None, t, rounds) for t in range(rounds)]
        got = np.concatenate([np.vstack((f, b.astype(np.uint64))) for f, b in parts], axis=1)
        want = np.vstack((L.history(h), h % np.uint64(L.CLASSES * L.MEMBERS)))
        assert sorted(map(tuple, got.T.tolist())) == sorted(map(tuple, want.T.tolist()))


def test_short_documents_train(spark):
    # documents of three tokens whose first word's hash left all of them out when a sixteenth of the positions was taken
    words = [w for w in (f"w{i}" for i in range(200)) if zlib.crc32(w.encode()) % 8 > 2][:10]
    df = spark.createDataFrame([(i, f"{words[i % 10]} next{i % 10}") for i in range(2000)], "doc_id long, text string")
    trained, start = ({r.doc_id: r.score for r in L.scores(df, rounds=k).filter("held_out").collect()} for k in (L.ROUNDS, 0))
    assert sum(trained.values()) > sum(start.values()) + 1


def test_features_of_a_batch_are_those_of_its_documents():
    texts = [b"", b"one", b"two words", b"three words here", b"some more words than three", b" \n"]
    ids = [4, None, 5, 5, 6, 7]
    for turn in range(2):
        features, buckets = L.shares(texts, ids, turn, 2)
        parts = [L.share(t, i, turn, 2) for t, i in zip(texts, ids)]
        assert (features == np.concatenate([f for f, _ in parts], axis=1)).all()
        assert (buckets == np.concatenate([b for _, b in parts])).all()
    h = [L.hashes(L.tokens(t)) for t in texts]
    plain = []
    for doc in h:
        padded = np.concatenate((np.zeros(3, np.uint64), doc))
        one, two, three = (padded[3 - k:len(padded) - k] for k in (1, 2, 3))
        plain.append(np.stack((L._mix(one, 1), L._mix(two, 2), L._mix(three, 3), L._mix(one ^ L._mix(two, 5), 4))))
    assert (L.histories(np.concatenate(h), [len(x) for x in h]) == np.concatenate(plain, axis=1)).all()


def test_errors_are_summed_by_row():
    r = np.random.default_rng(2)
    for rows in (1, 3, 900, 4096):  # fewer rows hold more than DEEP each
        place, error = r.integers(0, rows, (L.FEATURES, 700)), r.normal(size=(700, 32)).astype(np.float32)
        want = np.zeros((4096, 32))
        np.add.at(want, place.ravel(), np.tile(error, (L.FEATURES, 1)).astype(float))
        got = np.zeros((4096, 32))
        moved, sums = L._by_row(place, error)
        got[moved] = sums
        assert len(set(moved.tolist())) == len(moved) and np.allclose(got, want, atol=1e-3)


def test_large_logits():
    z = np.array([[1000.0, 0.0], [-1000.0, -1001.0], [0.5, 0.25]], np.float32)
    kept, _, total = L._exps(z.copy())
    want = z.astype(float) - np.logaddexp(z[:, 0].astype(float), z[:, 1])[:, None]
    assert np.allclose(kept - np.log(total)[:, None], want, atol=1e-5)
