"""Toxicity and quality: held-out accuracy, defined cases, and the parts' own properties."""

import numpy as np
import pytest

from tessera.llm import quality as Q
from tessera.llm import toxicity as X

RUN = {"toxic": X.toxicity, "quality": Q.quality}


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize("label,query,folds,held,least", [("toxic", "op1_toxicity", 5, 0, 0.85), ("quality", "op6_quality", 3, 1, 0.97)])
def test_held_out(spark, label, query, folds, held, least):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.1"
    got = E.queries()[query](spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (rows.predicted == (rows.score >= 0.5)).all() and rows.score.between(0, 1).all()
    assert (rows.held_out == rows.doc_id.map(lambda i: __import__("zlib").crc32(str(i).encode()) % folds == held)).all()
    own = rows[rows.held_out]
    assert auc(own.score.to_numpy(), own[label].to_numpy()) > least
    assert (own.predicted == own[label]).mean() > 0.95


@pytest.mark.parametrize("label", list(RUN))
def test_defined_cases(spark, label):
    docs = spark.createDataFrame([(1, "a fine text of words", 1.0), (2, None, 2.0), (3, "", 0.0), (None, "you idiot", 0.0), (4, "x " * 200000, 1.0), (4, "x " * 200000, 1.0)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        rows = RUN[label](docs, labels).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
        twice = [r.score for r in rows if r.doc_id == 4]
        assert twice[0] == twice[1]
    assert RUN[label](docs.limit(0), odd).collect() == []


def test_general_lexicon_without_labels(spark):
    docs = spark.createDataFrame([(1, "what a stupid idiot"), (2, "a calm sentence"), (3, None)], "doc_id long, text string")
    kept = X.filter_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == docs.columns


def test_label_model_finds_accuracies_and_discounts_copies():
    r = np.random.default_rng(1)
    y = r.random(6000) < 0.3
    vote = lambda right, speak: np.where(r.random(6000) < speak, np.where((r.random(6000) < right) == y, 1, -1), 0)
    good, weak = vote(0.9, 0.8), vote(0.65, 0.8)
    votes = np.column_stack((good, weak, weak, weak, vote(0.85, 0.5), vote(0.9, 1.0)))
    m = X.LabelModel().fit(votes, np.where(votes[:, -1] == 1, 0.9, 0.1))
    acc = m.accuracies(votes)
    assert abs(acc[0] - 0.9) < 0.05 and abs(acc[1] - 0.65) < 0.06
    assert ((m.posterior(votes) > 0.5) == y).mean() > ((votes[:, -1] == 1) == y).mean() + 0.01  # better than its best voter
    assert {frozenset((k, p)) for k, p in enumerate(m.parent) if p >= 0} & {frozenset((1, 2)), frozenset((2, 3)), frozenset((1, 3))}


def test_machine_equals_all_pairs():
    m = Q.FactorisationMachine()
    m.w[:] = np.random.default_rng(0).normal(size=len(m.w))
    at, x = Q.inputs("Some words, SOME marks!! and 12 digits".encode())
    pairs = sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert abs(m.raw(at, x)[0] - (m.w[at] @ x + pairs)) < 1e-9
