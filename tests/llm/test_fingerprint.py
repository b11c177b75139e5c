"""Fingerprints: edited texts exactly, estimates against exact sets, merging, defined cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import fingerprint as P

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(A_Z))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(n=60, seed=2):
    r = random.Random(seed)
    return [(3 * i, " ".join(r.choice(["eins", "Zwei", "drei", "é", "five", f"w{r.randrange(400)}"]) for _ in range(r.choice([0, 1, 4, 5, 30, 90, 1500])))) for i in range(n)]


@pytest.mark.parametrize("buckets", [1, 4, 50])
def test_edits_and_likeness(spark, buckets):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as bucket", "'x' as key", "2 as own", "3 as h")
    rows = {r.doc_id: r for r in P.fingerprint_edits(df, buckets=buckets).collect()}
    order = sorted(docs, reverse=True)
    assert sorted(rows) == sorted(i for i, _ in docs)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        r = rows[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for got, other in ((r.near_edited, edited), (r.near_next, following)):
            exact = jaccard(shingles(text), shingles(other))
            small = max(len(shingles(text)), len(shingles(other))) <= P.K // 2
            assert abs(got - exact) < (1e-9 if small else 0.2)
        n = len(shingles(text))
        assert abs(r.n_shingles_est - n) <= (1e-9 if n < P.K else 0.35 * n)
    assert len({r.fingerprint for r in rows.values()}) <= len({t for _, t in docs})


def test_merge_is_the_sketch_of_the_union(spark):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(900)).alias("s")).select(F.transform("s", lambda x: F.xxhash64(x)).alias("s"))
    parts = df.select(P.bottom_k(F.slice("s", 1, 500)).alias("a"), P.bottom_k(F.slice("s", 400, 501)).alias("b"), P.bottom_k(F.col("s")).alias("all"))
    assert parts.select((P.merge(F.col("a"), F.col("b")) == F.col("all")).alias("same")).first().same
    c = parts.select(P.containment(F.col("a"), F.col("all")).alias("c"), P.resemblance(F.col("a"), F.col("all")).alias("r")).first()
    assert c.c > 0.85 and abs(c.r - 500 / 900) < 0.2


def test_defined_cases(spark):
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    r = P.fingerprint_edits(one).first()
    assert (r.near_next, r.edited_sha256) == (1.0, hashlib.sha256(b"aba").hexdigest())
    odd = spark.createDataFrame([(5, None), (None, "null id text"), (4, ""), (4, ""), (9, "x " * 100000)], "doc_id long, text string")
    rows = P.fingerprint_edits(odd).collect()
    assert len(rows) == 5 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[5].n_chars == 0 and by[5].near_next == 1.0 and by[4].near_edited == 1.0
    assert P.fingerprint_edits(one.limit(0)).collect() == []
    assert P.fingerprints(odd).filter("doc_id = 9").first().n_shingles_est == 1.0
