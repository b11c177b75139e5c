"""Ball index against the tile join and brute force; how much it spares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import similarity
from tessera.operators import taxonomy as TX


def _units(spark, vectors, blocks):
    rows = [(i, [float(x) for x in v], b) for i, (v, b) in enumerate(zip(vectors, blocks))]
    return TX.unit_vectors(spark.createDataFrame(rows, "id long, e array<double>, label string"), "id", "e", "label")


def _want(vectors, blocks, threshold):
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = u @ u.T
    return {(i, j) for i in range(len(u)) for j in range(i + 1, len(u)) if blocks[i] == blocks[j] and cosine[i, j] >= threshold}


@pytest.mark.parametrize("threshold", [0.95, 0.85, 0.3, -0.2])
def test_nothing_is_lost(spark, threshold):
    r = np.random.default_rng(8)
    near = r.normal(size=(8, 12))[r.integers(0, 8, 160)] + r.normal(scale=0.2, size=(160, 12))
    vectors = np.concatenate((near, r.normal(size=(60, 12)), np.repeat(r.normal(size=(1, 12)), 25, 0)))  # copies are one ball
    blocks = [str(i % 3) if i % 7 else "rare" for i in range(len(vectors))]
    u = _units(spark, vectors, blocks)
    got = {(p.id_a, p.id_b) for p in TX.similar_pairs(u, threshold, tile=10).collect()}
    assert got == _want(vectors, blocks, threshold)
    assert got == {(p.id_a, p.id_b) for p in TX.similar_pairs(u, threshold, tile=10, index="tiles").collect()}


def test_few_centres_change_no_result(spark):
    r = np.random.default_rng(9)
    vectors, blocks = r.normal(size=(120, 6)), ["a"] * 120
    u = _units(spark, vectors, blocks)
    for most in (1, 2, 5):
        got = {(p.id_a, p.id_b) for p in similarity.ball_join(u, 0.8, tile=10, most=most).collect()}
        assert got == _want(vectors, blocks, 0.8)


def test_clustered_vectors_meet_few_others(spark):
    r = np.random.default_rng(10)
    vectors = r.normal(size=(40, 32))[r.integers(0, 40, 1200)] + r.normal(scale=0.05, size=(1200, 32))
    u = _units(spark, vectors, ["a"] * 1200)
    placed = similarity.visits(u, TX.AUTO_MERGE, tile=30)
    size = placed.groupBy("ball").agg(F.count("*").alias("n"))
    compared = placed.select(F.explode("visits").alias("ball")).join(size, "ball").agg(F.sum("n")).first()[0]
    assert compared < 0.15 * 1200 * 1200
    got = {(p.id_a, p.id_b) for p in TX.similar_pairs(u, TX.AUTO_MERGE, tile=30).collect()}
    assert got == _want(vectors, ["a"] * 1200, TX.AUTO_MERGE) and got


def test_empty_and_single(spark):
    u = _units(spark, np.ones((1, 3)), ["a"])
    assert TX.similar_pairs(u, 0.9).collect() == []
    assert TX.similar_pairs(u.filter("id < 0"), 0.9).collect() == []
    with pytest.raises(ValueError):
        TX.similar_pairs(u, 0.9, index="none")


def test_farthest_first():
    rows = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]])
    assert similarity.farthest_first(rows, 9).tolist() == [[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]]


@pytest.mark.parametrize("group, calls", [(16, 20), (40, 7), (1, 1)])
def test_keys_of_any_size_meet_all(spark, group, calls):
    """Groups of balls, and rows and columns of a group, cut small: nothing is lost or met twice."""
    r = np.random.default_rng(11)
    vectors = np.concatenate((r.normal(size=(90, 10)), np.repeat(r.normal(size=(1, 10)), 45, 0)))  # copies outgrow a group
    blocks = [("a", "a", "b")[i % 3] for i in range(len(vectors))]
    u = _units(spark, vectors, blocks)
    got = [(p.id_a, p.id_b) for p in similarity.ball_join(u, 0.3, tile=10, group=group, calls=calls).collect()]
    assert len(got) == len(set(got)) and set(got) == _want(vectors, blocks, 0.3)


def test_large_blocks_without_centres_are_cut(spark):
    r = np.random.default_rng(12)
    vectors, blocks = r.normal(size=(80, 5)), ["a"] * 50 + ["b"] * 30
    u = _units(spark, vectors, blocks)
    got = [(p.id_a, p.id_b) for p in similarity.ball_join(u, 0.5, tile=10, most=1, group=12, calls=9).collect()]
    assert len(got) == len(set(got)) and set(got) == _want(vectors, blocks, 0.5)


def test_a_vector_goes_to_groups_not_to_balls(spark):
    """Vectors that lie evenly visit every ball; what is dealt out follows the groups all the same."""
    vectors = np.random.default_rng(13).normal(size=(400, 64))
    u = _units(spark, vectors, ["a"] * 400)
    placed, index = similarity._placed(u, 0.3, 10, similarity.MOST_CENTRES)
    assert placed.agg(F.sum(F.size("visits"))).first()[0] > 5000  # a row each before
    dealt = similarity._dealt(placed, similarity._groups(placed, index, 150, 300))
    assert dealt.count() <= 400 * 5 and dealt.filter("side = 0").select("id").distinct().count() == 400


def test_keys_that_repeat_and_rows_without_numbers(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (2, [1.0, 0.1], 0), (3, None, 0), (4, [None, 1.0], 0), (None, [1.0, 0.0], 0),
            (5, [1.0, 0.0], None), (6, [1.0, 0.0], None), (7, [float("nan"), 1.0], 0), (8, [3.0], 1), (9, [2.0], 1)]
    u = spark.createDataFrame(rows, "id long, u array<double>, block int")
    got = sorted((p.block, p.id_a, p.id_b) for p in similarity.ball_join(u, 0.9).collect())
    assert got == [(0, 1, 2)] * 4 + [(1, 8, 9)]
    with pytest.raises(Exception, match="different lengths"):
        similarity.ball_join(spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0], 0)], "id long, u array<double>, block int"), 0.9).collect()


def test_text_ids(spark):
    u = spark.createDataFrame([("b", [1.0, 0.0], "x"), ("a", [1.0, 0.0], "x"), ("é", [0.0, 1.0], "x"), ("z", [0.0, 1.0], "x")], "id string, u array<double>, block string")
    assert sorted((p.id_a, p.id_b) for p in TX.similar_pairs(u, 0.9).collect()) == [("a", "b"), ("z", "é")]
