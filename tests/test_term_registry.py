"""Registry: chains and cycles of merges, splits, repair of touched clusters only, storage."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph as GR
from tessera.operators import term_registry as TR


def T(month):
    return F.lit(f"2025-0{month}-01 00:00:00")


DECISIONS = "term_id long, canonical_id long, score double, decision string, parts array<string>"


def _terms(spark, n):
    return spark.createDataFrame([(i, "topic", f"t{i}", f"t{i}") for i in range(1, n + 1)], "term_id long, term_type string, raw_value string, canonical_value string")


def _merged(spark, n, merges):
    rows = [(a, b, 0.9, "approve", None) for a, b in merges]
    return TR.apply_reviews(TR.first_rows(_terms(spark, n), T(1)), spark.createDataFrame(rows, DECISIONS), T(2))


def _values(registry):
    return {r.raw_value: r.canonical_value for r in TR.canonical_values(registry).collect()}


def test_chain_of_merges_reaches_its_end(spark):
    registry = _merged(spark, 6, [(3, 2), (2, 1), (4, 3), (6, 5)])
    assert _values(registry) == {"t1": "t1", "t2": "t1", "t3": "t1", "t4": "t1", "t5": "t5", "t6": "t5"}
    history = registry.filter("term_id = 3").orderBy("effective_from").collect()
    assert [(r.is_current, r.review_status, r.merged_into_id) for r in history] == [(False, "self_mapped", None), (True, "reviewed_approved", 2)]
    assert history[0].effective_to == history[1].effective_from and history[1].similarity_score == 0.9


def test_long_chain(spark):
    registry = _merged(spark, 70, [(i, i - 1) for i in range(2, 71)])
    assert set(_values(registry).values()) == {"t1"}


@pytest.mark.parametrize("merges", [[(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 1)], [(1, 2), (2, 3), (3, 4), (4, 5), (5, 1), (6, 3)]])
def test_cycles_are_errors(spark, merges):
    with pytest.raises(ValueError, match="cycle"):
        TR.canonical_values(_merged(spark, 6, merges)).collect()


def test_target_without_row_ends_the_chain(spark):
    assert _values(_merged(spark, 2, [(2, 99)])) == {"t1": "t1", "t2": "t2"}


def test_split_into_parts_and_back(spark):
    registry = TR.first_rows(_terms(spark, 3), T(1))
    split = spark.createDataFrame([(2, None, None, "split", ["x", "y", "x"]), (1, None, 0.86, "reject", None), (3, None, None, "split", [])], DECISIONS)
    registry = TR.apply_reviews(registry, split, T(2))
    current = {(r.term_id, r.part): (r.canonical_value, r.review_status) for r in registry.filter("is_current").collect()}
    assert current == {(1, 0): ("t1", "reviewed_rejected"), (2, 1): ("x", "reviewed_split"), (2, 2): ("y", "reviewed_split"), (3, 0): ("t3", "self_mapped")}
    assert registry.filter("not is_current").count() == 2
    assert _values(registry)["t2"] == "x"
    again = TR.apply_reviews(registry, spark.createDataFrame([(2, 1, 0.9, "approve", None)], DECISIONS), T(3))
    assert again.filter("is_current and term_id = 2").count() == 1 and _values(again)["t2"] == "t1"
    assert again.count() == registry.count() + 1


def test_repair_touches_only_cut_clusters(spark):
    r = random.Random(2)
    edges = sorted({tuple(sorted(r.sample(range(60), 2))) for _ in range(55)})
    cuts = r.sample(edges, 6)
    frame = lambda e: spark.createDataFrame(e, "id_a long, id_b long")
    nodes = spark.range(60).toDF("node")
    pairs = lambda e: frame(e).select(F.col("id_a").alias("src"), F.col("id_b").alias("dst"))
    clusters = GR.connected_components(pairs(edges), nodes)
    got = TR.repair_clusters(clusters, frame(edges), frame([(b, a) for a, b in cuts]))
    want = GR.connected_components(pairs([e for e in edges if e not in cuts]), nodes)
    assert sorted(map(tuple, got.select("node", "component").collect())) == sorted(map(tuple, want.select("node", "component").collect()))


def test_cut_moves_terms_unless_reviewed(spark):
    edges = spark.createDataFrame([(1, 2, 0.99), (2, 3, 0.96), (3, 4, 0.97), (5, 6, 0.98)], "id_a long, id_b long, cosine double")
    clusters = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5)], "node long, component long")
    terms = _terms(spark, 6).drop("canonical_value")
    registry = TR.cluster_rows(terms, clusters, edges, T(1))
    registry = TR.apply_reviews(registry, spark.createDataFrame([(4, 2, 0.9, "approve", None)], DECISIONS), T(2))
    cuts = spark.createDataFrame([(2, 3)], "id_a long, id_b long")
    after, repaired = TR.cut_merges(registry, clusters, edges, cuts, T(3))
    assert {r.node: r.component for r in repaired.collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 5}
    current = {r.term_id: (r.review_status, r.merged_into_id, r.similarity_score) for r in after.filter("is_current").collect()}
    assert current == {1: ("self_mapped", None, None), 2: ("auto_merged", 1, 0.99), 3: ("reviewed_split", None, None), 4: ("reviewed_approved", 2, 0.9),
                       5: ("self_mapped", None, None), 6: ("auto_merged", 5, 0.98)}
    assert after.count() == registry.count() + 1


def test_stored_registry_and_refresh(spark, tmp_path):
    store = TR.TermRegistry(spark, str(tmp_path / "terms"))
    assert store.read() is None
    first = store.save(TR.first_rows(_terms(spark, 3), T(1)), T(1))
    decisions = spark.createDataFrame([(3, 2, 0.9, "approve", None), (2, 1, 0.9, "approve", None)], DECISIONS)
    stored = store.save(TR.apply_reviews(first, decisions, T(2)), T(2))
    assert stored.count() == 5 and set(_values(stored).values()) == {"t1"}
    old = spark.createDataFrame([("t1", 1), ("t3", 2)], "topic string, topic_key long")
    got = TR.refresh_dim_topic(old, spark.createDataFrame([("t1",), ("t9",), ("t0",), ("t9",)], "topic string"))
    assert {(r.topic, r.topic_key, r.is_current) for r in got.collect()} == {("t1", 1, True), ("t3", 2, False), ("t0", 3, True), ("t9", 4, True)}
