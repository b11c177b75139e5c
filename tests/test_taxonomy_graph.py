"""Taxonomy thresholds (production 0.95/0.85), exact similarity join vs brute
force, connected components vs brute force, PageRank mass, quantiles."""

import math
import random

import numpy as np

from tessera.operators import graph as GR
from tessera.operators import taxonomy as TX
from tessera.operators.benchmark import exact_quantiles


def _vec(angle):
    return [math.cos(angle), math.sin(angle), 0.0]


def test_thresholds_on_fixture(spark):
    # cosines to term 1: 0.97, 0.90, 0.50, 0.95 (boundary), 0.85 (boundary)
    cosines = [0.97, 0.90, 0.50, 0.95, 0.85]
    rows = [(1, 0, _vec(0.0))] + [(i + 2, 0, _vec(math.acos(c))) for i, c in enumerate(cosines)]
    v = spark.createDataFrame(rows, "id long, label int, e array<double>")
    u = TX.unit_vectors(v, "id", "e", "label")
    p = TX.classify(TX.similar_pairs(u, 0.5 - 1e-9))
    got = {r.id_b: r.status for r in p.filter("id_a = 1").collect()}
    assert got[2] == "auto_merged" and got[3] == "pending_review" and got[4] == "distinct"
    assert got[5] == "auto_merged" and got[6] == "pending_review"


def test_similarity_join_is_exact(spark):
    rnd = random.Random(7)
    rows = [(i, i % 3, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    v = spark.createDataFrame(rows, "id long, label int, e array<double>")
    got = {(r.id_a, r.id_b) for r in
           TX.similar_pairs(TX.unit_vectors(v, "id", "e", "label"), 0.3).collect()}
    want = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1]:
                x, y = np.array(a[2]), np.array(b[2])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.3:
                    want.add((a[0], b[0]))
    assert got == want and len(want) > 0


def test_connected_components(spark):
    rnd = random.Random(3)
    edges = [(f"n{rnd.randrange(60):02d}", f"n{rnd.randrange(60):02d}") for _ in range(45)]
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.component for r in GR.connected_components(e).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    nodes = {n for ed in edges for n in ed if ed[0] != ed[1]}
    comp = {}
    for n in nodes:
        comp.setdefault(find(n), []).append(n)
    want = {n: min(members) for members in comp.values() for n in members}
    assert {k: v for k, v in got.items()} == want


def test_pagerank_mass(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "src string, dst string")
    r = {x.node: x.rank for x in GR.pagerank(e, iterations=30).collect()}
    assert abs(sum(r.values()) - 1.0) < 1e-9 and r["c"] > r["b"]


def test_exact_quantiles(spark):
    rnd = random.Random(5)
    rows = [(g, rnd.random() * 100) for g in ("a", "b") for _ in range(37)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, "g", "v").collect()}
    for g in ("a", "b"):
        vals = [v for gg, v in rows if gg == g]
        for p in (0.25, 0.5, 0.75):
            assert abs(got[(g, p)] - float(np.quantile(vals, p))) < 1e-9


def test_similar_pairs_over_many_tiles(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 16))
    v = centres[r.integers(0, 6, 90)] + r.normal(scale=0.25, size=(90, 16))
    rows = [(i, [float(x) for x in v[i]], int(i % 2)) for i in range(90)]
    u = TX.unit_vectors(spark.createDataFrame(rows, "id long, e array<double>, label int"), "id", "e", "label")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for threshold in (0.9, 0.5):
        got = {(p.id_a, p.id_b) for p in TX.similar_pairs(u, threshold, tile=8).collect()}
        assert got == {(i, j) for i in range(90) for j in range(i + 1, 90) if i % 2 == j % 2 and unit[i] @ unit[j] >= threshold}


def test_long_path_is_one_component(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)], "src long, dst long")
    assert {r.component for r in GR.connected_components(e).collect()} == {0}


def test_pagerank_is_the_same_with_hubs_cut(spark):
    e = spark.createDataFrame([(0, i) for i in range(1, 30)] + [(i, 0) for i in range(1, 20)] + [(3, 4)], "src long, dst long")
    plain = {r.node: r.rank for r in GR.pagerank(e, 5).collect()}
    cut = {r.node: r.rank for r in GR.pagerank(e, 5, hub_edges=4).collect()}
    assert plain.keys() == cut.keys() and all(abs(plain[k] - cut[k]) < 1e-12 for k in plain)


def _labels_by_hand(edges, rounds):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    now, before = {u: u for u in near}, {u: u for u in near}
    for _ in range(rounds):
        after = {}
        for u in near:
            votes = {}
            for label in [now[u]] + [now[v] for v in near[u]]:
                votes[label] = votes.get(label, 0) + 1
            after[u] = min(votes, key=lambda x: (-votes[x], x))
        before, now = now, after
    return {u: min(now[u], before[u]) for u in near}


def test_label_propagation(spark):
    clique = lambda ids: [(a, b) for a in ids for b in ids if a < b]
    two = clique(range(0, 5)) + clique(range(10, 15)) + [(4, 10), (3, 3)]
    got = {r.node: r.label for r in GR.label_propagation(spark.createDataFrame(two, "src long, dst long")).collect()}
    assert got == _labels_by_hand(two, 20) and {got[i] for i in range(5)} == {0} and {got[i] for i in range(10, 15)} == {10}
    rnd = random.Random(11)
    some = [(rnd.randrange(40), rnd.randrange(40)) for _ in range(70)] + [(100, i) for i in range(101, 130)]
    for rounds in (1, 3, 12):
        got = {r.node: r.label for r in GR.label_propagation(spark.createDataFrame(some, "src long, dst long"), rounds).collect()}
        assert got == _labels_by_hand(some, rounds)
    assert GR.label_propagation(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_a_round_of_components_reads_the_edges_a_few_times(spark, monkeypatch):
    """A union or a self-join of what a union made doubles the plan at each step."""
    plans, cut = [], GR.cut_lineage
    monkeypatch.setattr(GR, "cut_lineage", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), cut(df))[1])
    e = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(3, 3), (None, 4)], "src long, dst long")
    got = {r.node: r.component for r in GR.connected_components(e).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}
    assert len(plans) > 2 and max(p.count("LogicalRDD") for p in plans) <= 4


def test_components_without_edges(spark):
    e = spark.createDataFrame([(5, 5), (None, 1)], "src long, dst long")
    nodes = spark.createDataFrame([(5,), (6,)], "node long")
    assert {tuple(r) for r in GR.connected_components(e, nodes).collect()} == {(5, 5), (6, 6)}
    assert GR.connected_components(e).count() == 0


def test_contracted_edges_are_few_and_join_the_same(spark):
    rnd = random.Random(21)
    some = [(a, b) for a, b in ((rnd.randrange(60), rnd.randrange(60)) for _ in range(4000)) if a % 3 == b % 3] + [(100, 101), (101, 102), (200, 200), (None, 5), (7, None)]
    e = spark.createDataFrame(some, "src long, dst long").coalesce(1)
    for at_once in (1 << 20, 50, 1):
        few = GR.contracted(e, at_once)
        if at_once == 1 << 20:
            assert few.count() <= 61  # over a thousand before
        assert sorted(map(tuple, GR.connected_components(few).collect())) == sorted(map(tuple, GR.connected_components(e).collect()))
    words = spark.createDataFrame([("a", "b"), ("é", "b"), ("x", "y")], "src string, dst string")
    assert {tuple(r) for r in GR.connected_components(GR.contracted(words)).collect()} == {("a", "a"), ("b", "a"), ("é", "a"), ("x", "x"), ("y", "x")}
    path = spark.createDataFrame([(i, (i * 37) % 501) for i in range(501)], "src long, dst long")
    assert sorted(map(tuple, GR.connected_components(GR.contracted(path)).collect())) == sorted(map(tuple, GR.connected_components(path).collect()))
