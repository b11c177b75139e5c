"""Graph operators over edge DataFrames.

Iterative algorithms are loops of joins and aggregations; lineage is cut
with reliable checkpoints every few rounds so plans stay small and a lost
executor recomputes at most a few rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

AT_ONCE = 1 << 20  # edges that a task contracts at once


def typed_edges(topic_edges: DataFrame, resource_edges: DataFrame,
                profile_edges: DataFrame | None = None) -> DataFrame:
    """G1: one edge table (src, dst, edge_type, weight) from the views."""
    t = topic_edges.select(F.concat(F.lit("profile:"), "owner_id").alias("src"),
                           F.concat(F.lit("topic:"), "domain", F.lit("/"), "topic").alias("dst"),
                           F.lit("covers").alias("edge_type"),
                           F.col("post_count").cast("double").alias("weight"))
    r = resource_edges.select(F.concat(F.lit("profile:"), "owner_id").alias("src"),
                              F.concat(F.lit("resource:"), "resource_name").alias("dst"),
                              F.lit("uses").alias("edge_type"),
                              F.col("post_count").cast("double").alias("weight"))
    e = t.unionByName(r)
    if profile_edges is not None:
        e = e.unionByName(profile_edges.select(
            F.concat(F.lit("profile:"), "src").alias("src"),
            F.concat(F.lit("profile:"), "dst").alias("dst"),
            F.lit("related").alias("edge_type"), F.lit(1.0).alias("weight")))
    return e


def vertices(edges: DataFrame) -> DataFrame:
    v = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id")))
    return v.distinct().withColumn("kind", F.split("id", ":")[0])


def related_edges(profiles: DataFrame, current: DataFrame) -> DataFrame:
    """Profile -> profile edges from related_profiles (usernames),
    resolved against current profiles by username."""
    rel = profiles.select(F.col("owner_id").alias("src"),
                          F.explode("related_profiles").alias("username"))
    names = current.select(F.col("owner_username").alias("username"),
                           F.col("owner_id").alias("dst"))
    return rel.join(names, "username").select("src", "dst").filter(F.col("src") != F.col("dst")) \
        .distinct()


def pagerank(edges: DataFrame, iterations: int = 10, damping: float = 0.85,
             checkpoint_every: int = 3, hub_edges: int = 100_000) -> DataFrame:
    """PR(v) = (1-d)/N + d * sum over u->v of PR(u)/outdeg(u), from a
    uniform start; rank of dangling nodes is not redistributed (as specified).

    Edges are dealt by source once and kept; a round moves ranks only. The
    edges of a source with more than ``hub_edges`` are cut into parts by
    target, and its rank goes to each part."""
    e = edges.select("src", "dst").distinct()
    out = e.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("deg"))
    nodes = e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct()
    nodes = cut_lineage(nodes.join(out, "node", "left").select(
        "node", "deg", F.ceil(F.coalesce("deg", F.lit(1)) / hub_edges).cast("int").alias("parts")))
    n = nodes.count()
    e = (e.join(nodes.select(F.col("node").alias("src"), "deg", "parts"), "src")
         .select("src", F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int").alias("part"), "dst", "deg"))
    e = cut_lineage(e).repartition("src", "part").persist()
    ranks = nodes.withColumn("rank", F.lit(1.0 / n))
    for i in range(iterations):
        sent = ranks.filter("deg is not null").select(
            F.col("node").alias("src"), "rank", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        contrib = e.join(sent, ["src", "part"]).groupBy(F.col("dst").alias("node")) \
            .agg(F.sum(F.col("rank") / F.col("deg")).alias("c"))
        ranks = nodes.join(contrib, "node", "left").select(
            "node", "deg", "parts",
            (F.lit((1 - damping) / n) + F.lit(damping) * F.coalesce("c", F.lit(0.0))).alias("rank"))
        if (i + 1) % checkpoint_every == 0 or i + 1 == iterations:
            ranks = cut_lineage(ranks)
    e.unpersist()
    return ranks.select("node", "rank")


def _both_ways(*pairs: tuple) -> Column:
    """Each pair as an edge both ways, one a row (u, v): a generator reads its
    rows once, where a union would evaluate all that is behind them for each side."""
    return F.inline(F.array(*[F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for a, b in pairs for x, y in ((a, b), (b, a))]))


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.select(_both_ways(("src", "dst"))).filter(F.col("u") != F.col("v")).distinct()


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of nodes 0 to n - 1 with edges a-b."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while ((up := root[root]) != root).any():
            root = up


def _stars(src: pa.Array, dst: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Edges of the same components: each node but one to that one."""
    nodes = pa.concat_arrays([src, dst]).dictionary_encode()
    code = nodes.indices.to_numpy()
    root = _roots(code[:len(src)], code[len(src):], len(nodes.dictionary))
    far = np.flatnonzero(root != np.arange(len(root)))
    return nodes.dictionary.take(pa.array(far)), nodes.dictionary.take(pa.array(root[far]))


def contracted(edges: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """Edges (src, dst) with the same connected components, before any shuffle:
    a task replaces its edges, ``at_once`` at a time, by one for each node in
    them but one a component. Many edges between few nodes become few."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []

        def made() -> tuple[pa.Array, pa.Array]:
            return _stars(*(pa.concat_arrays([p[k] for p in parts]) for k in (0, 1)))

        for batch in batches:
            parts.append((batch.column("src"), batch.column("dst")))
            if sum(len(p[0]) for p in parts) >= at_once:
                stars = made()
                parts = [stars]
                if len(stars[0]) > at_once // 2:
                    yield pa.RecordBatch.from_arrays([*stars], names=["src", "dst"])
                    parts = []
        if parts:
            yield pa.RecordBatch.from_arrays([*made()], names=["src", "dst"])

    e = edges.select("src", "dst").filter("src != dst")
    kinds = [e.schema[c].dataType.simpleString() for c in ("src", "dst")]
    return e.mapInArrow(run, f"src {kinds[0]}, dst {kinds[1]}") if kinds[0] == kinds[1] else e


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1_000_000_007))).alias("h"),
                     F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Component label = smallest node id, by alternating large-star
    and small-star rounds (O(log^2 n) rounds; every round is two joins and
    two min-aggregations, no per-component collect), repeated until a round
    changes nothing. Returns (node, component); isolated nodes from ``nodes``
    get their own id."""
    nb = cut_lineage(_undirected(edges))
    prev = _signature(nb)
    while prev.n:
        # large-star: larger neighbours of u attach to min(N(u) + u)
        m = nb.groupBy("u").agg(F.min("v").alias("mn"))
        ls = nb.filter(F.col("v") > F.col("u")).join(m, "u").select("v", F.least("u", "mn").alias("m"))
        nb = ls.select(_both_ways(("v", "m"))).filter(F.col("u") != F.col("v")).distinct()
        # small-star: u and its smaller neighbours attach to their minimum
        small = nb.filter(F.col("v") < F.col("u"))
        ss = small.join(small.groupBy("u").agg(F.min("v").alias("m")), "u")
        nb = cut_lineage(ss.select(_both_ways(("v", "m"), ("u", "m"))).filter(F.col("u") != F.col("v")).distinct())
        sig = _signature(nb)
        if sig == prev:
            break
        prev = sig
    comp = nb.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")) \
        .select("node", F.least("node", "m").alias("component"))
    if nodes is not None:
        comp = nodes.select("node").distinct().join(comp, "node", "left") \
            .select("node", F.coalesce("component", "node").alias("component"))
    return comp


def label_propagation(edges: DataFrame, max_rounds: int = 20) -> DataFrame:
    """Communities by synchronous label propagation; returns (node, label).

    Every node starts with its own id. In a round all nodes at once take the
    label with most votes among their neighbours' labels and their own; of
    labels with equal votes the smallest. Synchronous rounds can end in two
    states that alternate, so the rounds stop when the labels equal those of the
    round before or of the one before that (or after ``max_rounds``), and a node
    gets the smaller of its last two labels. Votes are counted by (node, label)
    before the shuffle, so a hub's neighbours do not meet in one task."""
    und = cut_lineage(_undirected(edges))
    nodes = und.select(F.col("u").alias("node")).distinct()
    labels = cut_lineage(nodes.withColumn("before", F.col("node")).withColumn("label", F.col("node")))
    for _ in range(max_rounds):
        sent = und.join(labels.select(F.col("node").alias("v"), "label"), "v").select(F.col("u").alias("node"), "label")
        votes = sent.unionByName(labels.select("node", "label")).groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
        best = votes.groupBy("node").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("next"))
        after = cut_lineage(labels.join(best, "node").select("node", F.col("label").alias("before"), F.col("next").alias("label"), F.col("before").alias("_old")))
        still = after.agg(F.bool_and(F.col("label") == F.col("before")).alias("fixed"), F.bool_and(F.col("label") == F.col("_old")).alias("swings")).first()
        labels = after.drop("_old")
        if still.fixed is not False or still.swings:
            break
    return labels.select("node", F.least("label", "before").alias("label"))


def jaccard_on_edges(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Jaccard of token sets for given profile pairs (src, dst) only;
    work is linear in pairs x tokens per profile (no all-pairs join)."""
    t = tokens.select(F.col("owner_id"), F.col("token")).distinct()
    size = t.groupBy("owner_id").agg(F.count(F.lit(1)).alias("n"))
    ta = pairs.join(t.withColumnRenamed("owner_id", "src"), "src")
    tb = t.withColumnRenamed("owner_id", "dst")
    inter = ta.join(tb, ["dst", "token"]).groupBy("src", "dst") \
        .agg(F.count(F.lit(1)).alias("shared"))
    j = pairs.join(inter, ["src", "dst"], "left") \
        .join(size.select(F.col("owner_id").alias("src"), F.col("n").alias("n_src")), "src", "left") \
        .join(size.select(F.col("owner_id").alias("dst"), F.col("n").alias("n_dst")), "dst", "left")
    shared = F.coalesce("shared", F.lit(0))
    union = F.coalesce("n_src", F.lit(0)) + F.coalesce("n_dst", F.lit(0)) - shared
    return j.select("src", "dst", shared.alias("shared"),
                    F.when(union > 0, F.round(shared / union, 6)).alias("jaccard"))
