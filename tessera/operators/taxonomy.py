"""Taxonomy registry.

Similar terms are found by an exact cosine threshold join within a term type,
through a ball index (``similarity.py``) or, as a parameter, by comparing all
tiles. Decisions on merges are rows of an SCD2 registry; approved merges are
followed to the end of their chains, and a split repairs only the cluster that
it touches."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise_term
from .graph import connected_components, contracted
from .numbering import with_row_number
from .similarity import ball_join

# ---- fixed values (must equal the reference behaviour) -------------------
TERM_TYPES = ["domain", "subdomain", "topic", "subtopic", "content_type", "style", "format"]
AUTO_MERGE = 0.95
REVIEW = 0.85
DEFAULT_STATUS = "self_mapped"
# ---------------------------------------------------------------------------


def raw_terms(gold_analysed: DataFrame) -> DataFrame:
    """Distinct (term_type, raw_value) of the seven term types."""
    stack = F.explode(F.array(*[
        F.struct(F.lit(t).alias("term_type"), F.col(f"result.{t}").alias("raw_value"))
        for t in TERM_TYPES])).alias("x")
    return gold_analysed.select(stack).select("x.*") \
        .filter(F.col("raw_value").isNotNull() & (F.col("raw_value") != "")).distinct()


def exact_dedup(terms: DataFrame) -> DataFrame:
    """canonical = smallest raw value of each (type, lower+trim) class;
    every term starts self-mapped."""
    t = terms.withColumn("norm", normalise_term(F.col("raw_value")))
    canon = t.groupBy("term_type", "norm").agg(F.min("raw_value").alias("canonical_value"))
    out = t.join(canon, ["term_type", "norm"]).drop("norm") \
        .withColumn("review_status", F.lit(DEFAULT_STATUS))
    return with_row_number(out, ["term_type", "raw_value"], "term_id")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def unit_vectors(vecs: DataFrame, id_col: str, vec_col: str, block_col: str) -> DataFrame:
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    norm = F.sqrt(_dot(v, v))
    return vecs.select(F.col(id_col).alias("id"), F.col(block_col).alias("block"),
                       # The norm through an array of one, or each number would have it worked out anew.
                       F.transform(F.array(norm), lambda n: F.transform(v, lambda x: x / n))[0].alias("u"))


def _angle(a: Column, b: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(a, b))))


def similar_pairs(units: DataFrame, threshold: float, tile: int = 512, index: str = "balls") -> DataFrame:
    """All pairs a < b in the same block with cos >= threshold, exact,
    through the ball index or (``index="tiles"``) by comparing all tiles."""
    if index not in ("balls", "tiles"):
        raise ValueError(f"unknown index {index!r}")
    return (ball_join if index == "balls" else tile_join)(units, threshold, tile)


def tile_join(units: DataFrame, threshold: float, tile: int = 512) -> DataFrame:
    """All pairs of a block, tile by tile.

    Two pivots a block are chosen from the data: a vector, and the one at the
    largest angle to it. Angles obey the triangle inequality, so a pair within
    the threshold differs by its angle at most in its angles to either pivot;
    others are dropped before the dot product. In many dimensions angles lie
    close together and the pivots drop little, so the load is carried by tiles:
    a block is cut by hash into tiles of about ``tile`` vectors, and each pair
    of tiles is a join key of its own, which bounds the work of a key whatever
    the block's size."""
    theta = math.acos(max(min(threshold, 1.0), -1.0)) + 1e-9
    first = units.groupBy("block").agg(F.min_by("u", F.xxhash64("id")).alias("p1"),
                                       F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    near = units.join(first, "block").withColumn("a1", _angle(F.col("u"), F.col("p1")))
    second = near.groupBy("block").agg(F.max_by("u", "a1").alias("p2"))
    placed = near.join(second, "block").select(
        "id", "block", "u", "a1", _angle(F.col("u"), F.col("p2")).alias("a2"), "tiles",
        F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("t"))
    left = placed.select("*", F.explode(F.sequence("t", F.col("tiles") - 1)).alias("t2"))
    right = placed.select("block", F.explode(F.sequence(F.lit(0), "t")).alias("t"), F.col("t").alias("t2"),
                          *[F.col(c).alias(f"{c}_b") for c in ("id", "u", "a1", "a2")])
    close = ((F.abs(F.col("a1") - F.col("a1_b")) <= theta) & (F.abs(F.col("a2") - F.col("a2_b")) <= theta)
             & ((F.col("t") < F.col("t2")) | (F.col("id") < F.col("id_b"))))
    cand = left.join(right, ["block", "t", "t2"]).filter(close)
    return cand.select("block", F.least("id", "id_b").alias("id_a"), F.greatest("id", "id_b").alias("id_b"),
                       _dot(F.col("u"), F.col("u_b")).alias("cosine")).filter(F.col("cosine") >= F.lit(threshold))


def classify(pairs: DataFrame, auto: float = AUTO_MERGE, review: float = REVIEW) -> DataFrame:
    """T5: auto_merged / pending_review / distinct."""
    return pairs.withColumn("status", F.when(F.col("cosine") >= auto, "auto_merged")
                            .when(F.col("cosine") >= review, "pending_review")
                            .otherwise("distinct"))


def clusters(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """clusters = connected components of auto-merge edges; the cluster's
    canonical term is its smallest id."""
    e = pairs.filter(F.col("status") == "auto_merged") \
        .select(F.col("id_a").alias("src"), F.col("id_b").alias("dst"))
    return connected_components(contracted(e), nodes.select(F.col("id").alias("node")))


def review_queue(pairs: DataFrame, cl: DataFrame) -> DataFrame:
    """One row per proposed merge awaiting review: the canonical term of
    the first term's cluster, the proposed term and its score."""
    rv = pairs.filter(F.col("status") == "pending_review")
    return rv.join(cl.select(F.col("node").alias("id_a"), F.col("component").alias("canonical_id")),
                   "id_a").select("canonical_id", F.col("id_b").alias("proposed_id"),
                                  F.round("cosine", 6).alias("score"))


def apply_decisions(terms: DataFrame, decisions: DataFrame, as_of: Column) -> DataFrame:
    """Approved decisions (term_id, canonical_id, decision) deprecate
    the term: its current row is expired and a new current row records
    merged_into_id and 'reviewed_approved'; rejected ones get a new row with
    'reviewed_rejected'. SCD2 as join + union, history kept."""
    d = decisions.select("term_id", "canonical_id", "decision")
    hit = terms.join(d.select("term_id").withColumn("_d", F.lit(True)), "term_id", "left")
    cur = F.col("_d").isNotNull() & F.col("is_current")
    prior = hit.select(*[c for c in terms.columns if c not in ("is_current", "effective_to")],
                       F.when(cur, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
                       F.when(cur, as_of.cast("timestamp_ntz")).otherwise(F.col("effective_to"))
                       .alias("effective_to"))
    new = terms.filter("is_current").join(d, "term_id").select(
        *[F.col(c) for c in terms.columns if c not in
          ("review_status", "merged_into_id", "is_current", "effective_from", "effective_to")],
        F.when(F.col("decision") == "approve", "reviewed_approved")
        .otherwise("reviewed_rejected").alias("review_status"),
        F.when(F.col("decision") == "approve", F.col("canonical_id")).cast("bigint")
        .alias("merged_into_id"),
        F.lit(True).alias("is_current"), as_of.cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"))
    return prior.unionByName(new.select(*prior.columns))


def dim_topic(gold_analysed: DataFrame) -> DataFrame:
    """Distinct (domain, subdomain, topic, subtopic, content_type, style,
    format) with surrogate keys."""
    cols = ["domain", "subdomain", "topic", "subtopic", "content_type", "style", "format"]
    t = gold_analysed.select(*[F.coalesce(F.col(f"result.{c}"), F.lit("")).alias(c)
                               for c in cols]).distinct()
    return with_row_number(t, cols, "topic_key")


def canonical_map(terms: DataFrame) -> DataFrame:
    """J15 input: (term_type, raw_value) -> canonical_value, current rows."""
    return terms.filter(F.col("is_current")).select("term_type", "raw_value", "canonical_value")
