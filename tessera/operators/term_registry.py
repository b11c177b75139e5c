"""The stored term registry (T6-T10, J15, M10): clusters, reviews, splits, and
merges followed to their end.

A term has one current row, or after a split into parts one current row a
part. Earlier rows stay with the time at which they ended.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, staged
from .graph import connected_components, contracted
from .numbering import with_row_number
from .upsert import BucketedTable

# ---- fixed values (must equal the reference behaviour) -------------------
SELF_MAPPED, AUTO_MERGED, APPROVED, REJECTED = "self_mapped", "auto_merged", "reviewed_approved", "reviewed_rejected"
# ---------------------------------------------------------------------------
SPLIT = "reviewed_split"
REGISTRY_DDL = ("term_id bigint, part int, term_type string, raw_value string, canonical_value string, similarity_score double, "
                "review_status string, merged_into_id bigint, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
COLUMNS = [c.split()[0] for c in REGISTRY_DDL.split(", ")]


def _rows(df: DataFrame, since: Column, **columns: Column) -> DataFrame:
    """Current rows from ``since`` on; what ``columns`` does not set comes from ``df``."""
    columns = {"effective_from": since.cast("timestamp_ntz"), "effective_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True), **columns}
    kinds = dict(c.split() for c in REGISTRY_DDL.split(", "))
    return df.select(*[columns.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in COLUMNS])


def first_rows(terms: DataFrame, since: Column) -> DataFrame:
    """Registry of terms (term_id, term_type, raw_value, canonical_value) that
    stand for themselves."""
    return _rows(terms, since, part=F.lit(0), similarity_score=F.lit(None), review_status=F.lit(SELF_MAPPED), merged_into_id=F.lit(None))


def cluster_rows(terms: DataFrame, clusters: DataFrame, edges: DataFrame, since: Column, status: str = AUTO_MERGED) -> DataFrame:
    """Rows of terms (term_id, term_type, raw_value) by their cluster (node,
    component): merged into its smallest term, with their cosine to it where
    the two are an edge (id_a, id_b, cosine); the smallest stands for itself,
    as ``status`` only if that is a review."""
    heads = terms.select(F.col("term_id").alias("component"), F.col("raw_value").alias("head"))
    # Edges to a head only, and before a shuffle where the heads, staged and so of known size, are few.
    merged = staged(clusters.filter("node != component").select("component").distinct(), "heads")
    scores = edges.select(F.least("id_a", "id_b").alias("component"), F.greatest("id_a", "id_b").alias("term_id"), "cosine") \
        .join(merged, "component", "left_semi")
    own = F.col("component") == F.col("term_id")
    joined = (terms.join(clusters.select(F.col("node").alias("term_id"), "component"), "term_id").join(heads, "component")
              .join(scores, ["component", "term_id"], "left"))
    return _rows(joined, since, part=F.lit(0), canonical_value=F.col("head"), similarity_score=F.round("cosine", 6),
                 review_status=F.when(own & F.lit(status == AUTO_MERGED), SELF_MAPPED).otherwise(status),
                 merged_into_id=F.when(~own, F.col("component")))


def replace_current(registry: DataFrame, new: DataFrame, as_of: Column) -> DataFrame:
    """SCD2: the current rows of every term in ``new`` end, and ``new`` follows."""
    hit = registry.join(new.select("term_id").distinct().withColumn("_hit", F.lit(True)), "term_id", "left")
    ends = F.col("_hit").isNotNull() & F.col("is_current")
    kept = hit.withColumns({"effective_to": F.when(ends, as_of.cast("timestamp_ntz")).otherwise(F.col("effective_to")),
                            "is_current": F.col("is_current") & F.col("_hit").isNull()})
    return kept.select(*COLUMNS).unionByName(new.select(*COLUMNS))


def apply_reviews(registry: DataFrame, decisions: DataFrame, as_of: Column) -> DataFrame:
    """Decisions (term_id, canonical_id, score, decision, parts), one a
    term. approve: merged into canonical_id. reject: stands for itself. split:
    one current row for each different value of ``parts``, numbered from 1; a
    split without parts changes nothing here (see ``cut_merges``)."""
    base = registry.filter("is_current").groupBy("term_id", "term_type", "raw_value").agg(F.min_by("canonical_value", "part").alias("canonical_value"))
    d = base.join(decisions.select("term_id", "canonical_id", "score", "decision", "parts"), "term_id")
    plain = d.filter(F.col("decision").isin("approve", "reject"))
    approve = F.col("decision") == "approve"
    reviewed = _rows(plain, as_of, part=F.lit(0), similarity_score=F.round("score", 6), review_status=F.when(approve, APPROVED).otherwise(REJECTED),
                     merged_into_id=F.when(approve, F.col("canonical_id")))
    split = (d.filter("decision = 'split' and size(parts) > 0").drop("canonical_value")
             .select("term_id", "term_type", "raw_value", F.posexplode(F.array_distinct("parts")).alias("pos", "canonical_value")))
    parted = _rows(split, as_of, part=F.col("pos") + 1, similarity_score=F.lit(None), review_status=F.lit(SPLIT), merged_into_id=F.lit(None))
    return replace_current(registry, reviewed.unionByName(parted), as_of)


def _ordered(edges: DataFrame, *more: str) -> DataFrame:
    return edges.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), *more)


def repair_clusters(clusters: DataFrame, edges: DataFrame, cuts: DataFrame) -> DataFrame:
    """T6 after the edges ``cuts`` (id_a, id_b) are deleted: clusters that held
    one are computed anew from the edges they have left, all others are taken
    over. Edges lie within clusters, so one end tells an edge's cluster; they
    are contracted before they meet it."""
    cuts = staged(_ordered(cuts).distinct(), "cuts")
    of = clusters.select(F.col("node").alias("id_a"), "component")
    touched = cuts.join(of, "id_a").select("component").distinct()
    members = clusters.join(touched, "component", "left_semi")
    left = contracted(_ordered(edges).join(cuts, ["id_a", "id_b"], "left_anti").select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")))
    again = connected_components(left.join(members.select(F.col("node").alias("src")), "src", "left_semi"), members.select("node"))
    return clusters.join(touched, "component", "left_anti").select("node", "component").unionByName(again.select("node", "component"))


def cut_merges(registry: DataFrame, clusters: DataFrame, edges: DataFrame, cuts: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """T8 split of automatic merges: the cut edges go, their clusters are
    repaired, and terms that now belong elsewhere get a new row, unless a
    reviewer has decided on them. Returns (registry, clusters)."""
    cuts = staged(_ordered(cuts).distinct(), "cuts")
    after = cut_lineage(repair_clusters(clusters, edges, cuts))
    before = clusters.select("node", F.col("component").alias("was"))
    moved = after.join(before, "node").filter(F.col("component") != F.col("was")).select("node", "component")
    terms = registry.filter(F.col("is_current") & F.col("review_status").isin(SELF_MAPPED, AUTO_MERGED))
    raw = registry.filter("is_current").select("term_id", "term_type", "raw_value").distinct()
    left = _ordered(edges, "cosine").join(cuts, ["id_a", "id_b"], "left_anti")
    new = cluster_rows(raw, moved, left, as_of, SPLIT).join(terms.select("term_id"), "term_id", "left_semi")
    return replace_current(registry, new, as_of), after


def resolve_merges(registry: DataFrame) -> DataFrame:
    """(term_id, root_id) of every current term, merges followed to their
    end by pointer jumping: each round replaces a term's target by its
    target's target, so a chain of n takes log2(n) rounds. A cycle is an
    error; a target without a current row ends the chain."""
    current = registry.filter("is_current").groupBy("term_id").agg(F.max("merged_into_id").alias("to"))
    at = cut_lineage(current.select("term_id", F.coalesce("to", "term_id").alias("root_id")))
    for _ in range(2 + math.ceil(math.log2(2 + at.count()))):
        target = at.select(F.col("term_id").alias("root_id"), F.col("root_id").alias("next"))
        step = at.join(target, "root_id", "left").select("term_id", "root_id", F.coalesce("next", "root_id").alias("next"))
        step = cut_lineage(step)
        at = step.select("term_id", F.col("next").alias("root_id"))
        if step.filter("next != root_id").isEmpty():
            break
    merged = current.filter("to is not null and to != term_id").select(F.col("term_id").alias("root_id"))
    bad = at.join(merged, "root_id", "left_semi").agg(F.count(F.lit(1)).alias("n"), F.min("term_id").alias("least")).first()
    if bad["n"]:
        raise ValueError(f"{bad['n']} terms are merged in a cycle, the first of them {bad['least']}")
    return at


def canonical_values(registry: DataFrame) -> DataFrame:
    """(term_type, raw_value, canonical_value) of current terms, the value
    being that of the term at the end of their merges; of a term split into
    parts, the first part's."""
    current = registry.filter("is_current")
    values = current.groupBy("term_id", "term_type", "raw_value").agg(F.min_by("canonical_value", "part").alias("own"))
    ends = values.select(F.col("term_id").alias("root_id"), F.col("own").alias("last"))
    return (values.join(resolve_merges(registry), "term_id").join(ends, "root_id", "left")
            .select("term_type", "raw_value", F.coalesce("last", "own").alias("canonical_value")))


def refresh_dim_topic(old: DataFrame, tuples: DataFrame, key: str = "topic_key") -> DataFrame:
    """The topic dimension after its terms changed. Keys stay with their
    tuples; tuples no longer in use stay as not current; new ones are numbered
    on from the greatest key."""
    columns = [c for c in old.columns if c not in (key, "is_current")]
    used = tuples.select(*columns).distinct()
    kept = old.select(*columns, key).join(used.withColumn("is_current", F.lit(True)), columns, "left") \
        .withColumn("is_current", F.coalesce("is_current", F.lit(False)))
    start = old.agg(F.max(key)).first()[0] or 0
    new = with_row_number(used.join(old.select(*columns), columns, "left_anti"), columns, key, start=start)
    return kept.unionByName(new.withColumn("is_current", F.lit(True)))


class TermRegistry:
    """The registry as a stored table; an upsert writes the rows that a change
    of ``replace_current`` made or ended."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8):
        self.table = BucketedTable(spark, path, "row_key", buckets, REGISTRY_DDL)

    def read(self) -> DataFrame | None:
        rows = self.table.read()
        return None if rows is None else rows.select(*COLUMNS)

    def save(self, registry: DataFrame, as_of: Column) -> DataFrame:
        """Store rows that are new or differ from the stored ones."""
        key = F.concat_ws(":", F.col("term_id").cast("string"), F.col("part").cast("string"), F.col("effective_from").cast("string"))
        old = self.read()
        rows = registry if old is None else registry.exceptAll(old)
        self.table.upsert(cut_lineage(rows.withColumn("row_key", key)), as_of=as_of, keep_first=())
        return self.read()
