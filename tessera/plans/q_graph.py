"""Registered queries: graph exports and algorithms (S15, G1-G4, J14) and the
taxonomy registry (T1-T10, J15, J16, M10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims as D
from ..operators import graph as GR
from ..operators import taxonomy as TX
from ..operators import term_registry as TR
from ..session import cut_lineage, shared_path, staged
from . import views as V
from .registry import query
from .star import Star

AS_OF = "2025-05-01 00:00:00"
# Test thresholds: the fixture's largest pair cosine is about 0.5, so the
# production thresholds (0.95 / 0.85) select nothing; unit tests cover them.
FIXTURE_AUTO, FIXTURE_REVIEW = 0.40, 0.30


def _related(s):
    latest = D.dim_profile_from_posts(s.posts(), F.lit(AS_OF))
    return GR.related_edges(latest, V.current_profiles(s.profiles()))


@query("related_profile_edges")
def q_related_profile_edges(spark, sf_dir):
    return _related(Star(spark, sf_dir))


@query("edge_export")
def q_edge_export(spark, sf_dir):
    s = Star(spark, sf_dir)
    posts, prof, gold = s.posts(), s.profiles(), s.gold()
    e = GR.typed_edges(V.profile_topic_edges(posts, prof, gold),
                       V.profile_resource_edges(posts, prof, gold), _related(s))
    path = shared_path(spark, "graph")
    e.write.parquet(path + "/edges")
    GR.vertices(e).write.parquet(path + "/vertices")
    e.write.option("header", True).csv(path + "/edges_csv")
    return spark.read.parquet(path + "/edges")


@query("pagerank")
def q_pagerank(spark, sf_dir):
    r = GR.pagerank(_related(Star(spark, sf_dir)), iterations=10)
    return r.select("node", F.round("rank", 10).alias("rank"))


@query("communities")
def q_communities(spark, sf_dir):
    return GR.connected_components(_related(Star(spark, sf_dir)))


@query("label_communities")
def q_label_communities(spark, sf_dir):
    return GR.label_propagation(_related(Star(spark, sf_dir)), max_rounds=6)


@query("profile_jaccard")
def q_profile_jaccard(spark, sf_dir):
    s = Star(spark, sf_dir)
    posts, prof, gold = s.posts(), s.profiles(), s.gold()
    topics = V.profile_topic_edges(posts, prof, gold).select(
        "owner_id", F.concat(F.lit("topic:"), "domain", F.lit("/"), "topic").alias("token"))
    res = V.profile_resource_edges(posts, prof, gold).select(
        "owner_id", F.concat(F.lit("resource:"), "resource_name").alias("token"))
    tags = posts.select("owner_id", F.explode("hashtags").alias("t")) \
        .select("owner_id", F.concat(F.lit("tag:"), "t").alias("token"))
    return GR.jaccard_on_edges(_related(s), topics.unionByName(res).unionByName(tags))


@query("taxonomy_terms_exact")
def q_taxonomy_terms_exact(spark, sf_dir):
    t = TX.exact_dedup(TX.raw_terms(V.analysed(Star(spark, sf_dir).gold())))
    return t.select("term_id", "term_type", "raw_value", "canonical_value", "review_status")


def _pairs(s):
    u = TX.unit_vectors(s.cat.embeddings, "vec_id", "embedding", "label")
    # Staged: clusters and the review read the pairs several times each.
    return TX.classify(staged(TX.similar_pairs(u, FIXTURE_REVIEW), "pairs"), FIXTURE_AUTO, FIXTURE_REVIEW), u


@query("term_similarity_pairs")
def q_term_similarity_pairs(spark, sf_dir):
    u = TX.unit_vectors(Star(spark, sf_dir).cat.embeddings, "vec_id", "embedding", "label")
    p = TX.classify(TX.similar_pairs(u, FIXTURE_REVIEW), FIXTURE_AUTO, FIXTURE_REVIEW)
    return p.select("block", "id_a", "id_b", F.round("cosine", 6).alias("cosine"), "status")


@query("taxonomy_clusters")
def q_taxonomy_clusters(spark, sf_dir):
    p, u = _pairs(Star(spark, sf_dir))
    return TX.clusters(p, u)


@query("taxonomy_review")
def q_taxonomy_review(spark, sf_dir):
    p, u = _pairs(Star(spark, sf_dir))
    return TX.review_queue(p, TX.clusters(p, u))


@query("taxonomy_apply")
def q_taxonomy_apply(spark, sf_dir):
    s = Star(spark, sf_dir)
    p, u = _pairs(s)
    rq = TX.review_queue(p, TX.clusters(p, u))
    # One decision per proposed term (its best-scoring proposal).
    best = rq.groupBy(F.col("proposed_id").alias("term_id")).agg(
        F.max_by(F.struct("canonical_id", "score"), F.struct("score", "canonical_id")).alias("b"))
    decisions = staged(best.select("term_id", F.col("b.canonical_id").alias("canonical_id"),
                                   F.when(F.col("b.score") >= 0.35, "approve").otherwise("reject")
                                   .alias("decision")), "decisions")
    e = s.cat.embeddings.select("vec_id", "label")
    terms = e.select(F.col("vec_id").alias("term_id"),
                     F.concat(F.lit("label_"), F.col("label").cast("string")).alias("term_type"),
                     F.concat(F.lit("term_"), F.col("vec_id").cast("string")).alias("raw_value"),
                     F.concat(F.lit("term_"), F.col("vec_id").cast("string"))
                     .alias("canonical_value"),
                     F.lit(TX.DEFAULT_STATUS).alias("review_status"),
                     F.lit(None).cast("bigint").alias("merged_into_id"),
                     F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("effective_from"),
                     F.lit(None).cast("timestamp_ntz").alias("effective_to"),
                     F.lit(True).alias("is_current"))
    out = TX.apply_decisions(terms, decisions, F.lit(AS_OF))
    return out.select("term_id", "review_status", "merged_into_id", "is_current",
                      "effective_from", "effective_to")


@query("dim_topic")
def q_dim_topic(spark, sf_dir):
    return TX.dim_topic(V.analysed(Star(spark, sf_dir).gold()))


@query("fact_post_canonical")
def q_fact_post_canonical(spark, sf_dir):
    """The fact with topic_key and the canonical value of all seven
    term types (the raw value where the registry has no entry). Terms of a
    post go through the registry in one join."""
    s = Star(spark, sf_dir)
    ga = V.analysed(s.gold())
    cm = TX.canonical_map(TX.exact_dedup(TX.raw_terms(ga)).withColumn("is_current", F.lit(True)))
    raw = ga.select("post_id", *[F.col(f"result.{t}").alias(t) for t in TX.TERM_TYPES])
    keyed = raw.select("post_id", *[F.coalesce(F.col(t), F.lit("")).alias(t) for t in TX.TERM_TYPES]) \
        .join(TX.dim_topic(ga), TX.TERM_TYPES, "left").select("post_id", "topic_key")
    terms = raw.select("post_id", F.explode(F.array(*[
        F.struct(F.lit(t).alias("term_type"), F.col(t).alias("raw_value")) for t in TX.TERM_TYPES])).alias("x")).select("post_id", "x.*")
    canonical = (terms.join(cm, ["term_type", "raw_value"], "left")
                 .withColumn("value", F.coalesce("canonical_value", "raw_value"))
                 .groupBy("post_id").agg(*[F.max(F.when(F.col("term_type") == t, F.col("value"))).alias(f"{t}_canonical")
                                           for t in TX.TERM_TYPES]))
    fact = V.fact_post(s.posts(), s.profiles(), s.dim_time(), s.gold())
    return fact.join(keyed, "post_id", "left").join(canonical, "post_id", "left")


SINCE = "2025-01-01 00:00:00"
SPLIT_AUTO, SPLIT_APPROVE = 0.32, 0.31


@query("taxonomy_split")
def q_taxonomy_split(spark, sf_dir):
    """Clusters as a stored registry; reviews (approve, reject, split
    into parts) and cuts of merges applied to it. The decisions stand in for a
    reviewer's: proposals are approved by score, lone terms with an id of 7 mod
    25 are split in two, and clusters of three or more lose their weakest merge."""
    s = Star(spark, sf_dir)
    units = TX.unit_vectors(s.cat.embeddings, "vec_id", "embedding", "label")
    pairs = TX.classify(staged(TX.similar_pairs(units, FIXTURE_REVIEW), "pairs"), SPLIT_AUTO, FIXTURE_REVIEW)
    clusters = cut_lineage(TX.clusters(pairs, units))
    edges = pairs.filter("status = 'auto_merged'").select("id_a", "id_b", "cosine")
    terms = s.cat.embeddings.select(F.col("vec_id").alias("term_id"), F.concat(F.lit("label_"), F.col("label").cast("string")).alias("term_type"),
                                    F.concat(F.lit("term_"), F.col("vec_id").cast("string")).alias("raw_value"))
    store = TR.TermRegistry(spark, shared_path(spark, "terms"))
    stored = store.save(TR.cluster_rows(terms, clusters, edges, F.lit(SINCE)), F.lit(SINCE))

    proposals = staged(TX.review_queue(pairs, clusters).groupBy(F.col("proposed_id").alias("term_id")).agg(
        F.max_by(F.struct("canonical_id", "score"), F.struct("score", "canonical_id")).alias("b")), "proposals")
    reviewed = proposals.select("term_id", "b.canonical_id", "b.score", F.when(F.col("b.score") >= SPLIT_APPROVE, "approve").otherwise("reject").alias("decision"),
                                F.lit(None).cast("array<string>").alias("parts"))
    size = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    sized = clusters.join(size, "component")
    lone = (sized.filter("n = 1 and node % 25 = 7").select(F.col("node").alias("term_id")).join(reviewed, "term_id", "left_anti")
            .select("term_id", F.lit(None).cast("bigint").alias("canonical_id"), F.lit(None).cast("double").alias("score"), F.lit("split").alias("decision"),
                    F.array(*[F.concat(F.lit("term_"), F.col("term_id").cast("string"), F.lit(x)) for x in ("_a", "_b")]).alias("parts")))
    # The weakest of each term first: a task's many edges are few before they are shuffled.
    weakest = edges.groupBy("id_a").agg(F.min(F.struct(F.round("cosine", 9).alias("cosine"), "id_a", "id_b")).alias("e"))
    cuts = (weakest.join(sized.filter("n >= 3").select(F.col("node").alias("id_a"), "component"), "id_a").groupBy("component")
            .agg(F.min("e").alias("e")).select("e.id_a", "e.id_b"))
    after = store.save(TR.apply_reviews(stored, reviewed.unionByName(lone), F.lit(AS_OF)), F.lit(AS_OF))
    done, _ = TR.cut_merges(after, clusters, edges, cuts, F.lit(AS_OF))
    return store.save(done, F.lit(AS_OF))


def _merged_terms(s):
    """The raw terms as a stored registry after reviews that merge each term of
    a type into the one before it, in chains of four (stand-in decisions).
    Returns (analysed rows, their seven raw terms, canonical values)."""
    ga = V.analysed(s.gold())
    terms = cut_lineage(TX.exact_dedup(TX.raw_terms(ga)))
    store = TR.TermRegistry(s.spark, shared_path(s.spark, "terms"))
    stored = store.save(TR.first_rows(terms, F.lit(SINCE)), F.lit(SINCE))
    first = terms.groupBy("term_type").agg(F.min("term_id").alias("first"))
    chained = terms.join(first, "term_type").filter((F.col("term_id") - F.col("first")) % 4 != 0)
    decisions = chained.select("term_id", (F.col("term_id") - 1).alias("canonical_id"), F.lit(None).cast("double").alias("score"),
                               F.lit("approve").alias("decision"), F.lit(None).cast("array<string>").alias("parts"))
    registry = store.save(TR.apply_reviews(stored, decisions, F.lit(AS_OF)), F.lit(AS_OF))
    raw = ga.select("post_id", *[F.col(f"result.{t}").alias(t) for t in TX.TERM_TYPES])
    return ga, raw, TR.canonical_values(registry)


def _canonical_posts(raw, values):
    """(post_id, canonical value of each term type), the raw value where the registry has none."""
    terms = raw.select("post_id", F.explode(F.array(*[
        F.struct(F.lit(t).alias("term_type"), F.col(t).alias("raw_value")) for t in TX.TERM_TYPES])).alias("x")).select("post_id", "x.*")
    return (terms.join(values, ["term_type", "raw_value"], "left").withColumn("value", F.coalesce("canonical_value", "raw_value"))
            .groupBy("post_id").agg(*[F.max(F.when(F.col("term_type") == t, F.col("value"))).alias(t) for t in TX.TERM_TYPES]))


def _topics(posts):
    return posts.select("post_id", *[F.coalesce(F.col(t), F.lit("")).alias(t) for t in TX.TERM_TYPES])


@query("dim_topic_refreshed")
def q_dim_topic_refreshed(spark, sf_dir):
    """The topic dimension after merges: old keys kept, new tuples numbered on."""
    ga, raw, values = _merged_terms(Star(spark, sf_dir))
    return TR.refresh_dim_topic(TX.dim_topic(ga), _topics(_canonical_posts(raw, values)))


@query("fact_post_merged")
def q_fact_post_merged(spark, sf_dir):
    """The fact with canonical values that follow approved merges, and
    the key of the refreshed topic dimension."""
    s = Star(spark, sf_dir)
    ga, raw, values = _merged_terms(s)
    posts = cut_lineage(_canonical_posts(raw, values))
    dim = TR.refresh_dim_topic(TX.dim_topic(ga), _topics(posts)).filter("is_current")
    keyed = _topics(posts).join(dim, TX.TERM_TYPES, "left").select("post_id", "topic_key")
    fact = V.fact_post(s.posts(), s.profiles(), s.dim_time(), s.gold())
    return fact.join(keyed, "post_id", "left").join(posts.select("post_id", *[F.col(t).alias(f"{t}_canonical") for t in TX.TERM_TYPES]), "post_id", "left")
