"""Registered queries: scrape planning (W6, W10-W12, P25, A12) and
benchmarking (W7, W8, A13-A15, V10, F12, J12, J13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import benchmark as BM
from ..operators import dims as D
from ..operators import graph as GR
from ..operators import planning as PL
from ..sources import bronze as B
from . import views as V
from .medallion import Medallion
from .registry import query
from .star import Star

LANDED_AT, SILVERED_AT = "2025-06-01 00:00:00", "2025-06-01 01:00:00"


def _needing(spark, sf_dir):
    s = Star(spark, sf_dir)
    return V.profiles_needing_meta(s.posts(), s.profiles())


@query("tier_batches")
def q_tier_batches(spark, sf_dir):
    return PL.batches(PL.plan_batches(_needing(spark, sf_dir)))


@query("batch_cost_cumulative")
def q_batch_cost_cumulative(spark, sf_dir):
    return PL.cumulative_cost(PL.batches(PL.plan_batches(_needing(spark, sf_dir))))


@query("one_batch_per_profile")
def q_one_batch_per_profile(spark, sf_dir):
    t = PL.assign_tiers(_needing(spark, sf_dir))
    tiers = t.select("owner_username", "tier_rank", "tier", "results_limit")
    # A second, overlapping hand list: every profile also listed as tail.
    tail = t.select("owner_username", F.lit(3).alias("tier_rank"), F.lit("tail").alias("tier"),
                    F.lit(10).alias("results_limit"))
    return PL.one_batch_per_profile(tiers.unionByName(tail))


@query("sub_batches")
def q_sub_batches(spark, sf_dir):
    return PL.sub_batches(_needing(spark, sf_dir), 25)


@query("batch_ledger")
def q_batch_ledger(spark, sf_dir):
    """The planned batches' posts are landed, one dataset a batch, and
    silvered; the ledger comes from the manifest, progress and silver rows
    that these runs wrote."""
    s = Star(spark, sf_dir)
    posts = s.posts()
    planned = PL.plan_batches(V.profiles_needing_meta(posts, s.profiles()))
    m = Medallion(spark)
    B.land(PL.batch_datasets(planned, posts), m.bronze, downloaded_at=F.lit(LANDED_AT), order_by="post_id")
    m.deduplicate_all(F.lit(SILVERED_AT))
    return PL.ledger_totals(PL.ledger(B.read_manifest(spark, m.bronze), m.progress(), m.silver_posts()))


@query("post_vs_profile_avg")
def q_post_vs_profile_avg(spark, sf_dir):
    r = BM.post_vs_owner_avg(Star(spark, sf_dir).posts())
    return r.select("post_id", "owner_id", "likes_count",
                    F.round("owner_avg_likes", 6).alias("owner_avg_likes"),
                    F.round("likes_vs_avg", 6).alias("likes_vs_avg"))


@query("best_worst_posts")
def q_best_worst_posts(spark, sf_dir):
    return BM.best_worst(Star(spark, sf_dir).posts(), 3)


def _edges(spark, sf_dir):
    s = Star(spark, sf_dir)
    return V.profile_topic_edges(s.posts(), s.profiles(), s.gold())


@query("topic_leaderboard")
def q_topic_leaderboard(spark, sf_dir):
    r = BM.leaderboard(_edges(spark, sf_dir))
    return r.withColumn("avg_engagement", F.round("avg_engagement", 6))


@query("topic_quartiles")
def q_topic_quartiles(spark, sf_dir):
    return BM.topic_quartiles(_edges(spark, sf_dir))


@query("profile_benchmark")
def q_profile_benchmark(spark, sf_dir):
    s = Star(spark, sf_dir)
    return BM.profile_benchmark(s.posts(), V.analysed(s.gold()), content_type="tutorial")


@query("profile_benchmark_all")
def q_profile_benchmark_all(spark, sf_dir):
    s = Star(spark, sf_dir)
    return BM.profile_benchmark(s.posts(), V.analysed(s.gold()))


@query("topic_overlap")
def q_topic_overlap(spark, sf_dir):
    """Topics that related profiles share."""
    s = Star(spark, sf_dir)
    latest = D.dim_profile_from_posts(s.posts(), F.lit("2025-05-01 00:00:00"))
    return BM.topic_overlap(_edges(spark, sf_dir), GR.related_edges(latest, V.current_profiles(s.profiles())))


@query("resource_cooccurrence")
def q_resource_cooccurrence(spark, sf_dir):
    """Resources named together, over the posts of current profiles."""
    s = Star(spark, sf_dir)
    names = V.analysed(s.gold()).select("post_id", F.transform("result.actionable_json.resources", lambda r: r["name"]).alias("names"))
    known = V.current_profiles(s.profiles()).select("owner_id")
    return BM.cooccurring_resources(s.posts().select("post_id", "owner_id").join(known, "owner_id", "left_semi").join(names, "post_id"))
