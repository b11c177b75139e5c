"""Profile and topic benchmarking.

Per-owner statistics are aggregated first (partial, map-side) and joined
back, instead of windows partitioned by owner: one owner can hold a third of
all posts. Top-k per owner uses row_number <= k, which Spark plans with a
partial WindowGroupLimit before the shuffle. Exact quantiles come from one
distributed numbering per (group, value) order, never from collecting a
group's values into one buffer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import with_row_number


def post_vs_owner_avg(posts: DataFrame) -> DataFrame:
    """Likes / owner's average likes."""
    p = posts.select("post_id", "owner_id", "likes_count")
    avg = p.groupBy("owner_id").agg(F.avg("likes_count").alias("owner_avg_likes"))
    return p.join(avg, "owner_id").select(
        "post_id", "owner_id", "likes_count", "owner_avg_likes",
        F.when(F.col("owner_avg_likes") > 0,
               F.col("likes_count") / F.col("owner_avg_likes")).alias("likes_vs_avg"))


def best_worst(posts: DataFrame, k: int = 3) -> DataFrame:
    """K best and k worst posts per owner by engagement (likes+comments);
    ties broken by post_id."""
    p = posts.select("owner_id", "post_id",
                     (F.col("likes_count") + F.col("comments_count")).alias("engagement"))
    best = Window.partitionBy("owner_id").orderBy(F.desc("engagement"), "post_id")
    worst = Window.partitionBy("owner_id").orderBy("engagement", "post_id")
    b = p.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .withColumn("kind", F.lit("best"))
    w = p.withColumn("rank", F.row_number().over(worst)).filter(F.col("rank") <= k) \
        .withColumn("kind", F.lit("worst"))
    return b.unionByName(w)


def leaderboard(edges: DataFrame) -> DataFrame:
    """Per (domain, topic) the profile with the highest average
    engagement (ties: smallest owner_id), as a max_by aggregation."""
    e = edges.withColumn("avg_engagement", F.col("avg_likes") + F.col("avg_comments"))
    best = F.min_by(F.struct("owner_id", "owner_username", "avg_engagement"),
                    F.struct(-F.col("avg_engagement"), F.col("owner_id"))).alias("b")
    return e.groupBy("domain", "topic").agg(best).select("domain", "topic", "b.*")


def exact_quantiles(df: DataFrame, group: str, value: str,
                    probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Continuous quantiles (linear interpolation) per group, exact.

    Values are numbered once in (group, value) order (distributed); per
    group only n and the first number are aggregated; each requested rank
    is then picked by an equi-join on the number."""
    n = with_row_number(df.select(group, value), [F.col(group), F.col(value)], "_g")
    stats = n.groupBy(group).agg(F.min("_g").alias("_first"), F.count(F.lit(1)).alias("_n"))
    rows = []
    for p in probs:
        pos = (F.col("_n") - 1) * F.lit(p)
        rows.append(F.struct(F.lit(p).alias("p"), pos.alias("pos")))
    want = stats.select(group, "_first", "_n", F.explode(F.array(*rows)).alias("q")) \
        .select(group, "_first", "_n", "q.p", "q.pos",
                (F.col("_first") + F.floor("q.pos")).alias("_lo"),
                (F.col("_first") + F.ceil("q.pos")).alias("_hi"))
    vals = n.select(F.col("_g"), F.col(value).alias("_v"))
    lo = vals.withColumnRenamed("_g", "_lo").withColumnRenamed("_v", "_vlo")
    hi = vals.withColumnRenamed("_g", "_hi").withColumnRenamed("_v", "_vhi")
    j = want.join(lo, "_lo").join(hi, "_hi")
    frac = F.col("pos") - F.floor("pos")
    return j.select(group, "p", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac)
                    .alias("value"))


def topic_quartiles(edges: DataFrame) -> DataFrame:
    """Quartiles across profiles of per-(topic, owner) average likes."""
    e = edges.groupBy("topic", "owner_id").agg(F.avg("avg_likes").alias("owner_avg"))
    q = exact_quantiles(e, "topic", "owner_avg")
    return q.groupBy("topic").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value")) \
        .select("topic", F.round(F.col("`0.25`"), 6).alias("q1"),
                F.round(F.col("`0.5`"), 6).alias("median"),
                F.round(F.col("`0.75`"), 6).alias("q3"))


def profile_benchmark(posts: DataFrame, gold_analysed: DataFrame,
                      content_type: str | None = None, high_confidence: bool = False) -> DataFrame:
    """Per (domain, owner) posts and average likes against the
    domain's average across profiles, with optional dashboard filters."""
    g = gold_analysed.select("post_id", F.col("result.domain").alias("domain"),
                             F.col("result.content_type").alias("content_type"),
                             F.col("result.admirality").alias("admirality"))
    if content_type is not None:
        g = g.filter(F.col("content_type") == content_type)
    if high_confidence:
        from ..functions.credibility import is_high_confidence
        g = g.filter(is_high_confidence(F.col("admirality")))
    p = posts.select("post_id", "owner_id", "likes_count").join(g, "post_id")
    per = p.groupBy("domain", "owner_id").agg(F.count(F.lit(1)).alias("posts"),
                                              F.avg("likes_count").alias("avg_likes"))
    dom = per.groupBy("domain").agg(F.avg("avg_likes").alias("domain_avg_likes"))
    return per.join(dom, "domain").select(
        "domain", "owner_id", "posts", F.round("avg_likes", 6).alias("avg_likes"),
        F.round("domain_avg_likes", 6).alias("domain_avg_likes"),
        F.round(F.col("avg_likes") / F.col("domain_avg_likes"), 6).alias("vs_domain"))


def topic_overlap(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """The topics that two profiles share, for every given pair (src, dst):
    each pair meets the topics of its first profile, then that topic of its
    second. Work is linear in pairs x topics of a profile."""
    one = edges.select("domain", "topic", F.col("owner_id").alias("owner_a"), F.col("post_count").alias("posts_a"))
    two = edges.select("domain", "topic", F.col("owner_id").alias("owner_b"), F.col("post_count").alias("posts_b"))
    given = pairs.select(F.col("src").alias("owner_a"), F.col("dst").alias("owner_b"))
    return given.join(one, "owner_a").join(two, ["owner_b", "domain", "topic"])


def cooccurring_resources(named: DataFrame) -> DataFrame:
    """For every two resources named in one post, the posts that name both
    and their profiles. ``named``: (post_id, owner_id, names), the list of a
    post's resource names; pairs are made inside that list only."""
    n = named.select("post_id", "owner_id", F.array_sort(F.array_distinct(F.filter("names", lambda x: x != ""))).alias("n"))
    pairs = F.flatten(F.transform("n", lambda x, i: F.transform(
        F.slice("n", i + 2, F.size("n")), lambda y: F.struct(x.alias("resource_a"), y.alias("resource_b")))))
    return (n.select("post_id", "owner_id", F.inline(pairs)).groupBy("resource_a", "resource_b")
            .agg(F.count(F.lit(1)).alias("shared_posts"), F.count_distinct("owner_id").alias("shared_profiles")))
