"""Gold views (V1-V7) as DataFrame functions over the star tables.

Join strategy: dim_time is broadcast explicitly (one row per calendar day, a
bound independent of data volume). Profiles and analyses grow with the data,
so their joins are left to AQE, which broadcasts at runtime only when the
measured size is under the threshold and otherwise sort-merges (splitting
skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import guarded_ratio


def analysed(gold: DataFrame) -> DataFrame:
    """Right side of every analysis join, filtered before joining."""
    return gold.filter(F.col("status") == "analysed")


def current_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("is_current"))


def _obj_json(c):
    """JSON text of a sub-object; an absent object renders as '{}'."""
    return F.coalesce(F.to_json(c), F.lit("{}"))


def fact_post(posts: DataFrame, profiles: DataFrame, dim_time: DataFrame,
              gold: DataFrame) -> DataFrame:
    """V1: every silver row once, with keys, ratios and analysis attributes.
    result_json holds the original document where gold has it (fields outside
    the contract included), else the typed result."""
    sp = posts.select("post_id", "owner_id", "timestamp", "shortcode", "url", "likes_count",
                      "comments_count", "video_play_count", "video_view_count",
                      "has_engagement_bait")
    dp = current_profiles(profiles).select("owner_id", "profile_key")
    dt = F.broadcast(dim_time.select(F.col("date").alias("_date"), "time_key"))
    documents = ["document"] if "document" in gold.columns else []
    ga = analysed(gold).select(F.col("post_id").alias("_gid"), "schema_version", "result",
                               "analysed_at", *documents)
    j = (sp.join(dp, "owner_id", "left")
         .join(dt, F.to_date(sp.timestamp) == F.col("_date"), "left")
         .join(ga, F.col("post_id") == F.col("_gid"), "left"))
    a = F.col("result")

    def document(analysis):
        return F.to_json(F.when(analysis.isNotNull(), F.struct(
            F.col("post_id"), F.col("url"), F.col("schema_version"),
            F.date_format("analysed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("analysed_at"),
            analysis.alias("analysis"))))

    return j.select(
        "post_id", "profile_key", "time_key", "shortcode", "url",
        "likes_count", "comments_count", "video_play_count", "video_view_count",
        guarded_ratio(F.col("video_play_count"), F.col("video_view_count")).alias("play_view_ratio"),
        guarded_ratio(F.col("comments_count"), F.col("likes_count")).alias("comment_like_ratio"),
        "schema_version", "has_engagement_bait",
        a["admirality"].alias("admirality"),
        a["is_educational"].alias("is_educational"),
        a["is_actionable"].alias("is_actionable"),
        a["domain"].alias("domain"), a["subdomain"].alias("subdomain"), a["topic"].alias("topic"),
        a["content_type"].alias("content_type"), a["style"].alias("style"),
        a["format"].alias("format"),
        F.when(a.isNotNull(), _obj_json(a["educational_json"])).alias("educational_json"),
        F.when(a.isNotNull(), _obj_json(a["actionable_json"])).alias("actionable_json"),
        a["transcript"].alias("transcript"),
        F.coalesce(*[document(F.col(c)) for c in [*documents, "result"]]).alias("result_json"),
    )


def profile_stats(posts: DataFrame, profiles: DataFrame) -> DataFrame:
    """V2: per current profile post counts, time span, averages, bait count and
    the distinct hashtag lists (as JSON text, sorted)."""
    sp = posts.select("owner_id", "timestamp", "likes_count", "comments_count",
                      "video_play_count", "video_view_count", "has_engagement_bait")
    dp = current_profiles(profiles).select("owner_id", "owner_username")
    per = sp.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.min("timestamp").alias("first_post_at"),
        F.max("timestamp").alias("last_post_at"),
        F.avg("likes_count").alias("avg_likes"),
        F.avg("comments_count").alias("avg_comments"),
        F.avg("video_play_count").alias("avg_plays"),
        F.avg("video_view_count").alias("avg_views"),
        F.count_if("has_engagement_bait").alias("bait_post_count"))
    lists = hashtag_lists(posts).groupBy("owner_id").agg(F.array_sort(F.collect_list("hashtag_list")).alias("all_hashtags"))
    none = F.array().cast("array<string>")
    return per.join(dp, "owner_id").join(lists, "owner_id", "left").select(
        "owner_id", "owner_username", *[c for c in per.columns if c != "owner_id"],
        F.coalesce("all_hashtags", none).alias("all_hashtags"))


def hashtag_lists(posts: DataFrame) -> DataFrame:
    """The distinct hashtag lists (JSON text) of each owner, one a row: the form
    to use where an owner has more lists than fit a cell."""
    return posts.select("owner_id", F.to_json("hashtags").alias("hashtag_list")).filter("hashtag_list is not null").distinct()


def profile_hashtags(posts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every distinct individual hashtag per current profile, sorted.
    Tags are exploded and de-duplicated per (owner, tag) before grouping, so a
    prolific owner never holds its raw tag lists in one buffer."""
    sp = posts.select("owner_id", F.explode("hashtags").alias("tag"))
    dp = current_profiles(profiles).select("owner_id", "owner_username")
    return (sp.join(dp, "owner_id").select("owner_id", "owner_username", "tag").distinct()
            .groupBy("owner_id", "owner_username")
            .agg(F.array_sort(F.collect_list("tag")).alias("hashtags")))


def _domain_topic(gold: DataFrame) -> DataFrame:
    g = analysed(gold).select("post_id", F.col("result.domain").alias("domain"),
                              F.col("result.topic").alias("topic"))
    return g.filter(F.col("domain") != "")


def topic_stats(posts: DataFrame, gold: DataFrame) -> DataFrame:
    """V3: per (domain, topic) post and distinct-profile counts, averages."""
    sp = posts.select("post_id", "owner_id", "likes_count", "comments_count")
    return _domain_topic(gold).join(sp, "post_id").groupBy("domain", "topic").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.count_distinct("owner_id").alias("profile_count"),
        F.avg("likes_count").alias("avg_likes"),
        F.avg("comments_count").alias("avg_comments"),
    )


def profile_topic_edges(posts: DataFrame, profiles: DataFrame, gold: DataFrame,
                        with_plays: bool = False) -> DataFrame:
    """V4 (and A3b with plays): profile -> (domain, topic) edge weights."""
    sp = posts.select("post_id", "owner_id", "likes_count", "comments_count",
                      "video_play_count", "timestamp")
    dp = current_profiles(profiles).select("owner_id", "owner_username")
    aggs = [F.count(F.lit(1)).alias("post_count"), F.avg("likes_count").alias("avg_likes"),
            F.avg("comments_count").alias("avg_comments")]
    if with_plays:
        aggs.append(F.avg("video_play_count").alias("avg_plays"))
    aggs.append(F.max("timestamp").alias("last_post_at"))
    return (sp.join(_domain_topic(gold), "post_id").join(dp, "owner_id")
            .groupBy("owner_id", "owner_username", "domain", "topic").agg(*aggs))


def profile_resource_edges(posts: DataFrame, profiles: DataFrame, gold: DataFrame) -> DataFrame:
    """V5: profile -> resource edges from the exploded actionable resources; a
    post naming a resource twice counts twice."""
    sp = posts.select("post_id", "owner_id")
    dp = current_profiles(profiles).select("owner_id", "owner_username")
    r = (analysed(gold)
         .select("post_id", F.explode("result.actionable_json.resources").alias("r"))
         .select("post_id", F.col("r.name").alias("resource_name"),
                 F.col("r.url").alias("resource_url"), F.col("r.type").alias("resource_type"))
         .filter(F.col("resource_name") != ""))
    return (r.join(sp, "post_id").join(dp, "owner_id")
            .groupBy("owner_id", "owner_username", "resource_name", "resource_url",
                     "resource_type")
            .agg(F.count(F.lit(1)).alias("post_count")))


def profiles_needing_meta(posts: DataFrame, profiles: DataFrame) -> DataFrame:
    """V7: usernames with posts whose current profile lacks follower counts."""
    sp = posts.select("owner_id", "owner_username") \
        .filter(F.col("owner_username").isNotNull() & (F.col("owner_username") != ""))
    dp = current_profiles(profiles).select("owner_id", "follower_count")
    return (sp.join(dp, "owner_id", "left").filter(F.col("follower_count").isNull())
            .groupBy("owner_username").agg(F.count(F.lit(1)).alias("post_count")))


def refresh_views(posts: DataFrame, profiles: DataFrame, dim_time: DataFrame,
                  gold: DataFrame) -> dict:
    """V6: register the five views for SQL users."""
    fact_post(posts, profiles, dim_time, gold).createOrReplaceTempView("fact_post")
    profile_stats(posts, profiles).createOrReplaceTempView("profile_stats")
    topic_stats(posts, gold).createOrReplaceTempView("topic_stats")
    profile_topic_edges(posts, profiles, gold).createOrReplaceTempView("profile_topic_edges")
    profile_resource_edges(posts, profiles, gold).createOrReplaceTempView("profile_resource_edges")
    return {"views_created": 5}
