"""Star views over a small bakery feed: keys, ratios, statistics, edges."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import dims as D
from tessera.plans import views as V
from tessera.schemas import ANALYSIS_DDL

POST_COLUMNS = ("post_id string, shortcode string, url string, caption string, owner_id string, owner_username string, "
                "likes_count bigint, comments_count bigint, video_play_count bigint, video_view_count bigint, ts string, hashtags array<string>")


def post(post_id, owner, likes, comments, plays, views, day, tags, caption="fresh bread today"):
    return (post_id, f"code-{post_id}", f"https://feed.test/{post_id}", caption, owner, f"baker_{owner}", likes, comments, plays, views, f"{day} 08:30:00", tags)


def analysis(code, domain, topic, resources=(), **more):
    return {"is_educational": bool(resources), "is_actionable": False, "admirality": code, "domain": domain, "subdomain": "",
            "topic": topic, "subtopic": "", "content_type": "recipe", "style": "", "format": "single",
            "educational_json": {}, "actionable_json": {"summary": "", "resources": [dict(zip(("name", "url", "type", "purpose"), r)) for r in resources]},
            "transcript": "", **more}


@pytest.fixture(scope="module")
def star(spark):
    from tessera.functions.text import engagement_bait
    rows = [post("p7", "k9", 40, 8, 90, 60, "2024-02-29", ["rye", "oven"], "DM me the word RYE"),
            post("p8", "k9", 10, 0, 0, 0, "2024-12-31", ["rye", "oven"]),
            post("p9", "m2", 0, 3, 5, 0, "2024-12-31", []),
            post("p10", "zz", 6, 6, 1, 2, "2025-01-01", None)]  # zz is no known profile
    posts = (spark.createDataFrame(rows, POST_COLUMNS).withColumn("timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts")
             .withColumn("has_engagement_bait", engagement_bait(F.col("caption"))).withColumn("silvered_at", F.col("timestamp")))
    told = [("p7", 3, "analysed", analysis("B2", "bread", "sourdough", [("Oven Guide", "o.test", "book", ""), ("", "x.test", "site", "")])),
            ("p8", 3, "analysed", analysis("F6", "bread", "sourdough", [("Oven Guide", "o.test", "book", "")])),
            ("p9", 2, "analysed", analysis("C3", "", "none")),
            ("p10", 3, "failed", analysis("A1", "cake", "glaze"))]
    gold = (spark.createDataFrame([(*t[:3], json.dumps(t[3])) for t in told], "post_id string, schema_version int, status string, j string")
            .withColumn("result", F.from_json("j", ANALYSIS_DDL)).drop("j").withColumn("analysed_at", F.lit("2025-03-04 05:06:07").cast("timestamp_ntz")))
    profiles = spark.createDataFrame([(31, "k9", "baker_k9", True, 12), (32, "m2", "baker_m2", True, None), (12, "m2", "old_name", False, 4)],
                                     "profile_key bigint, owner_id string, owner_username string, is_current boolean, follower_count bigint")
    return posts, profiles, D.dim_time(posts), gold


def test_facts_keep_every_post(star):
    posts, profiles, dt, gold = star
    f = {r.post_id: r for r in V.fact_post(posts, profiles, dt, gold).collect()}
    assert sorted(f) == ["p10", "p7", "p8", "p9"]
    assert [f[p].profile_key for p in ("p7", "p8", "p9", "p10")] == [31, 31, 32, None]
    assert [f[p].time_key for p in ("p7", "p9", "p10")] == [20240229, 20241231, 20250101]
    assert (f["p7"].play_view_ratio, f["p9"].play_view_ratio, f["p10"].play_view_ratio) == (1.5, None, 0.5)
    assert abs(f["p7"].comment_like_ratio - 0.2) < 1e-6 and f["p9"].comment_like_ratio is None and f["p8"].comment_like_ratio == 0
    assert (f["p8"].admirality, f["p8"].topic, f["p9"].domain) == ("F6", "sourdough", "")
    assert f["p10"].admirality is None and f["p10"].result_json is None  # failed analyses do not count
    assert json.loads(f["p7"].result_json)["analysis"]["admirality"] == "B2"


def test_profile_statistics(star):
    posts, profiles, _, _ = star
    s = {r.owner_id: r for r in V.profile_stats(posts, profiles).collect()}
    assert sorted(s) == ["k9", "m2"]
    assert (s["k9"].post_count, s["k9"].avg_likes, s["k9"].avg_plays, s["k9"].bait_post_count) == (2, 25.0, 45.0, 1)
    assert s["k9"].all_hashtags == ['["rye","oven"]'] and s["m2"].all_hashtags == ["[]"]
    assert (str(s["k9"].first_post_at), str(s["k9"].last_post_at)) == ("2024-02-29 08:30:00", "2024-12-31 08:30:00")
    tags = {r.owner_id: r.hashtags for r in V.profile_hashtags(posts, profiles).collect()}
    assert tags == {"k9": ["oven", "rye"]}


def test_topics_and_edges(star):
    posts, profiles, _, gold = star
    t = V.topic_stats(posts, gold).collect()
    assert [(r.domain, r.topic, r.post_count, r.profile_count, r.avg_likes) for r in t] == [("bread", "sourdough", 2, 1, 25.0)]
    e = V.profile_topic_edges(posts, profiles, gold).collect()
    assert [(r.owner_username, r.topic, r.post_count, str(r.last_post_at)) for r in e] == [("baker_k9", "sourdough", 2, "2024-12-31 08:30:00")]
    r = V.profile_resource_edges(posts, profiles, gold).collect()
    assert [(x.owner_id, x.resource_name, x.resource_type, x.post_count) for x in r] == [("k9", "Oven Guide", "book", 2)]


def test_dates_are_not_added_twice(star):
    posts, _, dt, _ = star
    assert dt.count() == 3 and D.dim_time(posts, existing=dt).count() == 3


def test_profiles_from_posts(star):
    posts, _, _, _ = star
    d = D.dim_profile_from_posts(posts.withColumn("meta_data", F.lit(None).cast("variant")), F.lit("2025-01-01").cast("timestamp_ntz"))
    assert sorted((r.profile_key, r.owner_username, r.is_current) for r in d.collect()) == [(1, "baker_k9", True), (2, "baker_m2", True), (3, "baker_zz", True)]


def test_refresh_views_registers_all(star):
    posts, profiles, dt, gold = star
    V.refresh_views(posts, profiles, dt, gold)
    assert posts.sparkSession.table("fact_post").count() == 4
