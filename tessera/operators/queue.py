"""Enrichment work queue (E1, J8, O1, F7, E6): posts still to analyse.

Pending = silver LEFT ANTI (analyses with status 'analysed'); status is
never NULL, so this equals the reference's LEFT JOIN ... IS NULL OR status
!= 'analysed' without a null-aware anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(posts: DataFrame, gold: DataFrame) -> DataFrame:
    done = gold.filter(F.col("status") == "analysed").select("post_id")
    return posts.join(done, "post_id", "left_anti")


def pending_queue(posts: DataFrame, gold: DataFrame, max_posts: int | None = None) -> DataFrame:
    """Newest-silvered first (post_id breaks ties); max_posts <= 0 -> empty.
    With a limit Spark plans TakeOrderedAndProject: a per-partition top-n, so
    only n rows per partition reach the final merge."""
    if max_posts is not None and max_posts <= 0:
        return posts.select("post_id", "url").limit(0)
    q = pending(posts.select("post_id", "url", "silvered_at"), gold) \
        .orderBy(F.desc("silvered_at"), F.desc("post_id"))
    if max_posts:
        q = q.limit(max_posts)
    return q.select("post_id", "url", "silvered_at")


def pending_for_ids(posts: DataFrame, gold: DataFrame, ids: DataFrame) -> DataFrame:
    """Pending posts among an id list (semi join), no order, no limit."""
    p = posts.select("post_id", "url").join(ids.select("post_id").distinct(), "post_id",
                                            "left_semi")
    return pending(p, gold)
