"""Scrape planning: tiers, batches, cost, ledger.

Batch numbers come from one distributed global numbering in (tier, post
count desc, username) order minus each tier's first number, never from a
window partitioned by tier (a tier can hold a third of all profiles)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import scrape_cost
from .numbering import running_sum, with_row_number

# ---- fixed values (must equal the reference behaviour) -------------------
# tier: (min post_count, results_limit per profile, profiles per batch)
TIERS = [
    ("whales", 4, 80, 7),
    ("top", 3, 60, 8),
    ("mid", 2, 20, 50),
    ("tail", 1, 10, 300),
]
# ---------------------------------------------------------------------------


def _tier_cols(post_count):
    rank = F.lit(None).cast("int")
    name, limit, size = F.lit(None).cast("string"), F.lit(None).cast("int"), \
        F.lit(None).cast("int")
    for i, (t, threshold, lim, sz) in reversed(list(enumerate(TIERS))):
        hit = post_count >= threshold
        rank = F.when(hit, F.lit(i)).otherwise(rank)
        name = F.when(hit, F.lit(t)).otherwise(name)
        limit = F.when(hit, F.lit(lim)).otherwise(limit)
        size = F.when(hit, F.lit(sz)).otherwise(size)
    return rank, name, limit, size


def assign_tiers(needing: DataFrame) -> DataFrame:
    """(owner_username, post_count) -> + tier_rank, tier, results_limit, batch_size."""
    rank, name, limit, size = _tier_cols(F.col("post_count"))
    return needing.select("owner_username", "post_count", rank.alias("tier_rank"),
                          name.alias("tier"), limit.alias("results_limit"),
                          size.alias("batch_size")).filter(F.col("tier").isNotNull())


def number_in_group(df: DataFrame, group: str, order: list, out: str) -> DataFrame:
    """1-based position inside ``group`` via one global numbering."""
    g = with_row_number(df, [F.col(group)] + order, "_g")
    first = g.groupBy(group).agg(F.min("_g").alias("_first"))  # one row per group value
    return g.join(F.broadcast(first), group) \
        .withColumn(out, F.col("_g") - F.col("_first") + 1).drop("_g", "_first")


def plan_batches(needing: DataFrame) -> DataFrame:
    """Per profile its tier and batch number inside the tier."""
    t = assign_tiers(needing)
    n = number_in_group(t, "tier_rank", [F.desc("post_count"), F.col("owner_username")], "rn")
    return n.withColumn("batch_no", F.floor((F.col("rn") - 1) / F.col("batch_size")).cast("int"))


def batches(planned: DataFrame) -> DataFrame:
    """One row per batch: profiles, results_limit, estimated cost (P25).
    Groups are bounded by the batch size (<= 300 profiles)."""
    return planned.groupBy("tier_rank", "tier", "batch_no", "results_limit").agg(
        F.count(F.lit(1)).alias("profiles"),
        F.array_sort(F.collect_list("owner_username")).alias("usernames"),
    ).withColumn("est_cost_usd",
                 F.round(scrape_cost(F.col("profiles"), F.col("results_limit")), 6))


def cumulative_cost(b: DataFrame) -> DataFrame:
    """Running cost over the batch plan (tier order, batch number)."""
    r = running_sum(b.select("tier_rank", "tier", "batch_no", "profiles", "est_cost_usd"),
                    ["tier_rank", "batch_no"], "est_cost_usd", "cumulative_cost_usd")
    return r.withColumn("cumulative_cost_usd", F.round("cumulative_cost_usd", 6))


def one_batch_per_profile(listed: DataFrame) -> DataFrame:
    """A username listed in several tier lists keeps the highest-priority
    tier (lowest tier_rank); a partial min_by aggregation, skew-safe."""
    best = F.min_by(F.struct("tier", "results_limit"), F.col("tier_rank")).alias("b")
    return listed.groupBy("owner_username").agg(F.min("tier_rank").alias("tier_rank"), best) \
        .select("owner_username", "tier_rank", "b.tier", "b.results_limit")


def sub_batches(needing: DataFrame, size: int) -> DataFrame:
    """Fixed-size chunks over the whole queue (post_count desc, name)."""
    n = with_row_number(needing.select("owner_username", "post_count"),
                        [F.desc("post_count"), F.col("owner_username")], "rn")
    return n.withColumn("sub_batch", F.floor((F.col("rn") - 1) / F.lit(size)).cast("int"))


def batch_datasets(planned: DataFrame, posts: DataFrame) -> DataFrame:
    """(dataset_id, post_id, line): the posts of each batch's profiles as raw
    objects of one dataset, named <tier>-<batch number>."""
    raw = F.to_json(F.struct(F.col("post_id").alias("id"), F.col("shortcode").alias("shortCode"), F.col("owner_id").alias("ownerId"),
                             F.col("owner_username").alias("ownerUsername"), F.col("likes_count").alias("likesCount")))
    dataset = F.concat_ws("-", "tier", F.col("batch_no").cast("string"))
    return posts.join(planned.select("owner_username", "tier", "batch_no"), "owner_username").select(dataset.alias("dataset_id"), "post_id", raw.alias("line"))


def ledger(manifest: DataFrame, progress: DataFrame, posts: DataFrame) -> DataFrame:
    """One row a completed run (landed dataset): its tier, the profiles it
    brought, items landed and ingested, and the cost of the landed items."""
    brought = posts.groupBy("source_dataset").agg(F.count_distinct("owner_username").alias("profiles"))
    return (manifest.select(F.col("dataset_id").alias("source_dataset"), F.col("item_count").alias("items_landed"))
            .join(progress.select("source_dataset", F.col("post_count").alias("items_ingested")), "source_dataset")
            .join(brought, "source_dataset", "left")
            .select(F.col("source_dataset").alias("run_id"), F.regexp_extract("source_dataset", r"^(.*)-\d+$", 1).alias("tier"),
                    F.coalesce("profiles", F.lit(0)).alias("profiles"), "items_landed", "items_ingested",
                    scrape_cost(F.col("items_landed"), F.lit(1)).alias("cost_usd")))


def ledger_totals(runs: DataFrame) -> DataFrame:
    """Per tier runs, profiles, items and cost."""
    return runs.groupBy("tier").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("profiles").alias("profiles"),
        F.sum("items_landed").alias("items_landed"),
        F.sum("items_ingested").alias("items_ingested"),
        F.round(F.sum("cost_usd"), 6).alias("cost_usd"))
