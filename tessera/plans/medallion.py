"""Bronze -> silver runs over datasets derived from the driver's ``events``.

Each event becomes one raw post object; events are split into three bronze
datasets (``ds<event_id % 3>``), so post ids (the user id) collide across and
inside datasets and last-write-wins is exercised at every size. Error events
are written as truncated (malformed) lines, user 0 has a falsy numeric id.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..operators import dims as D
from ..operators import silver as S
from ..operators.upsert import BucketedTable, record_progress
from ..sources import bronze as B
from . import views as V
from ..schemas import PROGRESS_DDL, SILVER_DDL
from ..session import cut_lineage, shared_path

# ---- fixed values of the events -> raw post mapping (shared with the oracle)
N_DATASETS = 3
BRONZE_EPOCH = "2025-01-01 00:00:00"
POST_URL = "https://e.example/"
BAIT_CAPTION = "DM me for the deal"
# ---------------------------------------------------------------------------

META_TYPE = "struct<followersCount:bigint,biography:string>"


def dataset_of(event_id: Column) -> Column:
    return F.concat(F.lit("ds"), F.pmod(event_id, F.lit(N_DATASETS)).cast("string"))


def downloaded_at(dataset_id: Column) -> Column:
    """Landing time of a dataset: ds1 first, then ds2, then ds0."""
    k = F.substring(dataset_id, 3, 10).cast("int")
    hours = F.pmod(k + F.lit(2), F.lit(N_DATASETS))
    return F.lit(BRONZE_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)


def raw_posts(cat: Catalog) -> DataFrame:
    """(dataset_id, event_id, line): one raw JSON post per event."""
    e = cat.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    caption = (F.when(F.col("event_type") == "purchase", F.lit(BAIT_CAPTION))
               .when(F.col("event_type") == "view", F.lit(""))
               .otherwise(F.concat(F.lit("event "), F.col("event_type"))))
    k = F.get_json_object("props", "$.k").cast("bigint")
    meta = (F.when(F.col("event_type") == "signup",
                   F.struct(k.alias("followersCount"),
                            F.concat(F.lit("user "), F.col("user_id").cast("string"))
                            .alias("biography")))
            .otherwise(F.from_json(F.lit("{}"), META_TYPE)))
    obj = F.struct(
        F.col("user_id").alias("id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("shortCode"),
        F.concat(F.lit("  " + POST_URL), F.col("event_id").cast("string"), F.lit(" "))
        .alias("url"),
        caption.alias("caption"),
        F.col("user_id").alias("ownerId"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("ownerUsername"),
        F.floor("value").cast("bigint").alias("likesCount"),
        k.alias("commentsCount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.array(F.col("event_type")).alias("hashtags"),
        meta.alias("metaData"),
    )
    broken = F.concat(F.lit('{"id": '), F.col("user_id").cast("string"),
                      F.lit(', "shortCode": "e'), F.col("event_id").cast("string"))
    line = F.when(F.col("event_type") == "error", broken) \
        .otherwise(F.to_json(obj, {"ignoreNullFields": "true"}))
    return e.select(dataset_of(F.col("event_id")).alias("dataset_id"), "event_id",
                    line.alias("line"))


def in_memory_lines(cat: Catalog) -> DataFrame:
    """Raw post lines with the scan's position columns, without landing."""
    r = raw_posts(cat)
    return r.select("dataset_id", F.col("line"), F.lit("").alias("file_name"),
                    F.lit(0).cast("bigint").alias("block_start"),
                    F.col("event_id").alias("row_id"),
                    downloaded_at(F.col("dataset_id")).alias("ds_order_ts"))


def land_events(spark: SparkSession, cat: Catalog, datasets: list[str] | None = None,
                root: str | None = None) -> str:
    root = root or shared_path(spark, "bronze")
    lines = raw_posts(cat)
    if datasets is not None:
        lines = lines.filter(F.col("dataset_id").isin(datasets))
    B.land(lines, root, run_id="events", actor="driver-events",
           downloaded_at=downloaded_at(F.col("dataset_id")), order_by="event_id")
    return root


class Medallion:
    """Paths of one bronze/silver deployment in shared storage."""

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 16):
        self.spark = spark
        self.root = root or shared_path(spark, "medallion")
        self.bronze = os.path.join(self.root, "bronze")
        self.silver = BucketedTable(spark, os.path.join(self.root, "silver_posts"),
                                    "post_id", buckets, SILVER_DDL)
        self.completed = BucketedTable(spark, os.path.join(self.root, "silver_progress"),
                                       "source_dataset", buckets, PROGRESS_DDL)
        self.stream_files = BucketedTable(spark, os.path.join(self.root, "stream_files"),
                                          "file_key", buckets, bucket_by="source_dataset")

    def progress(self) -> DataFrame | None:
        return self.completed.read()

    def pending_files(self) -> DataFrame:
        """(dataset_id, path, ds_order_ts) of the datasets not yet completed."""
        files = B.listing(self.spark, self.bronze)
        return files.select("dataset_id", "path").join(
            B.discover(self.spark, self.bronze, self.progress()), "dataset_id")

    def deduplicate_all(self, as_of: Column, media: DataFrame | None = None, strict: bool = False) -> DataFrame:
        """Silver run: new datasets -> upsert -> progress. Returns one row
        (datasets_processed, posts_silvered). A dataset without any usable
        post is still recorded (post_count 0) so it is not rescanned. A later
        run's rows replace those of an earlier one; in ``strict`` mode only
        where their dataset is not the older."""
        pending = cut_lineage(self.pending_files())
        # The pending files' paths, which the scan's own file index holds too.
        paths = [r[0] for r in pending.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame(
                [(0, 0)], "datasets_processed bigint, posts_silvered bigint")
        datasets = pending.select("dataset_id", "ds_order_ts").distinct()
        # Broadcast, as there are no more datasets than paths: a shuffle by dataset would move every line to a few tasks.
        folded = cut_lineage(S.per_dataset(B.scan(self.spark, paths).join(F.broadcast(datasets), "dataset_id")))
        counts = cut_lineage(
            datasets.select(F.col("dataset_id").alias("source_dataset"))
            .join(S.counts_of(folded), "source_dataset", "left")
            .select("source_dataset", F.coalesce("post_count", F.lit(0)).cast("bigint").alias("post_count")))
        n, total = counts.agg(F.count(F.lit(1)), F.sum("post_count")).first()
        if total:
            self.silver.upsert(S.posts_of(folded, media), as_of=as_of, order="_order" if strict else None)
        record_progress(self.completed, counts, as_of)
        return self.spark.createDataFrame(
            [(int(n), int(total or 0))], "datasets_processed bigint, posts_silvered bigint")

    def silver_posts(self) -> DataFrame:
        return self.silver.read()


def backfill(med: Medallion, gold: DataFrame, as_of: Column) -> DataFrame:
    """V8: the whole refresh after new datasets have landed: silver, the
    profile dimension, dates, views; one row of counts."""
    run = med.deduplicate_all(as_of)
    posts = med.silver_posts()
    profiles = D.dim_profile_from_posts(posts, as_of)
    V.refresh_views(posts, profiles, D.dim_time(posts), gold)
    return run.crossJoin(profiles.agg(  # one row each
        F.count(F.lit(1)).alias("profiles"), F.count("follower_count").alias("profiles_with_followers"))) \
        .select("posts_silvered", "profiles", "profiles_with_followers")


def silver_view(silver: DataFrame) -> DataFrame:
    """Silver rows for output: VARIANT columns reduced to scalars."""
    return silver.select(
        "post_id", "shortcode", "url", "caption", "owner_id", "owner_username",
        "likes_count", "comments_count", "video_play_count", "video_view_count",
        "timestamp", "hashtags",
        F.try_variant_get("meta_data", "$.followersCount", "bigint").alias("meta_followers"),
        "has_engagement_bait", "media_files", "media_count", "source_dataset", "silvered_at")
