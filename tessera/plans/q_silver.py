"""Registered queries of the bronze -> silver path (S1-S6, P1-P9, W4, M1, M2,
A11, J7)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.text import profile_url
from ..operators import silver as S
from ..sources import bronze as B
from ..session import shared_path
from .medallion import (Medallion, backfill, downloaded_at, in_memory_lines as _in_memory_lines,
                        land_events, raw_posts, silver_view)
from .registry import query
from .star import Star, captions

RUN1_AT = "2025-02-01 00:00:00"
RUN2_AT = "2025-02-02 00:00:00"


def _ts(s):
    return F.lit(s).cast("timestamp_ntz")


@query("post_key_coalesce")
def q_post_key_coalesce(spark, sf_dir):
    good, _ = S.parse(_in_memory_lines(Catalog(spark, sf_dir)))
    return good.select("dataset_id",
                       F.try_variant_get("_f_shortCode", "$", "string").alias("shortcode"),
                       "post_id")


@query("silver_defaults")
def q_silver_defaults(spark, sf_dir):
    good, _ = S.parse(_in_memory_lines(Catalog(spark, sf_dir)))
    n = S.normalise(good)
    return n.select("post_id", "shortcode", "url", "caption", "owner_id", "owner_username",
                    "likes_count", "comments_count", "video_play_count", "video_view_count",
                    "timestamp", "hashtags",
                    F.col("meta_data").isNotNull().alias("has_meta"), "source_dataset")


@query("bronze_quarantine")
def q_bronze_quarantine(spark, sf_dir):
    _, bad = S.parse(_in_memory_lines(Catalog(spark, sf_dir)))
    return bad.groupBy("dataset_id", "reason").agg(F.count(F.lit(1)).alias("lines"))


@query("silver_last_write_wins")
def q_silver_lww(spark, sf_dir):
    good, _ = S.parse(_in_memory_lines(Catalog(spark, sf_dir)))
    w = S.latest_per_key(S.normalise(good))
    return w.select("post_id", "shortcode", "source_dataset", "likes_count", "timestamp")


@query("bait_flag")
def q_bait_flag(spark, sf_dir):
    return Star(spark, sf_dir).posts().select("post_id", "has_engagement_bait")


@query("caption_truncate")
def q_caption_truncate(spark, sf_dir):
    c = captions(Catalog(spark, sf_dir))
    cut = F.substring("caption_full", 1, 5000)
    return c.select(F.col("doc_id").cast("string").alias("post_id"),
                    F.char_length(cut).alias("caption_chars"),
                    F.char_length("caption_full").alias("full_chars"),
                    (F.char_length("caption_full") > 5000).alias("truncated"))


@query("silver_from_ndjson")
def q_silver_from_ndjson(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    m = Medallion(spark)
    land_events(spark, cat, root=m.bronze)
    m.deduplicate_all(_ts(RUN1_AT))
    return silver_view(m.silver_posts())


@query("silver_raw_fields")
def q_silver_raw_fields(spark, sf_dir):
    """Stored silver rows keep the object they came from; fields by path, as they were sent."""
    m = Medallion(spark)
    land_events(spark, Catalog(spark, sf_dir), root=m.bronze)
    m.deduplicate_all(_ts(RUN1_AT))
    return m.silver_posts().select(
        "post_id", F.try_variant_get("raw", "$.url", "string").alias("raw_url"), F.try_variant_get("raw", "$.timestamp", "string").alias("raw_timestamp"),
        F.try_variant_get("raw", "$.ownerId", "bigint").alias("raw_owner_id"), F.try_variant_get("raw", "$.hashtags[0]", "string").alias("first_hashtag"))


def _two_runs(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    m = Medallion(spark)
    land_events(spark, cat, ["ds1", "ds2"], root=m.bronze)
    m.deduplicate_all(_ts(RUN1_AT))
    land_events(spark, cat, ["ds0"], root=m.bronze)
    return m


@query("backfill_summary")
def q_backfill_summary(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    m = Medallion(spark)
    land_events(spark, cat, root=m.bronze)
    return backfill(m, Star(spark, sf_dir).gold(), _ts(RUN1_AT))


@query("silver_after_failed_runs")
def q_silver_after_failed_runs(spark, sf_dir):
    """A landing that stops before its manifest, and a silver run that stops
    before its upsert is published, leave nothing behind: the runs after them
    give the rows of a run without failures."""
    cat = Catalog(spark, sf_dir)
    m = Medallion(spark)
    B.write_landing(raw_posts(cat), m.bronze, "event_id")
    land_events(spark, cat, root=m.bronze)
    half = raw_posts(cat).filter(F.col("event_id") % 2 == 0)
    good, _ = S.parse(_in_memory_lines(cat).join(half.select(F.col("event_id").alias("row_id")), "row_id"))
    m.silver.write(S.attach_media(S.latest_per_key(S.normalise(good)), None), as_of=_ts(RUN2_AT))
    m.deduplicate_all(_ts(RUN1_AT))
    return silver_view(m.silver_posts())


NAMED = {"ds0": "007", "ds1": "7", "ds2": "1e3"}


@query("numeric_dataset_ids")
def q_numeric_dataset_ids(spark, sf_dir):
    """Dataset ids that look like numbers stay the text they are."""
    lines = raw_posts(Catalog(spark, sf_dir)).replace(NAMED, subset=["dataset_id"])
    m = Medallion(spark)
    B.land(lines, m.bronze, downloaded_at=_ts(RUN1_AT), order_by="event_id")
    m.deduplicate_all(_ts(RUN1_AT))
    return (m.progress().select("source_dataset", "post_count")
            .join(B.read_manifest(spark, m.bronze).select(F.col("dataset_id").alias("source_dataset"), "item_count"), "source_dataset"))


@query("silver_upsert_two_runs")
def q_silver_upsert_two_runs(spark, sf_dir):
    m = _two_runs(spark, sf_dir)
    m.deduplicate_all(_ts(RUN2_AT))
    return silver_view(m.silver_posts())


@query("silver_progress_counts")
def q_silver_progress_counts(spark, sf_dir):
    m = _two_runs(spark, sf_dir)
    m.deduplicate_all(_ts(RUN2_AT))
    return m.progress().select("source_dataset", "post_count", "completed_at")


@query("unprocessed_datasets")
def q_unprocessed_datasets(spark, sf_dir):
    m = _two_runs(spark, sf_dir)
    return B.discover(spark, m.bronze, m.progress())


@query("land_json_array")
def q_land_json_array(spark, sf_dir):
    """API pages (JSON arrays of <= 1000 objects, one page per line) ->
    NDJSON bronze with manifest; landing twice skips the second time."""
    cat = Catalog(spark, sf_dir)
    r = raw_posts(cat).join(cat.events.select("event_id", "event_type"), "event_id") \
        .filter(F.col("event_type") != "error")
    page = F.floor(F.col("event_id") / F.lit(3000))
    pages = (r.groupBy("dataset_id", page.alias("page"))
             .agg(F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("items"))
             .select("dataset_id", F.concat(
                 F.lit("["), F.array_join(F.transform("items", lambda x: x["line"]), ","),
                 F.lit("]")).alias("value")))
    payload = shared_path(spark, "payload")
    pages.write.partitionBy("dataset_id").text(payload)
    pages = spark.read.text(os.path.join(payload, "dataset_id=*"))
    lines = B.json_array_lines(pages.select(B.dataset_of_path(F.col("_metadata.file_path")).alias("dataset_id"), "value"))
    root = shared_path(spark, "bronze")
    first = B.land(lines, root, downloaded_at=downloaded_at(F.col("dataset_id")))
    second = B.land(lines, root, downloaded_at=downloaded_at(F.col("dataset_id")))
    return first.join(second.select("dataset_id", F.col("skipped").alias("skipped_again")),
                      "dataset_id")


def _targets_file(spark, cat):
    c = cat.customer.select("c_custkey", "c_name", "c_acctbal")
    line = (F.when(F.col("c_acctbal") < 0, F.lit("   "))
            .when(F.pmod("c_custkey", F.lit(2)) == 0,
                  F.concat(F.lit("  "), F.col("c_name"), F.lit("  ")))
            .otherwise(F.concat(F.lit("https://www.instagram.com/"), F.col("c_name"),
                                F.lit("/"))))
    path = shared_path(spark, "targets")
    c.select(line.alias("value")).write.text(path)
    return path


@query("target_list")
def q_target_list(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    return B.target_list(spark, _targets_file(spark, cat))


@query("profile_urls")
def q_profile_urls(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    t = B.target_list(spark, _targets_file(spark, cat))
    return t.select("target", profile_url(F.col("target")).alias("profile_url"))
