"""Bronze -> silver: tolerant parse, field normalisation and last-write-wins
deduplication (S1, P1-P9, F1, W4, S8, S9).

Deduplication is an aggregation, not a window: ``max_by(row, order)`` per
post_id runs partially on the map side, so a post id that holds a third of
all lines is reduced to one row per input partition before the shuffle and
never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonfields as J
from ..functions import text as T
from ..functions.calendar import parse_ts

POST_COLUMNS = ["post_id", "shortcode", "url", "caption", "owner_id", "owner_username",
                "likes_count", "comments_count", "video_play_count", "video_view_count",
                "timestamp", "hashtags", "meta_data", "has_engagement_bait", "source_dataset"]


RAW_FIELDS = {
    "id": "$.id", "shortCode": "$.shortCode", "url": "$.url", "caption": "$.caption",
    "ownerId": "$.ownerId", "ownerUsername": "$.ownerUsername",
    "likesCount": "$.likesCount", "commentsCount": "$.commentsCount",
    "videoPlayCount": "$.videoPlayCount", "videoViewCount": "$.videoViewCount",
    "timestamp": "$.timestamp", "hashtags": "$.hashtags", "metaData": "$.metaData",
}


def parse(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split scanned lines into (objects with a key, quarantine).

    Quarantine holds malformed JSON, valid JSON that is not an object, and
    objects without a usable key, each with a reason. Kept rows carry the
    extracted fields (see ``jsonfields.extract``)."""
    p = lines.withColumn("v", F.try_parse_json(F.col("line")))
    p = J.extract(p, "v", RAW_FIELDS)
    is_obj = F.col("line").startswith("{") & F.col("v").isNotNull()
    key = F.coalesce(J.text_or_null(*J.fld("id")), J.text_or_null(*J.fld("shortCode")))
    p = p.withColumn("post_id", F.when(is_obj, key))
    reason = (F.when(F.col("v").isNull(), "malformed")
              .when(~F.col("line").startswith("{"), "not_object")
              .when(F.col("post_id").isNull(), "no_key"))
    good = keep_where(p, F.col("post_id").isNotNull())
    bad = keep_where(p, F.col("post_id").isNull()).select("dataset_id", "line",
                                                          reason.alias("reason"))
    return good, bad


def keep_where(df: DataFrame, cond: Column) -> DataFrame:
    """Row filter expressed as a generator (explode of a 0/1-element array).

    A Filter on a derived column is pushed below the projections that derive
    it, which inlines the JSON parse into every reference of the predicate;
    a Generate is not pushed through, so each line is parsed once."""
    one = F.explode(F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    return df.select("*", one.alias("_keep")).drop("_keep")


def normalise(parsed: DataFrame) -> DataFrame:
    """One silver-shaped row per parsed line (falsy -> default rules)."""
    f = J.fld
    caption_full = J.text_or(*f("caption"))
    return parsed.select(
        "post_id",
        J.text_or(*f("shortCode")).alias("shortcode"),
        T.py_strip(J.text_or(*f("url"))).alias("url"),
        T.truncate_chars(caption_full).alias("caption"),
        J.text_or(*f("ownerId")).alias("owner_id"),
        J.text_or(*f("ownerUsername")).alias("owner_username"),
        J.count_or_zero(*f("likesCount")).alias("likes_count"),
        J.count_or_zero(*f("commentsCount")).alias("comments_count"),
        J.count_or_zero(*f("videoPlayCount")).alias("video_play_count"),
        J.count_or_zero(*f("videoViewCount")).alias("video_view_count"),
        parse_ts(J.text_or_null(*f("timestamp"))).alias("timestamp"),
        J.string_array(*f("hashtags")).alias("hashtags"),
        J.object_or_null(*f("metaData")).alias("meta_data"),
        T.engagement_bait(caption_full).alias("has_engagement_bait"),
        F.col("dataset_id").alias("source_dataset"),
        F.col("v").alias("raw"),
        order_key().alias("_order"),
    )


def order_key() -> Column:
    """Write order of a line: dataset order, dataset id, then the position of
    the line in its dataset (file by its number, block, row)."""
    number = F.coalesce(F.try_to_number(F.regexp_extract("file_name", r"^part-(\d+)", 1), F.lit("9" * 18)).cast("bigint"), F.lit(0))
    return F.struct(F.col("ds_order_ts"), F.col("dataset_id"), number.alias("file_number"), F.col("file_name"),
                    F.col("block_start"), F.col("row_id"))


def latest_per_key(rows: DataFrame, key: str = "post_id", order: str = "_order") -> DataFrame:
    """Keep the last-written row per key (skew-safe partial aggregation)."""
    payload = [c for c in rows.columns if c != key]
    win = F.max_by(F.struct(*[F.col(c) for c in payload]), F.col(order)).alias("_w")
    return rows.groupBy(key).agg(win).select(key, *[F.col(f"_w.{c}").alias(c) for c in payload])


def attach_media(posts: DataFrame, media: DataFrame | None) -> DataFrame:
    """media_files (sorted names, [] when none) and media_count from a
    manifest (source_dataset, post_id, media_files)."""
    empty = F.array().cast("array<string>")
    if media is None:
        return posts.withColumn("media_files", empty).withColumn("media_count", F.lit(0))
    m = media.select("source_dataset", "post_id", "media_files")
    j = posts.join(m, ["source_dataset", "post_id"], "left")
    files = F.coalesce(F.col("media_files"), empty)
    return j.withColumn("media_files", files).withColumn("media_count", F.size(files))


def per_dataset(lines: DataFrame) -> DataFrame:
    """One parse for both results of a run: the last-written row per (post,
    dataset), with ``_lines``, the keyed input lines behind it."""
    good, _ = parse(lines)
    rows = normalise(good)
    payload = [c for c in rows.columns if c not in ("post_id", "source_dataset")]
    return (rows.groupBy("post_id", "source_dataset")
            .agg(F.max_by(F.struct(*payload), "_order").alias("_w"), F.count(F.lit(1)).alias("_lines"))
            .select("post_id", "source_dataset", *[F.col(f"_w.{c}").alias(c) for c in payload], "_lines"))


def counts_of(folded: DataFrame) -> DataFrame:
    """Keyed input rows per dataset (duplicates inside a dataset count)."""
    return folded.groupBy("source_dataset").agg(F.sum("_lines").alias("post_count"))


def posts_of(folded: DataFrame, media: DataFrame | None = None) -> DataFrame:
    """Deduplicated silver rows from ``per_dataset``."""
    return attach_media(latest_per_key(folded.drop("_lines")), media)
