"""Dimensions: dim_time (M5), dim_profile rebuild from the latest post (W1,
M6), profile-details import (S13, F10, M8) and the SCD2 merge (M7, W3).

SCD2 on plain Parquet is a join + union: the merge never updates rows in
place; it returns the next version of the whole dimension, which the caller
writes (and which carries the history of every owner)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from .numbering import with_row_number

DETAILS_TYPE = ("struct<id:variant,username:string,fullName:string,biography:string,"
                "followersCount:bigint,followsCount:bigint,postsCount:bigint,"
                "verified:boolean,businessCategoryName:string,externalUrl:string,"
                "ig_status:string,status:string>")


def dim_time(posts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct post dates with calendar attributes; re-running is idempotent
    (union with the existing rows, one row per time_key)."""
    d = (posts.filter(F.col("timestamp").isNotNull())
         .select(F.to_date("timestamp").alias("d")).distinct()
         .select(*calendar_columns(F.col("d"))))
    if existing is not None:
        d = d.unionByName(existing.select(*d.columns)).dropDuplicates(["time_key"])
    return d


def latest_post_per_owner(posts: DataFrame, prefer_metadata: bool = False) -> DataFrame:
    """DISTINCT ON (owner_id) ... ORDER BY timestamp DESC NULLS LAST as a
    max_by aggregation (partial, skew-safe); ties broken by post_id."""
    p = posts.filter(F.col("owner_id").isNotNull() & (F.col("owner_id") != ""))
    rank = [F.col("timestamp").isNotNull(), F.col("timestamp"), F.col("post_id")]
    if prefer_metadata:
        rank.insert(0, F.col("meta_data").isNotNull())
    best = F.max_by(F.struct("owner_username", "meta_data", "timestamp", "post_id"),
                    F.struct(*rank)).alias("b")
    return p.groupBy("owner_id").agg(best).select("owner_id", "b.*")


def _meta_int(m: Column, path: str) -> Column:
    """Text -> INTEGER with rounding (D9); garbage -> NULL."""
    return F.round(F.try_variant_get(m, path, "double")).cast("bigint")


def dim_profile_from_posts(posts: DataFrame, as_of: Column,
                           prefer_metadata: bool = False) -> DataFrame:
    """M6: full rebuild, one current row per owner, keys in owner_id order."""
    lp = latest_post_per_owner(posts, prefer_metadata)
    m = F.col("meta_data")
    rows = lp.select(
        "owner_id", "owner_username",
        _meta_int(m, "$.followersCount").alias("follower_count"),
        _meta_int(m, "$.postsCount").alias("posts_count_ig"),
        F.try_variant_get(m, "$.biography", "string").alias("bio"),
        (F.try_variant_get(m, "$.verified", "string") == "true").alias("is_verified"),
        F.try_variant_get(m, "$.businessCategoryName", "string").alias("profile_category"),
        F.try_variant_get(m, "$.externalUrl", "string").alias("external_url"),
        F.try_variant_get(m, "$.relatedProfiles", "array<string>").alias("related_profiles"),
        as_of.cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"))
    return with_row_number(rows, "owner_id", "profile_key")


def details_import(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed details records (columns of DETAILS_TYPE plus
    line_no) -> (one staged row per owner, last record wins; skipped counts).

    Kept: status (ig_status or status) missing or 'ok', non-empty id and
    username; an explicit null id is missing (D17)."""
    status = F.coalesce(F.nullif(F.col("ig_status"), F.lit("")),
                        F.nullif(F.col("status"), F.lit("")))
    owner = F.when(F.col("id").isNotNull() & ~F.is_variant_null(F.col("id")),
                   F.try_variant_get(F.col("id"), "$", "string"))
    r = records.withColumn("_status", status).withColumn("owner_id", owner)
    bad_status = F.col("_status").isNotNull() & (F.col("_status") != "ok")
    no_key = (F.coalesce(F.col("owner_id"), F.lit("")) == "") | \
        (F.coalesce(F.col("username"), F.lit("")) == "")
    reason = F.when(bad_status, "status").when(no_key, "no_key")
    r = r.withColumn("_skip", reason)
    skipped = r.filter(F.col("_skip").isNotNull()).groupBy(F.col("_skip").alias("reason")) \
        .agg(F.count(F.lit(1)).alias("records"))
    kept = r.filter(F.col("_skip").isNull())
    last = F.max_by(F.struct(
        F.col("username").alias("owner_username"),
        F.col("followersCount").alias("follower_count"),
        F.col("postsCount").alias("posts_count_ig"),
        F.col("biography").alias("bio"),
        F.coalesce(F.col("verified"), F.lit(False)).alias("is_verified"),
        F.col("businessCategoryName").alias("profile_category"),
        F.col("externalUrl").alias("external_url")), F.col("line_no")).alias("s")
    staged = kept.groupBy("owner_id").agg(last).select("owner_id", "s.*")
    return staged, skipped


def scd2_merge(dim: DataFrame, staged: DataFrame, as_of: Column,
               restrict_to: DataFrame | None = None) -> DataFrame:
    """M7: expire the current rows of incoming owners (is_current=false,
    effective_to=as_of) and add one new current row each (effective_from=
    as_of); new keys continue after MAX(profile_key) in owner_id order (W3).
    related_profiles of the previous current row is carried forward (D16).
    ``restrict_to`` (owner_id) limits the import to known owners (D15)."""
    if restrict_to is not None:
        staged = staged.join(restrict_to.select("owner_id").distinct(), "owner_id", "left_semi")
    incoming = staged.select("owner_id").withColumn("_in", F.lit(True))
    flagged = dim.join(incoming, "owner_id", "left")
    hit = F.col("_in").isNotNull() & F.col("is_current")
    prior = flagged.select(
        *[c for c in dim.columns if c not in ("is_current", "effective_to")],
        F.when(hit, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        F.when(hit, as_of.cast("timestamp_ntz")).otherwise(F.col("effective_to"))
        .alias("effective_to"))
    carried = dim.filter(F.col("is_current")).select(
        "owner_id", F.col("related_profiles").alias("_rel"))
    max_key = dim.agg(F.coalesce(F.max("profile_key"), F.lit(0)).alias("m")).first()["m"]
    new = staged.join(carried, "owner_id", "left").select(
        *[F.col(c) for c in staged.columns],
        F.col("_rel").alias("related_profiles"),
        as_of.cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"))
    new = with_row_number(new, "owner_id", "profile_key", start=int(max_key))
    return prior.unionByName(new.select(*prior.columns))
