"""The medallion star over the driver's tables.

The driver ships TPC-H-style tables, so the social-content model is mapped
onto them (see README, "Proxy star"):

* silver_posts   <- orders (+ lineitem roll-up, documents as captions,
                    customer as post owner metadata, conversations as media)
* dim_profile    <- customer (current rows only; SCD2 columns literal)
* gold_analyses  <- documents LEFT JOIN labels (labelled = analysed)
* resources      <- lineitem JOIN part of the post's order
* dim_time       <- distinct post dates

Everything is lazy DataFrame code; Catalyst removes the joins a query does not
use (aggregated sides are unique on their key, so unused outer joins drop).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import text as T
from ..functions import media as M
from ..operators import dims

# ---- fixed values of the proxy mapping (shared with the SQL oracle) -------
CAPTION_SUFFIXES = [
    "",
    " comment GUIDE for the link",
    " DM me for details",
    " link in bio",
    " check the link",
    " drop a comment below",
    " message me today",
    " thanks for reading",
    " great commentary",
]
POST_URL_PREFIX = "https://x.com/p/"
SCHEMA_VERSION = 3
ANALYSIS_EPOCH = "2025-06-01 00:00:00"
PROFILE_EPOCH = "2025-01-01 00:00:00"
ADMIRALTY_SOURCES = "ABCDEF"
# ---------------------------------------------------------------------------


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def lineitem_rollup(cat: Catalog) -> DataFrame:
    """Per order: line count, quantities, flag set. Partial aggregation runs
    map-side, so only one row per order and partition reaches the shuffle."""
    li = cat.lineitem.select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)))
        .alias("r_qty"),
        F.array_sort(F.array_union(F.collect_set("l_returnflag"),
                                   F.collect_set("l_linestatus"))).alias("tags"),
    )


def captions(cat: Catalog) -> DataFrame:
    """Document text as the full caption, with a suffix chosen by doc id."""
    d = cat.documents.select("doc_id", "text")
    suffix = F.element_at(_lit_array(CAPTION_SUFFIXES),
                          (F.pmod(F.col("doc_id"), F.lit(len(CAPTION_SUFFIXES))) + 1).cast("int"))
    return d.select("doc_id", F.concat(F.col("text"), suffix).alias("caption_full"))


def stored_captions(cat: Catalog) -> DataFrame:
    """What silver keeps of a caption, taken before any shuffle: the cut text and the flag of the whole."""
    return captions(cat).select("doc_id", T.truncate_chars(F.col("caption_full")).alias("caption"),
                                T.engagement_bait(F.col("caption_full")).alias("bait"))


def media_names(cat: Catalog) -> DataFrame:
    """Media listing per post: one file per conversation turn, the extension
    chosen by role (user=image, assistant=video, other=unsupported)."""
    c = cat.conversations.select("conv_id", "turn", "role")
    ext = (F.when(F.col("role") == "user", "jpg")
           .when(F.col("role") == "assistant", "mp4").otherwise("txt"))
    return c.select(F.col("conv_id"),
                    F.format_string("media_%02d.%s", F.col("turn"), ext).alias("file_name"))


def media_manifest(cat: Catalog) -> DataFrame:
    """(post, sorted supported file names, count); S7/S8."""
    m = media_names(cat).filter(M.is_supported(F.col("file_name")))
    return m.groupBy("conv_id").agg(F.array_sort(F.collect_list("file_name")).alias("media_files"))


def silver_posts(cat: Catalog) -> DataFrame:
    o = cat.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority")
    c = cat.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    li = lineitem_rollup(cat)
    cap = stored_captions(cat)
    med = media_manifest(cat)
    # The customer first, while rows are narrow; then all joins by order key, in one shuffle.
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
         .join(li, o.o_orderkey == li.l_orderkey, "left")
         .join(med, o.o_orderkey == med.conv_id, "left")
         .join(cap, o.o_orderkey == cap.doc_id, "left"))
    meta = F.when(F.col("o_orderstatus") == "F", F.to_variant_object(F.struct(
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal").cast("bigint"))
        .alias("followersCount"),
        F.col("n_lines").cast("bigint").alias("postsCount"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("biography"),
        (F.col("c_mktsegment") == "BUILDING").alias("verified"),
        F.col("c_mktsegment").alias("businessCategoryName"),
        F.concat(F.lit("https://example.com/"), F.col("o_custkey").cast("string"))
        .alias("externalUrl"),
        F.array(F.format_string("Customer#%09d", F.col("o_custkey") + 1),
                F.format_string("Customer#%09d", F.col("o_custkey") + 2))
        .alias("relatedProfiles"),
    )))
    media_files = F.coalesce(F.col("media_files"), F.array().cast("array<string>"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("post_id"),
        F.concat(F.lit("sc"), F.col("o_orderkey").cast("string")).alias("shortcode"),
        F.concat(F.lit(POST_URL_PREFIX), F.col("o_orderkey").cast("string")).alias("url"),
        F.coalesce(F.col("caption"), F.lit("")).alias("caption"),
        F.col("o_custkey").cast("string").alias("owner_id"),
        F.coalesce(F.col("c_name"), F.lit("")).alias("owner_username"),
        F.floor("o_totalprice").cast("bigint").alias("likes_count"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("comments_count"),
        F.coalesce(F.col("qty"), F.lit(0.0)).cast("bigint").alias("video_play_count"),
        F.coalesce(F.col("r_qty"), F.lit(0.0)).cast("bigint").alias("video_view_count"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("hashtags"),
        meta.alias("meta_data"),
        F.coalesce(F.col("bait"), T.engagement_bait(F.lit(""))).alias("has_engagement_bait"),
        media_files.alias("media_files"),
        F.size(media_files).alias("media_count"),
        F.concat(F.lit("ds-"), F.substring("o_orderpriority", 1, 1)).alias("source_dataset"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("silvered_at"),
    )


def dim_profile(cat: Catalog) -> DataFrame:
    """Current profile rows from customer; profile_key assigned later."""
    c = cat.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return c.select(
        F.col("c_custkey").cast("string").alias("owner_id"),
        F.col("c_name").alias("owner_username"),
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal").cast("bigint")).alias("follower_count"),
        F.lit(None).cast("bigint").alias("posts_count_ig"),
        F.lit(None).cast("string").alias("bio"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_verified"),
        F.col("c_mktsegment").alias("profile_category"),
        F.lit(None).cast("string").alias("external_url"),
        F.lit(PROFILE_EPOCH).cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def resources(cat: Catalog, wanted: DataFrame) -> DataFrame:
    """Per order that ``wanted`` (r_orderkey) names the resource list {name, url,
    type, purpose} in line order (ties on the line number ordered by the resource
    values). Lines of other orders go before the part join."""
    li = cat.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    li = li.join(wanted, li.l_orderkey == wanted.r_orderkey, "left_semi")
    p = cat.part.select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    items = F.struct(F.col("l_linenumber").alias("ln"),
                     F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("url"),
                              F.col("p_type").alias("type"), F.lit("").alias("purpose"))
                     .alias("r"))
    g = j.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(items)).alias("items"))
    return g.select(F.col("l_orderkey").alias("r_orderkey"),
                    F.transform("items", lambda x: x["r"]).alias("resources"))


EDU_TYPE = ("struct<summary:string,workflow:array<struct<step:string,tool:string,detail:string>>,"
            "concepts:array<struct<term:string,explanation:string>>,"
            "principles:array<string>,techniques:array<string>>")


def gold_analyses(cat: Catalog) -> DataFrame:
    """documents LEFT JOIN labels: labelled -> analysed, else failed."""
    d = cat.documents.select("doc_id", "text", "lang", "source", "n_chars")
    lab = cat.labels.select(F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    res = resources(cat, d.select(F.col("doc_id").alias("r_orderkey")))
    j = (d.join(lab, d.doc_id == lab.l_doc_id, "left")
         .join(res, d.doc_id == res.r_orderkey, "left"))
    analysed = F.col("l_doc_id").isNotNull()
    is_edu = F.col("quality") == 1
    # A non-educational post carries an empty object: all fields NULL.
    edu = F.when(is_edu, F.struct(
        F.concat(F.col("lang"), F.lit(" text from "), F.col("source")).alias("summary"),
        F.array().cast("array<struct<step:string,tool:string,detail:string>>").alias("workflow"),
        F.array().cast("array<struct<term:string,explanation:string>>").alias("concepts"),
        F.array().cast("array<string>").alias("principles"),
        F.array().cast("array<string>").alias("techniques"))) \
        .otherwise(F.from_json(F.lit("{}"), EDU_TYPE))
    act = F.struct(
        F.concat(F.lit("use "), F.col("source")).alias("summary"),
        F.coalesce(F.col("resources"), F.array().cast(
            "array<struct<name:string,url:string,type:string,purpose:string>>")).alias("resources"),
        F.array().cast("array<string>").alias("tools"),
        F.array().cast("array<string>").alias("guides"),
        F.array().cast("array<struct<name:string,url:string>>").alias("downloads"))
    analysis = F.struct(
        is_edu.alias("is_educational"),
        (F.col("toxic") == 1).alias("is_actionable"),
        F.concat(F.substring(F.lit(ADMIRALTY_SOURCES),
                             (F.pmod(F.col("n_chars"), F.lit(6)) + 1).cast("int"), 1),
                 (F.pmod(F.col("doc_id"), F.lit(6)) + 1).cast("string")).alias("admirality"),
        F.col("source").alias("domain"),
        F.concat(F.col("source"), F.lit("/"), F.col("lang")).alias("subdomain"),
        F.col("lang").alias("topic"),
        F.when(F.col("n_chars") > 5000, "long").otherwise("short").alias("subtopic"),
        F.when(is_edu, "tutorial").otherwise("showcase").alias("content_type"),
        F.lit("minimal").alias("style"),
        F.when(F.col("n_chars") > 5000, "video").otherwise("carousel").alias("format"),
        edu.alias("educational_json"),
        act.alias("actionable_json"),
        F.col("text").alias("transcript"),
    )
    analysed_at = (F.lit(ANALYSIS_EPOCH).cast("timestamp_ntz")
                   + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id").cast("int")))
    return j.select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.when(analysed, "analysed").otherwise("failed").alias("status"),
        F.when(analysed, analysis).alias("result"),
        F.when(analysed, F.lit(None).cast("string")).otherwise(F.lit("gemini_failed")).alias("error"),
        F.lit(1).alias("attempts"),
        analysed_at.alias("analysed_at"),
    )


# Materialised star tables per (application, scale-factor dir): silver,
# gold and dimensions are stored tables in the medallion design, written once
# into the shared checkpoint folder and read by every view.
_STORED: dict[tuple[str, str], dict[str, str]] = {}


class Star:
    """The star tables of one scale-factor directory, stored on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = True):
        self.cat = Catalog(spark, sf_dir)
        self.spark = self.cat.spark
        self.stored = stored
        from ..session import app_key
        self._key = (app_key(self.spark), sf_dir)

    def _table(self, name: str, build) -> DataFrame:
        if not self.stored:
            return build()
        from ..session import shared_path, shuffles_dropped
        paths = _STORED.setdefault(self._key, {})
        if name not in paths:
            path = shared_path(self.spark, "star", name)
            table = build()
            with shuffles_dropped(self.spark):
                table.write.mode("overwrite").option("compression", "zstd").parquet(path)
            paths[name] = path
        return self.spark.read.parquet(paths[name])

    def posts(self) -> DataFrame:
        return self._table("silver_posts", lambda: silver_posts(self.cat))

    def profiles(self) -> DataFrame:
        from ..operators.numbering import with_row_number
        return self._table("dim_profile", lambda: with_row_number(
            dim_profile(self.cat), "owner_id", "profile_key"))

    def gold(self) -> DataFrame:
        return self._table("gold_analyses", lambda: gold_analyses(self.cat))

    def dim_time(self) -> DataFrame:
        return self._table("dim_time", lambda: dims.dim_time(self.posts()))
