"""Gold-table operators: success/failure upserts (M3, M4), archive history
(M9, W9, P21), credibility decode (P22), contract checks (P23), v2 -> v3
document upgrade (P28) and the document sink/scan (S10, S11)."""

from __future__ import annotations

import functools
import operator
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import credibility as C
from ..functions.text import alnum_only
from ..schemas import GOLD_DDL
from .upsert import BucketedTable

# ---- fixed values (must equal the reference behaviour) -------------------
RESOURCE_TYPES = ["tool", "site", "repo", "library", "framework", "course", "book", "font",
                  "template", "asset", "newsletter", "community", "other"]
STRINGS = ["admirality", "domain", "subdomain", "topic", "subtopic", "content_type", "style", "format", "transcript"]
# ---------------------------------------------------------------------------


def with_documents(gold: DataFrame) -> DataFrame:
    """Gold with the original result document beside the typed result, as a
    VARIANT that keeps fields outside the contract. Rows stored without one get
    the document of their typed result; rows without a result have none."""
    return gold.withColumn("document", F.try_parse_json(F.to_json("result")))


def apply_run(gold: DataFrame, results: DataFrame, as_of: Column,
              schema_version: int = 3) -> DataFrame:
    """Merge one enrichment run into gold (set-based upsert by post_id).

    success (M3): status 'analysed', new result, error NULL, attempts =
    previous + 1 (1 when new); failure (M4): status 'failed', error
    'gemini_failed', attempts = previous + 1, previous result kept. Where gold
    has documents (``with_documents``) a success stores the text it came as."""
    upd = updates(gold, results, as_of, schema_version)
    keep = gold.join(results.select("post_id"), "post_id", "left_anti")
    return upd.unionByName(keep.select(*upd.columns))


def updates(gold: DataFrame, results: DataFrame, as_of: Column, schema_version: int = 3) -> DataFrame:
    """The rows of ``apply_run`` that the run's results make."""
    rtype = gold.schema["result"].dataType
    documents = ["document"] if "document" in gold.columns else []
    results = results.withColumn("result", F.from_json("result_json", rtype))
    old = gold.select("post_id", F.col("attempts").alias("_a"), F.col("result").alias("_r"),
                      F.col("schema_version").alias("_v"), *[F.col(c).alias("_d") for c in documents])
    j = results.join(old, "post_id", "left")
    ok = F.col("status") == "analysed"
    return j.select(
        "post_id",
        F.when(ok, F.lit(schema_version)).otherwise(F.coalesce("_v", F.lit(schema_version)))
        .alias("schema_version"),
        "status",
        F.when(ok, F.col("result")).otherwise(F.col("_r")).alias("result"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.col("error")).alias("error"),
        (F.coalesce(F.col("_a"), F.lit(0)) + 1).cast("int").alias("attempts"),
        as_of.cast("timestamp_ntz").alias("analysed_at"),
        *[F.when(ok, F.try_parse_json("result_json")).otherwise(F.col("_d")).alias(c) for c in documents])


def superseded(gold: DataFrame, results: DataFrame) -> DataFrame:
    """The documents that a run's successes replace, as they were."""
    done = results.filter(F.col("status") == "analysed").select("post_id")
    return gold.filter(F.col("result").isNotNull()).join(done, "post_id", "left_semi")


class GoldStore:
    """Gold table and its history in shared storage. A run first appends the
    documents it replaces to the history, then upserts; the run's number makes
    a repeated append after a failure recognisable."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.gold = BucketedTable(spark, os.path.join(root, "gold"), "post_id", buckets, GOLD_DDL)
        self.archive = BucketedTable(spark, os.path.join(root, "gold_history"), "version_id", buckets, appends=True)

    def run(self, results: DataFrame, as_of: Column, seq: int) -> None:
        old = self.gold.read()
        gone = superseded(old, results).select(
            F.concat_ws("/", "post_id", F.lit(str(seq))).alias("version_id"), F.lit(seq).alias("seq"), "*")
        self.archive.upsert(gone, as_of=as_of, keep_first=())
        failed = results.filter(F.coalesce(F.col("status") != "analysed", F.lit(True)))
        if failed.isEmpty():  # only a failure keeps what was stored: no document goes through the join
            old = old.withColumns({c: F.lit(None).cast(old.schema[c].dataType) for c in ("result", "document") if c in old.columns})
        self.gold.upsert(updates(old, results, as_of), as_of=as_of, keep_first=())

    def history(self) -> DataFrame | None:
        return self.archive.read()


def archive_key(version: Column, analysed_at_text: Column) -> Column:
    """analysis_v{ver}_{first 15 alphanumerics of analysed_at}."""
    ts = F.substring(alnum_only(analysed_at_text), 1, 15)
    return F.concat(F.lit("analysis_v"), F.coalesce(version.cast("string"), F.lit("x")),
                    F.lit("_"), ts)


def archive_names(history: DataFrame) -> DataFrame:
    """Archive file names with collision suffixes _1, _2 ... in archival
    order (``seq``) per post. The window is per (post, key): bounded by the
    number of versions of one post."""
    k = history.withColumn("archive_key", archive_key(F.col("schema_version"),
                                                      F.col("analysed_at_text")))
    w = Window.partitionBy("post_id", "archive_key").orderBy("seq")
    n = F.row_number().over(w) - 1
    return k.withColumn("archive_name", F.concat(
        F.col("archive_key"), F.when(n > 0, F.concat(F.lit("_"), n.cast("string")))
        .otherwise(F.lit("")), F.lit(".json")))


def credibility(gold_analysed: DataFrame) -> DataFrame:
    """Decode the two-character code."""
    a = F.col("result.admirality")
    return gold_analysed.select(
        "post_id", a.alias("admirality"), C.is_valid(a).alias("valid"),
        C.source_label(a).alias("source_label"), C.information_label(a).alias("information_label"),
        C.is_high_confidence(a).alias("high_confidence"))


def violations(gold_analysed: DataFrame) -> DataFrame:
    """One row per (post, broken rule) of the analysis contract."""
    a = F.col("result")
    edu, act = a["educational_json"], a["actionable_json"]
    edu_filled = (F.coalesce(edu["summary"], F.lit("")) != "") | \
        (F.coalesce(F.size(edu["workflow"]), F.lit(0)) > 0) | \
        (F.coalesce(F.size(edu["concepts"]), F.lit(0)) > 0)
    act_filled = (F.coalesce(act["summary"], F.lit("")) != "") | \
        (F.coalesce(F.size(act["resources"]), F.lit(0)) > 0)
    bad_types = F.filter(F.coalesce(act["resources"], F.array()),
                         lambda r: ~F.coalesce(r["type"].isin(RESOURCE_TYPES), F.lit(False)))
    rules = [
        ("admirality_format", ~C.is_valid(a["admirality"])),
        ("educational_without_flag", ~F.coalesce(a["is_educational"], F.lit(False)) & edu_filled),
        ("actionable_without_flag", ~F.coalesce(a["is_actionable"], F.lit(False)) & act_filled),
        ("missing_flag", a["is_educational"].isNull() | a["is_actionable"].isNull()),
        ("resource_type_unknown", F.size(bad_types) > 0),
        ("missing_string", functools.reduce(operator.or_, [a[f].isNull() for f in STRINGS])),
    ]
    arr = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules])
    return gold_analysed.select("post_id", F.explode(F.filter(arr, lambda x: x.isNotNull()))
                                .alias("rule"))


V3_EDU = ("struct<summary:string,workflow:array<struct<step:string,tool:string,detail:string>>,"
          "concepts:array<struct<term:string,explanation:string>>,"
          "principles:array<string>,techniques:array<string>>")


def upgrade_v2(docs: DataFrame) -> DataFrame:
    """v2 documents -> v3 shape: workflow_steps -> educational_json.
    workflow, concepts -> educational_json.concepts, tools_apps ->
    actionable_json.tools; fields without a successor are dropped."""
    d = F.col("doc")
    edu = F.struct(F.lit("").alias("summary"), d["workflow_steps"].alias("workflow"),
                   d["concepts"].alias("concepts"),
                   F.array().cast("array<string>").alias("principles"),
                   F.array().cast("array<string>").alias("techniques"))
    act = F.struct(F.lit("").alias("summary"),
                   F.array().cast("array<struct<name:string,url:string,type:string,"
                                  "purpose:string>>").alias("resources"),
                   d["tools_apps"].alias("tools"),
                   F.array().cast("array<string>").alias("guides"),
                   F.array().cast("array<struct<name:string,url:string>>").alias("downloads"))
    v3 = F.struct(d["is_educational"].alias("is_educational"),
                  F.lit(None).cast("boolean").alias("is_actionable"),
                  d["content_type"].alias("content_type"), edu.alias("educational_json"),
                  act.alias("actionable_json"))
    return docs.select("post_id", F.when(F.col("schema_version") == 2, F.lit(3))
                       .otherwise(F.col("schema_version")).alias("schema_version"),
                       F.when(F.col("schema_version") == 2, v3).alias("analysis"))


def document(gold: DataFrame, posts: DataFrame) -> DataFrame:
    """{post_id, url, schema_version, analysed_at, analysis} per analysed post."""
    g = gold.filter(F.col("status") == "analysed")
    j = g.join(posts.select("post_id", "url"), "post_id")
    return j.select("post_id", "url", "schema_version",
                    F.date_format("analysed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("analysed_at"),
                    F.col("result").alias("analysis"))
