"""Registered queries: enrichment harness and gold documents (E1-E8, M3, M4,
M9, W9, P21-P23, P28, S10, S11)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.media import select_media
from ..operators import enrich as EN
from ..operators import gold as G
from ..operators.queue import pending, pending_for_ids
from ..session import shared_path
from . import views as V
from .registry import query
from .star import Star

RUN_AT = "2025-04-01 00:00:00"


def deterministic_enricher(post: dict) -> str:
    """A stand-in model: derives the analysis from caption and media.
    Empty posts are 'unavailable' every time; some captions hit the rate
    limit every time; some return bad JSON once."""
    cap = post.get("caption") or ""
    media = post.get("media") or []
    n = len(cap)
    if not cap and not media:
        raise EN.Unavailable("no content")
    if n % 11 == 4:
        raise EN.RateLimited("quota")
    if n % 5 == 1 and post.get("_attempt", 1) == 1:
        return "{not json"
    return json.dumps({
        "is_educational": n > 2000, "is_actionable": bool(media), "admirality": "C3",
        "domain": "media" if media else "text", "subdomain": "",
        "topic": "long" if n > 1000 else "short", "subtopic": "", "content_type": "post",
        "style": "", "format": "carousel" if len(media) > 1 else ("single" if media else "text"),
        "educational_json": {}, "actionable_json": {}, "transcript": ""})


def _queue(s, ids=None):
    posts = s.posts().select("post_id", "url", "caption",
                             select_media(F.col("media_files")).alias("media"))
    if ids is None:
        return pending(posts, s.gold())
    return pending_for_ids(posts, s.gold(), ids).join(posts.drop("url"), "post_id")


def _run(spark, s, ids=None):
    return EN.enrich(_queue(s, ids), deterministic_enricher, partitions=8)


@query("enrich_deterministic")
def q_enrich_deterministic(spark, sf_dir):
    r = _run(spark, Star(spark, sf_dir))
    return r.select("post_id", "status", "attempts",
                    F.get_json_object("result_json", "$.domain").alias("domain"),
                    F.get_json_object("result_json", "$.topic").alias("topic"),
                    F.get_json_object("result_json", "$.format").alias("format"))


@query("enrich_summary")
def q_enrich_summary(spark, sf_dir):
    return EN.summary(_run(spark, Star(spark, sf_dir)))


def _after_retry(spark, sf_dir):
    """Retry the failed analyses (E6) and merge the run into gold."""
    s = Star(spark, sf_dir)
    gold = s.gold()
    failed_ids = gold.filter(F.col("status") == "failed").select("post_id")
    results = _run(spark, s, failed_ids)
    return G.apply_run(gold, results, F.lit(RUN_AT))


@query("gold_failure_attempts")
def q_gold_failure_attempts(spark, sf_dir):
    g = _after_retry(spark, sf_dir).filter(F.col("status") == "failed")
    return g.select("post_id", "status", "attempts", "error",
                    F.col("result").isNotNull().alias("has_result"))


@query("gold_success")
def q_gold_success(spark, sf_dir):
    g = _after_retry(spark, sf_dir).filter(F.col("status") == "analysed")
    return g.select("post_id", "attempts", "error", "analysed_at",
                    F.col("result.domain").alias("domain"))


@query("analysis_history_versions")
def q_analysis_history_versions(spark, sf_dir):
    """Three re-analyses of every analysed post, the last two at one instant:
    each run archives the documents it replaces before it overwrites them.
    The results are the stored documents themselves, sent again."""
    store = G.GoldStore(spark, shared_path(spark, "gold"))
    first = V.analysed(Star(spark, sf_dir).gold())
    store.gold.upsert(first, as_of=F.lit(RUN_AT), keep_first=())
    results = first.select("post_id", F.lit("analysed").alias("status"),
                           F.to_json("result").alias("result_json"), F.lit(None).cast("string").alias("error"))
    for seq in range(3):
        store.run(results, F.lit(RUN_AT), seq)
    h = store.history().select("post_id", "schema_version", "seq",
                               F.date_format("analysed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("analysed_at_text"))
    return G.archive_names(h).select("post_id", "seq", "archive_name")


@query("fact_post_documents")
def q_fact_post_documents(spark, sf_dir):
    """Analyses sent again with fields outside the contract, which the
    stored documents keep and the fact returns. The results are the stored ones
    with a ``reading`` object added."""
    s = Star(spark, sf_dir)
    store = G.GoldStore(spark, shared_path(spark, "gold"))
    store.gold.upsert(G.with_documents(s.gold()), as_of=F.lit(RUN_AT), keep_first=())
    reading = F.struct(F.char_length("result.transcript").alias("chars"), F.col("result.topic").alias("language"))
    results = V.analysed(s.gold()).select("post_id", F.lit("analysed").alias("status"),
                                          F.to_json(F.struct("result.*", reading.alias("reading"))).alias("result_json"), F.lit(None).cast("string").alias("error"))
    store.run(results, F.lit(RUN_AT), 0)
    fact = V.fact_post(s.posts(), s.profiles(), s.dim_time(), store.gold.read())
    return fact.select("post_id", "domain", F.get_json_object("result_json", "$.analysis.domain").alias("document_domain"),
                       F.get_json_object("result_json", "$.analysis.reading.chars").cast("bigint").alias("reading_chars"),
                       F.get_json_object("result_json", "$.analysis.reading.language").alias("reading_language"))


@query("archive_key")
def q_archive_key(spark, sf_dir):
    g = V.analysed(Star(spark, sf_dir).gold())
    t = F.date_format("analysed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return g.select("post_id", G.archive_key(F.col("schema_version"), t).alias("archive_key"))


@query("credibility_filter")
def q_credibility_filter(spark, sf_dir):
    c = G.credibility(V.analysed(Star(spark, sf_dir).gold()))
    return c.filter(F.col("high_confidence"))


@query("credibility_decode")
def q_credibility_decode(spark, sf_dir):
    return G.credibility(V.analysed(Star(spark, sf_dir).gold()))


@query("analysis_violations")
def q_analysis_violations(spark, sf_dir):
    return G.violations(V.analysed(Star(spark, sf_dir).gold()))


V2_TYPE = ("struct<is_educational:boolean,value_score:int,content_type:string,"
           "workflow_steps:array<struct<step:string,tool:string,detail:string>>,"
           "concepts:array<struct<term:string,explanation:string>>,tools_apps:array<string>>")


@query("doc_upgrade_v2_v3")
def q_doc_upgrade_v2_v3(spark, sf_dir):
    """v2 documents built from the analyses, upgraded to the v3 shape."""
    g = V.analysed(Star(spark, sf_dir).gold())
    a = F.col("result")
    v2 = F.struct(
        a["is_educational"].alias("is_educational"),
        F.lit(5).alias("value_score"), a["content_type"].alias("content_type"),
        F.array(F.struct(F.lit("read").alias("step"), a["domain"].alias("tool"),
                         a["topic"].alias("detail"))).alias("workflow_steps"),
        F.array(F.struct(a["topic"].alias("term"), a["domain"].alias("explanation")))
        .alias("concepts"),
        F.transform(a["actionable_json"]["resources"], lambda r: r["name"]).alias("tools_apps"))
    docs = g.select("post_id", F.lit(2).alias("schema_version"), v2.alias("doc"))
    up = G.upgrade_v2(docs)
    e = F.col("analysis.educational_json")
    return up.select("post_id", "schema_version",
                     F.size(e["workflow"]).alias("n_workflow"),
                     e["workflow"][0]["tool"].alias("first_tool"),
                     F.size(e["concepts"]).alias("n_concepts"),
                     F.col("analysis.actionable_json.tools").alias("tools"))


@query("gold_documents_roundtrip")
def q_gold_documents_roundtrip(spark, sf_dir):
    """S10 -> S11: write the documents as JSON, scan them back by glob with
    the document schema."""
    s = Star(spark, sf_dir)
    docs = G.document(s.gold(), s.posts())
    path = shared_path(spark, "gold_docs")
    docs.withColumn("bucket", F.pmod(F.xxhash64("post_id"), F.lit(16))) \
        .write.partitionBy("bucket").json(path)
    back = spark.read.schema(docs.schema).json(path + "/bucket=*/*.json")
    return back.select("post_id", "url", "schema_version", "analysed_at",
                       F.col("analysis.domain").alias("domain"),
                       F.size("analysis.actionable_json.resources").alias("n_resources"),
                       F.col("analysis.educational_json.summary").alias("edu_summary"))
