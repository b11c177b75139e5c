"""The enrichment queue against a plain version, attempts, gold runs, history names, documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import enrich as EN
from tessera.operators import gold as G
from tessera.operators.queue import pending_for_ids, pending_queue
from tessera.schemas import ANALYSIS_DDL


def _gold(spark, rows):
    return spark.createDataFrame(rows, "post_id string, schema_version int, status string, "
                                       "j string, error string, attempts int") \
        .withColumn("result", F.from_json("j", ANALYSIS_DDL)).drop("j") \
        .withColumn("analysed_at", F.lit(None).cast("timestamp_ntz"))


def test_queue_agrees_with_a_plain_version(spark):
    """Random posts and gold states: what is queued, newest first, and cut to a length."""
    rnd = random.Random(17)
    posts = [(f"x{i:02d}", f"https://boats.example/{i}", 60 * rnd.randrange(1000) + i) for i in range(40)]
    states = [(p, 3, *rnd.choice([("analysed", "{}", None), ("failed", None, "no answer")]), rnd.randrange(1, 5)) for p, _, _ in posts if rnd.random() < 0.6]
    df = spark.createDataFrame(posts, "post_id string, url string, s long").withColumn("silvered_at", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    gold = _gold(spark, states)
    analysed = {r[0] for r in states if r[2] == "analysed"}
    waiting = [p for p, _, _ in sorted(posts, key=lambda r: -r[2]) if p not in analysed]
    assert 0 < len(analysed) and len(waiting) < len(posts)
    for n in (None, 0, 1, 7, 100):
        assert [r.post_id for r in pending_queue(df, gold, n).collect()] == waiting[:n]
    asked = [p for p, _, _ in posts[::3]] + ["unknown"]
    got = pending_for_ids(df, gold, spark.createDataFrame([(p,) for p in asked], "post_id string"))
    assert sorted(r.post_id for r in got.collect()) == sorted(set(asked) & set(waiting))
    assert pending_queue(df.limit(0), gold).count() == 0


def test_attempts():
    def flaky(post):
        if post["_attempt"] < 3:
            raise EN.Unavailable()
        return json.dumps({"domain": "x"})

    def always(post):
        raise EN.RateLimited()

    def broken(post):
        raise ValueError("no such field")

    assert EN.attempt(flaky, {"post_id": "p"}) == ({"domain": "x"}, 3)
    assert EN.attempt(always, {}) == (None, 4)
    assert EN.attempt(lambda post: "{oops" if post["_attempt"] == 1 else "{}", {}) == ({}, 2)
    assert EN.attempt(broken, {}) == (None, 1)


def test_overwritten_documents_go_to_the_history(spark, tmp_path):
    store = G.GoldStore(spark, str(tmp_path / "gold"), buckets=2)
    first = _gold(spark, [("a", 3, "analysed", '{"domain": "one"}', None, 1), ("b", 3, "analysed", '{"domain": "two"}', None, 1),
                          ("c", 3, "failed", None, "timeout", 1)])
    store.gold.upsert(first, as_of=F.lit("2024-01-01"), keep_first=())
    results = spark.createDataFrame([("a", "analysed", '{"domain": "new"}', None), ("b", "failed", None, "gemini_failed"),
                                     ("c", "analysed", '{"domain": "late"}', None)], "post_id string, status string, result_json string, error string")
    store.run(results, F.lit("2024-02-02"), 0)
    assert [(r.post_id, r.result.domain) for r in store.history().collect()] == [("a", "one")]
    now = {r.post_id: (r.status, r.result.domain, r.attempts) for r in store.gold.read().collect()}
    assert now == {"a": ("analysed", "new", 2), "b": ("failed", "two", 2), "c": ("analysed", "late", 2)}
    store.run(results.filter("post_id = 'a'"), F.lit("2024-03-03"), 1)
    assert sorted((r.seq, r.result.domain) for r in store.history().collect()) == [(0, "one"), (1, "new")]


def test_documents_keep_fields_outside_the_contract(spark, tmp_path):
    store = G.GoldStore(spark, str(tmp_path / "gold"), buckets=2)
    first = _gold(spark, [("a", 3, "analysed", '{"domain": "one"}', None, 1), ("b", 3, "analysed", '{"domain": "two"}', None, 1)])
    store.gold.upsert(G.with_documents(first), as_of=F.lit("2024-01-01"), keep_first=())
    results = spark.createDataFrame([("a", "analysed", '{"domain": "new", "mood": {"calm": [1, 2]}}', None), ("b", "failed", None, "timeout")],
                                    "post_id string, status string, result_json string, error string")
    store.run(results, F.lit("2024-02-02"), 0)
    got = {r.post_id: (r.domain, r.calm, r.told) for r in store.gold.read().select(
        "post_id", "result.domain", F.try_variant_get("document", "$.mood.calm[1]", "int").alias("calm"),
        F.try_variant_get("document", "$.domain", "string").alias("told")).collect()}
    assert got == {"a": ("new", 2, "new"), "b": ("two", None, "two")}
    assert [r.told for r in store.history().select(F.try_variant_get("document", "$.domain", "string").alias("told")).collect()] == ["one"]
    with pytest.raises(ValueError):
        store.gold.upsert(first, as_of=F.lit("2024-03-03"), keep_first=())


def test_enrich_and_apply_run(spark):
    q = spark.createDataFrame([("p1", "u", "cap", ["a.jpg"]), ("p2", "u", "", [])],
                              "post_id string, url string, caption string, media array<string>")

    def enricher(post):
        if not post["caption"]:
            raise EN.Unavailable()
        return json.dumps({"domain": "d", "topic": "t"})

    res = EN.enrich(q, enricher, partitions=2)
    got = {r.post_id: (r.status, r.attempts, r.error) for r in res.collect()}
    assert got == {"p1": ("analysed", 1, None), "p2": ("failed", 4, "gemini_failed")}
    gold = _gold(spark, [("p1", 2, "failed", None, "timeout", 1),
                         ("p2", 2, "failed", None, "timeout", 1),
                         ("p3", 3, "analysed", '{"domain": "keep"}', None, 1)])
    merged = {r.post_id: r for r in G.apply_run(gold, res, F.lit("2025-04-01")).collect()}
    assert (merged["p1"].status, merged["p1"].attempts, merged["p1"].error) == ("analysed", 2, None)
    assert merged["p1"].result.domain == "d"
    assert (merged["p2"].status, merged["p2"].attempts, merged["p2"].error) == \
        ("failed", 2, "gemini_failed")
    assert merged["p3"].result.domain == "keep" and merged["p3"].attempts == 1


def test_archive_names(spark):
    h = spark.createDataFrame([("p", 3, 0, "2025-06-01T01:42:00Z"),
                               ("p", 3, 1, "2025-06-02T00:00:00Z"),
                               ("p", 3, 2, "2025-06-02T00:00:00Z"),
                               ("q", None, 0, "2025-06-02T00:00:00Z")],
                              "post_id string, schema_version int, seq int, analysed_at_text string")
    got = sorted((r.post_id, r.seq, r.archive_name) for r in G.archive_names(h).collect())
    assert got == [("p", 0, "analysis_v3_20250601T014200.json"),
                   ("p", 1, "analysis_v3_20250602T000000.json"),
                   ("p", 2, "analysis_v3_20250602T000000_1.json"),
                   ("q", 0, "analysis_vx_20250602T000000.json")]


def test_contract_checks(spark):
    whole = {"is_educational": False, "is_actionable": True, "admirality": "B2", "transcript": "", "actionable_json": {"resources": [{"name": "n", "type": "tool"}]},
             **{f: "v" for f in ("domain", "subdomain", "topic", "subtopic", "content_type", "style", "format")}}
    broken = {"whole": {}, "no_subtopic": {"subtopic": None}, "no_subdomain": {"subdomain": None}, "no_flag": {"is_actionable": None},
              "no_type": {"actionable_json": {"resources": [{"name": "n"}]}}, "code": {"admirality": "Z9"},
              "unflagged": {"educational_json": {"summary": "s"}}}
    gold = _gold(spark, [(k, 3, "analysed", json.dumps(whole | v), None, 1) for k, v in broken.items()])
    assert {(r.post_id, r.rule) for r in G.violations(gold).collect()} == {
        ("no_subtopic", "missing_string"), ("no_subdomain", "missing_string"), ("no_flag", "missing_flag"), ("no_flag", "actionable_without_flag"),
        ("no_type", "resource_type_unknown"), ("code", "admirality_format"), ("unflagged", "educational_without_flag")}
