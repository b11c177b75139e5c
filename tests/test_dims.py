"""Dimensions, SCD2 merge, details import, distributed numbering."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import dims as D
from tessera.operators.numbering import running_sum, with_row_number


def test_row_number_equals_global_window(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000)
                                     .alias("k"))
    got = with_row_number(df, "k", "rn", num_partitions=7)
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy("k")))
    bad = got.join(ref, "k").filter(F.col("rn") != F.col("rn2")).count()
    assert bad == 0 and got.agg(F.min("rn"), F.max("rn")).first() == (1, 5000)
    assert with_row_number(df, "k", "rn", start=100).agg(F.min("rn")).first()[0] == 101


def test_running_sum(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "k int, v double")
    got = {r.k: r.c for r in running_sum(df, ["k"], "v", "c", num_partitions=5).collect()}
    assert got[1] == 1.0 and got[10] == 55.0 and got[100] == 5050.0


def _details(spark, recs):
    lines = [json.dumps(r) for r in recs]
    df = spark.createDataFrame([(ln, i) for i, ln in enumerate(lines)], "line string, n long")
    return df.select(F.variant_get(F.parse_json("line"), "$", D.DETAILS_TYPE).alias("r"),
                     F.col("n").alias("line_no")).select("r.*", "line_no")


def test_details_import_rules(spark):
    recs = [{"id": "1", "username": "alice", "followersCount": 5000, "status": "ok"},
            {"id": "2", "username": "bob", "followersCount": 200},
            {"id": "3", "username": "gone", "ig_status": "not_found"},
            {"id": "4", "username": ""},
            {"id": None, "username": "nullid"},
            {"id": "1", "username": "alice", "followersCount": 6000}]
    staged, skipped = D.details_import(_details(spark, recs))
    got = {r.owner_id: r.follower_count for r in staged.collect()}
    assert got == {"1": 6000, "2": 200}
    assert {r.reason: r.records for r in skipped.collect()} == {"status": 1, "no_key": 2}


def test_scd2_merge_invariants(spark):
    dim = spark.createDataFrame(
        [(1, "1", "alice", None, ["x"], "2025-01-01", None, True),
         (2, "2", "bob", 10, [], "2025-01-01", None, True)],
        "profile_key bigint, owner_id string, owner_username string, follower_count bigint, "
        "related_profiles array<string>, f string, t string, is_current boolean") \
        .withColumn("effective_from", F.col("f").cast("timestamp_ntz")) \
        .withColumn("effective_to", F.col("t").cast("timestamp_ntz")).drop("f", "t")
    staged, _ = D.details_import(_details(spark, [
        {"id": "1", "username": "alice", "followersCount": 5000},
        {"id": "9", "username": "zed", "followersCount": 1}]))
    at = F.lit("2025-03-01 00:00:00").cast("timestamp_ntz")
    m = D.scd2_merge(dim, staged, at)
    rows = m.collect()
    cur = [r for r in rows if r.is_current]
    assert sorted(r.owner_id for r in cur) == ["1", "2", "9"]  # one current row per owner
    old = [r for r in rows if r.owner_id == "1" and not r.is_current][0]
    new = [r for r in cur if r.owner_id == "1"][0]
    assert old.effective_to == new.effective_from  # half-open intervals meet
    assert new.follower_count == 5000 and list(new.related_profiles) == ["x"]  # carried
    assert sorted(r.profile_key for r in cur) == [2, 3, 4]  # keys continue after MAX
    only_known = D.scd2_merge(dim, staged, at, restrict_to=dim)
    assert only_known.filter("owner_id = '9'").count() == 0


def test_details_reader_fails_on_bad_lines_and_missing_files(spark, tmp_path):
    import pytest
    from tessera.sources.details import read_details
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"id": 5, "username": "mill", "followersCount": 3}\n\n{"id": 5, "username": "mill", "followersCount": 4}\n')
    bad.write_text('{"id": 5}\n{"id": \n')
    staged, _ = D.details_import(read_details(spark, str(good)))
    assert [(r.owner_id, r.follower_count) for r in staged.collect()] == [("5", 4)]
    for path in (bad, tmp_path / "none.jsonl"):
        with pytest.raises(Exception):
            read_details(spark, str(path)).collect()
